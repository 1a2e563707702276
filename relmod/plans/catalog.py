"""Query catalogue: (spark, sf_dir) -> DataFrame, each with its DuckDB oracle SQL.

Every query reads the test tables of ``sf_dir`` in full. Doubles are rounded to
6 decimals on both sides so that summation-order noise cannot show.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relmod.functions import text as T
from relmod.operators import evaluate as ev
from relmod.operators import expansion as ex
from relmod.operators import feedback as fb
from relmod.operators import local_context as lc
from relmod.operators import local_vectors as lv
from relmod.operators.lm import CandidateModels, query_term_freq
from relmod.operators.ordering import last_wins
from relmod.functions.english import english_stems_sql
from relmod.functions.stems import stem_lexicon as stem_table
from relmod.functions.stems import stemmed_tokens, text_words
from relmod.params import Params, TextOptions
from relmod.plans import oracle as O
from relmod.plans import pipelines as P
from relmod.session import materialize
from relmod.sources import fixtures as X
from relmod.sources import textfiles as TF

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

DIGITS = 6


def r6(c) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, DIGITS)


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return deco


def _models(spark, sf_dir, fields=P.FEEDBACK_FIELDS, params=Params(), fx=None):
    fx = fx or X.Fixtures(spark, sf_dir)
    qs = fx.queries()
    cands = fx.candidates().join(qs.select("qid"), "qid", "left_semi")
    return qs, CandidateModels(cands, fx.collection(), fields, params)


# ---------------------------------------------------------------------------
# text chain (SCL-1..7, PRJ-1)
# ---------------------------------------------------------------------------
@register(
    "preprocess_text",
    f"SELECT doc_id, {O.preprocess_sql('text')} AS text_clean FROM documents",
)
def preprocess_text(spark, sf_dir):
    return X.table(spark, sf_dir, "documents").select("doc_id", T.preprocess("text").alias("text_clean"))


@register(
    "tokens",
    O.with_ctes(
        "SELECT doc_id, CAST(i AS INTEGER) AS pos, tokens[i] AS term FROM"
        " (SELECT doc_id, tokens, unnest(range(1, len(tokens) + 1)) AS i FROM dtok)",
        "dtok",
    ),
)
def tokens(spark, sf_dir):
    d = X.doc_tokens(spark, sf_dir)
    return d.select("doc_id", F.posexplode("tokens").alias("pos", "term")).select(
        "doc_id", (F.col("pos") + 1).cast("int").alias("pos"), "term"
    )


SWITCHES = ("lowercase", "punctuation", "digits", "stopwords")


@register("tokens_no_stop", f"SELECT doc_id, CAST(len({O.tokens_sql('text', 'stopwords')}) AS BIGINT) AS n_tokens FROM documents")
def tokens_no_stop(spark, sf_dir):
    opts = TextOptions(stopwords=False)
    d = X.table(spark, sf_dir, "documents")
    return d.select("doc_id", F.size(T.tokens("text", opts)).cast("long").alias("n_tokens"))


@register(
    "text_switches",
    " UNION ALL ".join(
        f"SELECT doc_id, '{off}' AS off, array_to_string({O.tokens_sql('text', off)}, ' ') AS text FROM documents" for off in SWITCHES
    ),
)
def text_switches(spark, sf_dir):
    """SCL-7: the chain with each switch off in turn (stemming is off everywhere; see ``stemmed_documents``)."""
    d = X.table(spark, sf_dir, "documents")
    kinds = F.array(
        *[
            F.struct(F.lit(off).alias("off"), F.array_join(T.tokens("text", TextOptions(**{off: False})), " ").alias("text"))
            for off in SWITCHES
        ]
    )
    return d.select("doc_id", F.explode(kinds).alias("x")).select("doc_id", "x.off", "x.text")


_TITLE_RE = r"<title[^>]*>([^<]*)</title>"


_TAG_RE = "<[^>]*>"


@register(
    "page_fields_concat",
    "SELECT page_id, array_to_string("
    + O.tokens_sql(
        f"concat_ws(' ', coalesce(url, ''), coalesce(regexp_extract(html, '{_TITLE_RE}', 1), ''),"
        f" regexp_replace(coalesce(html, ''), '{_TAG_RE}', ' ', 'g'))"
    )
    + ", ' ') AS text FROM pages",
)
def page_fields_concat(spark, sf_dir):
    """PRJ-1 over ``pages``: url, title (the <title> element) and body (the html without tags), through the whole chain."""
    pg = X.table(spark, sf_dir, "pages")
    body = F.regexp_replace(F.coalesce("html", F.lit("")), _TAG_RE, " ")
    txt = T.fields_text("url", F.regexp_extract("html", _TITLE_RE, 1), body)
    return pg.select("page_id", F.array_join(T.tokens(txt), " ").alias("text"))


# ---------------------------------------------------------------------------
# document and background models
# ---------------------------------------------------------------------------
@register(
    "term_freq",
    O.with_ctes(
        "SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(tokens) AS term FROM dtok)"
        " GROUP BY doc_id, term",
        "dtok",
    ),
)
def term_freq(spark, sf_dir):
    from relmod.operators.lm import doc_term_freq

    return doc_term_freq(X.doc_tokens(spark, sf_dir))


@register(
    "doc_length",
    O.with_ctes("SELECT doc_id, CAST(len(tokens) AS BIGINT) AS doc_len FROM dtok", "dtok"),
)
def doc_length(spark, sf_dir):
    from relmod.operators.lm import doc_lengths

    return doc_lengths(X.doc_tokens(spark, sf_dir))


@register(
    "candidates",
    O.with_ctes("SELECT qid, doc_id, score, pos FROM cand", "cand"),
)
def candidates(spark, sf_dir):
    return X.candidates(spark, sf_dir)


@register(
    "qrels",
    O.with_ctes("SELECT qid, doc_id, relevance FROM qrels", "qrels"),
)
def qrels(spark, sf_dir):
    return X.qrels(spark, sf_dir)


@register(
    "collection_semi",
    O.with_ctes("SELECT DISTINCT d.doc_id FROM documents d SEMI JOIN cand c ON c.doc_id = d.doc_id", "cand"),
)
def collection_semi(spark, sf_dir):
    from relmod.operators.lm import candidate_documents

    return candidate_documents(X.candidates(spark, sf_dir), X.collection(spark, sf_dir)).select("doc_id")


@register(
    "candidate_join",
    O.with_ctes(
        "SELECT c.qid, count(DISTINCT c.doc_id) AS n_docs,"
        " count(DISTINCT CASE WHEN d.doc_id IS NULL THEN c.doc_id END) AS n_missing"
        " FROM q JOIN cand c USING (qid) LEFT JOIN documents d ON d.doc_id = c.doc_id GROUP BY c.qid",
        "q",
        "cand",
    ),
)
def candidate_join(spark, sf_dir):
    """JOIN-2, 3, AGG-3, 22: per query, distinct candidate documents and how many are missing."""
    qs = X.queries(spark, sf_dir)
    cand = X.candidates(spark, sf_dir).join(qs.select("qid"), "qid")
    docs = X.collection(spark, sf_dir).select("doc_id", F.lit(True).alias("found"))
    j = cand.select("qid", "doc_id").distinct().join(docs, "doc_id", "left")
    return j.groupBy("qid").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count(F.when(F.col("found").isNull(), 1)).alias("n_missing"),
    )


@register(
    "candidate_list",
    O.with_ctes("SELECT qid, pos, doc_id FROM cand", "cand"),
)
def candidate_list(spark, sf_dir):
    """AGG-4 / WIN-3: candidate lists in their stored order."""
    return X.candidates(spark, sf_dir).select("qid", "pos", "doc_id")


@register(
    "background_lm",
    O.with_ctes("SELECT qid, term, cf, round(p_bg, 6) AS p_bg FROM bg", "bg"),
)
def background_lm(spark, sf_dir):
    _, m = _models(spark, sf_dir)
    return m.bg.select("qid", "term", "cf", r6("p_bg").alias("p_bg"))


@register(
    "dirichlet_prob",
    O.with_ctes("SELECT qid, doc_id, term, round(p, 6) AS p FROM dprob", "dprob"),
)
def dirichlet_prob(spark, sf_dir):
    _, m = _models(spark, sf_dir)
    return m.term_probs().select("qid", "doc_id", "term", r6("p").alias("p"))


@register(
    "query_histogram",
    O.with_ctes("SELECT qid, term, qtf FROM qtf", "qtf"),
)
def query_histogram(spark, sf_dir):
    return query_term_freq(X.queries(spark, sf_dir))


@register(
    "oov_tokens",
    O.with_ctes(
        "SELECT qid, term, qtf FROM qtf WHERE qid IN (SELECT qid FROM cset)"
        " AND NOT EXISTS (SELECT 1 FROM bg WHERE bg.qid = qtf.qid AND bg.term = qtf.term)",
        "qtf",
        "bg",
        "cset",
    ),
)
def oov_tokens(spark, sf_dir):
    qs, m = _models(spark, sf_dir)
    qtf = query_term_freq(qs).join(m.cset.select("qid").distinct(), "qid", "left_semi")
    return fb.oov_tokens(qtf, m)


@register(
    "query_likelihood",
    O.with_ctes("SELECT qid, doc_id, round(ll, 6) AS ll, round(w, 6) AS w FROM lw", "lw"),
)
def query_likelihood(spark, sf_dir):
    qs, m = _models(spark, sf_dir)
    lik = fb.query_likelihood(query_term_freq(qs), m)
    return lik.select("qid", "doc_id", r6("ll").alias("ll"), r6("w").alias("w"))


@register(
    "feedback_model",
    O.with_ctes("SELECT qid, term, round(p_rm, 6) AS p_rm FROM prm", "prm"),
)
def feedback_model(spark, sf_dir):
    """AGG-10 over the whole vocabulary of every query."""
    qs, m = _models(spark, sf_dir)
    p_rm = fb.feedback_model(fb.query_likelihood(query_term_freq(qs), m), m)
    return p_rm.select("qid", "term", r6("p_rm").alias("p_rm"))


@register(
    "rerank_feedback",
    O.with_ctes("SELECT qid, doc_id, rank, round(score, 6) AS score FROM run_a", "run_a"),
)
def rerank_feedback(spark, sf_dir):
    run = P.rerank_feedback(X.queries(spark, sf_dir), X.candidates(spark, sf_dir), X.collection(spark, sf_dir))
    return run.select("qid", "doc_id", "rank", r6("score").alias("score"))


# ---------------------------------------------------------------------------
# embedding expansion (ML-2, ML-3) and Score B (PIPE-2/3)
# ---------------------------------------------------------------------------
@register(
    "query_centroid",
    O.with_ctes("SELECT qid, CAST(i - 1 AS INTEGER) AS pos, round(s, 6) AS value FROM cent", "cent"),
)
def query_centroid(spark, sf_dir):
    c = ex.centroids(query_term_freq(X.queries(spark, sf_dir)), X.vectors(spark, sf_dir))
    return c.select("qid", F.posexplode("c").alias("pos", "value")).select(
        "qid", F.col("pos").cast("int"), r6("value").alias("value")
    )


@register(
    "expansions",
    O.with_ctes("SELECT qid, rk, term, round(sim, 6) AS sim FROM exps", "exps"),
)
def expansions(spark, sf_dir):
    e = P.expansions_from_vectors(X.queries(spark, sf_dir), X.vectors(spark, sf_dir))
    return e.select("qid", "rk", "term", r6("sim").alias("sim"))


@register(
    "expansion_blocked",
    O.with_ctes("SELECT qid, rk, term, round(sim, 6) AS sim FROM exps", "exps"),
)
def expansion_blocked(spark, sf_dir):
    """ML-2 with many small blocks, most of which are skipped: the same expansions as with a few."""
    qtf = query_term_freq(X.queries(spark, sf_dir))
    vec = materialize(X.vectors(spark, sf_dir))
    e = ex.expand(vec.repartition(7), ex.centroids(qtf, vec), Params().top_k, block_words=7, block_queries=8)
    return e.select("qid", "rk", "term", r6("sim").alias("sim"))


@register(
    "expansion_model",
    O.with_ctes("SELECT qid, term, round(r, 6) AS r FROM rm", "rm", extra=O.EMBEDDING),
)
def expansion_model(spark, sf_dir):
    fx = X.Fixtures(spark, sf_dir)
    qs, m = _models(spark, sf_dir, P.EMBEDDING_FIELDS, fx=fx)
    qtf = query_term_freq(qs)
    vec = fx.vectors()
    exps = ex.expand(vec, ex.centroids(qtf, vec), Params().top_k)
    rm = ex.relevance_model(ex.expansion_model(exps, qtf, m), Params().lam)
    return rm.select("qid", "term", r6("r").alias("r"))


@register(
    "rerank_embeddings",
    O.with_ctes("SELECT qid, doc_id, rank, round(score, 6) AS score FROM run_b", "run_b", extra=O.EMBEDDING),
)
def rerank_embeddings(spark, sf_dir):
    fx = X.Fixtures(spark, sf_dir)
    run, _ = P.rerank_embeddings(fx.queries(), fx.candidates(), fx.collection(), fx.vectors())
    return run.select("qid", "doc_id", "rank", r6("score").alias("score"))


# ---------------------------------------------------------------------------
# evaluation (PIPE-4, PIPE-5) and sweeps (PIPE-6, PIPE-7)
# ---------------------------------------------------------------------------
MU_SWEEP = [(100, 0.2), (200, 0.2), (350, 0.2), (500, 0.2)]
LAMBDA_SWEEP = [(800, 0.2), (800, 0.5), (800, 0.7)]


def _feedback_run(spark, sf_dir, fx=None):
    fx = fx or X.Fixtures(spark, sf_dir)
    return P.rerank_feedback(fx.queries(), fx.candidates(), fx.collection())


@register(
    "dcg",
    O.with_ctes("SELECT qid, CAST(cutoff AS INTEGER) AS cutoff, round(dcg, 6) AS dcg FROM dcg_before", "dcg_before"),
)
def dcg(spark, sf_dir):
    """AGG-18, WIN-3, JOIN-13: DCG of the candidate lists in stored order."""
    fx = X.Fixtures(spark, sf_dir)
    d = ev.candidates_dcg(fx.candidates(), fx.qrels())
    return d.select("qid", "cutoff", r6("dcg").alias("dcg"))


@register(
    "ideal_dcg",
    O.with_ctes("SELECT qid, CAST(cutoff AS INTEGER) AS cutoff, round(idcg, 6) AS idcg FROM idcg", "idcg"),
)
def ideal_dcg(spark, sf_dir):
    d = ev.ideal_dcg(X.qrels(spark, sf_dir))
    return d.select("qid", "cutoff", r6("idcg").alias("idcg"))


@register(
    "ndcg_per_query",
    O.with_ctes("SELECT qid, stage, cutoff, round(ndcg, 6) AS ndcg FROM perq", "perq", extra=O.run_of("run_a")),
)
def ndcg_per_query(spark, sf_dir):
    fx = X.Fixtures(spark, sf_dir)
    per_q, _ = P.evaluate(_feedback_run(spark, sf_dir, fx), fx.candidates(), fx.qrels())
    return per_q.select("qid", "stage", "cutoff", r6("ndcg").alias("ndcg"))


@register(
    "ndcg_mean",
    O.with_ctes("SELECT stage, cutoff, round(ndcg, 6) AS ndcg FROM meanq", "meanq", extra=O.run_of("run_a")),
)
def ndcg_mean(spark, sf_dir):
    fx = X.Fixtures(spark, sf_dir)
    _, mean = P.evaluate(_feedback_run(spark, sf_dir, fx), fx.candidates(), fx.qrels())
    return mean.select("stage", "cutoff", r6("ndcg").alias("ndcg"))


@register(
    "ndcg_trec_order",
    O.with_ctes("SELECT qid, cutoff, round(ndcg, 6) AS ndcg FROM trec", "trec", extra=O.run_of("run_a")),
)
def ndcg_trec_order(spark, sf_dir):
    fx = X.Fixtures(spark, sf_dir)
    t = ev.evaluate_trec(_feedback_run(spark, sf_dir, fx), fx.qrels())
    return t.select("qid", "cutoff", r6("ndcg").alias("ndcg"))


@register(
    "ndcg_trec_mean",
    O.with_ctes(
        "SELECT cutoff, round(avg(ndcg), 6) AS ndcg, count(*) AS n_queries FROM trec GROUP BY cutoff", "trec", extra=O.run_of("run_a")
    ),
)
def ndcg_trec_mean(spark, sf_dir):
    """PIPE-5: the means that the documented command prints."""
    fx = X.Fixtures(spark, sf_dir)
    t = ev.trec_mean(ev.evaluate_trec(_feedback_run(spark, sf_dir, fx), fx.qrels()))
    return t.select("cutoff", r6("ndcg").alias("ndcg"), "n_queries")


@register(
    "metrics_roundtrip",
    O.with_ctes(
        "SELECT qid, stage, cutoff, round(ndcg, 6) AS ndcg FROM perq UNION ALL SELECT NULL, stage, cutoff, round(ndcg, 6) FROM meanq",
        "perq",
        "meanq",
        extra=O.run_of("run_a"),
    ),
)
def metrics_roundtrip(spark, sf_dir):
    """SNK-3: the metric tables as written and read back; the mean has no qid."""
    from relmod.session import scratch_dir

    fx = X.Fixtures(spark, sf_dir)
    path = scratch_dir(spark, "metrics")
    TF.write_metrics(*P.evaluate(_feedback_run(spark, sf_dir, fx), fx.candidates(), fx.qrels()), path)
    per_q, mean = TF.read_metrics(spark, path)
    cols = ("qid", "stage", "cutoff", r6("ndcg").alias("ndcg"))
    return per_q.select(*cols).unionByName(mean.withColumn("qid", F.lit(None).cast("long")).select(*cols))


@register(
    "run_diagnostics",
    O.with_ctes(
        "SELECT q.qid, coalesce(c.n, 0) AS n_candidates, coalesce(d.n, 0) AS n_documents, coalesce(o.n, 0) AS n_oov,"
        " q.qid NOT IN (SELECT qid FROM qtf) AS empty_query,"
        " c.n IS NOT NULL AND q.qid IN (SELECT qid FROM qtf) AND q.qid NOT IN (SELECT qid FROM exps) AS no_vectors,"
        " q.qid IN (SELECT rm.qid FROM rm JOIN bg ON bg.qid = rm.qid AND bg.term = rm.term"
        "  WHERE rm.term = '<UNK>' AND rm.r > 0 AND bg.cf = 0) AS unk_dropped FROM q"
        " LEFT JOIN (SELECT qid, count(*) AS n FROM cset GROUP BY qid) c ON c.qid = q.qid"
        " LEFT JOIN (SELECT qid, count(*) AS n FROM clen GROUP BY qid) d ON d.qid = q.qid"
        " LEFT JOIN (SELECT qid, count(*) AS n FROM qtf t WHERE NOT EXISTS"
        "  (SELECT 1 FROM bg WHERE bg.qid = t.qid AND bg.term = t.term) GROUP BY qid) o ON o.qid = q.qid",
        "q",
        "cset",
        "clen",
        "qtf",
        "bg",
        "exps",
        "rm",
        extra=O.EMBEDDING,
    ),
)
def run_diagnostics(spark, sf_dir):
    """AGG-22, D4, D7-D9: what a run met and left out, from the run itself."""
    fx = X.Fixtures(spark, sf_dir)
    report = P.RunReport()
    P.rerank_embeddings(fx.queries(), fx.candidates(), fx.collection(), fx.vectors(), report=report)
    return report.queries


@register(
    "skipped_queries",
    O.with_ctes(
        "SELECT DISTINCT g.qid, g.qid IN (SELECT qid FROM run_a) AS in_run, g.qid IN (SELECT qid FROM cand) AS in_candidates"
        " FROM (SELECT qid FROM qrels UNION ALL SELECT -1 - qid FROM qrels) g"
        " WHERE NOT (g.qid IN (SELECT qid FROM run_a) AND g.qid IN (SELECT qid FROM cand))",
        "cand",
        "qrels",
        "run_a",
    ),
)
def skipped_queries(spark, sf_dir):
    """FLT-5, JOIN-14: gold queries without a run or candidates; every judged query has a twin that nobody ran."""
    fx = X.Fixtures(spark, sf_dir)
    gold = fx.qrels().unionByName(fx.qrels().withColumn("qid", -1 - F.col("qid")))
    return ev.skipped_queries(_feedback_run(spark, sf_dir, fx), fx.candidates(), gold)


@register(
    "missing_documents",
    O.with_ctes(
        "SELECT DISTINCT c.qid, c.doc_id FROM (SELECT qid, doc_id FROM cand UNION ALL SELECT qid, -1 - doc_id FROM cand) c"
        " WHERE c.doc_id NOT IN (SELECT doc_id FROM documents WHERE doc_id IS NOT NULL)",
        "cand",
    ),
)
def missing_documents(spark, sf_dir):
    """JOIN-3, D15: candidates that the collection lacks; every listed document has a twin that is in no collection."""
    fx = X.Fixtures(spark, sf_dir)
    listed = fx.candidates().select("qid", "doc_id")
    return P.missing_documents(fx.queries(), listed.unionByName(listed.withColumn("doc_id", -1 - F.col("doc_id"))), fx.collection())


def _sweep(spark, sf_dir, settings):
    fx = X.Fixtures(spark, sf_dir)
    m = P.sweep_embeddings(fx.queries(), fx.candidates(), fx.collection(), fx.vectors(), fx.qrels(), settings)
    return m.select("setting_id", "mu", "lam", "stage", "cutoff", r6("ndcg").alias("ndcg"))


_SWEEP_SELECT = (
    "SELECT m.setting_id, s.mu, s.lam, m.stage, m.cutoff, round(m.ndcg, 6) AS ndcg"
    " FROM meanq m JOIN settings s USING (setting_id)"
)


@register("sweep_mu", O.with_ctes(_SWEEP_SELECT, "meanq", "settings", extra={**O.sweep_of(MU_SWEEP), **O.EMBEDDING}))
def sweep_mu(spark, sf_dir):
    """PIPE-6: mu in {100, 200, 350, 500} for Task 2.1 in one job."""
    return _sweep(spark, sf_dir, MU_SWEEP)


@register("sweep_lambda", O.with_ctes(_SWEEP_SELECT, "meanq", "settings", extra={**O.sweep_of(LAMBDA_SWEEP), **O.EMBEDDING}))
def sweep_lambda(spark, sf_dir):
    """PIPE-7: lambda in {0.2, 0.5, 0.7} for Task 2.2 in one job."""
    return _sweep(spark, sf_dir, LAMBDA_SWEEP)


# ---------------------------------------------------------------------------
# sources and sinks (SRC-*, SNK-*, AGG-17)
# ---------------------------------------------------------------------------
@register(
    "run_lines",
    O.with_ctes("SELECT qid, rank, printf('%d Q0 %d %d %.4f runid1', qid, doc_id, rank, score) AS line FROM run_a", "run_a"),
)
def run_lines(spark, sf_dir):
    """SNK-1 / PRJ-4: the Task 0 run as output lines."""
    return TF.run_lines(_feedback_run(spark, sf_dir))


@register(
    "expansion_lines",
    O.with_ctes(
        "SELECT qid, CAST(qid AS VARCHAR) || ': ' || string_agg(term, ', ' ORDER BY rk) AS line FROM exps GROUP BY qid",
        "exps",
    ),
)
def expansion_lines(spark, sf_dir):
    """SNK-2: expansion words per query, best first."""
    return TF.expansion_lines(P.expansions_from_vectors(X.queries(spark, sf_dir), X.vectors(spark, sf_dir)))


@register(
    "last_wins",
    "SELECT user_id, s.event_type AS event_type, s.value AS value FROM ("
    " SELECT user_id, arg_max({'event_type': event_type, 'value': value}, event_id) AS s FROM events"
    " GROUP BY user_id)",
)
def last_wins_events(spark, sf_dir):
    """AGG-17 on ``events``: per user (NULL is one), the fields of the event with the highest event_id."""
    ev_ = X.table(spark, sf_dir, "events")
    return last_wins(ev_.select("user_id", "event_type", "value", "event_id"), "user_id", "event_id")


_SANITIZE = r"[\t\n\r]"


def _clean_sql(expr: str) -> str:
    return f"regexp_replace(coalesce({expr}, ''), '{_SANITIZE}', ' ', 'g')"


def _strip_sql(expr: str) -> str:
    return f"regexp_replace({expr}, '^{O.WHITESPACE_CLASS}|{O.WHITESPACE_CLASS}$', '', 'g')"


@register(
    "text_roundtrip",
    O.with_ctes(
        "SELECT 'queries' AS file, count(*) AS n_rows FROM benchmark"
        f" WHERE {_strip_sql(_clean_sql('text'))} <> ''"
        " UNION ALL SELECT 'candidates', count(*) FROM cand"
        f" UNION ALL SELECT 'docs', count(*) FROM documents WHERE {_strip_sql(_clean_sql('text'))} <> ''"
        " UNION ALL SELECT 'qrels', count(*) FROM qrels"
        " UNION ALL SELECT 'run', count(*) FROM cand",
        "cand",
        "qrels",
    ),
)
def text_roundtrip(spark, sf_dir):
    """SRC-1..6, FLT-1..3, SNK-1: write the fixtures in the text formats, read them back, count.

    Tabs and line breaks inside text fields are replaced by spaces first (the
    formats cannot hold them). Files go to a fresh folder under the shared
    checkpoint directory.
    """
    from relmod.session import scratch_dir

    base = scratch_dir(spark, "roundtrip")
    clean = lambda c: F.regexp_replace(F.col(c), _SANITIZE, " ")
    qs = X.queries(spark, sf_dir).select("qid", clean("text").alias("text"))
    fx = X.Fixtures(spark, sf_dir)
    cands = fx.candidates()
    docs = X.table(spark, sf_dir, "documents").select("doc_id", F.lit("").alias("url"), F.lit("").alias("title"), clean("text").alias("body"))
    qrels = fx.qrels().withColumn("run", F.lit(0))
    TF.write_tsv(qs, ["qid", "text"], f"{base}/queries.tsv", header="[query_id]\ttext")
    TF.write_tsv(cands, ["qid", "doc_id", "score"], f"{base}/top100docs.tsv", header="[query_id]\tdoc_id\tscore", order=["qid", "pos"])
    TF.write_tsv(docs, ["doc_id", "url", "title", "body"], f"{base}/docs.tsv")
    qrels.select(F.concat_ws(" ", "qid", "doc_id", "relevance", "run").alias("value")).write.mode("overwrite").text(f"{base}/qrels.tsv")
    TF.write_run(cands.select("qid", "doc_id", F.col("pos").alias("rank"), "score"), f"{base}/run")
    counts = [
        ("queries", TF.read_queries(spark, f"{base}/queries.tsv")),
        ("candidates", TF.read_candidates(spark, f"{base}/top100docs.tsv")),
        ("docs", TF.read_collection(spark, f"{base}/docs.tsv")),
        ("qrels", TF.read_qrels(spark, f"{base}/qrels.tsv")),
        ("run", TF.read_run(spark, f"{base}/run")),
    ]
    out = None
    for name, df in counts:
        c = df.groupBy().agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("file"), "n_rows")
        out = c if out is None else out.unionByName(c)
    return out


def _clean(c) -> Column:
    return F.regexp_replace(F.col(c), _SANITIZE, " ")


def _messy(spark, path: str, rows: DataFrame, line: Column, again: Column, junk: tuple[str, ...]) -> str:
    """Writes ``line`` of every row, then ``again`` (null: none); between the two, header, blank and malformed lines."""
    first = rows.select(F.lit(0).alias("part"), F.col("key"), line.alias("value"))
    odd = spark.createDataFrame([(1, i, v) for i, v in enumerate(("[query_id]\theader again", "", " \t ", *junk))], "part int, key long, value string")
    last = rows.select(F.lit(2).alias("part"), F.col("key"), again.alias("value")).filter("value IS NOT NULL")
    TF.write_lines(first.unionByName(odd).unionByName(last), path, ["part", "key"])
    return path


def _messy_queries(spark, sf_dir: str) -> str:
    from relmod.session import scratch_dir

    rows = X.queries(spark, sf_dir).select(F.col("qid").alias("key"), "qid", _clean("text").alias("text"))
    line = F.concat_ws("\t", F.col("qid").cast("string"), F.concat(F.lit(" "), "text"))
    again = F.when(F.col("qid") % 3 == 0, F.concat_ws("\t", F.col("qid").cast("string"), F.concat(F.lit("later "), "text")))
    return _messy(spark, scratch_dir(spark, "queries"), rows, line, again, ("1\ttoo\tmany", "none"))


def _rstrip_sql(expr: str) -> str:
    return f"regexp_replace({expr}, '{O.WHITESPACE_CLASS}$', '')"


@register(
    "read_queries",
    "SELECT CAST(item_id AS VARCHAR) AS qid,"
    f" {_rstrip_sql('CASE WHEN item_id % 3 = 0 THEN ' + chr(39) + 'later ' + chr(39) + ' ELSE ' + chr(39) + ' ' + chr(39) + ' END || ' + _clean_sql('text'))}"
    " AS text FROM benchmark",
)
def read_queries(spark, sf_dir):
    """SRC-1: repeated ids (the later line wins), a header in the middle, blank and malformed lines."""
    return TF.read_queries(spark, _messy_queries(spark, sf_dir))


_RAW_SQL = "concat_ws(chr(9), CAST(doc_id AS VARCHAR), coalesce(source, ''), coalesce(lang, ''), coalesce(text, ''))"


@register(
    "malformed_lines",
    "SELECT line, CAST(len(string_split(s, chr(9))) AS INTEGER) AS n_fields FROM ("
    f" SELECT line, {_strip_sql('line')} AS s FROM (SELECT unnest(regexp_split_to_array({_RAW_SQL}, '\r\n|\n|\r')) AS line FROM documents))"
    " WHERE s <> '' AND len(string_split(s, chr(9))) <> 4",
)
def malformed_lines(spark, sf_dir):
    """FLT-2: documents written as they are; lines that their own tabs and line breaks make are left out and listed."""
    from relmod.session import scratch_dir

    d = X.table(spark, sf_dir, "documents")
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("source", "lang", "text")]
    path = scratch_dir(spark, "raw")
    d.select(F.concat_ws("\t", "doc_id", *fields).alias("value")).write.text(path)
    return TF.malformed_lines(spark, path, "collection")


def _candidate_file(spark, sf_dir: str, sep: str) -> str:
    from relmod.session import scratch_dir

    # stored: the file is written from these rows and again from some of them, after a look at their order
    rows = materialize(X.candidates(spark, sf_dir)).withColumn("key", F.col("qid") * 1000 + F.col("pos"))
    line = F.concat_ws(sep, "qid", "doc_id", "score")
    return _messy(spark, scratch_dir(spark, "candidates"), rows, line, F.when(F.col("pos") == 2, line), ("7\tonly-two", "a b c d"))


_CANDIDATE_ROWS = (
    "SELECT {qid} AS qid, CAST(doc_id AS VARCHAR) AS doc_id, score, CAST(row_number() OVER (PARTITION BY qid ORDER BY part, pos) AS INTEGER) AS pos"
    " FROM (SELECT 0 AS part, * FROM cand UNION ALL SELECT 2, * FROM cand WHERE pos = 2)"
)


@register("read_candidates", O.with_ctes(_CANDIDATE_ROWS.format(qid="CAST(qid AS VARCHAR)"), "cand"))
def read_candidates(spark, sf_dir):
    """SRC-2, AGG-4: file order within a query, repeated lines kept."""
    return TF.read_candidates(spark, _candidate_file(spark, sf_dir, "\t"))


@register("read_scoring_candidates", O.with_ctes(_CANDIDATE_ROWS.format(qid="CAST(qid AS INTEGER)"), "cand"))
def read_scoring_candidates(spark, sf_dir):
    """SRC-6, PRJ-2: the evaluation's reader, by white space and with integer ids."""
    return TF.read_candidates(spark, _candidate_file(spark, sf_dir, "  "), scoring=True)


@register(
    "read_collection",
    f"SELECT CAST(doc_id AS VARCHAR) AS doc_id, 'u' || doc_id AS url, 't ' || coalesce(lang, '') AS title,"
    f" CASE WHEN doc_id % 4 = 0 THEN 'second' ELSE regexp_replace('b' || {_clean_sql('text')}, '{O.WHITESPACE_CLASS}$', '') END AS body FROM documents",
)
def read_collection(spark, sf_dir):
    """SRC-3: four fields, a repeated document's last line wins, no header line."""
    from relmod.session import scratch_dir

    rows = X.table(spark, sf_dir, "documents").withColumn("key", F.col("doc_id"))
    front = [F.col("doc_id").cast("string"), F.concat(F.lit("u"), F.col("doc_id").cast("string")), F.concat(F.lit("t "), F.coalesce("lang", F.lit("")))]
    line = F.concat_ws("\t", *front, F.concat(F.lit("b"), F.coalesce(_clean("text"), F.lit(""))))
    again = F.when(F.col("doc_id") % 4 == 0, F.concat_ws("\t", *front, F.lit("second")))
    return TF.read_collection(spark, _messy(spark, scratch_dir(spark, "docs"), rows, line, again, ("5\tu\tt", "5\tu\tt\tb\tx")))


@register(
    "read_qrels",
    O.with_ctes(
        "SELECT CAST(qid AS INTEGER) AS qid, CAST(doc_id AS VARCHAR) AS doc_id, CAST(CASE WHEN doc_id % 5 = 0 THEN 3 ELSE relevance END AS INTEGER) AS relevance FROM qrels",
        "qrels",
    ),
)
def read_qrels(spark, sf_dir):
    """SRC-4, PRJ-2: judgements by white space; the later line of a pair wins."""
    from relmod.session import scratch_dir

    rows = materialize(X.qrels(spark, sf_dir)).withColumn("key", F.col("qid") * 1_000_000 + F.col("doc_id"))
    line = F.concat_ws(" ", "qid", "doc_id", "relevance", F.lit("0"))
    again = F.when(F.col("doc_id") % 5 == 0, F.concat_ws("\t", "qid", "doc_id", F.lit("3"), F.lit("0")))
    return TF.read_qrels(spark, _messy(spark, scratch_dir(spark, "qrels"), rows, line, again, ("1 2 3", "1 2 3 4 5")))


@register(
    "read_run",
    O.with_ctes(
        "SELECT CAST(qid AS INTEGER) AS qid, CAST(doc_id AS VARCHAR) AS doc_id, pos AS rank, CASE WHEN pos = 3 THEN -1.0 ELSE score END AS score FROM cand",
        "cand",
    ),
)
def read_run(spark, sf_dir):
    """SRC-5, SNK-1, PRJ-4: run lines; the later line of a rank wins."""
    from relmod.session import scratch_dir

    rows = materialize(X.candidates(spark, sf_dir)).withColumn("key", F.col("qid") * 1000 + F.col("pos")).withColumn("rank", F.col("pos"))
    lines = TF.run_lines(rows).select(F.col("qid").alias("_q"), F.col("rank").alias("_r"), "line")
    rows = rows.join(lines, (F.col("qid") == F.col("_q")) & (F.col("rank") == F.col("_r")))
    again = F.when(F.col("pos") == 3, F.concat_ws(" ", "qid", F.lit("Q0"), "doc_id", "rank", F.lit("-1.0"), F.lit("runid1")))
    return TF.read_run(spark, _messy(spark, scratch_dir(spark, "run"), rows, F.col("line"), again, ("1 Q0 2 3 4", "x")))


@register(
    "vector_file_scan",
    O.with_ctes(
        "SELECT f.fmt, term, CAST(len(vec) AS INTEGER) AS dim, round(list_sum(vec), 6) AS vsum FROM vectors"
        " CROSS JOIN (VALUES ('glove'), ('word2vec')) f(fmt)",
        "vectors",
    ),
)
def vector_file_scan(spark, sf_dir):
    """SRC-7, SRC-8, SCL-15: vectors written as GloVe and word2vec text, read back."""
    from relmod.session import scratch_dir

    base = scratch_dir(spark, "vectors")
    vec = X.Fixtures(spark, sf_dir).vectors()
    body = vec.select(
        F.concat_ws(" ", "term", F.array_join(F.transform("vec", lambda x: x.cast("string")), " ")).alias("value")
    )
    body.write.mode("overwrite").text(f"{base}/glove")
    n, dim = vec.select(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    # several files, of which the first has the table's one header
    head = spark.createDataFrame([("", f"{n} {dim}")], "_o string, value string")
    lines = head.unionByName(body.select(F.concat(F.lit("w"), "value").alias("_o"), "value"))
    lines.repartitionByRange(5, "_o").sortWithinPartitions("_o").select("value").write.mode("overwrite").text(f"{base}/w2v")
    out = None
    for fmt, sub in (("glove", "glove"), ("word2vec", "w2v")):
        e = TF.read_embeddings(spark, f"{base}/{sub}", fmt)
        e = e.select(
            F.lit(fmt).alias("fmt"),
            "term",
            F.size("vec").cast("int").alias("dim"),
            r6(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x)).alias("vsum"),
        )
        out = e if out is None else out.unionByName(e)
    return out


# ---------------------------------------------------------------------------
# Task 1: local contexts (ML-1, PIPE-1)
# ---------------------------------------------------------------------------
_LOCAL = {**O.EMBEDDING, **O.LOCAL}


@register("local_expansions", O.with_ctes("SELECT qid, rk, term, round(sim, 6) AS sim FROM exps", "exps", extra=_LOCAL))
def local_expansions(spark, sf_dir):
    qs, m = _models(spark, sf_dir, P.EMBEDDING_FIELDS)
    e = lc.local_expansions(m, query_term_freq(qs), Params().top_k)
    return e.select("qid", "rk", "term", r6("sim").alias("sim"))


@register(
    "rerank_local",
    O.with_ctes("SELECT qid, doc_id, rank, round(score, 6) AS score FROM run_b", "run_b", extra=_LOCAL),
)
def rerank_local(spark, sf_dir):
    fx = X.Fixtures(spark, sf_dir)
    run, _ = P.rerank_local(fx.queries(), fx.candidates(), fx.collection())
    return run.select("qid", "doc_id", "rank", r6("score").alias("score"))


@register("sweep_local", O.with_ctes(_SWEEP_SELECT, "meanq", "settings", extra={**O.sweep_of(MU_SWEEP), **_LOCAL}))
def sweep_local(spark, sf_dir):
    """PIPE-6 for Task 1."""
    fx = X.Fixtures(spark, sf_dir)
    m = P.sweep_local(fx.queries(), fx.candidates(), fx.collection(), fx.qrels(), MU_SWEEP)
    return m.select("setting_id", "mu", "lam", "stage", "cutoff", r6("ndcg").alias("ndcg"))


# vectors of few directions and a narrow window, so that SQL can follow every step
LOCAL_VECTORS = {"d": 2, "window": 2, "rounds": 2}
_LOCAL_VECTORS = {**O.EMBEDDING, **O.local_vectors(**LOCAL_VECTORS)}


# sums of products of large numbers: four decimals; + 0.0 makes one zero of two
@register("local_vectors", O.with_ctes("SELECT qid, term, round(y_0, 4) + 0.0 AS v_0, round(y_1, 4) + 0.0 AS v_1 FROM lvec", "lvec", extra=_LOCAL_VECTORS))
def local_vectors(spark, sf_dir):
    """ML-1: word vectors of every query's own candidates."""
    _, m = _models(spark, sf_dir, P.EMBEDDING_FIELDS)
    v = lv.local_vectors(m, **LOCAL_VECTORS)
    return v.select("qid", "term", *[(F.round(F.col("vec")[i], 4) + 0.0).alias(f"v_{i}") for i in range(LOCAL_VECTORS["d"])])


@register(
    "rerank_local_vectors",
    O.with_ctes("SELECT qid, doc_id, rank, round(score, 6) AS score FROM run_b", "run_b", extra=_LOCAL_VECTORS),
)
def rerank_local_vectors(spark, sf_dir):
    """PIPE-1 with vectors, ML-2 over each query's own words."""
    fx = X.Fixtures(spark, sf_dir)
    run, _ = P.rerank_local_vectors(fx.queries(), fx.candidates(), fx.collection(), **LOCAL_VECTORS)
    return run.select("qid", "doc_id", "rank", r6("score").alias("score"))


# ---------------------------------------------------------------------------
# stemming (SCL-4): the English rules over the documents' distinct words
# ---------------------------------------------------------------------------
_WORDS_SQL = f"(SELECT DISTINCT unnest({O.words_sql('text')}) AS word FROM documents)"
_STEMS_SQL = english_stems_sql(_WORDS_SQL)


@register("stem_lexicon", _STEMS_SQL)
def stem_lexicon(spark, sf_dir):
    """(word, stem) for every distinct normalised whitespace word of the documents."""
    return stem_table(text_words(X.table(spark, sf_dir, "documents"), "doc_id", "text"))


@register(
    "stemmed_documents",
    f"WITH stems AS ({_STEMS_SQL}), w AS (SELECT doc_id, {O.words_sql('text')} AS words FROM documents),"
    " p AS (SELECT doc_id, i, words[i] AS word FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM w)),"
    " s AS (SELECT doc_id, list(stem ORDER BY i) AS stems FROM p JOIN stems USING (word) GROUP BY doc_id)"
    f" SELECT d.doc_id, array_to_string({O.split_sql('array_to_string(' + O.without_stops_sql('coalesce(s.stems, [])') + ', ' + chr(39) + ' ' + chr(39) + ')')}, ' ') AS text"
    " FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id",
)
def stemmed_documents(spark, sf_dir):
    """SCL-4 in the chain: the documents' tokens with every word's stem."""
    d = X.table(spark, sf_dir, "documents").select("doc_id", "text")
    out = stemmed_tokens(d, "doc_id", "text", opts=TextOptions(stemming=True))
    return out.select("doc_id", F.array_join("tokens", " ").alias("text"))
