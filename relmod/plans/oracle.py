"""DuckDB SQL for every catalogued query: an independent, dense statement of the same maths.

The SQL is assembled from named CTEs (each with its dependencies) so that the
text chain, the fixtures and the models are written once. Where the Spark side
uses sparse algebra (Task 0 likelihood, feedback model, Score B), the SQL uses
the direct dense definitions; the two agree to ~1e-12 and outputs are rounded
to 6 decimals.
"""

from __future__ import annotations

from relmod.operators import local_vectors as lv
from relmod.params import (
    DEFAULT_LAMBDA,
    DEFAULT_MU,
    DEFAULT_TOP_K,
    DEFAULT_UNK_PCT,
    DELIMITER_CLASS,
    DIGITS_PATTERN,
    NUM_TOKEN,
    PUNCTUATION,
    STOP_WORDS,
    WHITESPACE_CLASS,
)


def _q(s: str) -> str:
    return s.replace("'", "''")


_STOP = "[" + ", ".join(f"'{_q(w)}'" for w in STOP_WORDS) + "]"


def normalize_sql(expr: str, off: str = "") -> str:
    t = f"coalesce({expr}, '')"
    t = t if off == "lowercase" else f"lower({t})"
    t = t if off == "punctuation" else f"translate({t}, '{_q(PUNCTUATION)}', '')"
    return t if off == "digits" else f"regexp_replace({t}, '{DIGITS_PATTERN}', '{NUM_TOKEN}', 'g')"


def words_sql(expr: str, off: str = "") -> str:
    return f"list_filter(regexp_split_to_array({normalize_sql(expr, off)}, '{WHITESPACE_CLASS}'), lambda w: w <> '')"


def without_stops_sql(words: str) -> str:
    return f"list_filter({words}, lambda w: NOT list_contains({_STOP}, w))"


def preprocess_sql(expr: str, off: str = "") -> str:
    words = words_sql(expr, off)
    return f"array_to_string({words if off == 'stopwords' else without_stops_sql(words)}, ' ')"


def split_sql(text: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({text}), '{_q(DELIMITER_CLASS)}'), lambda x: x <> '')"


def tokens_sql(expr: str, off: str = "") -> str:
    """The tokens of a text, with the switch named by ``off`` switched off."""
    return split_sql(preprocess_sql(expr, off))


MU = DEFAULT_MU
LAM = DEFAULT_LAMBDA
K = DEFAULT_TOP_K
UNK_SHARE = DEFAULT_UNK_PCT / 100.0

# name -> (sql, dependencies)
CTE: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *deps: str) -> None:
    CTE[name] = (sql, deps)


# ---- fixtures -------------------------------------------------------------
cte("q", "SELECT item_id AS qid, text FROM benchmark")
cte("qtok", f"SELECT qid, {tokens_sql('text')} AS tokens FROM q", "q")
cte("dtok", f"SELECT doc_id, {tokens_sql('text')} AS tokens FROM documents")
cte("qterms", "SELECT DISTINCT qid, unnest(tokens) AS term FROM qtok", "qtok")
cte("dterms", "SELECT DISTINCT doc_id, unnest(tokens) AS term FROM dtok", "dtok")
cte("nq", "SELECT qid, count(*) AS n_qterms FROM qterms GROUP BY qid", "qterms")
cte(
    "shared",
    "SELECT qid, doc_id, count(*) AS n_shared FROM qterms JOIN dterms USING (term) GROUP BY qid, doc_id",
    "qterms",
    "dterms",
)
cte(
    "cand",
    "SELECT qid, doc_id, CAST(n_shared AS DOUBLE) AS score, CAST(pos AS INTEGER) AS pos FROM ("
    " SELECT qid, doc_id, n_shared, row_number() OVER (PARTITION BY qid ORDER BY n_shared DESC, doc_id) AS pos"
    " FROM shared) WHERE pos <= 100",
    "shared",
)
cte(
    "qgrams",
    "SELECT DISTINCT qid, array_to_string(tokens[i:i+4], ' ') AS gram FROM ("
    " SELECT qid, tokens, unnest(range(1, len(tokens) - 3)) AS i FROM qtok WHERE len(tokens) >= 5)",
    "qtok",
)
cte(
    "dgrams",
    "SELECT doc_id, array_to_string(tokens[i:i+4], ' ') AS gram FROM ("
    " SELECT doc_id, tokens, unnest(range(1, len(tokens) - 3)) AS i FROM dtok WHERE len(tokens) >= 5)",
    "dtok",
)
cte("grade2", "SELECT DISTINCT qid, doc_id FROM dgrams JOIN qgrams USING (gram)", "dgrams", "qgrams")
cte(
    "qrels",
    "SELECT qid, doc_id, 2 AS relevance FROM grade2 UNION ALL "
    "SELECT s.qid, s.doc_id, 1 AS relevance FROM shared s JOIN nq USING (qid) "
    "WHERE s.n_shared * 10 >= nq.n_qterms * 3 AND NOT EXISTS "
    "(SELECT 1 FROM grade2 g WHERE g.qid = s.qid AND g.doc_id = s.doc_id)",
    "grade2",
    "shared",
    "nq",
)
cte(
    "termcf",
    "SELECT term, count(*) AS cf FROM (SELECT unnest(tokens) AS term FROM dtok) GROUP BY term",
    "dtok",
)
cte(
    "vectors",
    "SELECT t.term, CAST(e.embedding AS DOUBLE[]) AS vec FROM ("
    " SELECT term, row_number() OVER (ORDER BY cf DESC, term) - 1 AS vec_id FROM termcf) t"
    " JOIN embeddings e ON e.vec_id = t.vec_id",
    "termcf",
)

# ---- candidate models (Task 0 text = url + title + body) ----
cte("cset", "SELECT DISTINCT qid, doc_id FROM cand", "cand")
_URL = "'https://' || coalesce(source, '') || '.example.org/' || coalesce(lang, '')"
_TITLE = "regexp_extract(coalesce(text, ''), '^[^.\\n]*')"
_FIELDS = {
    "feedback": f"concat_ws(' ', {_URL}, {_TITLE}, coalesce(text, ''))",
    "embedding": f"concat_ws(' ', {_TITLE}, coalesce(text, ''))",
}
cte("ftok", f"SELECT doc_id, {tokens_sql(_FIELDS['feedback'])} AS tokens FROM documents")
cte("ctok", "SELECT c.qid, c.doc_id, d.tokens FROM cset c JOIN ftok d USING (doc_id)", "cset", "ftok")
#: For ``with_ctes``: the embedding tasks read title and body only.
EMBEDDING = {"ftok": (f"SELECT doc_id, {tokens_sql(_FIELDS['embedding'])} AS tokens FROM documents", ())}
cte("clen", "SELECT qid, doc_id, CAST(len(tokens) AS BIGINT) AS doc_len FROM ctok", "ctok")
cte(
    "ctf",
    "SELECT qid, doc_id, term, count(*) AS tf FROM (SELECT qid, doc_id, unnest(tokens) AS term FROM ctok)"
    " GROUP BY qid, doc_id, term",
    "ctok",
)
cte("nn", "SELECT qid, CAST(sum(doc_len) AS BIGINT) AS n FROM clen GROUP BY qid", "clen")
cte(
    "bg",
    "SELECT qid, term, cf, n, CAST(cf AS DOUBLE) / n AS p_bg FROM ("
    " SELECT qid, term, CAST(sum(tf) AS BIGINT) AS cf FROM ctf GROUP BY qid, term"
    f" UNION ALL SELECT qid, '<UNK>' AS term, CAST(floor({UNK_SHARE} * n) AS BIGINT) AS cf FROM nn)"
    " JOIN nn USING (qid)",
    "ctf",
    "nn",
)
cte("qtf", "SELECT qid, term, count(*) AS qtf FROM (SELECT qid, unnest(tokens) AS term FROM qtok) GROUP BY qid, term", "qtok")
cte("qv", "SELECT qid, term, qtf, p_bg FROM qtf JOIN bg USING (qid, term)", "qtf", "bg")
cte(
    "ll",
    f"SELECT c.qid, c.doc_id, c.doc_len, coalesce(sum(qv.qtf * ln((coalesce(t.tf, 0) + {MU} * qv.p_bg)"
    f" / (c.doc_len + {MU}))), 0) AS ll"
    " FROM clen c LEFT JOIN qv ON qv.qid = c.qid"
    " LEFT JOIN ctf t ON t.qid = c.qid AND t.doc_id = c.doc_id AND t.term = qv.term"
    " GROUP BY c.qid, c.doc_id, c.doc_len",
    "clen",
    "qv",
    "ctf",
)
cte(
    "lw",
    "SELECT qid, doc_id, doc_len, ll, e / sum(e) OVER (PARTITION BY qid) AS w FROM ("
    " SELECT *, exp(ll - max(ll) OVER (PARTITION BY qid)) AS e FROM ll)",
    "ll",
)
cte(
    "prm",
    f"SELECT b.qid, b.term, sum(lw.w * (coalesce(t.tf, 0) + {MU} * b.p_bg) / (lw.doc_len + {MU})) AS p_rm"
    " FROM bg b JOIN lw ON lw.qid = b.qid"
    " LEFT JOIN ctf t ON t.qid = b.qid AND t.doc_id = lw.doc_id AND t.term = b.term"
    " GROUP BY b.qid, b.term",
    "bg",
    "lw",
    "ctf",
)
cte(
    "dprob",
    f"SELECT qid, doc_id, term, tf, doc_len, p_bg, (tf + {MU} * p_bg) / (doc_len + {MU}) AS p"
    " FROM ctf JOIN clen USING (qid, doc_id) JOIN bg USING (qid, term)",
    "ctf",
    "clen",
    "bg",
)
cte(
    "score_a",
    "SELECT c.qid, c.doc_id, 1 - coalesce(k.kl, 0) AS score FROM clen c LEFT JOIN ("
    " SELECT qid, doc_id, sum(p * ln(p / p_rm)) AS kl FROM dprob JOIN prm USING (qid, term) GROUP BY qid, doc_id) k"
    " USING (qid, doc_id)",
    "clen",
    "dprob",
    "prm",
)
cte(
    "run_a",
    "SELECT qid, doc_id, CAST(row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, doc_id)"
    " AS INTEGER) AS rank, score FROM score_a",
    "score_a",
)


# ---- embedding expansion and Score B (Tasks 2.1 / 2.2) ----------------------
cte("qvec", "SELECT q.qid, q.qtf, v.vec FROM qtf q JOIN vectors v USING (term)", "qtf", "vectors")
cte(
    "cent",
    "SELECT qid, i, sum(qtf * vec[i]) AS s FROM ("
    " SELECT qid, qtf, vec, unnest(range(1, len(vec) + 1)) AS i FROM qvec) GROUP BY qid, i",
    "qvec",
)
cte("centv", "SELECT qid, list(s ORDER BY i) AS c FROM cent GROUP BY qid", "cent")
cte(
    "exps",
    "SELECT qid, CAST(rk AS INTEGER) AS rk, term, sim FROM ("
    " SELECT qid, term, sim, row_number() OVER (PARTITION BY qid ORDER BY sim DESC, term) AS rk FROM ("
    "  SELECT c.qid, v.term, round(list_dot_product(v.vec, c.c), 9) AS sim FROM vectors v CROSS JOIN centv c))"
    " WHERE rk <= " + str(K),
    "vectors",
    "centv",
)
cte(
    "ex0",
    "SELECT e.qid, e.rk, CASE WHEN b.term IS NULL THEN '<UNK>' ELSE e.term END AS term,"
    " CASE WHEN sum(e.sim) OVER (PARTITION BY e.qid) <> 0 THEN e.sim / sum(e.sim) OVER (PARTITION BY e.qid) END AS w"
    " FROM exps e JOIN (SELECT DISTINCT qid FROM cset) cq ON cq.qid = e.qid"
    " LEFT JOIN bg b ON b.qid = e.qid AND b.term = e.term",
    "exps",
    "bg",
    "cset",
)
cte(
    "ex1",
    "SELECT qid, term, arg_max(w, rk) AS w FROM ex0 GROUP BY qid, term",
    "ex0",
)
cte(
    "exf",
    "SELECT qid, term, CASE WHEN sum(w) OVER (PARTITION BY qid) <> 0 THEN w / sum(w) OVER (PARTITION BY qid) END AS e"
    " FROM ex1",
    "ex1",
)
cte(
    "orig",
    "SELECT qid, term, CAST(c AS DOUBLE) / sum(c) OVER (PARTITION BY qid) AS o FROM ("
    " SELECT t.qid, CASE WHEN b.term IS NULL THEN '<UNK>' ELSE t.term END AS term, sum(t.qtf) AS c"
    " FROM qtf t LEFT JOIN bg b ON b.qid = t.qid AND b.term = t.term"
    " WHERE t.qid IN (SELECT qid FROM cset) GROUP BY 1, 2)",
    "qtf",
    "bg",
    "cset",
)
cte(
    "em",
    "SELECT coalesce(x.qid, o.qid) AS qid, coalesce(x.term, o.term) AS term, x.e, o.o"
    " FROM exf x FULL OUTER JOIN orig o ON x.qid = o.qid AND x.term = o.term",
    "exf",
    "orig",
)
cte(
    "rm",
    "SELECT qid, term, lam_eff * coalesce(e, 0) + (1.0 - lam_eff) * coalesce(o, 0) AS r FROM ("
    " SELECT *, CASE WHEN max(CASE WHEN e IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY qid) = 1"
    f" THEN CAST({LAM} AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS lam_eff FROM em)",
    "em",
)
cte(
    "supp",
    f"SELECT rm.qid, rm.term, rm.r, b.p_bg FROM rm JOIN bg b USING (qid, term) WHERE rm.r > 0 AND {MU} * b.p_bg > 0",
    "rm",
    "bg",
)
cte(
    "score_b",
    "SELECT c.qid, c.doc_id, 1 - coalesce(sum(s.r * log10(s.r / ((coalesce(t.tf, 0) + "
    f"{MU} * s.p_bg) / (c.doc_len + {MU})))), 0) AS score"
    " FROM clen c LEFT JOIN supp s ON s.qid = c.qid"
    " LEFT JOIN ctf t ON t.qid = c.qid AND t.doc_id = c.doc_id AND t.term = s.term"
    " GROUP BY c.qid, c.doc_id",
    "clen",
    "supp",
    "ctf",
)
cte(
    "run_b",
    "SELECT qid, doc_id, CAST(row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, doc_id)"
    " AS INTEGER) AS rank, score FROM score_b",
    "score_b",
)


# ---- evaluation (score.py semantics) over a run CTE named run_x -------------
# run_x: (setting_id, qid, doc_id, rank[, score]); settings_ids: (setting_id)
cte("cuts", "SELECT * FROM (VALUES (5), (10), (50)) t(cutoff)")
cte("gold", "SELECT DISTINCT qid FROM qrels", "qrels")
cte(
    "idcg",
    "SELECT i.qid, c.cutoff, sum(CASE WHEN i.pos <= c.cutoff THEN i.rel / log2(i.pos + 1) ELSE 0 END) AS idcg"
    " FROM (SELECT qid, CAST(relevance AS DOUBLE) AS rel,"
    "  row_number() OVER (PARTITION BY qid ORDER BY relevance DESC, doc_id) AS pos FROM qrels) i"
    " CROSS JOIN cuts c GROUP BY i.qid, c.cutoff",
    "qrels",
    "cuts",
)
cte(
    "before_pos",
    "SELECT c.qid, row_number() OVER (PARTITION BY c.qid ORDER BY c.pos) AS pos,"
    " CAST(coalesce(g.relevance, 0) AS DOUBLE) AS rel FROM cand c LEFT JOIN qrels g ON g.qid = c.qid AND g.doc_id = c.doc_id",
    "cand",
    "qrels",
)
cte(
    "dcg_before",
    "SELECT b.qid, c.cutoff, sum(CASE WHEN b.pos <= c.cutoff THEN b.rel / log2(b.pos + 1) ELSE 0 END) AS dcg"
    " FROM before_pos b CROSS JOIN cuts c GROUP BY b.qid, c.cutoff",
    "before_pos",
    "cuts",
)
cte(
    "after_pos",
    "SELECT r.setting_id, r.qid, row_number() OVER (PARTITION BY r.setting_id, r.qid ORDER BY r.rank) AS pos,"
    " CAST(coalesce(g.relevance, 0) AS DOUBLE) AS rel FROM run_x r LEFT JOIN qrels g ON g.qid = r.qid AND g.doc_id = r.doc_id",
    "run_x",
    "qrels",
)
cte(
    "evq",
    "SELECT DISTINCT setting_id, qid FROM run_x WHERE qid IN (SELECT qid FROM gold) AND qid IN (SELECT qid FROM cand)",
    "run_x",
    "gold",
    "cand",
)
cte(
    "perq",
    "SELECT d.setting_id, d.qid, d.stage, CAST(d.cutoff AS INTEGER) AS cutoff,"
    " CASE WHEN i.idcg > 0 THEN d.dcg / i.idcg ELSE 0.0 END AS ndcg FROM ("
    "  SELECT a.setting_id, a.qid, 'after' AS stage, c.cutoff,"
    "   sum(CASE WHEN a.pos <= c.cutoff THEN a.rel / log2(a.pos + 1) ELSE 0 END) AS dcg"
    "  FROM after_pos a JOIN evq e ON e.setting_id = a.setting_id AND e.qid = a.qid CROSS JOIN cuts c"
    "  GROUP BY a.setting_id, a.qid, c.cutoff"
    "  UNION ALL SELECT e.setting_id, b.qid, 'before' AS stage, b.cutoff, b.dcg FROM dcg_before b JOIN evq e USING (qid)"
    " ) d LEFT JOIN idcg i ON i.qid = d.qid AND i.cutoff = d.cutoff",
    "after_pos",
    "evq",
    "cuts",
    "dcg_before",
    "idcg",
)
cte(
    "meanq",
    "SELECT s.setting_id, st.stage, CAST(c.cutoff AS INTEGER) AS cutoff, avg(coalesce(p.ndcg, 0.0)) AS ndcg"
    " FROM gold g CROSS JOIN (VALUES ('before'), ('after')) st(stage) CROSS JOIN cuts c CROSS JOIN settings_ids s"
    " LEFT JOIN perq p ON p.setting_id = s.setting_id AND p.qid = g.qid AND p.stage = st.stage AND p.cutoff = c.cutoff"
    " GROUP BY s.setting_id, st.stage, c.cutoff",
    "gold",
    "cuts",
    "settings_ids",
    "perq",
)
cte(
    "trec",
    "SELECT d.qid, CAST(d.cutoff AS INTEGER) AS cutoff, CASE WHEN i.idcg > 0 THEN d.dcg / i.idcg ELSE 0.0 END AS ndcg FROM ("
    " SELECT a.qid, c.cutoff, sum(CASE WHEN c.cutoff = 0 OR a.pos <= c.cutoff THEN a.rel / log2(a.pos + 1) ELSE 0 END) AS dcg"
    " FROM (SELECT r.qid, row_number() OVER (PARTITION BY r.qid ORDER BY round(r.score, 4) DESC,"
    "   CAST(r.doc_id AS VARCHAR) DESC) AS pos, CAST(coalesce(g.relevance, 0) AS DOUBLE) AS rel"
    "   FROM run_x r LEFT JOIN qrels g ON g.qid = r.qid AND g.doc_id = r.doc_id) a"
    " CROSS JOIN (VALUES (0), (5), (10), (50)) c(cutoff) GROUP BY a.qid, c.cutoff) d"
    " LEFT JOIN (SELECT i.qid, c.cutoff, sum(CASE WHEN c.cutoff = 0 OR i.pos <= c.cutoff THEN i.rel / log2(i.pos + 1) ELSE 0 END) AS idcg"
    "  FROM (SELECT qid, CAST(relevance AS DOUBLE) AS rel, row_number() OVER (PARTITION BY qid ORDER BY relevance DESC, doc_id) AS pos"
    "   FROM qrels WHERE relevance > 0) i CROSS JOIN (VALUES (0), (5), (10), (50)) c(cutoff) GROUP BY i.qid, c.cutoff) i"
    " ON i.qid = d.qid AND i.cutoff = d.cutoff WHERE d.qid IN (SELECT qid FROM gold)",
    "run_x",
    "qrels",
    "gold",
)

# ---- sweeps: Score B per (mu, lambda) setting --------------------------------
cte(
    "em_flag",
    "SELECT *, max(CASE WHEN e IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY qid) AS has_e FROM em",
    "em",
)
cte(
    "rm_s",
    "SELECT s.setting_id, s.mu, f.qid, f.term, CASE WHEN f.has_e = 1 THEN s.lam ELSE 0.0 END * coalesce(f.e, 0)"
    " + (1.0 - CASE WHEN f.has_e = 1 THEN s.lam ELSE 0.0 END) * coalesce(f.o, 0) AS r"
    " FROM em_flag f CROSS JOIN settings s",
    "em_flag",
    "settings",
)
cte(
    "score_s",
    "SELECT c.setting_id, c.qid, c.doc_id, 1 - coalesce(sum(s.r * log10(s.r / ((coalesce(t.tf, 0) + c.mu * s.p_bg)"
    " / (c.doc_len + c.mu)))), 0) AS score"
    " FROM (SELECT st.setting_id, st.mu, cl.* FROM clen cl CROSS JOIN settings st) c"
    " LEFT JOIN (SELECT rm_s.*, b.p_bg FROM rm_s JOIN bg b USING (qid, term) WHERE rm_s.r > 0 AND rm_s.mu * b.p_bg > 0) s"
    "  ON s.setting_id = c.setting_id AND s.qid = c.qid"
    " LEFT JOIN ctf t ON t.qid = c.qid AND t.doc_id = c.doc_id AND t.term = s.term"
    " GROUP BY c.setting_id, c.qid, c.doc_id",
    "clen",
    "settings",
    "rm_s",
    "bg",
    "ctf",
)


def with_ctes(select: str, *roots: str, extra: dict | None = None) -> str:
    """``WITH`` clause holding ``roots`` and everything they depend on, then ``select``.

    ``extra`` adds or overrides CTEs for this statement only (name -> (sql, deps)).
    """
    table = dict(CTE)
    table.update(extra or {})
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in table[n][1]:
            visit(d)
        order.append(n)

    for r in roots:
        visit(r)
    if not order:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({table[n][0]})" for n in order) + "\n" + select


# ---- local contexts (Task 1) --------------------------------------------------
cte(
    "cpos",
    "SELECT qid, doc_id, i, tokens[i] AS term FROM (SELECT qid, doc_id, tokens, unnest(range(1, len(tokens) + 1)) AS i FROM ctok)",
    "ctok",
)
cte(
    "ctx",
    "SELECT a.qid, a.term AS t, b.term AS w, count(*) AS n FROM cpos a JOIN (SELECT DISTINCT qid, term FROM qtf) q"
    " ON q.qid = a.qid AND q.term = a.term JOIN cpos b ON b.qid = a.qid AND b.doc_id = a.doc_id"
    " AND b.i BETWEEN a.i - 20 AND a.i + 20 AND b.i <> a.i GROUP BY a.qid, a.term, b.term",
    "cpos",
    "qtf",
)
#: For ``with_ctes``: expansions from local contexts.
LOCAL = {
    "exps": (
        "SELECT qid, CAST(rk AS INTEGER) AS rk, term, sim FROM ("
        " SELECT *, row_number() OVER (PARTITION BY qid ORDER BY sim DESC, term) AS rk FROM ("
        "  SELECT x.qid, x.w AS term, round(sum(q.qtf * greatest(ln(x.n * CAST(bw.n AS DOUBLE)"
        "   / (CAST(bt.cf AS DOUBLE) * bw.cf)), 0)), 9) AS sim"
        "  FROM ctx x JOIN bg bw ON bw.qid = x.qid AND bw.term = x.w JOIN bg bt ON bt.qid = x.qid AND bt.term = x.t"
        "  JOIN qtf q ON q.qid = x.qid AND q.term = x.t GROUP BY x.qid, x.w) WHERE sim > 0) WHERE rk <= " + str(K),
        ("ctx", "bg", "qtf"),
    )
}


def run_of(cte_name: str) -> dict:
    """``run_x`` / ``settings_ids`` for evaluating a single (non-sweep) run CTE."""
    return {
        "run_x": (f"SELECT 0 AS setting_id, qid, doc_id, rank, score FROM {cte_name}", (cte_name,)),
        "settings_ids": ("SELECT 0 AS setting_id", ()),
    }


def sweep_of(settings) -> dict:
    """``settings`` / ``run_x`` / ``settings_ids`` for a sweep over (mu, lam) pairs."""
    rows = ", ".join(f"({i}, CAST({float(m)} AS DOUBLE), CAST({float(l)} AS DOUBLE))" for i, (m, l) in enumerate(settings))
    return {
        "settings": (f"SELECT * FROM (VALUES {rows}) t(setting_id, mu, lam)", ()),
        "settings_ids": ("SELECT setting_id FROM settings", ("settings",)),
        "run_x": (
            "SELECT setting_id, qid, doc_id, CAST(row_number() OVER (PARTITION BY setting_id, qid"
            " ORDER BY round(score, 9) DESC, doc_id) AS INTEGER) AS rank, score FROM score_s",
            ("score_s",),
        ),
    }


def local_vectors(d: int, window: int, rounds: int, negatives: int = 1) -> dict:
    """CTEs up to ``lvec`` (qid, term, y_0, ...): vectors of the queries' own candidates."""
    ahead = ", ".join(f"lead(term, {k}) OVER d" for k in range(1, window + 1))
    out = {
        "lfwd": (
            f"SELECT qid, t, w, count(*) AS n FROM (SELECT qid, term AS t, unnest([{ahead}]) AS w FROM cpos"
            " WINDOW d AS (PARTITION BY qid, doc_id ORDER BY i)) WHERE w IS NOT NULL GROUP BY qid, t, w",
            ("cpos",),
        ),
        "lcnt": (
            "SELECT qid, t, w, sum(n) AS n FROM (SELECT qid, t, w, n FROM lfwd UNION ALL SELECT qid, w, t, n FROM lfwd) GROUP BY qid, t, w",
            ("lfwd",),
        ),
        "lrow": ("SELECT qid, t, sum(n) AS r FROM lcnt GROUP BY qid, t", ("lcnt",)),
        "ltot": ("SELECT qid, sum(r) AS d FROM lrow GROUP BY qid", ("lrow",)),
        "lm": (
            f"SELECT * FROM (SELECT c.qid, c.t, c.w, ln(CAST(c.n AS DOUBLE) * d / (CAST(a.r AS DOUBLE) * b.r * {negatives})) AS m"
            " FROM lcnt c JOIN lrow a ON a.qid = c.qid AND a.t = c.t JOIN lrow b ON b.qid = c.qid AND b.t = c.w"
            " JOIN ltot ON ltot.qid = c.qid) WHERE m > 0",
            ("lcnt", "lrow", "ltot"),
        ),
    }

    def number(digits: str) -> str:
        return f"CAST(CAST('0x' || {digits} AS BIGINT) AS DOUBLE)"

    starts = ", ".join(f"{lv.start_sql(i, number)} AS x_{i}" for i in range(d))
    out["lx0"] = (f"SELECT qid, term, {starts} FROM (SELECT DISTINCT qid, t AS term FROM lm)", ("lm",))
    sums = ", ".join(f"sum(m * x_{i}) AS y_{i}" for i in range(d))
    for r in range(rounds + 1):
        y = f"ly{r}" if r < rounds else "lvec"
        out[y] = (f"SELECT lm.qid, lm.t AS term, {sums} FROM lm JOIN lx{r} x ON x.qid = lm.qid AND x.term = lm.w GROUP BY lm.qid, lm.t", ("lm", f"lx{r}"))
        if r == rounds:
            break
        factor = f"(SELECT qid, {', '.join(f'{e} AS {c}' for c, e in lv.gram_sql(d))} FROM {y} GROUP BY qid)"
        for c, e in lv.cholesky_sql(d):
            factor = f"(SELECT *, {e} AS {c} FROM {factor})"
        rows = f"(SELECT y.*, f.* EXCLUDE (qid) FROM {y} y JOIN {factor} f ON f.qid = y.qid)"
        for c, e in lv.orthonormal_sql(d):
            rows = f"(SELECT *, {e} AS {c} FROM {rows})"
        out[f"lx{r + 1}"] = (f"SELECT qid, term, {', '.join(f'x_{i}' for i in range(d))} FROM {rows}", (y,))
    centre = ", ".join(f"sum(qtf * y_{i}) AS c_{i}" for i in range(d))
    product = " + ".join(f"y_{i} * c_{i}" for i in range(d))
    out["exps"] = (
        "SELECT qid, CAST(rk AS INTEGER) AS rk, term, sim FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY sim DESC, term) AS rk"
        f" FROM (SELECT v.qid, v.term, round({product}, 9) AS sim FROM lvec v JOIN (SELECT v.qid, {centre} FROM lvec v"
        f" JOIN qtf q ON q.qid = v.qid AND q.term = v.term GROUP BY v.qid) c ON c.qid = v.qid)) WHERE rk <= {K}",
        ("lvec", "qtf"),
    )
    return out
