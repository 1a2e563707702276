"""URL filtering by rules and link-graph propagation [native].

Rules decide the urls they fit. Every other url gets its host's verdict:
personalised PageRank flows along the host edges from the pages that rules
allow, distrust flows along the reversed edges from the pages that rules
block (a host that links to blocked hosts inherits distrust), and a host is
blocked once its distrust outweighs its trust by a share of its pages.

A host edge is a link from a page of one host to another host; links inside a
host (relative ones among them) are none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relmod.llm.common import stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""

DAMPING = 0.85
#: The rounds of the SQL, which has no loop that ends by a test.
ITERATIONS = 8
#: Rounds go on until all scores together can change by no more than this, in pages.
TOLERANCE = 1e-6
#: A host is blocked if its distrust less its trust, in pages, is over this share of its pages.
THRESHOLD = 0.5
#: Sums of floating-point numbers may differ this much with their order; they never tip a verdict.
SLACK = 1e-9


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, both null if none does.

    ``rules`` are (verdict, 'host/path') pairs; a rule fits its host and all
    subdomains if the path starts with the rule's, which begins at its first ``/``.
    """
    rule = verdict = F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the longest is tested first, so wrapped last
        name, slash, rest = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Distinct (src, dst) of links from one host to another."""
    to = F.explode(F.array_distinct(F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(LINK), 1)))
    return (
        pages.select(host_of(F.col(url)).alias("src"), to.alias("_to"))
        .select("src", F.translate("_to", _UPPER, _LOWER).alias("dst"))
        .filter((F.col("src") != "") & (F.col("src") != F.col("dst")))
        .distinct()
    )


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, kind, score): trust along the edges and distrust against them.

    ``seeds`` has (host, kind, weight); kind is 'trust' or 'distrust'. Both flow
    in one job. The score is the PageRank personalised by the seeds, times the
    sum of their weights; mass at a host without further edges ends there.

    A round moves what the last one added. Each keeps at most ``damping`` of
    it, so all later rounds together add at most damping / (1 - damping) of
    what the last one added; they end when that is at most ``tolerance``.
    """
    both = stored(
        edges.select(F.lit("trust").alias("kind"), "src", "dst").unionByName(
            edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"))
        ),
        "edges",
    )
    degree = both.groupBy("kind", "src").agg(F.count(F.lit(1)).alias("_out"))
    flow = stored(
        both.join(degree, ["kind", "src"]).select("kind", "src", "dst", (F.lit(damping) / F.col("_out")).alias("_w")),
        "flow",
    )
    score = F.col("weight") * (1 - damping)
    state = seeds.groupBy("host", "kind").agg(F.sum(score).alias("score"), F.sum(score).alias("added"))
    left = float("inf")
    while left > tolerance:
        for _ in range(4):
            moved = (
                flow.join(state.filter("added > 0").select(F.col("host").alias("src"), "kind", "added"), ["kind", "src"])
                .groupBy(F.col("dst").alias("host"), "kind")
                .agg(F.sum(F.col("added") * F.col("_w")).alias("added"))
            )
            both_rounds = state.select("host", "kind", "score", F.lit(0.0).alias("added")).unionByName(
                moved.select("host", "kind", F.col("added").alias("score"), "added")
            )
            state = both_rounds.groupBy("host", "kind").agg(F.sum("score").alias("score"), F.sum("added").alias("added"))
        state = stored(state, "ranks")
        left = (state.agg(F.sum("added")).first()[0] or 0.0) * damping / (1 - damping)
    return state.select("host", "kind", "score")


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]],
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    threshold: float = THRESHOLD,
    damping: float = DAMPING,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict ('allow' or 'block').

    A null url, or one without ``://``, has an empty host and path, fits no
    rule and is allowed. Null html has no links. Repeated rows are judged
    alike and each counts as a page. A host without trust or distrust is
    allowed. A host that occurs as a link's target only counts as one page if a
    rule without a path covers it. An empty table gives an empty result; other columns are not read.

    Pages are counted per host before anything is joined, so a host with a
    large share of all pages is one row of the graph; the last join meets
    pages with hosts and can split a large host.
    """
    host, path = host_of(F.col(url)), path_of(F.col(url))
    placed = pages.select(F.col(key).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = placed.select("*", rule.alias("rule"), verdict.alias("_said"))

    hosts = stored(
        ruled.filter(F.col("host") != "")
        .groupBy("host")
        .agg(
            F.count(F.lit(1)).alias("pages"),
            F.count_if(F.col("_said") == "allow").alias("trust"),
            F.count_if(F.col("_said") == "block").alias("distrust"),
        ),
        "hosts",
    )
    seeds = hosts.selectExpr("host", "stack(2, 'trust', trust, 'distrust', distrust) as (kind, weight)").filter("weight > 0")
    edges = stored(host_edges(pages, url, html), "links")
    whole = [(said, text) for said, text in rules if text.partition("/")[2] == ""]
    targets = edges.select(F.col("dst").alias("host")).distinct().join(hosts, "host", "left_anti")
    kind = F.when(rule_of(F.col("host"), F.lit("/"), whole)[1] == "allow", "trust").otherwise("distrust")
    linked = targets.filter(rule_of(F.col("host"), F.lit("/"), whole)[1].isNotNull())
    seeds = seeds.unionByName(linked.select("host", kind.alias("kind"), F.lit(1).cast("long").alias("weight")))
    ranks = propagate(seeds, edges, damping, tolerance)
    excess = ranks.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == "distrust", F.col("score")).otherwise(-F.col("score"))).alias("_excess")
    )
    blocked = (
        hosts.join(excess, "host")
        .filter(F.col("_excess") > F.col("pages") * (threshold * (1 - damping)) + SLACK)
        .select("host", F.lit("block").alias("_host_said"))
    )
    return ruled.join(blocked, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("_said", "_host_said", F.lit("allow")).alias("verdict")
    )


def judge_sql(rules: Sequence[tuple[str, str]], threshold: float = THRESHOLD, damping: float = DAMPING, iterations: int = ITERATIONS) -> str:
    """The same verdicts over a table ``pages`` in DuckDB's SQL."""
    cases = {"rule": "", "said": ""}
    for said, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, slash, rest = text.partition("/")
        fits = f"(host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{slash}{rest}')"
        cases["rule"] += f" WHEN {fits} THEN '{text}'"
        cases["said"] += f" WHEN {fits} THEN '{said}'"
    link = LINK.replace("'", "''")
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = "r0 AS (SELECT * FROM base)"
    for i in range(iterations):
        steps += f""",
        r{i + 1} AS MATERIALIZED (
            SELECT host, kind, sum(score) AS score FROM (
                SELECT f.dst AS host, f.kind, r.score * f.w AS score FROM flow f JOIN r{i} r ON r.host = f.src AND r.kind = f.kind
                UNION ALL SELECT host, kind, score FROM base) GROUP BY host, kind)"""
    return rf"""
        WITH p AS (
            SELECT page_id, html, {lower.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")} AS host,
                   regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
        ruled AS (SELECT page_id, html, host, path, CASE{cases["rule"]} END AS rule, CASE{cases["said"]} END AS said FROM p),
        hosts AS (
            SELECT host, count(*) AS pages, count(*) FILTER (WHERE said = 'allow') AS trust,
                   count(*) FILTER (WHERE said = 'block') AS distrust FROM ruled WHERE host <> '' GROUP BY host),
        base AS (
            SELECT host, 'trust' AS kind, trust * {1 - damping} AS score FROM hosts WHERE trust > 0
            UNION ALL SELECT host, 'distrust', distrust * {1 - damping} FROM hosts WHERE distrust > 0),
        links AS (
            SELECT host AS src, {lower.format("unnest(regexp_extract_all(coalesce(html, ''), '" + link + "', 1))")} AS dst FROM ruled),
        edges AS (SELECT DISTINCT src, dst FROM links WHERE src <> '' AND src <> dst),
        both_ways AS (SELECT 'trust' AS kind, src, dst FROM edges UNION ALL SELECT 'distrust', dst, src FROM edges),
        flow AS MATERIALIZED (SELECT *, {damping} / count(*) OVER (PARTITION BY kind, src) AS w FROM both_ways),
        {steps},
        excess AS (SELECT host, sum(CASE kind WHEN 'distrust' THEN score ELSE -score END) AS excess FROM r{iterations} GROUP BY host),
        blocked AS (
            SELECT host FROM hosts JOIN excess USING (host) WHERE excess > pages * {threshold * (1 - damping)} + {SLACK})
        SELECT page_id, ruled.host, path, rule, coalesce(said, CASE WHEN blocked.host IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
        FROM ruled LEFT JOIN blocked ON blocked.host = ruled.host
    """
