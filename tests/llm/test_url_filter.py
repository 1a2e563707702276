import re

from relmod.llm import url_filter
from relmod.llm.queries import URL_RULES

SCHEMA = "page_id long, url string, html string, host string, verdict int, pages int"


def split(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return ("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")


def plain(pages, rules, iterations=url_filter.ITERATIONS, d=url_filter.DAMPING):
    ruled, edges, hosts = [], set(), {}
    for page_id, url, html, *_ in pages:
        host, path = split(url)
        fit = [(len(r), r, v) for v, r in rules if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.partition("/")[2])]
        rule, said = max(fit)[1:] if fit else (None, None)
        ruled.append((page_id, host, path, rule, said))
        if host:
            n = hosts.setdefault(host, {"n": 0, "allow": 0, "block": 0})
            n["n"] += 1
            if said:
                n[said] += 1
            for to in re.findall(url_filter.LINK, html or ""):
                if (to := to.lower()) != host:
                    edges.add((host, to))
    excess = dict.fromkeys(hosts, 0.0)
    for said, sign, ways in (("allow", -1, edges), ("block", 1, {(b, a) for a, b in edges})):
        out = {}
        for a, _ in ways:
            out[a] = out.get(a, 0) + 1
        seed = {h: (1 - d) * n[said] for h, n in hosts.items()}
        rank = dict(seed)
        for _ in range(iterations):
            new = dict(seed)
            for a, b in ways:
                new[b] = new.get(b, 0) + d * rank.get(a, 0) / out[a]
            rank = new
        for h in excess:
            excess[h] += sign * rank.get(h, 0)
    bad = {h for h, n in hosts.items() if excess[h] > n["n"] * url_filter.THRESHOLD * (1 - d) + 1e-9}
    return sorted(((p, h, path, r, s or ("block" if h in bad else "allow")) for p, h, path, r, s in ruled), key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("page_id", "host", "path", "rule", "verdict").collect()), key=repr)


def test_links_carry_trust_and_distrust(spark):
    def a(*hosts):
        return "".join(f"<a HREF='https://{h}/x'>" for h in hosts)

    pages = [
        (1, "http://Spam.net/x", a("shop.com"), "h", 1, 1),
        (2, "http://shop.com/", a("spam.net", "spam2.net", "www.spam.net"), "h", 1, 1),  # links to blocked hosts
        (3, "https://fair.com/en/1", a("a.org"), "h", 1, 1),
        (4, "https://a.org/fr/", a("fair.com"), "h", 1, 1),
        (5, "http://spam2.net", a("fair.com"), "h", 1, 1),  # an empty path fits no rule
        (6, "http://spam2.net/", a("fair.com"), "h", 1, 1),
        (7, "http://www.spam.net/?q", "", "h", 1, 1),
        (8, "http://spam.example.net/en/9", None, "h", 1, 1),
        (9, "http://example.com/de/9?x://y", "<a href=/de/local>", "h", 1, 1),
        (10, "http://xexample.com/de/9", "", "h", 1, 1),
        (11, None, a("fair.com"), None, None, None),
        (12, "no host", "", "h", 1, 1),
        (13, "a://b://c/d", "", "h", 1, 1),
        (14, "http://far.com/", a("shop.com"), "h", 1, 1),  # distrust reaches it in two steps
        (2, "http://shop.com/", a("spam.net", "spam2.net", "www.spam.net"), "h", 1, 1),
        (15, "http://long.com/" + "p" * 100_000, "x" * 300_000 + a("fair.com"), "h", 1, 1),
    ]
    got = rows_of(url_filter.judge(spark.createDataFrame(pages, SCHEMA), URL_RULES))
    assert got == plain(pages, URL_RULES)
    assert {r[0]: r[4] for r in got if r[0] in (2, 3)} == {2: "block", 3: "allow"}


def test_sql_on_linked_pages(spark):
    import duckdb

    pages = [(i, f"http://h{i % 9}.{'net' if i % 4 else 'com'}/{'de' if i % 5 else ''}/{i}", "".join(f'<a href="//h{j}.com/">' for j in range(i % 6)), "h", 1, 1) for i in range(120)]
    df = spark.createDataFrame(pages, SCHEMA)
    db = duckdb.connect()
    pages_table = df.select("page_id", "url", "html").toPandas()  # noqa: F841
    db.register("pages", pages_table)
    assert rows_of(url_filter.judge(df, URL_RULES)) == plain(pages, URL_RULES)
    sql = db.execute(f"SELECT page_id, host, path, rule, verdict FROM ({url_filter.judge_sql(URL_RULES)})").fetchall()
    assert sorted(sql, key=repr) == plain(pages, URL_RULES)


def test_empty_table(spark):
    assert url_filter.judge(spark.createDataFrame([], SCHEMA), URL_RULES).collect() == []


def test_chains_are_followed_to_the_end(spark):
    n = 40
    pages = [(i, f"http://c{i}.com/", f'<a href="http://c{i + 1}.com/">', "h", 1, 1) for i in range(1, n + 1)]  # c41 is the last
    pages += [(1000 + i, "http://c41.com/de/", None, "h", 1, 1) for i in range(100)]
    pages += [(2000 + i, f"http://r{i}.com/", f'<a href="http://r{(i + 1) % 3}.com/"><a href="http://c1.com/">', "h", 1, 1) for i in range(3)]
    rules = [("block", "c41.com/de/")]
    got = rows_of(url_filter.judge(spark.createDataFrame(pages, SCHEMA), rules))
    assert got == plain(pages, rules, iterations=400)
    assert sorted(r[0] for r in got if r[4] == "block" and r[0] <= n) == list(range(9, n + 1))  # up to 32 links away
    assert plain(pages, rules, iterations=url_filter.ITERATIONS) != got


def test_targets_without_pages_are_seeds(spark):
    pages = [(1, "http://a.com/", '<a href="http://x.net/1">', "h", 1, 1), (2, "http://b.com/", '<a href="http://x.example.com/">', "h", 1, 1)]
    rules = [("block", "net/"), ("block", "example.com/de/"), ("allow", "x.org/")]
    df = spark.createDataFrame(pages, SCHEMA)
    assert {r[0]: r[4] for r in rows_of(url_filter.judge(df, rules))} == {1: "block", 2: "allow"}
    assert {r[0]: r[4] for r in rows_of(url_filter.judge(df, [*rules, ("allow", "x.net/")]))} == {1: "allow", 2: "allow"}
