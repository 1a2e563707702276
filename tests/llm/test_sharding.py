import zlib

from relmod.llm import sharding

SCHEMA = "doc_id long, text string, shard string, slot int"


def jump(key: int, n: int) -> int:
    """The published algorithm."""
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_equals_the_published_algorithm(spark):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), 10863919174838991, 2016238256797177309, *range(1000, 1400), *range(-50, 0)]
    df = spark.createDataFrame([(k,) for k in keys], "doc_id long")
    for n in (1, 2, 8, 40, 1000):
        got = {r[0]: (r[1], r[2]) for r in sharding.shard_rows(df, n).collect()}
        assert got == {k: (jump(k, n), jump(k, n + 1)) for k in keys}


def test_manifest(spark):
    rows = [(i, "é" * (i % 9) if i % 10 else None, "clash", 7) for i in range(500)]
    rows += [(3, "again", "clash", 7), (3, "again", "clash", 7), (None, "no key", None, None), (900, "w " * 100_000, "", 0)]
    got = sharding.manifest(spark.createDataFrame(rows, SCHEMA), 40).collect()
    want = sorted((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows if r[0] is not None)
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in got if r.doc_id is not None) == want
    assert {r.law for r in got} == {"key"}
    by = {}
    for r in got:
        assert r.shard == jump(r.doc_id or 0, 40) and r.grown_shard in (r.shard, 40)
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())


def test_empty_table(spark):
    assert sharding.manifest(spark.createDataFrame([], SCHEMA), 40).collect() == []


def test_written_shards(spark, tmpdir_run):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(200)], "doc_id long, text string")
    sharding.write_shards(df, f"{tmpdir_run}/shards", 5)
    back = spark.read.parquet(f"{tmpdir_run}/shards")
    assert {r.doc_id: r.shard for r in back.collect()} == {i: jump(i, 5) for i in range(200)}
