"""Headline benchmark: wall time of the re-ranking, evaluation and sweep pipelines.

Runs on ``local[$BENCH_CPUS]`` against ``$BENCH_SF_DIR`` (default sf0.1) and
prints one JSON line. The test tables' fixtures (queries, candidate lists,
judgements, vectors) are inputs: they are built and stored before any clock
runs. A small run of every pipeline comes first, so that code is compiled; then
each is computed ``$BENCH_RUNS`` times (default 3) with the ``noop`` sink, and
the median counts. ``calibration`` is a fixed job of hashing and sorting that
reads no table: times of two machines, or of one under other load, compare as
multiples of it. ``BENCH_QUERIES`` (comma-separated) overrides the list.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from relmod.plans import catalog  # noqa: E402
from relmod.plans import pipelines as P  # noqa: E402
from relmod.session import local_session, materialize  # noqa: E402
from relmod.sources import fixtures as X  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def computed(df) -> None:
    df.write.format("noop").mode("overwrite").save()


class Inputs:
    """The fixtures of one folder, stored."""

    def __init__(self, spark, sf_dir: str):
        fx = X.Fixtures(spark, sf_dir)
        self.lists = fx.queries(), fx.candidates(), fx.collection()
        self.vectors, self.qrels = fx.vectors(), fx.qrels()
        self._run = None

    def run(self):
        if self._run is None:
            self._run = materialize(P.rerank_feedback(*self.lists))
        return self._run


def _evaluated(run, x: Inputs) -> None:
    for df in P.evaluate(run, x.lists[1], x.qrels):
        computed(df)


HEADLINE = {
    "rerank_feedback": lambda x: computed(P.rerank_feedback(*x.lists)),
    "rerank_embeddings": lambda x: computed(P.rerank_embeddings(*x.lists, x.vectors)[0]),
    "rerank_local": lambda x: computed(P.rerank_local(*x.lists)[0]),
    "expansions": lambda x: computed(P.expansions_from_vectors(x.lists[0], x.vectors)),
    "ndcg_mean": lambda x: computed(P.evaluate(P.rerank_feedback(*x.lists), x.lists[1], x.qrels)[1]),
    "sweep_mu": lambda x: computed(P.sweep_embeddings(*x.lists, x.vectors, x.qrels, catalog.MU_SWEEP)),
    "evaluate": lambda x: _evaluated(x.run(), x),
}


def calibrate(spark) -> None:
    numbers = spark.range(0, 20_000_000, 1, 16).select(F.xxhash64("id").alias("h"), F.md5(F.col("id").cast("string")).alias("m"))
    computed(numbers.groupBy(F.pmod("h", F.lit(1_000_000)).alias("k")).agg(F.max("m").alias("m")).orderBy("m"))


def seconds(job, *args) -> float:
    t0 = time.time()
    job(*args)
    return time.time() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * int(cpus)), app="relmod-bench")
    small, inputs = Inputs(spark, SMALL), Inputs(spark, sf_dir)
    calibrate(spark)
    calibration = [seconds(calibrate, spark)]
    times: dict[str, float] = {}
    for name in names:
        HEADLINE[name](small)
        if name == "evaluate":
            inputs.run()
        times[name] = round(statistics.median(seconds(HEADLINE[name], inputs) for _ in range(runs)), 3)
    calibration.append(seconds(calibrate, spark))
    documents = X.table(spark, sf_dir, "documents").count()
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    fixed = statistics.mean(calibration)
    print(
        json.dumps(
            {
                "metric": "rerank_suite_wall",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "calibration": round(fixed, 3),
                "in_calibrations": {n: round(t / fixed, 2) for n, t in times.items()},
                "documents_per_second": {n: round(documents / t, 1) for n, t in times.items() if n.startswith("rerank")},
                "runs": runs,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": int(cpus),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
