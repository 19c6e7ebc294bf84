"""Headline pipelines at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Timed steps (each on the driver's tables at the given scale). The headline
value is the sum of the pipeline steps; ``envelope_setup`` (building the raw
input files, which the pipeline itself never writes) is reported but not summed.
  envelope_setup  m (orders x customer x nation) -> raw envelope files
  c1_bronze    raw envelope files -> Bronze (scan, explode, stamp, partitioned append)
  c2_silver    Bronze new rows -> parse once -> Silver append + one status merge into Bronze
  c3_repair    quarantined Bronze rows -> dedupe, abs(RunTime) -> Silver + merge + genres/languages
  split        parse + three-way split of the Bronze batch (noop sink, all rows)
  g1_genres    genre lookup over Silver (noop sink)
  c5_prepare   events -> landing backlog with time parts (partitioned by month, day)
  c4_land      one landing batch (hours=10) out of the backlog, with the key delete
  c4_drain3    three more batches
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


from strata.functions.records import parse_records, unpack  # noqa: E402
from strata.operators.dimensions import genre_lookup  # noqa: E402
from strata.operators.landing import land_next_batch, prepare_activity_path  # noqa: E402
from strata.operators.quality import split  # noqa: E402
from strata.plans.bronze_to_silver import bronze_to_silver  # noqa: E402
from strata.plans.raw_to_bronze import raw_to_bronze  # noqa: E402
from strata.plans.silver_update import repair_quarantined  # noqa: E402
from strata.session import build_session, fresh_dir  # noqa: E402
from strata.sinks.envelope import write_envelope  # noqa: E402
from strata.sources.driver_tables import activity_records, movie_records  # noqa: E402
from strata.sources.tables import read_by_status  # noqa: E402


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def run_pipeline(spark, sf_dir: str, cpus: int, timed) -> dict:
    raw = fresh_dir(spark, "bench-raw")
    timed("envelope_setup", lambda: write_envelope(movie_records(spark, sf_dir), raw))
    bronze, silver = fresh_dir(spark, "bench-bronze"), fresh_dir(spark, "bench-silver")
    timed("c1_bronze", lambda: raw_to_bronze(spark, raw, bronze, ingest_ts="2024-01-31 12:00:00",
                                             multiline=False))
    timed("split", lambda: [noop(p) for p in split(
        unpack(parse_records(read_by_status(spark, bronze, "new"))))])
    timed("c2_silver", lambda: bronze_to_silver(spark, bronze, silver))
    gp, lp = fresh_dir(spark, "bench-genre"), fresh_dir(spark, "bench-lang")
    timed("c3_repair", lambda: repair_quarantined(spark, bronze, silver, genre_path=gp, language_path=lp))
    timed("g1_genres", lambda: noop(genre_lookup(spark.read.parquet(silver))))
    landing = fresh_dir(spark, "bench-landing")
    timed("c5_prepare", lambda: prepare_activity_path(spark, activity_records(spark, sf_dir), landing,
                                                      tz="UTC", tie_breaker="event_id"))
    landed = fresh_dir(spark, "bench-landed")
    timed("c4_land", lambda: land_next_batch(spark, landing, landed, hours=10, tie_breaker="event_id",
                                             batch_name="b0"))
    timed("c4_drain3", lambda: [land_next_batch(spark, landing, landed, hours=10, tie_breaker="event_id",
                                                batch_name=f"b{i}") for i in (1, 2, 3)])
    status = {r.status: r["count"] for r in spark.read.parquet(bronze).groupBy("status").count().collect()}
    return {"records": movie_records(spark, sf_dir).count(), "bronze_status": status}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    warm_dir = os.environ.get("BENCH_WARMUP_DIR",
                              os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus * 2,
                          **{"spark.ui.showConsoleProgress": "false",
                             "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")})
    # warm-up (JVM, JIT, codegen, Python workers): the same pipeline once on the
    # smallest scale, results discarded; a JVM-only warm-up if that data is absent
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        run_pipeline(spark, warm_dir, cpus, lambda name, fn: fn())
    else:
        noop(movie_records(spark, sf_dir).limit(1000))

    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t, 3)
        return out

    info = run_pipeline(spark, sf_dir, cpus, timed)
    total = round(sum(v for k, v in times.items() if not k.endswith("_setup")), 3)
    print(json.dumps({
        "metric": "pipeline_total_sec",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "records": info["records"],
        "bronze_status": info["bronze_status"],
        "cpus": cpus,
        "warmup": os.path.basename(warm_dir.rstrip("/")) if os.path.isdir(warm_dir) else "jvm",
    }))
    spark.stop()


if __name__ == "__main__":
    main()
