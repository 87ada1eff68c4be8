"""Times the headline jobs at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]`` and prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from driver_checks import registry  # noqa: E402
from driver_checks import sources as S  # noqa: E402
from watchtide.sources.contracts import split  # noqa: E402
from watchtide.sources.exports import read_findings  # noqa: E402
from watchtide.sources.table import to_findings_table, write_findings  # noqa: E402
from watchtide.storage import work_folder  # noqa: E402
from watchtide.streaming.ingest import checked_events  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))

HEADLINE = (
    "c1_base_view",
    "b7_quality_category",
    "d1_network_view",
    "d2_identity_view",
    "d3_storage_view",
    "d4_kubernetes_view",
    "d5_malware_view",
    "d6_database_view",
    "d7_session_view",
    "e2_structure_score",
    "e3_type_diversity",
    "e4_network_quality",
    "e8_account_region_coverage",
    "f2_findings_by_country",
    "f5_inbound_sessions",
    "f7_threat_categories",
    "f15_hourly_trend",
    "f25_risky_destinations",
    "b12_parity",
    "j4_geo_lookup",
    "a10_pack_batches",
    "g1_ingest_stream",
    "g3_latest_stream",
)


def session() -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))  # one machine: driver and executors share it
        .getOrCreate()
    )


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def ingest(spark: SparkSession) -> None:
    """Export files to the partitioned table, with the contract check on the way."""
    valid, _ = split(checked_events(read_findings(spark, S.finding_export(spark, SF_DIR))))
    write_findings(to_findings_table(valid), work_folder(spark, "bench-ingest"))


def timed(job) -> float:
    """Median of the repeats after one warm-up run."""
    job()
    seconds = []
    for _ in range(REPEATS):
        start = time.perf_counter()
        job()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def main() -> None:
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    findings = S.given(spark, SF_DIR, "events").count()
    S.finding_export(spark, SF_DIR)
    S.mixed_export(spark, SF_DIR)
    S.table_path(spark, SF_DIR)
    only = sys.argv[1:]
    times = {}
    if not only or "a1_a7_ingest" in only:
        times["a1_a7_ingest"] = timed(lambda: ingest(spark))
    for name in HEADLINE:
        if not only or name in only:
            times[name] = timed(lambda: drain(registry.QUERIES[name](spark, SF_DIR)))
    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline jobs",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "findings": findings,
                "ingest_findings_per_second": round(findings / times["a1_a7_ingest"]) if "a1_a7_ingest" in times else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
