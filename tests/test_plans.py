"""What the plans must look like to hold at a thousand times the data."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from driver_checks import registry, sources
from driver_checks.derived import AS_OF
from watchtide.sources import exports
from watchtide.sources.table import FINDINGS, findings, write_findings

SF = "/root/testdata/sf0.001"
VIEWS = ("c1_base_view", "d1_network_view", "d2_identity_view", "d3_storage_view", "d4_kubernetes_view")
VIEWS += ("d5_malware_view", "d6_database_view", "d7_session_view")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", VIEWS)
def test_a_view_is_one_scan_and_one_shuffle(spark, name):
    text = plan(registry.QUERIES[name](spark, SF))
    assert len(re.findall(r"\bExchange hashpartitioning", text)) == 1
    assert text.count("FileScan parquet") == 1
    assert "PartitionFilters: [isnotnull(GeneratedDate" in text
    assert "GreaterThanOrEqual(TimeGenerated" in text
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", text)


def test_copies_are_dropped_before_the_shuffle(spark):
    text = plan(registry.QUERIES["c1_base_view"](spark, SF))
    assert re.search(r"Exchange hashpartitioning.*\n.*WindowGroupLimit.*Partial", text)


def test_only_used_members_are_read_and_shuffled(spark):
    text = plan(registry.QUERIES["f7_threat_categories"](spark, SF))
    scan = next(line for line in text.splitlines() if "FileScan parquet" in line)
    assert "ResourceDetails" not in scan and "Description" not in scan
    shuffled = next(line for line in text.splitlines() if "WindowGroupLimit" in line and "Partial" in line)
    assert "ServiceDetails" not in shuffled


def test_an_id_filter_reaches_the_scan(spark):
    text = plan(sources.base(spark, SF).filter("FindingId = 'f-300'"))
    below_the_shuffle = text[text.index("Exchange hashpartitioning") :]
    assert re.search(r"Id#\d+ = f-300", below_the_shuffle)


def test_geo_lookup_reads_the_findings_once(spark):
    text = plan(registry.QUERIES["j4_geo_lookup"](spark, SF))
    assert text.count("GeneratedDate#") and sum("FileScan parquet" in line and "Severity" in line for line in text.splitlines()) == 1


def test_a_time_filter_skips_row_groups(spark, tmp_path):
    """Rows that leave the scan, not words in the plan: the file has many row groups, sorted by time."""
    rows = spark.range(200_000).selectExpr("timestamp_seconds(1704067200 + id) AS TimeGenerated", "cast(id as string) AS Id", "cast(null as variant) AS ServiceDetails")
    table = rows.select(*[F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in FINDINGS])
    spark.conf.set("parquet.block.size", "65536")
    write_findings(table.coalesce(1), str(tmp_path / "t"))
    spark.conf.unset("parquet.block.size")
    near = findings(spark, str(tmp_path / "t")).filter("TimeGenerated >= timestamp_seconds(1704067200 + 195000)").select("TimeGenerated")
    assert near.count() == 5000
    near.collect()
    executed = near._jdf.queryExecution().executedPlan()
    near._jdf.queryExecution().toRdd().count()
    scan = executed
    while scan.children().size():
        scan = scan.children().head()
    assert 5000 <= scan.metrics().apply("numOutputRows").value() < 100_000


def test_lookback_literal_is_the_pinned_time(spark):
    text = plan(sources.base(spark, SF, "7d"))
    assert "2024-01-24" in text and AS_OF.day == 31


def test_the_smoke_suite_is_two_scans_and_one_shuffle_of_ids(spark):
    text = plan(registry.QUERIES["e12_smoke_suite"](spark, SF))
    assert text.count("FileScan parquet") == 2
    assert len(re.findall(r"Exchange hashpartitioning\(Id#", text)) == 1
    assert not re.search("Python|CartesianProduct|BroadcastNestedLoop", text)


def test_members_of_a_batch_are_copied_once(spark):
    """The tests of an envelope read one member of each finding; only the rows of the result copy whole ones."""
    lines = exports.parse_lines(spark.createDataFrame([('{"findings":[{"id":"a"},{"id":"b"}]}',), ('{"findings":[{"id":"a"},1]}',)], "raw STRING"))
    exploded = exports.explode_batches(lines)
    text = exploded._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("$.findings, ArrayType(VariantType") == 1
    assert sorted(str(r.contract_error) for r in exploded.collect()) == ["None", "None", "every finding must be an object"]
