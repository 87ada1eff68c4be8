from __future__ import annotations

import copy
import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF, base, table
from watchtide.functions.text import JSON_OPTIONS
from watchtide.operators.identity import identity_findings
from watchtide.operators.network import network_findings
from watchtide.operators.quality import quality_categories
from watchtide.operators.sessions import network_sessions
from watchtide.plans import hunting, reports
from watchtide.settings import DEFAULTS, SETTINGS_ROWS, Settings, settings_table


def at(finding, hours, **changes):
    other = copy.deepcopy(finding)
    moment = (AS_OF - timedelta(hours=hours)).strftime("%Y-%m-%dT%H:%M:%SZ")
    other.update(updatedAt=moment, createdAt=moment, **changes)
    return other


@pytest.fixture
def many(finding):
    return [at(finding, 0.25 + i, id=f"m{i}", accountId=f"{i % 3:012d}", severity=i % 11) for i in range(30)]


def test_settings(spark):
    rows = {r.Setting: (r.Value, r.DefaultValue) for r in settings_table(spark, {"DefaultLookback": "1d"}).collect()}
    assert len(rows) == len(SETTINGS_ROWS) == 15
    assert rows["DefaultLookback"] == ("1d", "7d") and rows["ParserVersion"] == ("1.5.0", "1.5.0")
    assert DEFAULTS.lookback() == timedelta(days=7) and DEFAULTS.lookback("3650d") == timedelta(days=90)
    assert Settings().table_name == "AWSGuardDuty"
    with pytest.raises(ValueError, match="unknown"):
        settings_table(spark, {"Nope": "1"})
    found = hunting.settings_lookup(settings_table(spark), "DefaultLookback", "MaxLookback", "EnableDataValidation")
    assert {r.Value for r in found.collect()} == {"7d", "90d", "true"}


def test_verdicts_over_nothing(spark, finding):
    nothing, rows = table(spark, finding).filter("false"), base(spark, finding).filter("false")
    network, identity = network_findings(rows), identity_findings(rows)
    verdicts = [
        reports.data_availability(nothing, as_of=AS_OF).first().TestResult,
        reports.structure_score(rows).first().TestResult,
        reports.type_diversity(rows).first().TestResult,
        reports.network_quality(network).first().TestResult,
        reports.identity_quality(identity).first().TestResult,
        reports.ingestion_pattern(nothing, AS_OF).first().IngestionPattern,
        reports.data_quality_rates(rows).first().QualityAssessment,
        reports.account_region_coverage(rows).first().Coverage,
        reports.recent_health(rows, AS_OF).first().HealthStatus,
        reports.data_lag(nothing, AS_OF).first().Status,
    ]
    assert verdicts == [
        "FAIL: No GuardDuty records found",
        "FAIL: No parseable GuardDuty records",
        "FAIL: No finding types detected",
        "INFO: No network findings in timeframe",
        "INFO: No IAM findings in timeframe",
        "No data in last 24 hours",
        "Good data quality",
        "Monitoring 0 accounts across 0 regions",
        "No recent data - check connector",
        "No data - check KMS permissions",
    ]
    report = reports.diagnostic_report(nothing, settings_table(spark), rows).collect()
    assert [(r.RecordCount, r.ConfigEntries, r.ParsedRecords) for r in report] == [(0, None, None), (None, 15, None), (None, None, 0)]


SMOKE_NAMES = ["Data Availability", "Data Structure", "Finding Types", "Network Findings", "IAM Findings"]


def smoke_of(stored):
    rows = reports.smoke_suite(stored, AS_OF).collect()
    assert [r.Test for r in rows] == SMOKE_NAMES
    return [(r.TestResult, json.loads(r.Metrics)) for r in rows]


def separate(stored, week, day):
    """The smoke tests' results from the reports one by one."""
    from pyspark.sql import functions as F
    from watchtide.functions.text import json_bag

    each = [
        reports.data_availability(stored, as_of=AS_OF),
        reports.structure_score(day),
        reports.type_diversity(week),
        reports.network_quality(network_findings(week)),
        reports.identity_quality(identity_findings(week)),
    ]
    told = [df.select("TestResult", json_bag(*[F.col(c) for c in df.columns[1:]]).alias("m")).first() for df in each]
    return [(r.TestResult, json.loads(r.m)) for r in told]


def test_smoke_suite_in_one_pass_equals_the_reports(spark, finding):
    """Findings of the week and of the day, of all kinds, some with an older copy outside the day, and none at all."""
    kinds = ["Trojan:EC2/DropPoint", "Policy:IAMUser/RootCredentialUsage", "Stealth:S3/LogsOff", "Impact:RDS/Guess"]
    call = {"actionType": "AWS_API_CALL", "awsApiCallAction": {"api": "ListUsers", "remoteIpDetails": {"ipAddressV4": "198.18.9.9"}}}
    rows = []
    for i in range(60):
        row = json.loads(json.dumps(finding)) | {"id": f"s{i % 40}", "type": f"{kinds[i % 4]}.{i % 13}", "accountId": f"{i % 7:012d}"}
        row["updatedAt"] = f"2025-03-{12 + i % 7:02d}T{i % 24:02d}:10:00.000Z"
        if i % 3 == 0:
            row["service"]["action"] = call
        if i % 5 == 0:
            row["service"]["action"] = {"actionType": "OTHER"}
        rows.append(row)
    stored = table(spark, *rows)
    found = smoke_of(stored)
    assert found == separate(stored, base(spark, *rows), base(spark, *rows, lookback="1d"))
    assert found[1][1]["TotalRecords"] < found[3][1]["NetworkFindings"] and found[4][1]["IAMFindings"] > 0
    assert len(found[2][1]["TopFindingTypes"]) == 10
    empty = stored.limit(0)
    assert [r[0][:4] for r in smoke_of(empty)] == ["FAIL", "FAIL", "FAIL", "INFO", "INFO"]


def test_verdicts_over_rows(spark, many):
    rows, stored = base(spark, *many), table(spark, *many)
    assert reports.data_availability(stored, as_of=AS_OF).first().TestResult.startswith("PASS")
    assert reports.data_availability(stored, as_of=AS_OF + timedelta(days=2)).first().TestResult.startswith("WARNING")
    assert reports.ingestion_pattern(stored, AS_OF).first().IngestionPattern == "Consistent ingestion pattern"
    few = stored.filter("Id IN ('m0', 'm1')")
    assert reports.ingestion_pattern(few, AS_OF).first().IngestionPattern.startswith("Intermittent")
    assert reports.type_diversity(rows).first().TestResult.startswith("WARNING")
    coverage = reports.account_region_coverage(rows).first()
    assert (coverage.UniqueAccounts, coverage.UniqueRegions) == (3, 1)
    assert coverage.TopAccountRegions[0] == "000000000000/eu-central-1 (10)"
    for approximate in (False, True):
        assert reports.structure_score(rows, approximate).first().UniqueAccounts == 3
    assert reports.recent_health(rows, AS_OF).first().HealthStatus == "Healthy ingestion"
    assert reports.recent_health(rows, AS_OF + timedelta(hours=5)).first().HealthStatus.startswith("Data delay")
    assert reports.data_lag(stored, AS_OF).first().Status == "KMS permissions working"
    assert reports.data_lag(stored, AS_OF + timedelta(minutes=40)).first().Status == "Data lag detected"
    assert smoke_of(stored) == separate(stored, rows, base(spark, *many, lookback="1d"))
    assert [r.ResolutionSteps[:2] for r in reports.resolution_steps(spark).collect()] == [f"{i}." for i in range(1, 8)]


def test_daily_volume_is_the_size_of_the_rows(spark, many):
    stored = table(spark, *many)
    sizes = {}
    for r in stored.select(F.to_date("TimeGenerated").alias("d"), F.to_json(F.struct(*stored.columns), JSON_OPTIONS).alias("j")).collect():
        sizes[r.d] = sizes.get(r.d, 0) + len(r.j.encode())
    found = {r.Day.date(): r.DataSizeMB for r in hunting.daily_volume(stored, AS_OF).collect()}
    assert found == {d: n / 1048576 for d, n in sizes.items()}


def test_hunting_queries(spark, many):
    rows, stored = base(spark, *many), table(spark, *many)
    network = network_findings(rows)
    assert {r.AwsAccountId for r in hunting.high_severity(rows).collect()} <= {f"{i:012d}" for i in range(3)}
    urgent = hunting.urgent(rows, AS_OF, "15h")
    assert {r.FindingId for r in urgent.collect()} == {"m7", "m8", "m9", "m10"}
    assert [r.FindingId for r in hunting.newest(rows, 2, "FindingId").collect()] == ["m0", "m1"]
    assert hunting.search_types(rows, "TROJAN").count() == rows.count()
    with pytest.raises(ValueError, match="substring"):
        hunting.search_types(rows)
    assert "ResourceDetails" not in hunting.recent_samples(stored, 3, AS_OF).columns
    assert hunting.recent_samples(stored, 3, AS_OF).count() == 3
    shares = hunting.quality_shares(quality_categories(stored, "7d", AS_OF)).collect()
    assert sum(r.Percentage for r in shares) == pytest.approx(100)
    traced = hunting.trace_finding("m5", rows, network, identity_findings(rows), network_sessions(network))
    assert [r.Parser for r in traced.collect()] == ["Main", "Network", "ASIM"]
    latency = hunting.parse_latency(rows, AS_OF + timedelta(0)).collect()
    assert {r.MaxQueryDuration for r in latency} == {0.0}
    log = spark.createDataFrame(
        [("2025-03-18 12:00:00", "10.9.9.9", "198.18.7.21", "allow"), ("2025-03-18 12:00:00", "10.9.9.9", "192.0.2.77", "allow")],
        "t STRING, SourceIP STRING, DestinationIP STRING, Activity STRING",
    ).withColumn("TimeGenerated", F.to_timestamp("t"))
    risky = hunting.risky_destinations(network_sessions(network), log, AS_OF, "1d").collect()
    assert [r.DestinationIP for r in risky] == ["198.18.7.21"]
    across = hunting.across_sources(network_sessions(network), log, AS_OF, "1d")
    assert {r.Source for r in across.collect()} == {"GuardDuty", "Firewall"}


def test_parse_rate_counts_the_lines_that_are_no_json(spark, many):
    from conftest import lines

    rows = base(spark, *many)
    count = rows.count()
    for lost in (0, count // 10, count):
        aside = lines(spark, *["{cut"] * lost) if lost else rows.limit(0)
        found = reports.data_quality_rates(rows, aside).first()
        assert (found.TotalRecords, found.JsonParseRate) == (count, 100 * count // (count + lost))
        assert found.QualityAssessment.startswith("JSON parsing issues" if found.JsonParseRate < 90 else "Good")
