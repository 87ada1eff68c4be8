from __future__ import annotations

import copy
import gzip
import json
from datetime import timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import AS_OF, envelope, lines, table, unwrapped
from watchtide.sources import contracts
from watchtide.sources.exports import explode_batches, read_findings, unwrap_events
from watchtide.sources.table import FINDINGS, SPLIT_BYTES, findings, table_counts, to_flat_record, write_findings
from watchtide.streaming.ingest import checked_events


def errors(df):
    return sorted((r.contract_error or "") for r in df.select("contract_error").collect())


def changed(finding, **changes):
    other = copy.deepcopy(finding)
    for name, value in changes.items():
        if value is KeyError:
            del other[name]
        else:
            other[name] = value
    return other


def test_export_files(spark, finding, tmp_path):
    folder = tmp_path / "AWSLogs" / "210987654321" / "GuardDuty" / "eu-central-1"
    folder.mkdir(parents=True)
    body = json.dumps(finding) + "\n" + '{"id": "cut' + "\n\n" + json.dumps(envelope(finding)) + "\n"
    (folder / "findings.jsonl.gz").write_bytes(gzip.compress(body.encode()))
    read = read_findings(spark, str(tmp_path), partitions=3)
    assert read.rdd.getNumPartitions() == 3
    assert errors(read) == ["", "", "line is not valid JSON"]
    valid, quarantine = contracts.split(checked_events(read))
    assert valid.count() == 2
    assert [(r.raw, r.contract_error) for r in quarantine.collect()] == [('{"id": "cut', "line is not valid JSON")]


def test_a_repeated_key_keeps_its_last_value(spark):
    row = lines(spark, '{"id": "first", "id": "last"}').select(F.to_json("event").alias("e"), "contract_error").first()
    assert (row.e, row.contract_error) == ('{"id":"last"}', None)


ODD_LINES = (
    "null", "1", "-0.0", "01", "1e400", "NaN", "[NaN]", '{"a":+1}', '{"a":.5}', '{"a":-Infinity}', '{"a":INF}', "[]", "{}", "[1,2", '{"a":1}x',
    '{"a":1} {"b":2}', '{"a":1,}', "{'a':1}", '{"a":\'b\'}', "{a:1}", '{"a":1,"a":2}', '{"a":"\\u00e9\\ud83d\\ude00"}', '{"a":"\\ud800"}',
    '{"a":"\\x"}', '{"a":"tab\there"}', '{"a":"\x01"}', '{"a":1/*c*/}', "#c", "\ufeff{}", '\x00{"a":1}', '{"a":1}\x00', '{"a":0.10,"b":1.50,"c":1E2}',
    '{"a":123456789012345678901234567890123456789012345678901234567890}', '{"b":1,"a":{"é":null}}', "[" * 1200 + "]" * 1200, '{"a":"unterminated',
)


def test_lines_are_read_as_strictly_as_one_parser_for_each_reads_them(spark):
    read = lines(spark, *ODD_LINES)
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" in plan and "parseJson" not in plan
    text = lambda column: (F.to_json(column), F.schema_of_variant(column))
    both = read.select("raw", F.array(*text("event")).alias("one"), F.array(*text(F.try_parse_json("raw"))).alias("other"), "contract_error").collect()
    assert len(both) == len(ODD_LINES) and [r.raw for r in both if r.one != r.other] == []
    assert all((r.one == [None, None]) == (r.contract_error == "line is not valid JSON") for r in both)
    assert 10 < sum(r.contract_error is None for r in both) < len(both) - 10


def test_spread_lines_are_not_sorted_first(spark, tmp_path):
    """Dealing in turn would sort the text of a file in the one task that unpacks it; equal lines still part."""
    with gzip.open(tmp_path / "a.gz", "wt") as f:
        f.write("{}\n" * 4000)
    read = read_findings(spark, str(tmp_path), partitions=4)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning" not in plan and "hashpartitioning" in plan
    sizes = [len(part) for part in read.select("raw").rdd.glom().collect()]
    assert sum(sizes) == 4000 and min(sizes) > 800


def test_batch_envelopes(spark, finding):
    other = changed(finding, id="f2")
    rows = explode_batches(
        lines(
            spark,
            {"findings": [finding, other]},
            {"findings": []},
            {"findings": None},
            {"findings": {"a": 1}},
            {"findings": ["x"]},
            {"findings": [finding, 1]},
            finding,
            [finding],
            "7",
        )
    )
    empty, member = "findings must be a non-empty array", "every finding must be an object"
    assert errors(rows) == sorted(["", "", "", empty, empty, empty, member, member] + ["event must be an object"] * 2)


def test_event_envelopes(spark, finding):
    events = {
        "bare": finding,
        "enveloped": envelope(finding),
        "no source": {k: v for k, v in envelope(finding).items() if k != "source"},
        "null source": envelope(finding, source=None),
        "other source": envelope(finding, source="not.expected"),
        "array detail": envelope([]),
        "null detail": envelope(None),
        "unknown form": {"source": "aws.guardduty"},
    }
    found = unwrap_events(lines(spark, *events.values())).select("contract_error", F.col("finding").isNotNull().alias("ok"))
    by_name = dict(zip(events, [(r.contract_error, r.ok) for r in found.collect()]))
    assert [n for n, (error, ok) in by_name.items() if error is None and ok] == ["bare", "enveloped", "no source", "null source"]
    assert by_name["other source"][0] == "event source must be aws.guardduty"
    assert by_name["array detail"][0] == by_name["null detail"][0] == "event detail must be an object"
    assert by_name["unknown form"][0] == "unrecognized event format"


def test_delivery_contract(spark, finding):
    cases = [
        (finding, None),
        (changed(finding, unknown={"new": [1]}), None),
        (changed(finding, severity=0), None),
        (changed(finding, severity=10), None),
        (changed(finding, region=KeyError), "finding is missing required fields: region"),
        (changed(finding, region=None, createdAt=""), "finding is missing required fields: createdAt, region"),
        (changed(finding, type=None, updatedAt=KeyError), "finding is missing required fields: type, updatedAt"),
        (changed(finding, resource=""), "finding is missing required fields: resource"),
        (changed(finding, resource=["i-77"]), "resource must be an object"),
        (changed(finding, resource={}), None),
        (changed(finding, severity="high"), "severity must be numeric"),
        (changed(finding, severity={"score": 4}), "severity must be numeric"),
        (changed(finding, severity=True), "severity must be numeric"),
        (changed(finding, severity=12), "severity must be between 0 and 10"),
        (changed(finding, severity=-3.5), "severity must be between 0 and 10"),
    ]
    checked = contracts.check_findings(unwrapped(spark, *[changed(c, title=str(i)) for i, (c, _) in enumerate(cases)]))
    found = {
        int(r.t): r.contract_error
        for r in checked.select(F.try_variant_get("finding", "$.title", "string").alias("t"), "contract_error").collect()
    }
    assert [found[i] for i in range(len(cases))] == [expected for _, expected in cases]
    valid, quarantine = contracts.split(checked)
    assert valid.count() + quarantine.count() == len(cases)


def test_strict_mode_fails_the_job(spark, finding):
    good = contracts.check_findings(unwrapped(spark, finding))
    assert contracts.require_valid(good).count() == 1
    bad = contracts.check_findings(unwrapped(spark, finding, changed(finding, severity="7")))
    with pytest.raises(PySparkException, match="severity must be numeric"):
        contracts.require_valid(bad).collect()


def rules(df):
    return sorted(r.rule for r in df.collect())


def test_finding_contract_rules(spark, finding):
    assert rules(contracts.finding_violations(unwrapped(spark, finding))) == []
    broken = changed(
        finding,
        accountId="12",
        arn="urn:x",
        confidence=100.5,
        createdAt="2025-03-18",
        description=5,
        id="",
        partition="aws-moon",
        region=1,
        resource={"resourceType": ""},
        schemaVersion="3.0",
        service=[],
        severity="8",
        title=None,
        type="",
        updatedAt=KeyError,
    )
    assert rules(contracts.finding_violations(unwrapped(spark, broken))) == sorted(
        [
            "accountId:pattern",
            "arn:pattern",
            "confidence:range",
            "createdAt:date-time",
            "description:type",
            "id:minLength",
            "partition:enum",
            "region:type",
            "resource.resourceType:minLength",
            "schemaVersion:pattern",
            "service:type",
            "severity:type",
            "title:type",
            "type:minLength",
            "updatedAt:required",
        ]
    )


def test_event_contract_rules(spark, finding):
    assert rules(contracts.event_violations(lines(spark, envelope(finding)))) == []
    broken = envelope(changed(finding, arn=1), version=0, account="1", resources=["a", 2], time="now", region="")
    del broken["detail-type"]
    assert rules(contracts.event_violations(lines(spark, broken))) == sorted(
        [
            "account:pattern",
            "detail-type:required",
            "detail.arn:type",
            "region:minLength",
            "resources.items:type",
            "time:date-time",
            "version:const",
        ]
    )
    counts = contracts.violation_counts(contracts.event_violations(lines(spark, broken, broken)))
    assert {r.violations for r in counts.collect()} == {2}


def test_table_contract(spark, finding):
    mapped = table(spark, finding)
    assert contracts.table_problems(spark, mapped.schema, FINDINGS).count() == 0
    odd = mapped.withColumn("RawFinding", F.lit("{}")).drop("Arn").withColumn("Severity", F.lit(1.5))
    problems = {(r.column, r.problem) for r in contracts.table_problems(spark, odd.schema, FINDINGS).collect()}
    assert problems == {("RawFinding", "extra column"), ("Arn", "missing column"), ("Severity", "wrong type")}
    assert [r.column for r in contracts.column_types(spark, FINDINGS).orderBy("ordinal").collect()] == FINDINGS.names


def test_table_mapping(spark, finding):
    plain = changed(finding, partition=KeyError, service=KeyError, description=KeyError, title="Ünïcode 日本", severity=0.9)
    nothing = changed(finding, id="f2", partition=None, service=None, severity=8)
    rows = {r.Id: r for r in table(spark, plain, nothing).withColumn("s", F.to_json("ServiceDetails")).collect()}
    assert (rows["f1"].Partition, rows["f1"].s, rows["f1"].Description, rows["f1"].Severity) == ("aws", "{}", None, 0)
    assert rows["f1"].Title == "Ünïcode 日本"
    assert (rows["f2"].Partition, rows["f2"].s, rows["f2"].Severity) == ("", "{}", 8)
    assert str(rows["f2"].TimeGenerated) == "2025-03-18 19:30:45.123456"


def test_flat_record(spark, finding, small_finding):
    row = to_flat_record(unwrapped(spark, finding)).first().asDict()
    raw = row.pop("RawFinding")
    assert json.loads(raw) == finding
    assert raw == json.dumps(finding, separators=(",", ":"), sort_keys=True)
    assert str(row.pop("TimeGenerated")) == "2025-03-18 19:30:45.123456"
    assert row == {
        "FindingId": "f1",
        "FindingType": finding["type"],
        "Severity": 7.3,
        "SeverityLevel": "High",
        "Title": finding["title"],
        "Description": finding["description"],
        "AwsAccountId": "210987654321",
        "AwsRegion": "eu-central-1",
        "SchemaVersion": "2.0",
        "ResourceType": "Instance",
        "ActionType": "NETWORK_CONNECTION",
        "RemoteIp": "198.18.7.21",
        "RemoteCountry": "Brazil",
        "Protocol": "UDP",
        "ConnectionDirection": "INBOUND",
        "RemotePort": 53,
        "LocalPort": 40000,
        "ApiName": None,
        "CallerType": None,
        "UserName": None,
        "UserType": None,
        "AccessKeyId": None,
        "InstanceId": "i-77",
        "InstanceType": "m6g.large",
        "VpcId": "vpc-main",
        "DetectorId": "dt-9",
        "EventFirstSeen": "2025-03-17T23:59:58.250Z",
        "EventLastSeen": "2025-03-18T04:05:06.125Z",
    }
    for interfaces in ({}, [], None):
        small_finding["resource"]["instanceDetails"]["networkInterfaces"] = interfaces
        assert to_flat_record(unwrapped(spark, envelope(small_finding))).first().VpcId is None
    api = changed(finding, region="", service={"action": {
        "networkConnectionAction": {"remoteIpDetails": {}},
        "awsApiCallAction": {"api": "GetObject", "remoteIpDetails": {"ipAddressV4": "192.0.2.9"}},
    }})
    row = to_flat_record(unwrapped(spark, api), default_region="eu-west-1").first()
    assert (row.RemoteIp, row.ApiName, row.AwsRegion) == ("192.0.2.9", "GetObject", "eu-west-1")


def test_a_table_is_the_same_in_every_zone(spark, finding, tmp_path):
    late, early = changed(finding, id="late", updatedAt="2025-03-18T23:30:00.000001Z"), changed(finding, id="early", updatedAt="2025-03-18T00:00:00Z")
    path = str(tmp_path / "zones")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    write_findings(table(spark, late, early), path)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert {r.Id for r in findings(spark, path, "1d", AS_OF).collect()} == {"late", "early"}
    assert findings(spark, path).agg(F.max(F.unix_micros("TimeGenerated")) % 1_000_000).first()[0] == 1


def test_table_files(spark, finding, tmp_path):
    old = changed(finding, id="f0", updatedAt="2025-02-20T00:00:00Z")
    path = str(tmp_path / "table")
    write_findings(table(spark, finding), path)
    write_findings(table(spark, old), path)
    assert findings(spark, path).columns == FINDINGS.names
    assert findings(spark, path).count() == 2
    assert [r.Id for r in findings(spark, path, "7d", AS_OF).collect()] == ["f1"]
    counted = table_counts({"findings": findings(spark, path), "none": findings(spark, path).filter("false")})
    assert [(r.TableName, r.Records) for r in counted.collect()] == [("findings", 2)]
    both = {"Findings": findings(spark, path), "other": findings(spark, path)}
    assert [(r.TableName, r.Records) for r in table_counts(both, "find", AS_OF - timedelta(days=7)).collect()] == [("Findings", 1)]
    with pytest.raises(ValueError, match="no tables"):
        table_counts({})


def test_a_task_reads_a_bounded_split_of_the_table(spark, finding, tmp_path, monkeypatch):
    """Tasks sort the rows of their split, so a split does not grow with the table; a session's own setting is left."""
    option, path = "spark.sql.files.maxPartitionBytes", str(tmp_path / "t")
    write_findings(table(spark, *[{**finding, "id": f"f{i}", "title": f"{i * 7919}"} for i in range(50)]).coalesce(1), path)
    size = sum(f.stat().st_size for f in (tmp_path / "t").rglob("*.parquet"))
    before = spark.conf.get(option, None)
    try:
        spark.conf.unset(option)
        assert SPLIT_BYTES <= 16 << 20
        monkeypatch.setattr("watchtide.sources.table.SPLIT_BYTES", size // 4)
        assert findings(spark, path).rdd.getNumPartitions() >= 4
        spark.conf.set(option, size * 2)
        assert findings(spark, path).rdd.getNumPartitions() == 1
        assert findings(spark, path).count() == 50
    finally:
        spark.conf.unset(option) if before is None else spark.conf.set(option, before)


def test_a_task_reads_few_files_of_an_export(spark, tmp_path, monkeypatch):
    """Packed text grows many times when it is read, so files share a task up to a small split only."""
    option = "spark.sql.files.maxPartitionBytes"
    (tmp_path / "e").mkdir()
    for i in range(12):
        with gzip.open(tmp_path / "e" / f"{i}.jsonl.gz", "wt") as file:
            file.write("{}\n")
    session = spark.newSession()
    session.conf.unset(option)
    session.conf.set("spark.sql.files.openCostInBytes", "1000")
    session.conf.set("spark.sql.files.minPartitionNum", "1")
    monkeypatch.setattr("watchtide.sources.table.SPLIT_BYTES", 1040)
    few = read_findings(session, str(tmp_path / "e"))
    assert few.count() == 12 and few.rdd.getNumPartitions() == 12
    session.conf.set(option, "64m")
    assert read_findings(session, str(tmp_path / "e")).rdd.getNumPartitions() == 1
    assert session.conf.get(option) == "64m"
