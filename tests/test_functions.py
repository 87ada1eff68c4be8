from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import given, settings as hypothesis_settings, strategies as st
from pyspark.sql import functions as F

from watchtide.functions import text as T
from watchtide.functions.severity import BANDS, severity_level, severity_level_flat
from watchtide.functions.times import clamp_lookback, hour, seconds_between, timespan, utc_day, whole_share
from watchtide.functions.variant import canonical_json, has_content, is_number, is_object, member


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


WHOLE_TERMS = [
    ("Recon:EC2/PortProbeUnprotectedPort", "Port", False),
    ("UnauthorizedAccess:EC2/TorClient", "Tor", False),
    ("UnauthorizedAccess:EC2/TorClient", "Unauthorized", False),
    ("CredentialAccess:IAMUser/X", "Credential", False),
    ("CryptoCurrency:EC2/BitcoinTool.B!DNS", "Cryptocurrency", True),
    ("CryptoCurrency:EC2/BitcoinTool.B!DNS", "dns", True),
    ("Discovery:S3/MaliciousIPCaller", "S3/", True),
    ("Trojan:EC2/DNSDataExfiltration", "Trojan:EC2/", True),
    ("XTrojan:EC2/Drop", "Trojan:EC2/", False),
    ("Backdoor:EC2/C&CActivity.B!DNS", "Backdoor:EC2/C&CActivity", True),
    ("PUA C&C", "C&C", True),
    ("AWORM", "Worm", False),
    ("boto3/1.0", "boto", False),
    ("", "Tor", False),
    (None, "Tor", False),
]


def test_whole_term_search(spark):
    rows = spark.createDataFrame([(i, v) for i, (v, _, _) in enumerate(WHOLE_TERMS)], "i INT, v STRING")
    tests = [F.when(F.col("i") == i, T.has(F.col("v"), term)) for i, (_, term, _) in enumerate(WHOLE_TERMS)]
    found = {r.i: r.x for r in rows.select("i", F.coalesce(*tests).alias("x")).collect()}
    assert [found[i] for i in range(len(WHOLE_TERMS))] == [expected for *_, expected in WHOLE_TERMS]


def test_terms_must_be_given():
    for terms in ((), ("",)):
        with pytest.raises(ValueError, match="non-empty"):
            T.term_pattern(*terms)


def test_string_predicates_are_never_null(spark):
    missing = F.lit(None).cast("string")
    checks = {
        "empty": T.is_empty(missing),
        "filled": T.not_empty(missing),
        "contains": T.contains(missing, "x"),
        "starts": T.starts_with(missing, "x"),
        "case": T.contains(F.lit("Behavior:EC2/X"), "ec2/"),
        "prefix": T.starts_with(F.lit("SYSTEM:node"), "system:"),
        "first": T.first_text(F.lit(""), missing, F.lit("b"), F.lit("c")),
        "none": T.first_text(F.lit(""), missing),
        "true": T.is_true(F.lit(None).cast("boolean")),
        "false": T.is_false(F.lit(None).cast("boolean")),
        "bag": T.json_bag(F.lit(None).cast("string").alias("a"), F.lit(1).alias("b")),
        "points": T.points((F.lit(True), 20), (F.lit(None).cast("boolean"), 10), (F.lit(False), 5)),
        "match": T.first_match([(F.lit(None).cast("boolean"), "a"), (F.lit(True), "b")], "c"),
        "default": T.first_match([], "c"),
    }
    row = spark.range(1).select(*[c.alias(n) for n, c in checks.items()]).first().asDict()
    assert row == {
        "empty": True,
        "filled": False,
        "contains": False,
        "starts": False,
        "case": True,
        "prefix": True,
        "first": "b",
        "none": "",
        "true": False,
        "false": False,
        "bag": '{"a":null,"b":1}',
        "points": 20,
        "match": "b",
        "default": "c",
    }


def test_typed_members(spark):
    document = F.parse_json(
        F.lit(
            '{"s":"x","n":"443","bad":"zz","o":{"k":1,"a":"é"},"arr":[{"i":1}],"e":[],"t":"2025-03-16T10:00:00.000Z",'
            '"b":true,"nul":null,"d":443.7}'
        )
    )
    reads = {
        "s": member(document, ".s"),
        "absent": member(document, ".zz.y"),
        "null": member(document, ".nul"),
        "object": member(document, ".o"),
        "flag": member(document, ".b"),
        "int": member(document, ".n", "int"),
        "cut": member(document, ".d", "int"),
        "bad": member(document, ".bad", "int"),
        "first": member(document, ".arr[0].i", "int"),
        "beyond": member(document, ".e[0].i", "int"),
        "is_object": is_object(document, ".o"),
        "not_object": is_object(document, ".arr"),
        "canonical": canonical_json(F.parse_json(F.lit('{"b":[{"z":1,"a":2}],"a":"ü"}'))),
    }
    row = spark.range(1).select(*[c.alias(n) for n, c in reads.items()]).first().asDict()
    assert row == {
        "s": "x",
        "absent": "",
        "null": "",
        "object": '{"a":"é","k":1}',
        "flag": "true",
        "int": 443,
        "cut": 443,
        "bad": None,
        "first": 1,
        "beyond": None,
        "is_object": True,
        "not_object": False,
        "canonical": '{"a":"ü","b":[{"a":2,"z":1}]}',
    }


def test_kinds_of_values(spark):
    texts = ["9", "9.5", "1e3", '"9"', "true", "null", "{}", "[]", '""', "0", '{"a":1}', '"a"']
    rows = spark.createDataFrame([(t,) for t in texts], "t STRING").withColumn("v", F.parse_json("t"))
    found = {r.t: (r.number, r.content) for r in rows.select(
        "t", is_number(F.col("v")).alias("number"), has_content(F.col("v")).alias("content")
    ).collect()}
    assert [t for t in texts if found[t][0]] == ["9", "9.5", "1e3", "0"]
    assert [t for t in texts if not found[t][1]] == ["null", "{}", "[]", '""', "0"]


@pytest.mark.parametrize(
    ("asked", "expected"),
    [(None, 7), ("1d", 1), ("90d", 90), ("91d", 90), ("48h", 2), (timedelta(days=3650), 90), ("1440m", 1), ("86400s", 1)],
)
def test_lookback_is_clamped(asked, expected):
    assert clamp_lookback(asked, timedelta(days=7), timedelta(days=90)) == timedelta(days=expected)


def test_timespan_rejects_other_text():
    for bad in ("", "7", "7 weeks", "d", "-1d"):
        with pytest.raises(ValueError, match="timespan"):
            timespan(bad)


def test_time_and_share_columns(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    moment = F.lit(datetime(2025, 3, 18, 23, 45, tzinfo=timezone.utc))
    assert one(spark, F.unix_seconds(hour(moment)) % 86400) == 23 * 3600 and str(one(spark, utc_day(moment))) == "2025-03-18"
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    later, earlier = F.lit("2025-03-18 18:47:17.5").cast("timestamp"), F.lit("2025-03-18 18:00:00").cast("timestamp")
    assert one(spark, seconds_between(later, earlier)) == 2837.5
    assert one(spark, hour(later).cast("string")) == "2025-03-18 18:00:00"
    assert one(spark, whole_share(F.lit(2), F.lit(3))) == 66
    assert one(spark, whole_share(F.lit(0), F.lit(0))) is None


#: Each cut, a little below it and a little above it.
EDGES = sorted({round(floor + by, 2) for _, floor in BANDS for by in (-0.01, 0.0, 0.3)} | {0.25})


def test_both_bandings(spark):
    rows = spark.createDataFrame([(s,) for s in [0.0, *EDGES]], "s DOUBLE")
    found = rows.select("s", severity_level(F.col("s")).alias("v"), severity_level_flat(F.col("s")).alias("f")).collect()
    band = lambda s: next((label for label, floor in BANDS if s >= floor), "Informational")
    assert {r.s: r.f for r in found} == {s: band(s) for s in [0.0, *EDGES]}
    assert {r.s: r.v for r in found} == {s: band(s) for s in EDGES} | {0.0: "Unknown"}


@given(st.lists(st.floats(min_value=0, max_value=10, allow_nan=False), min_size=50, max_size=50))
@hypothesis_settings(max_examples=5, deadline=None)
def test_bands_follow_their_floors(scores):
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    rows = spark.createDataFrame([(s,) for s in scores], "s DOUBLE")
    for r in rows.select("s", severity_level_flat(F.col("s")).alias("level")).collect():
        assert r.level == next((label for label, floor in BANDS if r.s >= floor), "Informational")
