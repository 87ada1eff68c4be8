"""Health, structure and coverage reports. Each is a small aggregate with a verdict."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from watchtide.functions.text import first_match, json_bag, not_empty
from watchtide.functions.times import at, hour, instant, seconds_between, timespan, whole_share
from watchtide.operators.base import base_findings
from watchtide.operators.identity import READS as IDENTITY_READS, is_identity, with_calls
from watchtide.operators.network import READS as NETWORK_READS, is_network
from watchtide.settings import DEFAULTS, Settings

# How many groups the top lists keep and how many hourly bins a pattern looks at.
TOP_TYPES = 10
TOP_PAIRS = 20
PATTERN_HOURS = 24

# Tasks that rank values before the ranks meet.
TYPE_SALTS = 64

# Resolution checklist.
RESOLUTION_STEPS = (
    "1. KMS Issues: Add GuardDuty service principal to KMS key policy",
    "2. No Data: Verify GuardDuty export destination is configured and active",
    "3. Partial Data: Check S3 bucket notifications and SQS queue configuration",
    "4. Permission Issues: Ensure connector IAM role has s3:GetObject and kms:Decrypt",
    "5. Table Issues: Verify correct table name in connector configuration",
    "6. Regional Issues: Confirm GuardDuty is enabled in expected regions",
    "7. Timing Issues: GuardDuty exports can take 6+ hours for initial findings",
)


def _distinct(name: str, approximate: bool) -> Column:
    return F.approx_count_distinct(name) if approximate else F.count_distinct(F.col(name))


def _rows() -> Column:
    return F.count(F.lit(1))


def _ranked_list(df: DataFrame, order: Column, label: Column, *aggregates: Column) -> DataFrame:
    """Aggregates of an already cut list, with its labels as an array in rank order."""
    pairs = F.sort_array(F.collect_list(F.struct(order.alias("rank"), label.alias("label"))))
    return df.agg(F.transform(pairs, lambda p: p["label"]).alias("labels"), *aggregates)


def data_availability(table: DataFrame, lookback="7d", as_of: datetime | None = None) -> DataFrame:
    """Whether the table has rows in the lookback and how fresh they are."""
    count, latest = F.col("RecordCount"), F.col("LatestRecord")
    return (
        table.filter(F.col("TimeGenerated") >= at(as_of, lookback))
        .agg(
            _rows().alias("RecordCount"),
            F.max("TimeGenerated").alias("LatestRecord"),
            F.min("TimeGenerated").alias("OldestRecord"),
        )
        .select(
            first_match(
                [
                    (count == 0, "FAIL: No GuardDuty records found"),
                    (latest < at(as_of, "24h"), "WARNING: Latest record is older than 24 hours"),
                ],
                "PASS: GuardDuty data is available",
            ).alias("TestResult"),
            "RecordCount",
            "LatestRecord",
            "OldestRecord",
            seconds_between(latest, F.col("OldestRecord")).alias("DataSpanSeconds"),
        )
    )


def structure_score(base: DataFrame, approximate: bool = False) -> DataFrame:
    """Share of filled id, severity, account and raw text. The raw text is never empty, so it is counted as rows."""
    filled = (
        F.count_if(not_empty(F.col("FindingId")))
        + F.count_if(F.col("Severity").isNotNull())
        + F.count_if(not_empty(F.col("AwsAccountId")))
        + _rows()
    )
    return base.agg(
        _rows().alias("TotalRecords"),
        filled.alias("_filled"),
        _distinct("FindingType", approximate).alias("UniqueFindingTypes"),
        _distinct("AwsAccountId", approximate).alias("UniqueAccounts"),
    ).select(*_structure())


def _structure() -> list[Column]:
    total = F.col("TotalRecords")
    score = whole_share(F.col("_filled"), total * 4)
    verdict = first_match(
        [
            (total == 0, "FAIL: No parseable GuardDuty records"),
            (score < 80, "WARNING: Some records missing required fields"),
        ],
        "PASS: GuardDuty data structure is valid",
    )
    counts = [F.col(c) for c in ("UniqueFindingTypes", "UniqueAccounts")]
    return [verdict.alias("TestResult"), total, score.alias("StructureScore"), *counts]


def type_diversity(base: DataFrame) -> DataFrame:
    """The most frequent finding types as one list, ties in name order."""
    top = base.groupBy("FindingType").agg(_rows().alias("n")).orderBy(F.desc("n"), "FindingType").limit(TOP_TYPES)
    label = F.concat("FindingType", F.lit(" ("), F.col("n").cast("string"), F.lit(")"))
    listed = _ranked_list(top, F.struct(-F.col("n"), F.col("FindingType")), label, _rows().alias("TotalTypes"))
    return listed.select(*_diversity())


def _diversity() -> list[Column]:
    types = F.col("TotalTypes")
    verdict = first_match(
        [
            (types == 0, "FAIL: No finding types detected"),
            (types < 3, "WARNING: Limited finding type diversity"),
        ],
        "PASS: Multiple GuardDuty finding types detected",
    )
    return [verdict.alias("TestResult"), types, F.col("labels").alias("TopFindingTypes")]


def network_quality(network: DataFrame, approximate: bool = False) -> DataFrame:
    """How many network findings carry addresses and ports."""
    return network.agg(
        _rows().alias("NetworkFindings"),
        F.count_if(not_empty(F.col("RemoteIp"))).alias("FindingsWithRemoteIP"),
        _distinct("RemoteIp", approximate).alias("UniqueRemoteIPs"),
        _distinct("RemoteCountry", approximate).alias("UniqueCountries"),
    ).select(*_addresses())


def _addresses() -> list[Column]:
    total, known = F.col("NetworkFindings"), F.col("FindingsWithRemoteIP")
    verdict = first_match(
        [
            (total == 0, "INFO: No network findings in timeframe"),
            (whole_share(known, total) < 50, "WARNING: Many network findings missing IP details"),
        ],
        "PASS: Network findings have good data quality",
    )
    return [verdict.alias("TestResult"), total, known, *[F.col(c) for c in ("UniqueRemoteIPs", "UniqueCountries")]]


def identity_quality(identity: DataFrame, approximate: bool = False) -> DataFrame:
    """How many identity findings carry calls and users."""
    return identity.agg(
        _rows().alias("IAMFindings"),
        F.count_if(not_empty(F.col("ApiName"))).alias("FindingsWithAPI"),
        F.count_if(not_empty(F.col("UserName"))).alias("FindingsWithUser"),
        _distinct("ApiName", approximate).alias("UniqueAPIs"),
        _distinct("UserName", approximate).alias("UniqueUsers"),
    ).select(*_calls())


def _calls() -> list[Column]:
    total, known = F.col("IAMFindings"), F.col("FindingsWithAPI")
    verdict = first_match(
        [
            (total == 0, "INFO: No IAM findings in timeframe"),
            (whole_share(known, total) < 50, "WARNING: Many IAM findings missing API details"),
        ],
        "PASS: IAM findings have good data quality",
    )
    counts = [F.col(c) for c in ("FindingsWithUser", "UniqueAPIs", "UniqueUsers")]
    return [verdict.alias("TestResult"), total, known, *counts]


def ingestion_pattern(table: DataFrame, as_of: datetime | None = None, lookback="7d") -> DataFrame:
    """Verdict over the newest hourly bins that hold rows."""
    hours = F.col("HoursWithData")
    return (
        table.filter(F.col("TimeGenerated") >= at(as_of, lookback))
        .groupBy(hour(F.col("TimeGenerated")).alias("Hour"))
        .agg(_rows().alias("n"))
        .orderBy(F.desc("Hour"))
        .limit(PATTERN_HOURS)
        .agg(
            _rows().alias("HoursWithData"),
            F.avg("n").alias("AvgRecordsPerHour"),
            F.max("n").alias("MaxRecordsPerHour"),
            F.min("n").alias("MinRecordsPerHour"),
        )
        .select(
            first_match(
                [
                    (hours == 0, "No data in last 24 hours"),
                    (hours < 12, "Intermittent ingestion - possible KMS/permission issues"),
                    (F.col("MinRecordsPerHour") == 0, "Gaps in ingestion - check connector health"),
                ],
                "Consistent ingestion pattern",
            ).alias("IngestionPattern"),
            "HoursWithData",
            "AvgRecordsPerHour",
            "MaxRecordsPerHour",
        )
    )


def data_quality_rates(base: DataFrame, unparsed: DataFrame | None = None) -> DataFrame:
    """Shares of rows with parsed documents and with filled fields.

    A row of the base view was parsed. ``unparsed`` are the quarantined lines of the same time that are no JSON; they
    count against the parse rate and in nothing else.
    """
    total, rate, score = F.col("TotalRecords"), F.col("JsonParseRate"), F.col("DataQualityScore")
    filled = (
        F.count_if(not_empty(F.col("FindingId")))
        + F.count_if(F.col("Severity").isNotNull())
        + F.count_if(not_empty(F.col("AwsAccountId")))
    )
    counted = base.agg(_rows().alias("TotalRecords"), filled.alias("_filled"))
    if unparsed is not None:
        lost = unparsed.agg(_rows().alias("_lost"))
        counted = counted.unionByName(lost, allowMissingColumns=True).agg(*[F.sum(c).alias(c) for c in ("TotalRecords", "_filled", "_lost")])
    lines = total + F.col("_lost") if unparsed is not None else total
    return (
        counted.withColumns(
            {
                "JsonParseRate": whole_share(total, lines),
                "DataQualityScore": whole_share(F.col("_filled"), total * 3),
            }
        )
        .select(
            first_match(
                [
                    (rate < 90, "JSON parsing issues - check raw data format"),
                    (score < 80, "Missing required fields - possible schema changes"),
                ],
                "Good data quality",
            ).alias("QualityAssessment"),
            "TotalRecords",
            "JsonParseRate",
            "DataQualityScore",
        )
    )


def account_region_pairs(base: DataFrame) -> DataFrame:
    """The account and region pairs with most findings, ties in name order."""
    return (
        base.groupBy("AwsAccountId", "AwsRegion")
        .agg(
            _rows().alias("RecordCount"),
            F.min("EventTime").alias("FirstSeen"),
            F.max("EventTime").alias("LastSeen"),
        )
        .orderBy(F.desc("RecordCount"), "AwsAccountId", "AwsRegion")
        .limit(TOP_PAIRS)
    )


def account_region_coverage(base: DataFrame) -> DataFrame:
    """How many accounts and regions the top pairs cover, with the pairs as one list."""
    label = F.concat("AwsAccountId", F.lit("/"), "AwsRegion", F.lit(" ("), F.col("RecordCount").cast("string"), F.lit(")"))
    listed = _ranked_list(
        account_region_pairs(base),
        F.struct(-F.col("RecordCount"), F.col("AwsAccountId"), F.col("AwsRegion")),
        label,
        F.count_distinct("AwsAccountId").alias("UniqueAccounts"),
        F.count_distinct("AwsRegion").alias("UniqueRegions"),
    )
    return listed.select(
        F.concat(
            F.lit("Monitoring "),
            F.col("UniqueAccounts").cast("string"),
            F.lit(" accounts across "),
            F.col("UniqueRegions").cast("string"),
            F.lit(" regions"),
        ).alias("Coverage"),
        "UniqueAccounts",
        "UniqueRegions",
        F.col("labels").alias("TopAccountRegions"),
    )


# The notes beside the quick health check.
HEALTH_NOTES = {
    "Instructions": "Run this query every few hours to monitor connector health",
    "ExpectedResults": "Should see consistent data flow with recent timestamps",
}


def recent_health(base: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Quick check over a base view of the last hour."""
    count, latest = F.col("RecentRecords"), F.col("LatestRecord")
    return base.agg(
        _rows().alias("RecentRecords"),
        F.max("TimeGenerated").alias("LatestRecord"),
        F.count_distinct("FindingId").alias("UniqueFindings"),
    ).select(
        F.lit(instant(as_of)).alias("CheckTime"),
        *[F.lit(words).alias(name) for name, words in HEALTH_NOTES.items()],
        first_match(
            [
                (count == 0, "No recent data - check connector"),
                (latest < at(as_of, "2h"), "Data delay - possible ingestion lag"),
            ],
            "Healthy ingestion",
        ).alias("HealthStatus"),
        "RecentRecords",
        "LatestRecord",
        "UniqueFindings",
    )


def data_lag(table: DataFrame, as_of: datetime | None = None, window="1h") -> DataFrame:
    """Time since the newest row of the last hour."""
    count, lag = F.col("RecordCount"), F.col("DataLagSeconds")
    return (
        table.filter(F.col("TimeGenerated") > at(as_of, window))
        .agg(_rows().alias("RecordCount"), F.max("TimeGenerated").alias("LatestRecord"))
        .withColumn("DataLagSeconds", seconds_between(at(as_of), F.col("LatestRecord")))
        .withColumn(
            "Status",
            first_match(
                [
                    (count == 0, "No data - check KMS permissions"),
                    (lag > timespan("30m").total_seconds(), "Data lag detected"),
                ],
                "KMS permissions working",
            ),
        )
    )


def resolution_steps(spark: SparkSession) -> DataFrame:
    """The resolution checklist, one step per row."""
    steps = F.array(*[F.lit(s) for s in RESOLUTION_STEPS])
    return spark.range(1).select(F.explode(steps).alias("ResolutionSteps"))


def diagnostic_report(table: DataFrame, settings_rows: DataFrame, base: DataFrame) -> DataFrame:
    """Titled sections in one result: availability, settings, parsed findings with their severity distribution."""
    availability = table.agg(_rows().alias("RecordCount"), F.max("TimeGenerated").alias("LatestRecord"))
    config = settings_rows.agg(_rows().alias("ConfigEntries"))
    levels = base.groupBy("SeverityLevel").agg(_rows().alias("n"), F.count_distinct("FindingId").alias("ids"))
    entries = F.sort_array(F.collect_list(F.struct("SeverityLevel", "n")))
    # A finding id has one row in the base view, so distinct ids add up over the levels.
    quality = levels.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("ParsedRecords"),
        F.coalesce(F.sum("ids"), F.lit(0)).alias("UniqueFindings"),
        F.map_from_entries(entries).alias("SeverityDistribution"),
    )
    sections = (
        ("1. Connector Data Availability", availability),
        ("2. Parsing Function Status", config),
        ("3. Data Quality Check", quality),
    )
    report = None
    for title, df in sections:
        titled = df.withColumn("Section", F.lit(title))
        report = titled if report is None else report.unionByName(titled, allowMissingColumns=True)
    return report.select(
        "Section",
        "RecordCount",
        "LatestRecord",
        "ConfigEntries",
        "ParsedRecords",
        "UniqueFindings",
        "SeverityDistribution",
    )


def _metric(name: str, key: str, when: Column) -> Column:
    return F.when(when, F.struct(F.lit(name).alias("metric"), F.col(key).alias("key")))


def smoke_suite(table: DataFrame, as_of: datetime | None = None, settings: Settings = DEFAULTS) -> DataFrame:
    """The five smoke tests as rows ``(Test, TestResult, Metrics)``: availability, structure, types, network, identity.

    Two scans and one shuffle of ids. A finding's newest copy of the week is that of the day too where it lies in the
    day, so the day's base is a part of the week's, and the network and identity findings are marked in it. Rows become
    one count per metric and value, which gives totals and distinct values at once, and no metric's values gather in
    one task: types are ranked per salt before the ranks of all salts meet.
    """
    address = [r for r in NETWORK_READS if r.name in ("RemoteIp", "RemoteCountry")]
    week = with_calls(base_findings(table, "7d", as_of, settings, reads=(*IDENTITY_READS, *address)))
    day = F.col("TimeGenerated") >= at(as_of, "1d")
    call = is_identity() & (F.col("DataQuality") == "Good")
    metrics = F.array(
        _metric("type of the day", "FindingType", day),
        _metric("account of the day", "AwsAccountId", day),
        _metric("type", "FindingType", F.lit(True)),
        _metric("address", "RemoteIp", is_network()),
        _metric("country", "RemoteCountry", is_network()),
        _metric("call", "ApiName", call),
        _metric("user", "UserName", call),
    )
    # The parts that a row of the day has filled; the raw text always is.
    parts = not_empty(F.col("FindingId")).cast("int") + F.col("Severity").isNotNull().cast("int") + 1
    entries = week.select(parts.alias("parts"), F.explode(F.array_compact(metrics)).alias("m")).select("m.*", "parts")
    counts = entries.groupBy("metric", "key").agg(_rows().alias("n"), F.sum("parts").alias("parts"))
    salted = Window.partitionBy("metric", F.pmod(F.xxhash64("key"), F.lit(TYPE_SALTS))).orderBy(F.desc("n"), "key")
    ranked = counts.withColumn("place", F.row_number().over(salted))

    def total(metric: str, value: str = "n", when: Column | None = None) -> Column:
        wanted = F.col("metric") == metric
        return F.coalesce(F.sum(F.when(wanted if when is None else wanted & when, F.col(value))), F.lit(0))

    def values(metric: str) -> Column:
        return F.count_if(F.col("metric") == metric)

    known = not_empty(F.col("key"))
    leading = F.when((F.col("metric") == "type") & (F.col("place") <= TOP_TYPES), F.struct((-F.col("n")).alias("n"), "key"))
    totals = ranked.agg(
        total("type of the day").alias("TotalRecords"),
        (total("type of the day", "parts") + total("account of the day", when=known)).alias("_filled"),
        values("type of the day").alias("UniqueFindingTypes"),
        values("account of the day").alias("UniqueAccounts"),
        F.slice(F.sort_array(F.collect_list(leading)), 1, TOP_TYPES).alias("_types"),
        total("address").alias("NetworkFindings"),
        total("address", when=known).alias("FindingsWithRemoteIP"),
        values("address").alias("UniqueRemoteIPs"),
        values("country").alias("UniqueCountries"),
        total("call").alias("IAMFindings"),
        total("call", when=known).alias("FindingsWithAPI"),
        total("user", when=known).alias("FindingsWithUser"),
        values("call").alias("UniqueAPIs"),
        values("user").alias("UniqueUsers"),
    ).withColumns(
        {
            "TotalTypes": F.size("_types").cast("bigint"),
            "labels": F.transform("_types", lambda t: F.concat(t["key"], F.lit(" ("), (-t["n"]).cast("string"), F.lit(")"))),
        }
    )

    def row(test: str, verdict: Column, *measures: Column) -> Column:
        return F.struct(F.lit(test).alias("Test"), verdict, json_bag(*measures).alias("Metrics"))

    available = data_availability(table, as_of=as_of)
    first = available.select(row("Data Availability", *[F.col(c) for c in available.columns]).alias("r"))
    others = F.array(
        row("Data Structure", *_structure()),
        row("Finding Types", *_diversity()),
        row("Network Findings", *_addresses()),
        row("IAM Findings", *_calls()),
    )
    return first.unionByName(totals.select(F.explode(others).alias("r"))).select("r.*")
