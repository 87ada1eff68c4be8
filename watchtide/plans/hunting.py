"""Documented user queries over the table and the views."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window, functions as F

from watchtide.functions.text import contains, is_empty, json_bag, not_empty
from watchtide.functions.times import at, hour, seconds_between, utc_day
from watchtide.functions.variant import part

RISKY_SESSION = 70


def _count(name: str):
    return F.count(F.lit(1)).alias(name)


def high_severity(base: DataFrame) -> DataFrame:
    return base.filter(F.col("SeverityLevel") == "High").select(
        "EventTime", "FindingType", "Title", "AwsAccountId", "AwsRegion"
    )


def findings_by_country(network: DataFrame) -> DataFrame:
    """Findings with a remote address by its country and finding type, most first."""
    return (
        network.filter(not_empty(F.col("RemoteIp")))
        .groupBy("RemoteCountry", "FindingType")
        .agg(_count("Findings"))
        .orderBy(F.desc("Findings"), "RemoteCountry", "FindingType")
    )


def exposed_buckets(storage: DataFrame) -> DataFrame:
    exposed = F.col("IsPubliclyExposed") | (F.col("S3RiskCategory") == "Encryption Disabled")
    return storage.filter(exposed).select(
        "EventTime", "BucketName", "S3RiskCategory", "EffectivePermission", "EncryptionType", "AwsAccountId"
    )


def risky_workloads(kubernetes: DataFrame) -> DataFrame:
    return kubernetes.filter(F.col("K8sThreatCategory").isin("Privilege Escalation", "Credential Access")).select(
        "EventTime", "ClusterName", "K8sNamespace", "K8sObjectName", "K8sIsPrivileged", "K8sRiskScore"
    )


def inbound_sessions(sessions: DataFrame) -> DataFrame:
    return sessions.filter(F.col("NetworkDirection") == "Inbound").select(
        "TimeGenerated", "SrcIpAddr", "DstIpAddr", "DstPortNumber", "ThreatCategory"
    )


def count_by(df: DataFrame, *names: str, label: str = "Findings") -> DataFrame:
    """Rows per value, in value order: severity levels, threat categories, compliance, schema versions."""
    return df.groupBy(*names).agg(_count(label)).orderBy(*names)


def severity_distribution(base: DataFrame) -> DataFrame:
    return (
        base.groupBy("SeverityLevel", "Severity")
        .agg(_count("Findings"))
        .orderBy(F.desc("Severity"), "SeverityLevel")
    )


def finding_types(base: DataFrame) -> DataFrame:
    return base.groupBy("FindingType").agg(_count("Findings")).orderBy(F.desc("Findings"), "FindingType")


def hourly_ingestion(table: DataFrame, as_of: datetime | None = None, back="24h") -> DataFrame:
    """Rows per hour of the last day."""
    return (
        table.filter(F.col("TimeGenerated") > at(as_of, back))
        .groupBy(hour(F.col("TimeGenerated")).alias("Hour"))
        .agg(_count("RecordCount"))
        .orderBy("Hour")
    )


def latest_hours(table: DataFrame, hours: int = 48) -> DataFrame:
    """Newest hourly bins that hold rows, newest first."""
    return (
        table.groupBy(hour(F.col("TimeGenerated")).alias("Hour"))
        .agg(F.max("TimeGenerated").alias("LatestRecord"), _count("RecordCount"))
        .orderBy(F.desc("Hour"))
        .limit(hours)
    )


def search_types(base: DataFrame, *parts: str) -> DataFrame:
    """Findings whose type contains any of the substrings, newest first."""
    if not parts:
        raise ValueError("no substring given")
    wanted = F.lit(False)
    for piece in parts:
        wanted = wanted | contains(F.col("FindingType"), piece)
    return base.filter(wanted).orderBy(F.desc("EventTime"), "FindingId")


def newest(df: DataFrame, n: int, *ties: str) -> DataFrame:
    """The ``n`` newest rows: a top-k over the whole input, not a scan that stops early."""
    return df.orderBy(F.desc("TimeGenerated"), *ties).limit(n)


def missing_ids(base: DataFrame) -> DataFrame:
    return base.filter(is_empty(F.col("FindingId")))


def missing_documents(table: DataFrame, as_of: datetime | None = None, back="1h") -> DataFrame:
    """Recent rows without a resource or service document."""
    absent = F.lit(False)
    for name in ("ResourceDetails", "ServiceDetails"):
        absent = absent | F.col(name).isNull() | F.is_variant_null(name)
    return table.filter((F.col("TimeGenerated") > at(as_of, back)) & absent)


def hourly_trend(base: DataFrame) -> DataFrame:
    return (
        base.groupBy(hour(F.col("EventTime")).alias("Hour"), "FindingType")
        .agg(_count("Findings"))
        .orderBy("Hour", "FindingType")
    )


def urgent(base: DataFrame, as_of: datetime | None = None, back="15m") -> DataFrame:
    """High and Critical findings of the last minutes."""
    recent = F.col("EventTime") > at(as_of, back)
    return base.filter(recent & F.col("SeverityLevel").isin("High", "Critical"))


def daily_volume(table: DataFrame, as_of: datetime | None = None, back="30d") -> DataFrame:
    """Data per UTC day in MB, measured as the UTF-8 size of each row's JSON text, members that are null included."""
    size = F.octet_length(json_bag(*[F.col(c) for c in table.columns])).cast("long")
    return (
        table.filter(F.col("TimeGenerated") > at(as_of, back))
        .groupBy(F.timestamp_seconds(F.unix_date(utc_day(F.col("TimeGenerated"))) * 86400).alias("Day"))
        .agg((F.sum(size) / F.lit(1048576.0)).alias("DataSizeMB"))
        .orderBy("Day")
    )


def parse_latency(base: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Seconds between parsing and now, per five minutes of ``TimeGenerated``."""
    age = seconds_between(at(as_of), F.col("ParsingTimestamp"))
    return (
        base.groupBy(F.window("TimeGenerated", "5 minutes").alias("bin"))
        .agg(F.avg(age).alias("AvgQueryDuration"), F.max(age).alias("MaxQueryDuration"))
        .select(F.col("bin.start").alias("Bin"), "AvgQueryDuration", "MaxQueryDuration")
    )


def trace_finding(finding_id: str, base: DataFrame, network: DataFrame, identity: DataFrame, sessions: DataFrame):
    """One finding through every view. The id is the key of the newest-copy step, so it filters the scan."""
    views = (
        ("Main", base, "FindingId", "FindingType", "EventTime"),
        ("Network", network, "FindingId", "FindingType", "EventTime"),
        ("IAM", identity, "FindingId", "FindingType", "EventTime"),
        ("ASIM", sessions, "NetworkSessionId", "ThreatName", "EventStartTime"),
    )
    traced = None
    for parser, view, key, kind, time in views:
        rows = view.filter(F.col(key) == finding_id).select(
            F.lit(parser).alias("Parser"),
            F.col(key).alias("FindingId"),
            F.col(kind).alias("FindingType"),
            F.col(time).alias("EventTime"),
        )
        traced = rows if traced is None else traced.unionByName(rows)
    return traced


def quality_shares(quality: DataFrame) -> DataFrame:
    """Rows per quality category and their percentage. The window runs over the few category totals only."""
    counts = quality.groupBy("QualityCategory").agg(_count("Records"))
    share = F.col("Records") * 100.0 / F.sum("Records").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("Percentage", F.round(share, 2)).orderBy(F.desc("Records"), "QualityCategory")


def version_issues(quality: DataFrame) -> DataFrame:
    """Rows with a schema problem by version."""
    return count_by(quality.filter(contains(F.col("QualityCategory"), "Schema")), "SchemaVersion", label="Records")


def schema_versions(table: DataFrame) -> DataFrame:
    return table.groupBy("SchemaVersion").agg(_count("Records")).orderBy(F.desc("SchemaVersion"))


def action_documents(base: DataFrame, action_type: str, path: str) -> DataFrame:
    """The raw action document of every finding of one action type, as JSON text."""
    return base.filter(F.col("ActionType") == action_type).select(
        "FindingId", "FindingType", F.to_json(part(F.col("service"), path)).alias("Action")
    )


def session_readiness(network: DataFrame) -> DataFrame:
    """How many network findings could become sessions."""
    return network.agg(
        F.count_if(not_empty(F.col("PrivateIp"))).alias("SrcIpCount"),
        F.count_if(not_empty(F.col("RemoteIp"))).alias("DstIpCount"),
        F.count_if(not_empty(F.col("Protocol"))).alias("ProtocolCount"),
        _count("TotalRecords"),
    )


def across_sources(sessions: DataFrame, firewall: DataFrame, as_of: datetime | None = None, back="1d") -> DataFrame:
    """Address pairs of findings and of a firewall log ``(TimeGenerated, SourceIP, DestinationIP)`` in one list."""
    ours = sessions.select(F.lit("GuardDuty").alias("Source"), "SrcIpAddr", "DstIpAddr")
    theirs = firewall.filter(F.col("TimeGenerated") > at(as_of, back)).select(
        F.lit("Firewall").alias("Source"),
        F.col("SourceIP").alias("SrcIpAddr"),
        F.col("DestinationIP").alias("DstIpAddr"),
    )
    return ours.unionByName(theirs).filter(not_empty(F.col("SrcIpAddr")))


def risky_destinations(sessions: DataFrame, firewall: DataFrame, as_of: datetime | None = None, back="1d") -> DataFrame:
    """Firewall rows whose destination is the remote address of a risky session.

    The addresses are made distinct first and no side is forced to be broadcast: adaptive execution broadcasts them
    when their measured size allows it and splits a destination most of the log shares otherwise.
    """
    risky = sessions.filter(F.col("ThreatRiskLevel") > RISKY_SESSION).select(F.col("DstIpAddr").alias("DestinationIP"))
    log = firewall.filter(F.col("TimeGenerated") > at(as_of, back))
    return log.join(risky.distinct(), "DestinationIP", "left_semi").select(
        "TimeGenerated", "SourceIP", "DestinationIP", "Activity"
    )


def recent_samples(table: DataFrame, n: int = 5, as_of: datetime | None = None, back="24h") -> DataFrame:
    """The newest rows without the big documents."""
    rows = table.filter(F.col("TimeGenerated") > at(as_of, back)).drop("ResourceDetails", "ServiceDetails")
    return newest(rows, n, "Id", "Arn")


def settings_lookup(settings_rows: DataFrame, *names: str) -> DataFrame:
    return settings_rows.filter(F.col("Setting").isin(*names))
