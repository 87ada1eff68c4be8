"""The findings table, the flat record, and their files."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
    VariantType,
)

from watchtide.functions.severity import severity_level_flat
from watchtide.functions.text import first_text
from watchtide.functions.times import at, day_at, utc_day
from watchtide.functions.variant import canonical_json, has_content, is_object, member, nullable_text, part

# Columns of the findings table, in contract order.
FINDINGS = StructType(
    [
        StructField("AccountId", StringType()),
        StructField("ActivityType", StringType()),
        StructField("Arn", StringType()),
        StructField("Description", StringType()),
        StructField("Id", StringType()),
        StructField("Partition", StringType()),
        StructField("Region", StringType()),
        StructField("ResourceDetails", VariantType()),
        StructField("SchemaVersion", StringType()),
        StructField("ServiceDetails", VariantType()),
        StructField("Severity", IntegerType()),
        StructField("TimeCreated", TimestampType()),
        StructField("TimeGenerated", TimestampType()),
        StructField("Title", StringType()),
    ]
)
# Fixed value: bytes of the table's or an export's files that one task reads at most, unless a file cannot be split.
SPLIT_BYTES = 16 << 20
PARTITION_COLUMN = "GeneratedDate"
CONTENT_HASH = "ContentHash"
STORED = StructType([*FINDINGS.fields, StructField(CONTENT_HASH, LongType()), StructField(PARTITION_COLUMN, DateType())])


def to_findings_table(df: DataFrame, *carried: str | Column) -> DataFrame:
    """The 14 table columns of a ``finding``, then the carried ones.

    Severity loses its fraction; the newest-copy time is ``updatedAt``.
    """
    finding = F.col("finding")
    service = part(finding, ".service")
    partition = F.when(part(finding, ".partition").isNull(), F.lit("aws")).otherwise(member(finding, ".partition"))
    columns = {
        "AccountId": member(finding, ".accountId"),
        "ActivityType": member(finding, ".type"),
        "Arn": member(finding, ".arn"),
        "Description": nullable_text(finding, ".description"),
        "Id": member(finding, ".id"),
        "Partition": partition,
        "Region": member(finding, ".region"),
        "ResourceDetails": part(finding, ".resource"),
        "SchemaVersion": member(finding, ".schemaVersion"),
        "ServiceDetails": F.when(is_object(finding, ".service"), service)
        .when(has_content(service), service)
        .otherwise(F.parse_json(F.lit("{}"))),
        "Severity": F.try_variant_get(finding, "$.severity", "double").try_cast("int"),
        "TimeCreated": F.try_variant_get(finding, "$.createdAt", "timestamp"),
        "TimeGenerated": F.try_variant_get(finding, "$.updatedAt", "timestamp"),
        "Title": nullable_text(finding, ".title"),
    }
    return df.select(*[columns[name].alias(name) for name in FINDINGS.names], *carried)


def to_flat_record(df: DataFrame, default_region: str = "") -> DataFrame:
    """The 30-column record of the older custom table. Missing text stays null here."""
    finding = F.col("finding")
    resource, service = part(finding, ".resource"), part(finding, ".service")
    connection, api = ".service.action.networkConnectionAction", ".service.action.awsApiCallAction"
    own = part(finding, connection + ".remoteIpDetails")
    remote = F.when(has_content(own), own).otherwise(part(finding, api + ".remoteIpDetails"))
    score = F.try_variant_get(finding, "$.severity", "double")

    def words(path: str):
        return nullable_text(finding, path)

    def whole(path: str):
        return F.try_variant_get(finding, "$" + path, "int")

    columns = {
        "TimeGenerated": F.coalesce(
            F.try_variant_get(finding, "$.updatedAt", "timestamp"),
            F.try_variant_get(finding, "$.createdAt", "timestamp"),
        ),
        "FindingId": words(".id"),
        "FindingType": words(".type"),
        "Severity": score,
        "SeverityLevel": severity_level_flat(score),
        "Title": words(".title"),
        "Description": words(".description"),
        "AwsAccountId": words(".accountId"),
        "AwsRegion": first_text(words(".region"), F.lit(default_region)),
        "SchemaVersion": words(".schemaVersion"),
        "ResourceType": nullable_text(resource, ".resourceType"),
        "ActionType": nullable_text(service, ".action.actionType"),
        "RemoteIp": nullable_text(remote, ".ipAddressV4"),
        "RemoteCountry": nullable_text(remote, ".country.countryName"),
        "Protocol": words(connection + ".protocol"),
        "ConnectionDirection": words(connection + ".connectionDirection"),
        "RemotePort": whole(connection + ".remotePortDetails.port"),
        "LocalPort": whole(connection + ".localPortDetails.port"),
        "ApiName": words(api + ".api"),
        "CallerType": words(api + ".callerType"),
        "UserName": words(".resource.accessKeyDetails.userName"),
        "UserType": words(".resource.accessKeyDetails.userType"),
        "AccessKeyId": words(".resource.accessKeyDetails.accessKeyId"),
        "InstanceId": words(".resource.instanceDetails.instanceId"),
        "InstanceType": words(".resource.instanceDetails.instanceType"),
        "VpcId": words(".resource.instanceDetails.networkInterfaces[0].vpcId"),
        "DetectorId": words(".service.detectorId"),
        "EventFirstSeen": words(".service.eventFirstSeen"),
        "EventLastSeen": words(".service.eventLastSeen"),
        "RawFinding": canonical_json(finding),
    }
    return df.select(*[column.alias(name) for name, column in columns.items()])


def content_hash() -> Column:
    """60 bits of the MD5 of what the short columns of a copy do not say: title, description, partition, documents.

    It is stored with every row, so that copies which differ in nothing else have an order that no view has to read
    the documents for. A missing value is not an empty one.
    """
    long_ones = ("Title", "Description", "Partition", F.to_json("ResourceDetails"), F.to_json("ServiceDetails"))
    parts = [F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("\x02")) for c in long_ones]
    return F.conv(F.substring(F.md5(F.concat_ws("\x01", *parts)), 1, 15), 16, 10).cast("long")


def with_content_hash(table: DataFrame) -> DataFrame:
    """The 14 columns and ``ContentHash``."""
    return table.select(*FINDINGS.names, content_hash().alias(CONTENT_HASH))


def micros(df: DataFrame) -> DataFrame:
    """Makes the session of ``df`` write Parquet times with statistics, so that a time filter skips row groups."""
    df.sparkSession.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    return df


@contextmanager
def variants_whole(spark: SparkSession) -> Iterator[None]:
    """Files written inside keep variants in one piece, which is cheaper for rows that are read whole and soon replaced."""
    option = "spark.sql.variant.writeShredding.enabled"
    before = spark.conf.get(option)
    spark.conf.set(option, "false")
    try:
        yield
    finally:
        spark.conf.set(option, before)


def write_findings(df: DataFrame, path: str, mode: str = "append") -> None:
    """Appends to the table, one folder per UTC day of ``TimeGenerated``.

    The rebalance hint lets adaptive execution join small days and split a day that holds most of the rows, so a
    file is neither tiny nor written by one overloaded task. Files are sorted by time, and variants are shredded on write: a later read of one
    member reads one Parquet column.
    """
    dated = with_content_hash(df).select("*", utc_day(F.col("TimeGenerated")).alias(PARTITION_COLUMN))
    dealt = micros(dated.hint("rebalance", F.col(PARTITION_COLUMN)).sortWithinPartitions(PARTITION_COLUMN, "TimeGenerated"))
    dealt.write.mode(mode).partitionBy(PARTITION_COLUMN).parquet(path)


def small_splits(spark: SparkSession) -> None:
    """Makes the session of ``spark`` read at most ``SPLIT_BYTES`` of files in one task, if it says nothing about it.

    A task that drops older copies, or deals rows round, sorts all rows of its split first, with the documents if they
    are asked for; they take more than ten times the bytes of the files.
    """
    option = "spark.sql.files.maxPartitionBytes"
    if spark.conf.get(option, None) is None:
        spark.conf.set(option, SPLIT_BYTES)


def findings(
    spark: SparkSession, path: str, lookback=None, as_of: datetime | None = None, with_hash: bool = False
) -> DataFrame:
    """The table's 14 columns, and ``ContentHash`` on request, null in files older than it.

    With a lookback only the day folders inside it are listed and read.
    """
    small_splits(spark)
    table = spark.read.schema(STORED).parquet(path)
    if lookback is not None:
        table = table.filter(F.col(PARTITION_COLUMN) >= day_at(as_of, lookback))
    return table.select(*FINDINGS.names, *([CONTENT_HASH] if with_hash else []))


def table_counts(tables: dict[str, DataFrame], prefix: str = "", since: datetime | None = None) -> DataFrame:
    """Row count of each given table: ``(TableName, Records)``. Tables without rows give no row.

    ``prefix`` keeps the tables whose name starts with it, in any case; ``since`` counts rows with a later
    ``TimeGenerated`` only.
    """
    counted = None
    for name, df in tables.items():
        if not name.lower().startswith(prefix.lower()):
            continue
        if since is not None:
            df = df.filter(F.col("TimeGenerated") > at(since))
        one = df.select(F.lit(name).alias("TableName")).groupBy("TableName").agg(F.count(F.lit(1)).alias("Records"))
        counted = one if counted is None else counted.unionByName(one)
    if counted is None:
        raise ValueError("no tables given")
    return counted

