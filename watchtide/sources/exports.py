"""Findings export files: JSON Lines, usually gzip, one finding, event or batch envelope per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from watchtide.functions.text import first_match
from watchtide.functions.variant import is_object, part
from watchtide.sources.table import small_splits

LINE = StructType([StructField("raw", StringType())])
EXPORT_GLOB = "*.jsonl.gz"

# How an event envelope names its kind and its sender.
EVENT_KIND = "GuardDuty Finding"
EVENT_SOURCE = "aws.guardduty"

# What ``from_json`` would let pass beyond JSON.
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def parse_lines(lines: DataFrame) -> DataFrame:
    """``(raw, event, contract_error)`` from a ``raw`` text column. A line that is not JSON is an error, not a loss.

    Of a key that an object repeats the last value counts. ``from_json`` reads all lines of a task with one parser, which
    knows the names of members from the lines before; ``try_parse_json`` makes a parser for every line.
    """
    lines.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    event = F.from_json("raw", "variant", _STRICT)
    return (
        lines.select("raw", event.alias("event"))
        .withColumn("contract_error", F.when(F.col("event").isNull(), F.lit("line is not valid JSON")))
    )


def _spread(lines: DataFrame, partitions: int | None) -> DataFrame:
    """Lines dealt to so many tasks by lot. Dealing them in turn would sort the text in the one task that unpacks a file."""
    return lines.repartition(partitions, F.rand(0)) if partitions else lines


def read_findings(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Export files under ``path`` and its account/region sub-folders.

    A gzip file is one task, however large. Give ``partitions`` to spread the parsing when files are few and big;
    with many files the scan is already parallel and a shuffle of the raw text would only cost. Files share a task up
    to the split size of the session, which ``small_splits`` keeps small: packed text grows twentyfold when it is read.
    """
    small_splits(spark)
    lines = spark.read.schema("raw STRING").option("recursiveFileLookup", "true").text(path)
    lines = lines.filter(F.trim("raw") != "")
    return parse_lines(_spread(lines, partitions))


def stream_findings(
    spark: SparkSession,
    path: str,
    glob: str = EXPORT_GLOB,
    max_files: int | None = 1000,
    max_bytes: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """The same files as a stream: each new file is taken once, a bounded amount per trigger.

    ``partitions`` spreads the lines of a trigger. Without it they are spread over the cores where a trigger has fewer
    gzip files than that.
    """
    cores = spark.sparkContext.defaultParallelism
    if partitions is None and max_bytes is None and max_files is not None and max_files < cores:
        partitions = cores
    reader = (
        spark.readStream.schema("raw STRING").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    )
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    elif max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.text(path).filter(F.trim("raw") != "")
    return parse_lines(_spread(lines, partitions))


def _first_error(*errors: Column) -> Column:
    return F.coalesce(F.col("contract_error"), *errors)


def explode_batches(df: DataFrame) -> DataFrame:
    """One row per member of a ``{"findings": [...]}`` envelope; other rows pass through.

    An envelope that is empty, not an array, or has a member that is not an object stays one row with its error.
    """
    event = F.col("event")
    # Reading a member as a variant copies all of it, so only the rows of the result do; a struct is null for any kind
    # but an object, and copies one member.
    batch = F.try_variant_get(event, "$.findings", "array<struct<id:variant>>")
    members = F.try_variant_get(event, "$.findings", "array<variant>")
    in_batch = is_object(event) & (batch.isNotNull() | part(event, ".findings").isNotNull())
    error = (
        F.when(event.isNotNull() & ~is_object(event), F.lit("event must be an object"))
        .when(in_batch & (F.coalesce(F.size(batch), F.lit(-1)) < 1), F.lit("findings must be a non-empty array"))
        .when(in_batch & F.exists(batch, lambda member: member.isNull()), F.lit("every finding must be an object"))
    )
    checked = df.withColumn("contract_error", _first_error(error))
    whole = F.array(event)
    rows = F.when(F.col("contract_error").isNull() & in_batch, members).otherwise(whole)
    return checked.select("raw", F.explode(rows).alias("event"), "contract_error")


def unwrap_events(df: DataFrame) -> DataFrame:
    """Adds ``finding``: the event itself or the ``detail`` of its envelope."""
    event = F.col("event")
    enveloped = F.coalesce(F.try_variant_get(event, "$['detail-type']", "string") == EVENT_KIND, F.lit(False))
    detail = part(event, ".detail")
    source = part(event, ".source")
    sender = F.coalesce(F.try_variant_get(event, "$.source", "string"), F.lit(EVENT_SOURCE))
    bare = part(event, ".schemaVersion").isNotNull()
    holds_object = is_object(event, ".detail")
    problem = first_match(
        [
            (enveloped & source.isNotNull() & (sender != EVENT_SOURCE), "event source must be " + EVENT_SOURCE),
            (enveloped & ~holds_object, "event detail must be an object"),
            (~enveloped & ~bare, "unrecognized event format"),
        ],
        "",
    )
    error = F.when(event.isNotNull(), F.nullif(problem, F.lit("")))
    finding = F.when(enveloped, detail).when(bare, event)
    # A generator keeps later filters from being pushed below it, where every use of the finding would unwrap it anew.
    unwrapped = F.struct(finding.alias("finding"), _first_error(error).alias("contract_error"))
    return df.select(*[c for c in df.columns if c != "contract_error"], F.inline(F.array(unwrapped)))
