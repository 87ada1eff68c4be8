"""Distinct counts over long ranges from one small sketch per day."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from watchtide.functions.times import day_at, utc_day
from watchtide.sources.table import micros

#: Measure and the column of the findings table whose values it counts.
MEASURES = {"Findings": "Id", "FindingTypes": "ActivityType", "Accounts": "AccountId", "Regions": "Region"}
DAY = "Day"
#: Sketches of 2^12 registers: the standard error of an estimate is about 1.6%.
REGISTERS_LOG2 = 12


def daily_sketches(table: DataFrame) -> DataFrame:
    """``Day, Records`` and one sketch per measure for every UTC day of ``TimeGenerated``; rows without a time give no day.

    Tasks sketch their own rows before the shuffle, which carries one row per task and day, whatever the day holds.
    Null values do not count; the empty text is a value, which a sketch would pass over without the mark before it.
    """
    marked = {name: F.concat(F.lit("="), F.col(column)) for name, column in MEASURES.items()}
    sketches = [F.hll_sketch_agg(value, REGISTERS_LOG2).alias(name) for name, value in marked.items()]
    dated = table.filter(F.col("TimeGenerated").isNotNull()).withColumn(DAY, utc_day(F.col("TimeGenerated")))
    return dated.groupBy(DAY).agg(F.count(F.lit(1)).alias("Records"), *sketches)


def write_sketches(table: DataFrame, path: str) -> None:
    """Writes the sketches of the days in ``table``, in place of older ones of these days; a day must come whole."""
    writer = micros(daily_sketches(table)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(DAY).parquet(path)


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    """The sketches that ``write_sketches`` wrote."""
    kinds = ", ".join(f"{name} BINARY" for name in MEASURES)
    return spark.read.schema(f"Records BIGINT, {kinds}, {DAY} DATE").parquet(path)


def distinct_counts(sketches: DataFrame, lookback=None, as_of: datetime | None = None) -> DataFrame:
    """One row ``Days, Records, Findings, FindingTypes, Accounts, Regions`` over the whole days of a range.

    The range begins with the UTC day that the lookback falls in. No row of the table is read; a value that many days
    hold counts once.
    """
    rows = sketches if lookback is None else sketches.filter(F.col(DAY) >= day_at(as_of, lookback))
    estimates = [F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(n)), F.lit(0)).alias(n) for n in MEASURES]
    return rows.agg(F.count(F.lit(1)).alias("Days"), F.coalesce(F.sum("Records"), F.lit(0)).alias("Records"), *estimates)
