"""Newest copy per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Copies with the same time are told apart by these short columns, so that every run keeps the same one. Long ones would
# ride through the shuffle of every view; the last column, which is stored with the table, stands for them.
TIE_BREAK = ("TimeCreated", "Severity", "ActivityType", "SchemaVersion", "AccountId", "Region", "Arn", "ContentHash")


def newest_first(df: DataFrame, time: str = "TimeGenerated", ties=TIE_BREAK) -> list[Column]:
    return [F.desc_nulls_last(c) for c in (time, *ties) if c in df.columns]


def newest_per_key(df: DataFrame, key: str | list[str] = "Id", time: str = "TimeGenerated", ties=TIE_BREAK) -> DataFrame:
    """One row per key: the one with the latest time.

    Ranking by ``row_number() = 1`` lets Spark drop all but one row per key inside every task before the shuffle, so
    a key that holds a third of the table still sends at most one row per task.
    """
    order = Window.partitionBy(*([key] if isinstance(key, str) else key)).orderBy(*newest_first(df, time, ties))
    return df.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") == 1).drop("_rank")
