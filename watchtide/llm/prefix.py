"""Hash keys that SQL engines agree on, and running totals that no single task has to add up."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from watchtide.storage import stored

#: Rows that share a bucket of a running total, on average.
BUCKET_ROWS = 1 << 13
KEY_BITS = 52


def hash_key(*parts: Column) -> Column:
    """A number from 0 to 2**52 - 1 made from the MD5 of the parts' texts, joined by ``/``; nulls are empty."""
    text = F.concat_ws("/", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("bigint")


def running_total(df: DataFrame, group: str, key: str, ties: list[str], value: str, name: str, rows: int, sums: DataFrame | None = None) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over earlier rows of the same ``group``, by ``key``, then ``ties``.

    ``key`` is a ``hash_key``, so its leading bits cut every group, however large, into even buckets of about
    ``BUCKET_ROWS`` of the ``rows`` in all. Bucket sums are added up first and handed to the buckets, which then run
    side by side. ``sums`` may give ``group``, ``key`` and ``value`` of the same rows from where they are cheaper to
    read. Column names starting with ``_`` are used inside.
    """
    width = 2**KEY_BITS // max(1, math.ceil(rows / BUCKET_ROWS)) + 1
    bucket = F.expr(f"{key} div {width}")
    dealt = df.withColumn("_bucket", bucket)
    sums = (df if sums is None else sums).withColumn("_bucket", bucket).groupBy(group, "_bucket").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(sums.select(group, "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset")), "offsets")
    earlier = Window.partitionBy(group, "_bucket").orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, -1)
    return (
        dealt.join(offsets, [group, "_bucket"])
        .withColumn(name, F.col("_offset") + F.coalesce(F.sum(value).over(earlier), F.lit(0)))
        .drop("_bucket", "_offset")
    )


def with_rows(df: DataFrame, name: str) -> DataFrame:
    """``(_all, _row)``: the rows of ``df`` as structs with a number each, written once so that the numbers stay."""
    return stored(df.select(F.struct("*").alias("_all"), F.monotonically_increasing_id().alias("_row")), name)


def attached(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``with_rows`` that ``found`` has numbers of, with its columns.

    Wide rows only pass by: the narrow side is hashed, so they are neither sorted nor held.
    """
    return rows.join(found.hint("shuffle_hash"), "_row")
