"""Packing records into delivery batches bounded by count and encoded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from watchtide.functions.text import JSON_OPTIONS

# Default limits of one delivery batch.
MAX_ROWS = 25
MAX_BYTES = 900_000

PACKED = "lane INT, batch_no BIGINT, rows INT, bytes BIGINT, records ARRAY<STRING>"


# Fixed value: records that a task of a lane packs at most, where the number of records is known.
TASK_RECORDS = 250_000


def tasks_per_lane(records: int, lanes: int) -> int:
    """Tasks that share a lane, so that what one task reads does not grow with the number of records."""
    return max(1, -(-records // (lanes * TASK_RECORDS)))


def pack_batches(
    df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES, lanes: int | None = None, lane_tasks: int = 1
) -> DataFrame:
    """Greedy batches of JSON records: ``(lane, batch_no, rows, bytes, records)``.

    ``bytes`` is the UTF-8 size of the batch as a JSON array. Each partition is a lane and is packed as it streams by,
    holding one batch at a time, so nothing is shuffled and no key can overload a task. ``lanes`` spreads the records
    evenly over that many senders first, each served by ``lane_tasks`` tasks that pack their share one beside the other;
    the numbers of a lane's batches are gapless in each share and start at a multiple of ``2 ** 32``, the first at 0. A
    record above the limit fails the job.
    """
    if max_rows < 1 or max_bytes < 3:
        raise ValueError("batch limits must be positive")
    if lane_tasks < 1 or (lane_tasks > 1 and not lanes):
        raise ValueError("tasks share the lanes that are given")
    record = F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)]), JSON_OPTIONS)
    spread = df.repartition(lanes * lane_tasks) if lanes else df
    encoded = spread.select(F.spark_partition_id().alias("lane"), record.alias("record")).withColumn(
        "size", F.octet_length("record").cast("long")
    )

    def pack(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cuts the stream of records where the next one would not fit. Only the open batch is carried along."""
        lane, batch_no, records, sizes = 0, 0, None, None

        def cut(bounds: list[int]) -> pa.RecordBatch:
            edges = np.asarray(bounds)
            with_commas = np.concatenate(([0], np.cumsum(sizes + 1)))[edges]
            count = len(bounds) - 1
            return pa.record_batch(
                [
                    pa.array(np.full(count, lane, "int32")),
                    pa.array(np.arange(batch_no, batch_no + count, dtype="int64")),
                    pa.array(np.diff(edges).astype("int32")),
                    pa.array((np.diff(with_commas) + 1).astype("int64")),
                    pa.ListArray.from_arrays(pa.array(edges.astype("int32")), records[: bounds[-1]]),
                ],
                names=["lane", "batch_no", "rows", "bytes", "records"],
            )

        for chunk in chunks:
            if chunk.num_rows == 0:
                continue
            if records is None and batch_no == 0:
                share, lane = divmod(chunk.column("lane")[0].as_py(), lanes) if lanes else (0, chunk.column("lane")[0].as_py())
                batch_no = share << 32
            new_records, new_sizes = chunk.column("record"), chunk.column("size").to_numpy()
            if int(new_sizes.max()) + 2 > max_bytes:
                raise ValueError("a single record exceeds the batch byte limit")
            records = new_records if records is None else pa.concat_arrays([records, new_records])
            sizes = new_sizes if sizes is None else np.concatenate([sizes, new_sizes])
            ends, bounds = np.cumsum(sizes + 1), [0]
            while True:
                start = bounds[-1]
                before = ends[start - 1] if start else 0
                stop = min(int(np.searchsorted(ends, before + max_bytes - 1, side="right")), start + max_rows)
                if stop >= len(records):
                    break
                bounds.append(stop)
            if len(bounds) > 1:
                yield cut(bounds)
                batch_no += len(bounds) - 1
                records, sizes = records.slice(bounds[-1]), sizes[bounds[-1] :]
        if records is not None:
            yield cut([0, len(records)])

    return encoded.mapInArrow(pack, PACKED)


def batch_summary(batches: DataFrame) -> DataFrame:
    """Delivered totals: ``(batches_sent, records_sent)``."""
    return batches.agg(
        F.count(F.lit(1)).alias("batches_sent"),
        F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("records_sent"),
    )
