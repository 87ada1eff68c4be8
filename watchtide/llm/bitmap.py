"""A bitmap of fixed size that tells which keys cannot occur, for use where rows are read."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F


def gathered_bitmap(marks: DataFrame, bits: int) -> np.ndarray:
    """Bitmap with the bits named in the only column of ``marks`` set.

    Bits are joined to words before they leave the executors, so ``bits / 64`` numbers at most reach the driver,
    however many marks there are.
    """
    mark = marks.columns[0]
    words = marks.select(F.shiftright(mark, 6).alias("word"), F.expr(f"shiftleft(1L, cast({mark} & 63 as int))").alias("bit"))
    gathered = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bitmap = np.zeros(bits // 64, np.int64)
    bitmap[gathered["word"].to_numpy()] = gathered["bits"].to_numpy()
    return bitmap.view(np.uint64)


def in_bitmap(bitmap: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Whether the bit of each mark is set."""
    return ((bitmap[marks >> 6] >> (marks & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
