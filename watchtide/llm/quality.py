"""Text quality by compression: how much better a dictionary of good text compresses a text than one of bad text.

Two zstandard dictionaries are trained, on texts labelled good and bad. A text is cut into chunks, each compressed with
either dictionary; the difference of the two sums, per byte of the text, is the only thing that is looked at. A logistic
curve of it, fitted on labelled texts that the dictionaries have not seen, turns it into a probability.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from watchtide.llm.words import bounded_batches


@dataclass(frozen=True)
class Learning:
    """Bounds of what is learnt from, per label: ``rows`` texts of at most ``row_bytes``; and the coder's shape."""

    rows: int = 2000
    row_bytes: int = 1 << 15
    chunk: int = 512
    dictionary_bytes: int = 1 << 18
    level: int = 3


@dataclass(frozen=True)
class Model:
    """Two dictionaries and the curve ``1 / (1 + exp(-(slope * difference + constant)))``."""

    good: bytes
    bad: bytes
    slope: float
    constant: float
    chunk: int
    level: int

    def probability(self, differences: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * differences + self.constant, -30, 30)))


@functools.lru_cache(maxsize=4)
def _coder(dictionary: bytes, level: int) -> zstandard.ZstdCompressor:
    if not dictionary:
        return zstandard.ZstdCompressor(level=level, write_content_size=False)
    known = zstandard.ZstdCompressionDict(dictionary)
    known.precompute_compress(level=level)
    return zstandard.ZstdCompressor(dict_data=known, write_content_size=False, write_dict_id=False)


def difference(text: str | None, good: bytes, bad: bytes, chunk: int, level: int) -> float:
    """Compressed size with the bad dictionary less that with the good one, per byte; 0 for a null or empty text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data:
        return 0.0
    with_good, with_bad = (
        sum(len(_coder(d, level).compress(data[i : i + chunk])) for i in range(0, len(data), chunk)) for d in (good, bad)
    )
    return (with_bad - with_good) / len(data)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of the logistic curve by Newton's method, with a ridge on all but the constant."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + penalty * w
        curve = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _dictionary(texts: list[bytes], rule: Learning) -> bytes:
    """A trained dictionary, or plain content where there is too little to train on."""
    chunks = [t[i : i + rule.chunk] for t in texts for i in range(0, len(t), rule.chunk)]
    try:
        return zstandard.train_dictionary(rule.dictionary_bytes, chunks).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(chunks)[: rule.dictionary_bytes]


def fit(docs: DataFrame, labels: DataFrame, may_learn: Column | None = None, rule: Learning = Learning(), id: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Learns from ``labels (id, label)`` with label 1 for good and 0 for bad, of ids for which ``may_learn`` holds.

    The sample: of each label the ``rule.rows`` ids first in hash order, texts over ``rule.row_bytes`` left out; half
    of it makes the dictionaries, half the curve, weighted to the shares that the labels have in all. Ids with both
    labels, null ids and null labels are not learnt from; of an id with several texts the smallest is. With less than one text of either label, all scores are the
    share of good labels, 1/2 without any.
    """
    clean = labels.filter(labels[id].isNotNull() & labels[label].isin(0, 1))
    clean = clean if may_learn is None else clean.filter(may_learn)
    each = clean.groupBy(F.col(id).alias("id")).agg(F.min(label).alias("label"), F.max(label).alias("other")).filter("label = other")
    shares = {r.label: r["count"] for r in each.groupBy("label").count().collect()}
    drawn = None
    for value in (0, 1):
        part = each.filter(F.col("label") == value).orderBy(F.xxhash64("id"), "id").limit(rule.rows).select("id", "label")
        drawn = part if drawn is None else drawn.unionByName(part)
    texts = docs.select(docs[id].alias("id"), docs[text].alias("text")).filter(F.octet_length("text").between(1, rule.row_bytes))
    # The drawn ids are 2 * rule.rows at most, whatever the size of the tables.
    sample = texts.join(F.broadcast(drawn), "id").groupBy("id", "label").agg(F.min("text").alias("text")).toPandas()
    sample["turn"] = [zlib.crc32(str(i).encode()) for i in sample["id"]]
    sample = sample.sort_values(["turn", "id"], kind="stable")
    halves = {v: [t.encode("utf-8", "surrogatepass") for t in sample.loc[sample["label"] == v, "text"]] for v in (0, 1)}
    if min(map(len, halves.values())) < 2:
        total = sum(shares.values())
        odds = np.log((shares.get(1, 0) + 0.5) / (shares.get(0, 0) + 0.5)) if total else 0.0
        return Model(b"", b"", 0.0, float(odds), rule.chunk, rule.level)
    bad, good = (_dictionary(halves[v][::2], rule) for v in (0, 1))
    rest = [(t.decode("utf-8", "surrogatepass"), v) for v in (0, 1) for t in halves[v][1::2]]
    raw = np.array([difference(t, good, bad, rule.chunk, rule.level) for t, _ in rest])
    y = np.array([v for _, v in rest], float)
    centre, spread = raw.mean(), raw.std() + 1e-9
    total = sum(shares.values())
    weight = np.where(y == 1, shares[1] / total / y.sum(), shares[0] / total / (1 - y).sum()) * len(y)
    slope, constant = _logistic(np.column_stack([(raw - centre) / spread, np.ones(len(y))]), y, weight)
    return Model(good, bad, float(slope / spread), float(constant - slope * centre / spread), rule.chunk, rule.level)


def with_scores(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, the probability of label 1, and ``predicted``, 1 from 1/2 on; columns so named give way.

    Null and empty texts have the difference 0 and get the score of it. No shuffle; every chunk of a text counts.
    """
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            raw = np.array([difference(t, model.good, model.bad, model.chunk, model.level) for t in batch], float)
            yield pd.Series(model.probability(raw))

    scored = docs.withColumn("score", score(docs[text]))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
