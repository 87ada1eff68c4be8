"""Token sequences of one length, by concatenating all documents and cutting.

The first pass turns texts into ids, counts them up inside each partition and writes both. Totals of the partitions, one
row each, are summed up to global offsets. The second pass adds a partition's offset to its rows, which tells where the
borders of the fixed windows fall in every document, and cuts there; ids are neither shuffled nor sorted for it. A
window that spans two partitions comes together from boundary records, of which a partition has two at most.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from public_tokenizers import PATTERN
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from tokenizers import Tokenizer

from watchtide.llm.words import bounded_batches
from watchtide.storage import stored

#: Texts of nothing but characters whose kind never changed: those below U+0250 and common marks.
_PLAIN = re.compile("[\u0000-\u024F\u2010-\u2027\u2030-\u205E\u20AC]*")
#: Where a long text may be cut: a space after a non-blank always begins a token.
_CUT = re.compile(r" (?<=\S )")
_SEGMENT = 1 << 18
_OUT_BYTES = 1 << 22


@dataclass(frozen=True)
class Packing:
    """Ids in a sequence, the id that ends a document, and the id that fills up a sequence."""

    length: int = 2048
    end_id: int = 1
    pad_id: int = 0

    def __post_init__(self) -> None:
        if self.length < 1:
            raise ValueError("a sequence holds at least one id")


class Encoder:
    """Ids of whole texts by a byte-level tokenizer file, and its vocabulary as ranks where there is such a file.

    Ranks do plain text several times as fast; without them, and for other texts, the tokenizer itself does the work.
    Both give the same ids. Strings of special tokens in a text are ordinary text. Long texts are encoded in segments.
    """

    def __init__(self, path: str, ranks: str | None = None):
        self._any = Tokenizer.from_file(path)
        self._any.encode_special_tokens = True
        self.kind = "<u2" if self._any.get_vocab_size() <= 1 << 16 else "<u4"
        self._plain = _by_ranks(ranks) if ranks else None

    def __call__(self, text: str | None) -> bytes:
        """The ids as little-endian numbers of type ``kind``, one after the other."""
        found, start = [], 0
        while text and start < len(text):
            cut = _CUT.search(text, start + _SEGMENT)
            end = cut.start() if cut else len(text)
            part = text[start:end]
            if self._plain and _PLAIN.fullmatch(part):
                ids = self._plain.encode_to_numpy(part)
            else:
                ids = np.array(self._any.encode(part, add_special_tokens=False).ids)
            found.append(ids.astype(self.kind).tobytes())
            start = end
        return b"".join(found)


def _by_ranks(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        known = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=known, special_tokens={})


@functools.lru_cache(maxsize=2)
def _encoder(path: str, ranks: str | None) -> Encoder:
    return Encoder(path, ranks)


def _tables(rows: Iterator[tuple], schema: pa.Schema, size_of) -> Iterator[pa.RecordBatch]:
    """Rows in batches of bounded bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += size_of(row) + 64
        if size >= _OUT_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _tokens(docs: DataFrame, path: str, ranks: str | None, rule: Packing) -> DataFrame:
    """``(id, ids, tokens, part, before)``: the ids of a document and how many its partition has before it."""

    kind = docs.schema["id"].dataType
    schema = pa.schema([("id", to_arrow_type(kind)), ("ids", pa.binary()), ("tokens", pa.int64()), ("part", pa.int32()), ("before", pa.int64())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path, ranks)
        end = np.array([rule.end_id], encode.kind).tobytes()
        part = TaskContext.get().partitionId()

        def rows() -> Iterator[tuple]:
            before = 0
            for batch in batches:
                for key, text in zip(*[c.to_pylist() for c in batch.columns]):
                    ids = encode(text) + end
                    yield key, ids, len(ids) // len(end), part, before
                    before += len(ids) // len(end)

        yield from _tables(rows(), schema, lambda row: len(row[1]))

    return docs.mapInArrow(of, f"id {kind.simpleString()}, ids binary, tokens bigint, part int, before bigint")


def packed(docs: DataFrame, tokenizer: str, ranks: str | None = None, rule: Packing = Packing(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of documents: ``(id, start, length, ids, doc_tokens, sequence_id, offset)``, the id under its own name.

    ``tokenizer`` is the path of a byte-level tokenizer file that every executor can read, ``ranks`` that of the same
    vocabulary as ranks, which saves time. A document is the ids of its text and
    ``rule.end_id``; null and empty texts are that id alone. ``start`` and ``length`` count ids of the document,
    ``offset`` says where in the sequence the piece begins, ``ids`` are little-endian unsigned 32-bit numbers.
    Documents follow each other in the order of the table's partitions, every row is one of its own, repeated and null
    ids included, and only the last sequence is shorter than ``rule.length``. Other columns are not read; an empty
    table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    tokens = stored(_tokens(docs.select(docs[id].alias("id"), docs[text].alias("text")), tokenizer, ranks, rule), "tokens")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = tokens.groupBy("part").agg(F.max(F.col("before") + F.col("tokens")).alias("total"))
    offsets = stored(totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset")), "offsets")
    placed = tokens.join(offsets, "part").select("id", "ids", "tokens", (F.col("before") + F.col("offset")).alias("at"))
    kind, length = placed.schema["id"].dataType, rule.length

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for key, ids, tokens, at in zip(*[c.to_pylist() for c in batch.columns]):
                    wide = np.frombuffer(ids, f"<u{len(ids) // tokens}").astype("<u4")
                    borders = [at, *range((at // length + 1) * length, at + tokens, length), at + tokens]
                    for first, last in zip(borders, borders[1:]):
                        yield key, first - at, last - first, wide[first - at : last - at].tobytes(), tokens, first // length, first % length

        yield from _tables(rows(), schema, lambda row: len(row[3]))

    longs = ["start", "length", "doc_tokens", "sequence_id", "offset"]
    schema = pa.schema([("id", to_arrow_type(kind)), *[(n, pa.int64()) for n in longs[:2]], ("ids", pa.binary()), *[(n, pa.int64()) for n in longs[2:]]])
    pieces = placed.mapInArrow(cut, f"id {kind.simpleString()}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint")
    return pieces.withColumnRenamed("id", id)


def sequences(pieces: DataFrame, rule: Packing = Packing()) -> DataFrame:
    """``(sequence_id, tokens, ids)`` from the pieces of ``packed``: the ids of every sequence, in order.

    A window whose pieces lie in one partition, as nearly all do, is put together there. What is left of windows that
    several partitions share are boundary records, and only these are shuffled. A sequence of fewer ids than
    ``rule.length`` is filled up with ``rule.pad_id``, unless their number is a power of two; ``tokens`` is their number.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            held = None
            for batch in batches:
                for sequence, offset, ids in zip(*[c.to_pylist() for c in batch.columns]):
                    if held and held[0] == sequence and held[1] + held[2] == offset:
                        held = (sequence, held[1], held[2] + len(ids) // 4, [*held[3], ids])
                    else:
                        if held:
                            yield *held[:3], b"".join(held[3])
                        held = (sequence, offset, len(ids) // 4, [ids])
            if held:
                yield *held[:3], b"".join(held[3])

        schema = pa.schema([("sequence_id", pa.int64()), ("offset", pa.int64()), ("tokens", pa.int64()), ("ids", pa.binary())])
        yield from _tables(rows(), schema, lambda row: len(row[3]))

    found = pieces.select("sequence_id", "offset", "ids").mapInArrow(joined, "sequence_id bigint, offset bigint, tokens bigint, ids binary")
    records = stored(found, "windows")
    whole = F.col("tokens") == rule.length
    boundary = records.filter(~whole).groupBy("sequence_id").agg(F.sum("tokens").alias("tokens"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    glued = boundary.select("sequence_id", "tokens", F.aggregate("parts", F.lit(b""), lambda ids, part: F.concat(ids, part["ids"])).alias("ids"))
    every = records.filter(whole).select("sequence_id", "tokens", "ids").unionByName(glued)
    short = (F.col("tokens") < rule.length) & (F.col("tokens").bitwiseAND(F.col("tokens") - 1) != 0)
    filler = F.unhex(F.repeat(F.lit(rule.pad_id.to_bytes(4, "little").hex()), (rule.length - F.col("tokens")).cast("int")))
    return every.withColumn("ids", F.when(short, F.concat("ids", filler)).otherwise(F.col("ids")))
