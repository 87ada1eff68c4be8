from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from watchtide.llm import packing, queries
from watchtide.llm.packing import Encoder, Packing, packed, sequences

PATH, RANKS = map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def encode():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def numbers(ids):
    return np.frombuffer(ids, "<u4").tolist()


def rows(seed=4):
    draw = random.Random(seed)
    vocabulary = ["the", "wörter", "naïve,", "x1", "don't", "42", "\n", " ", "中文", "<|endoftext|>", "a\tb", "…", "é"]
    made = [(i, " ".join(draw.choices(vocabulary, k=draw.randrange(0, 120)))) for i in range(300)]
    return [*made, (None, None), (7, ""), (8, "again"), (8, "again"), (9, "long " * 20_000), (10, "ab" * 30_000)]


def frame(spark, given, parts=5):
    return spark.createDataFrame([(i, t, "own", -1) for i, t in given], "doc_id long, text string, ids string, start int").repartition(parts)


@pytest.mark.parametrize("ranks", [None, RANKS])
def test_ids_are_the_tokenizers(encode, ranks, monkeypatch):
    monkeypatch.setattr(packing, "_SEGMENT", 40)
    own = Encoder(PATH, ranks)
    draw = random.Random(8)
    signs = [chr(c) for c in range(0x250)] + list("   \n\n\t…’“”€中文éА́'s'll \x1c\x85")
    for _ in range(3000):
        text = "".join(draw.choices(signs, k=draw.randrange(0, 90)))
        assert np.frombuffer(own(text), own.kind).tolist() == encode(text)
    assert own(None) == own("") == b""


def check(pieces, given, encode, length, end_id=1):
    """Every id of every document lies in one piece, sequences are gapless and all but the last are full."""
    expected = sorted(((i, [*encode(t), end_id]) for i, t in given), key=str)
    places = defaultdict(dict)
    for p in pieces:
        assert p.length == len(p.ids) // 4 > 0
        assert p.offset not in places[p.sequence_id]
        places[p.sequence_id][p.offset] = p.length
    for n, filled in places.items():
        at = 0
        for offset in sorted(filled):
            assert offset == at
            at += filled[offset]
        assert at == length or n == max(places)
    assert sorted(places) == list(range(len(places)))
    # Rows in the order of the stream: pieces of one document follow each other.
    found, held = [], []
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.start == len(held)
        held += numbers(p.ids)
        if len(held) == p.doc_tokens:
            found.append((p.doc_id, held))
            held = []
    assert not held and sorted(found, key=str) == expected


@pytest.mark.parametrize("length", [1, 64, 2048])
def test_every_id_lies_in_one_piece(spark, encode, length):
    given = rows()[: 60 if length == 1 else None] if length > 1 else rows()[:60]
    pieces = packed(frame(spark, given), PATH, RANKS, Packing(length))
    assert pieces.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    check(pieces.collect(), given, encode, length)


@pytest.mark.parametrize("length, parts", [(64, 7), (2048, 3), (1 << 17, 6)])
def test_sequences_come_together(spark, encode, length, parts):
    rule = Packing(length, pad_id=5)
    pieces = packed(frame(spark, rows(), parts), PATH, RANKS, rule).cache()
    whole = defaultdict(dict)
    for p in pieces.collect():
        whole[p.sequence_id][p.offset] = numbers(p.ids)
    for frame_ in (pieces, pieces.repartition(9)):
        made = {r.sequence_id: (r.tokens, numbers(r.ids)) for r in sequences(frame_, rule).collect()}
        assert made.keys() == whole.keys()
        for n, parts_ in whole.items():
            ids = [x for at in sorted(parts_) for x in parts_[at]]
            full = ids if not len(ids) & (len(ids) - 1) else ids + [5] * (length - len(ids))
            assert made[n] == (len(ids), full)


def test_nothing_and_bad_lengths(spark):
    empty = frame(spark, [])
    assert packed(empty, PATH).collect() == [] and sequences(packed(empty, PATH)).collect() == []
    named = spark.createDataFrame([("k", "word")], "key string, body string")
    assert [(r.key, r.length) for r in packed(named, PATH, id="key", text="body").collect()] == [("k", 2)]
    with pytest.raises(ValueError):
        Packing(0)


def test_query(spark, encode):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = queries.op11_packing(spark, sf).collect()
    seen = defaultdict(int)
    for r in found:
        ids = [*encode(texts[r.doc_id]), 1]
        piece = np.array(ids[r.start : r.start + r.length], "<u4")
        assert (r.ids_crc32, r.doc_tokens) == (zlib.crc32(piece.tobytes()), len(ids))
        assert r.offset + r.length <= 2048
        seen[r.doc_id] += r.length
    assert seen == {i: len(encode(t)) + 1 for i, t in texts.items()}
