from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from watchtide.llm import periodic, queries
from watchtide.llm.convolution import PRIME, squared_differences
from watchtide.llm.periodic import RunRule, periodic_runs, with_runs, word_runs


def plain(words, rule):
    """Runs by comparing all words at all distances."""
    found = {}
    for period in range(1, len(words) // rule.times + 1):
        i = 0
        while i < len(words) - period:
            j = i
            while j < len(words) - period and words[j] == words[j + period]:
                j += 1
            if j + period - i >= max(rule.least, rule.times * period):
                found.setdefault((i, j + period), period)
            i = max(j, i + 1)
    return sorted((start, period, end - start) for (start, end), period in found.items())


def collapsed(words, runs):
    lost = {i for start, period, length in runs for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in lost)


def texts(draw, count, signs, longest):
    for _ in range(count):
        size, made = draw.randrange(0, longest), []
        while len(made) < size:
            made += [draw.randrange(signs) for _ in range(draw.randrange(1, 20))] * draw.randrange(1, 6)
            if made and draw.random() < 0.2:
                made[draw.randrange(len(made))] = 99
        yield made[:size]


@pytest.mark.parametrize("rule", [RunRule(), RunRule(9), RunRule(1), RunRule(5, 4)])
@pytest.mark.parametrize("signs", [1, 2, 3, 60])
def test_runs_are_those_of_plain_comparison(rule, signs, monkeypatch):
    monkeypatch.setattr(periodic, "_CELLS", 64)
    for codes in texts(random.Random(signs), 150, signs, 170):
        assert [(s, p, n) for s, n, p in periodic_runs(np.array(codes), rule).tolist()] == plain(codes, rule)


def test_a_wrong_hash_is_found_out(monkeypatch):
    monkeypatch.setattr(periodic._Prefixes, "_same", lambda self, first, second, length: np.full(len(length), True))
    codes = [1, 2, 3, 4] + [5, 6] * 20 + [7, 8, 9]
    assert periodic_runs(np.array(codes)).tolist() == [[4, 40, 2]]


def test_squared_differences_are_exact():
    draw = np.random.default_rng(2)
    for length in (1, 2, 8, 64):
        blocks, windows = draw.integers(0, PRIME, (5, length)), draw.integers(0, PRIME, (5, 3 * length - 1))
        windows[0, length - 1 : 2 * length - 1] = blocks[0]
        found = squared_differences(blocks, windows)
        for b, w, f in zip(blocks.tolist(), windows.tolist(), found.tolist()):
            assert f == [sum((x - w[d + i]) ** 2 for i, x in enumerate(b)) % PRIME for d in range(2 * length)]


def test_long_texts_take_time_in_proportion():
    same = np.ones(400_000, np.int64)
    assert periodic_runs(same).tolist() == [[0, 400_000, 1]]
    assert periodic_runs(np.tile(np.arange(50_000), 5)).tolist() == [[0, 250_000, 50_000]]
    same[100_000] = same[250_001] = 2
    assert [r[1] for r in periodic_runs(same).tolist()] == [100_000, 150_000, 149_998]


def test_rows_and_edges(spark):
    repeat = "a b\tc\n" * 9
    rows = [(1, None), (1, ""), (2, " \n\x0b"), (3, "one word"), (4, repeat), (4, repeat), (None, "x " * 23), (5, "x\x0c" * 24), (6, "é\x85é " * 30)]
    df = spark.createDataFrame([(i, t, "own", 5) for i, t in rows], "doc_id long, text string, runs string, _found int")
    found = with_runs(df).collect()
    assert with_runs(df).columns == ["doc_id", "text", "_found", "runs", "collapsed"]
    by = lambda r: (str(r[0]), str(r[1]))
    for row, (key, text) in zip(sorted(found, key=by), sorted(rows, key=by)):
        words = [w.decode() for w in (text or "").encode().split()]
        runs = plain(words, RunRule())
        assert (row.doc_id, row._found) == (key, 5)
        assert [(r.start, r.period, r.length) for r in row.runs] == runs
        assert row.collapsed == collapsed(words, runs)
    assert with_runs(df.limit(0)).collect() == []
    for bad in ((24, 2), (0, 3)):
        with pytest.raises(ValueError):
            RunRule(*bad)


def test_runs_inside_runs():
    inner = ["a", "b"] * 13 + ["c"]
    words = inner * 4 + ["end"]
    runs, left = word_runs(" ".join(words))
    assert [(s, p, n) for s, n, p in runs.tolist()] == plain(words, RunRule())
    assert left == collapsed(words, plain(words, RunRule())) == "a b c end"


def test_query(spark):
    """The whole contract in plain Python, planting included."""
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = {r.doc_id: r for r in queries.op12_periodic_runs(spark, sf).collect()}
    assert found.keys() == texts.keys()
    planted = 0
    for key, text in texts.items():
        words = (text or "").encode().split()
        h, n = zlib.crc32(str(key).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
            planted += 1
        runs = plain(words, RunRule())
        best = min(runs, key=lambda r: (-r[2] / r[1], r[0], r[1]), default=None)
        row = found[key]
        assert row.n_runs == len(runs)
        assert (row.start, row.period, row.length) == (best or (None,) * 3)
        assert row.exponent_milli == (1000 * best[2] // best[1] if best else None)
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{p}\n" for s, p, n in runs).encode()).hexdigest()
        left = collapsed([w.decode() for w in words], runs)
        assert row.collapsed_sha256 == hashlib.sha256(left.encode()).hexdigest()
    assert planted
