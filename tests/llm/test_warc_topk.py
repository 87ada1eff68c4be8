from __future__ import annotations

import base64
import gzip
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from watchtide.llm.topk import TopK, _packed, _unpacked, top_k
from watchtide.llm.warc import WarcReader, _Files, archive, read_warc, register

PAGES = [
    (1, "http://a/\r\nX-Injected: 1", "same"), (2, "http://b/", "same"), (3, None, "same"), (4, "http://c/", None), (5, "http://d/", ""),
    (6, "http://é/", "WARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"), (7, "http://big/", "é" * 400_000), (None, "http://n/", "same"), (None, "http://m/", "alone"),
    (-8, "http://m/", "other"), (9, "http://m/", "twice"), (9, "http://m/", "twice"),
]


@pytest.fixture(scope="module")
def written(spark):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, payload string")
    return archive(pages)


def test_round_trip(spark, written):
    rows = read_warc(spark, written).collect()
    assert len(rows) == len(PAGES)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.record_id.rpartition(":")[2], []).append(r)
    first = {}
    for page, _, html in PAGES:
        if page is not None:
            first[html or ""] = max(first.get(html or "", page), page)
    for page, url, html in PAGES:
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        record = next(r for r in by_id[str(page or "")] if r.payload_digest == digest)
        assert record.payload_bytes == len(payload)
        again = first.get(html or "") is not None and first[html or ""] != page
        assert record.record_type == ("revisit" if again else "response")
        assert record.refers_to == (f"urn:page:{first[html or '']}" if again else None)
        assert (record.payload is None) if again else (bytes(record.payload) == payload)
        assert record.target_uri == (None if url is None else url.replace("\r\n", "%0D%0A"))


def test_pushed_conditions(spark, written):
    rows = read_warc(spark, written, ["record_id", "record_type", "payload_bytes"])
    revisits = rows.filter("record_type = 'revisit'")
    plan = revisits._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan and "Filter [" not in plan
    assert {r.record_id for r in revisits.collect()} == {"urn:page:1", "urn:page:2", "urn:page:4", "urn:page:"}
    two = read_warc(spark, written).filter(F.col("record_id").isin("urn:page:2", "urn:page:7") & (F.col("payload_bytes") > 10))
    assert [r.record_id for r in two.collect()] == ["urn:page:7"]
    assert read_warc(spark, written).filter("record_type = 'response' and record_type = 'revisit'").collect() == []


def test_unwanted_payloads_are_not_decoded(spark, written, monkeypatch):
    import watchtide.llm.warc as warc

    decoded = []
    monkeypatch.setattr(warc, "_payload", lambda block, headers: decoded.append(len(block)) or b"")
    reader = WarcReader(written, ["record_id"], 1 << 30)
    assert sum(len(list(reader.read(p))) for p in reader.partitions()) == len(PAGES) and decoded == []


def test_file_and_split_sizes(spark, tmp_path):
    register(spark)
    pages = spark.createDataFrame([(i, "http://x/", f"{i}" * 500) for i in range(60)], "page_id long, url string, html string")
    from watchtide.llm.warc import records

    path = f"file:{tmp_path}/warc"
    records(pages).coalesce(2).write.format("warc").option("file_bytes", 5000).mode("append").save(path)
    reader = WarcReader(path, ["record_id"], 12_000)
    parts = reader.partitions()
    assert len(parts) > 2 and all(1 <= len(p.names) <= 3 for p in parts)
    assert sum(len(list(reader.read(p))) for p in parts) == 60
    assert not [p for p in (tmp_path / "warc").iterdir() if p.name.startswith("_")]


def test_batches_are_bounded_in_bytes(spark, tmp_path):
    """Many large records in one file come in batches of few; a record beyond the bound comes alone."""
    from watchtide.llm.warc import WarcReader

    sizes = [1000] * 20 + [300_000] + [1000] * 20
    pages = spark.createDataFrame([(i, f"http://a/{i}", chr(97 + i % 26) * n + str(i)) for i, n in enumerate(sizes)], "page_id long, url string, html string").coalesce(1)
    path = archive(pages, str(tmp_path / "large"))
    reader = WarcReader(path, ["record_id", "payload"], 1 << 30, 20_000)
    (part,) = reader.partitions()
    batches = list(reader.read(part))
    assert sum(b.num_rows for b in batches) == len(sizes)
    assert all(sum(len(p) for p in b["payload"].to_pylist()[:-1]) < 20_000 for b in batches) and len(batches) >= 4
    assert read_warc(spark, path).count() == len(sizes)


def test_archives_of_others_and_faults(spark, tmp_path):
    record = (
        b"WARC/1.0\nWARC-Type: resource\nWARC-Record-ID: <urn:x>\nX-Long: a\n b\nContent-Type: text/plain\nContent-Length: 3\n\nabc\n\n"
        b"WARC/1.0\r\nWARC-Type: response\r\nContent-Type: application/http\r\nContent-Length: 21\r\n\r\nHTTP/1.1 200 OK\r\n\r\nhi\r\n\r\n"
    )
    (tmp_path / "a.warc").write_bytes(record)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(record[:120]) + gzip.compress(record[120:]))
    (tmp_path / "notes.txt").write_text("no archive")
    rows = read_warc(spark, str(tmp_path)).collect()
    assert sorted((r.record_type, bytes(r.payload), r.payload_bytes) for r in rows) == [("resource", b"abc", 3)] * 2 + [("response", b"hi", 2)] * 2
    reader = WarcReader(str(tmp_path), ["record_id"], 100)
    (tmp_path / "c.warc").write_bytes(b"nonsense\n")
    with pytest.raises(ValueError):
        list(reader.read(_Files([str(tmp_path / "c.warc")])))


def test_no_pages(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert read_warc(spark, archive(empty)).collect() == []


def plain_top(rows, k, scale=1024):
    whole = {}
    kept = [(i, [int(np.floor(float(x) * scale)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    for i, v in kept:
        if i % 2 == 0:
            whole[i] = min(whole.get(i, v), v)
    out = []
    for q, v in whole.items():
        scores = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in kept if i != q and len(w) == len(v)))[:k]
        out += [(q, rank + 1, i, -max(min(s, 2**63), -(2**63 - 1))) for rank, (s, i) in enumerate(scores)]
    return sorted(out)


def top(spark, rows, rule=TopK()):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    return sorted(map(tuple, top_k(df, F.col("vec_id") % 2 == 0, rule).collect()))


@pytest.mark.parametrize("rule", [TopK(k=4), TopK(k=4, query_rows=7, vector_rows=5, fan_in=2)])
def test_top_k_equals_brute_force(spark, rule):
    draw = random.Random(1)
    rows = [(i, [draw.choice([-1.0, -0.3, 0.0, 0.25, 0.7]) for _ in range(3)]) for i in range(90)]
    assert top(spark, rows, rule) == plain_top(rows, 4)


def test_top_k_broadcasts_no_copies_of_blocks(spark):
    rows = spark.createDataFrame([(i, [float(i % 7), 1.0]) for i in range(40)], "vec_id long, embedding array<float>")
    found = top_k(rows, F.col("vec_id") % 2 == 0, TopK(k=2, query_rows=4, vector_rows=4))
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("top", [0, 3, 2**15 - 1, 2**15, 2**31, 2**60])
def test_packed_numbers_stay_whole(top):
    data = np.array([[top, -top, 1], [0, -1, top]], np.float64)
    assert (_unpacked(_packed(data), 2, 3) == data).all()


def test_top_k_edges(spark):
    rows = [
        (0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (None, [1.0, 1.0]), (4, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (8, []), (9, []),
        (10, [1.0]), (11, [2.0]), (12, [1.0, 2.0, 3.0]), (13, [1e15, 1e15]), (14, [1e15, -1e15]), (3, [0.5, 0.5]), (3, [0.5, 0.5]), (0, [0.5, 2.0]), (5, [-1e-4, 0.0]),
    ]
    assert top(spark, rows) == plain_top([(i, [np.float32(x) for x in v] if v and None not in v else v) for i, v in rows], 10)
    assert top(spark, []) == [] and top(spark, [(2, [1.0])]) == []


def test_digest_is_base32_sha1(spark):
    from watchtide.llm.warc import _base32

    value = spark.range(1).select(_base32(F.unhex(F.sha1(F.lit("x").cast("binary")))).alias("d")).first().d
    assert value == base64.b32encode(hashlib.sha1(b"x").digest()).decode() and re.fullmatch("[A-Z2-7]{32}", value)
