from __future__ import annotations

import copy
import json
import random
import time
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF, envelope, table
from watchtide.operators.base import base_findings, stored_base
from watchtide.operators.newest import newest_per_key
from watchtide.sources.exports import stream_findings, unwrap_events
from watchtide.sources.table import FINDINGS, SPLIT_BYTES, findings, to_findings_table, write_findings
from watchtide.storage import child_names, remove_folder, rows_on_disk
from watchtide.streaming import monitors
from watchtide.streaming.commits import CommitLog
from watchtide.streaming.ingest import checked_events, drop_redeliveries, start_ingest, write_micro_batch
from watchtide.streaming.latest import LatestStore, start_latest
from watchtide.streaming.unique import UniqueStore, start_unique


@pytest.fixture
def folders(tmp_path):
    def folder(name):
        return str(tmp_path / name)

    (tmp_path / "in").mkdir()
    return folder


def drop_file(folders, name, *documents):
    text = "\n".join(d if isinstance(d, str) else json.dumps(d) for d in documents)
    with open(f"{folders('in')}/{name}.jsonl", "w") as f:
        f.write(text + "\n")


def copies(finding, count, seed):
    rng = random.Random(seed)
    out = []
    for i in range(count):
        other = copy.deepcopy(finding)
        minutes = rng.randrange(0, 5000)
        moment = (AS_OF - timedelta(minutes=minutes)).strftime("%Y-%m-%dT%H:%M:%SZ")
        other.update(id=f"f{rng.randrange(12)}", updatedAt=moment, severity=rng.randrange(11), arn=f"arn:{seed}:{i}")
        out.append(other)
    return out


def test_ingest_is_exactly_once_over_restarts_and_retries(spark, finding, folders):
    good, bad = copies(finding, 20, 1), ["{cut", envelope([]), {**finding, "severity": "9"}]
    drop_file(folders, "one", *good[:10], *bad)
    lines = stream_findings(spark, folders("in"), glob="*.jsonl", max_files=1)
    start_ingest(lines, folders("t"), folders("q"), folders("cp")).awaitTermination()
    drop_file(folders, "two", envelope(good[10]), {"findings": good[11:]})
    start_ingest(lines, folders("t"), folders("q"), folders("cp")).awaitTermination()
    assert findings(spark, folders("t")).count() == 20
    assert spark.read.parquet(folders("q")).count() == 3
    # A retry of a micro-batch replaces what its first attempt wrote.
    again = checked_events(stream_free(spark, folders, "two"))
    write_micro_batch(again, 1, folders("t"), folders("q"))
    assert findings(spark, folders("t")).count() == 20
    assert findings(spark, folders("t")).columns == FINDINGS.names


def stream_free(spark, folders, name):
    from watchtide.sources.exports import read_findings

    return read_findings(spark, f"{folders('in')}/{name}.jsonl")


def test_redeliveries_are_dropped_once(spark, finding, folders):
    rows = copies(finding, 30, 2)
    drop_file(folders, "one", *rows, *rows)
    drop_file(folders, "two", *rows)
    lines = stream_findings(spark, folders("in"), glob="*.jsonl", max_bytes=1000)
    unique = drop_redeliveries(to_findings_table(unwrap_events(lines)), "30 days", salts=3)
    query = (
        unique.select("Id", "TimeGenerated", "Arn")
        .writeStream.format("parquet")
        .option("path", folders("out"))
        .option("checkpointLocation", folders("cp"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    found = [(r.Id, str(r.TimeGenerated)) for r in spark.read.parquet(folders("out")).collect()]
    assert sorted(found) == sorted({(r["id"], r["updatedAt"].replace("T", " ").rstrip("Z")) for r in rows})


def test_unique_store_keeps_late_copies_and_drops_every_redelivery(spark, finding, folders):
    rows = copies(finding, 40, 2)
    # One far-off time moves no watermark: what comes after it, however old, is kept.
    far = {**finding, "id": "far", "updatedAt": "2031-01-01T00:00:00Z", "arn": "far"}
    untimed = {**finding, "id": "none", "arn": "none"}
    untimed.pop("updatedAt")
    store = UniqueStore(folders("unique"))
    assert store.read(spark).count() == 0
    for name, documents in (("one", [far, *rows[:25]]), ("two", [*rows, untimed, far, untimed]), ("three", [*rows, untimed])):
        drop_file(folders, name, *documents)
        lines = stream_findings(spark, folders("in"), glob="*.jsonl", max_files=1)
        start_unique(to_findings_table(unwrap_events(lines)), store, folders("cp")).awaitTermination()
    expected = sorted({(r["id"], r["updatedAt"].replace("T", " ").rstrip("Z")) for r in [*rows, far]})
    found = store.read(spark).select("Id", F.col("TimeGenerated").cast("string"), "Arn").collect()
    assert sorted((r.Id, r[1]) for r in found if r[1]) == expected
    assert [r.Arn for r in found if not r[1]] == ["none"]
    assert store.read(spark).columns == FINDINGS.names
    # A batch that is committed is left alone; one that was cut off before its commit is written anew.
    store.add(table(spark, *rows), 0)
    assert store.read(spark).count() == len(expected) + 1
    remove_folder(spark, f"{store.log.path}/{2:012d}.json")
    store.add(table(spark, *rows, untimed), 2)
    assert store.read(spark).count() == len(expected) + 1


def test_unique_store_reads_the_days_of_the_batch_only(spark, finding, folders, monkeypatch):
    asked = []
    known = UniqueStore._known
    monkeypatch.setattr(UniqueStore, "_known", lambda self, spark, days: asked.append(sorted(days)) or known(self, spark, days))
    store = UniqueStore(folders("unique"))
    for n, day in enumerate(("01", "02", "02")):
        store.add(table(spark, {**finding, "updatedAt": f"2025-03-{day}T10:00:00Z"}), n)
    assert asked == [["2025-03-01"], ["2025-03-02"], ["2025-03-02"]] and store.read(spark).count() == 2


def test_unique_store_maps_a_batch_once_and_keeps_few_key_folders(spark, finding, folders, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(value):
        seen.add(1)
        return value

    monkeypatch.setattr("watchtide.streaming.unique._OPEN_BATCHES", 3)
    rows = [{**finding, "id": f"u{i}", "arn": f"a{i}", "updatedAt": f"2025-03-0{1 + i % 2}T10:00:00Z"} for i in range(40)]
    store = UniqueStore(folders("unique"))
    for n in range(8):
        batch = table(spark, *rows[max(n * 5 - 5, 0) : n * 5 + 5], *rows[:2])
        store.add(batch.withColumn("Id", counted("Id")) if n == 0 else batch, n)
    assert seen.value == 7
    assert sorted(r.Arn for r in store.read(spark).collect()) == sorted(r["arn"] for r in rows)
    for day in ("2025-03-01", "2025-03-02"):
        assert child_names(spark, f"{store.path}/keys/KeyDate={day}") == ["batch=6", "batch=7", "upto=5"]


def newest(spark, rows):
    return {r.Id: r.Arn for r in newest_per_key(table(spark, *rows)).collect()}


def test_latest_store_equals_the_batch_view(spark, finding, folders):
    rows = copies(finding, 120, 3)
    store = LatestStore(folders("latest"), compact_every=3, buckets=5)
    assert store.read(spark).count() == 0 and store.versions(spark) == []
    for i in range(8):
        drop_file(folders, f"part{i}", *rows[i * 15 : (i + 1) * 15])
    lines = stream_findings(spark, folders("in"), glob="*.jsonl", max_files=1)
    stream = to_findings_table(unwrap_events(lines))
    start_latest(stream, store, folders("cp")).awaitTermination()
    assert {r.Id: r.Arn for r in store.read(spark).collect()} == newest(spark, rows)
    assert store.read(spark).columns == FINDINGS.names
    store.vacuum(spark, keep=1)
    assert store.versions(spark) == [7]
    assert {r.Id: r.Arn for r in store.read(spark).collect()} == newest(spark, rows)
    for bad in ({"compact_every": 0}, {"buckets": 0}):
        with pytest.raises(ValueError, match="positive"):
            LatestStore("x", **bad)


def test_equal_time_copies_have_one_winner(spark, finding, folders):
    """Copies that differ in title or documents alone: the same one in any partitioning, stored, streamed or not."""
    rows = []
    for n in range(40):
        for k in range(5):
            one = {**copy.deepcopy(finding), "id": f"f{n}", "title": f"title {n} {k}" if n % 2 else "same"}
            one["service"]["count"] = k
            rows.append(one)
    winners = []
    for parts in (1, 3, 8):
        dealt = table(spark, *rows).repartition(parts, F.rand(parts))
        write_findings(dealt, folders(f"t{parts}"))
        view = stored_base(spark, folders(f"t{parts}"), "30d", datetime(2025, 3, 20, tzinfo=timezone.utc))
        winners.append({r.FindingId: r.RawJson for r in view.select("FindingId", "RawJson").collect()})
    assert winners[0] == winners[1] == winners[2] and len(winners[0]) == 40
    store = LatestStore(folders("latest"), compact_every=2, buckets=3)
    shuffled = [rows[i * 37 % 200] for i in range(200)]
    for batch in range(4):
        store.merge(table(spark, *shuffled[batch * 50 : batch * 50 + 50]), batch)
    view = base_findings(store.read(spark), "30d", datetime(2025, 3, 20, tzinfo=timezone.utc)).select("FindingId", "RawJson")
    assert {r.FindingId: r.RawJson for r in view.collect()} == winners[0]


def test_latest_store_takes_a_batch_once(spark, finding, folders):
    rows = copies(finding, 60, 5)
    store = LatestStore(folders("latest"), compact_every=2, buckets=3)
    for n in range(4):
        batch = table(spark, *rows[n * 15 : n * 15 + 15])
        store.merge(batch, n)
        store.merge(batch, n)
    assert {r.Id: r.Arn for r in store.read(spark).collect()} == newest(spark, rows)
    with pytest.raises(ValueError, match="other rows"):
        store.merge(table(spark, *rows[:3]), 3)
    store.merge(table(spark), 4)
    assert {r.Id: r.Arn for r in store.read(spark).collect()} == newest(spark, rows)
    # A batch that was cut off before its manifest is written anew.
    remove_folder(spark, f"{store.path}/manifest/{4:012d}.json")
    store.merge(table(spark, *rows[15:30]), 4)
    assert {r.Id: r.Arn for r in store.read(spark).collect()} == newest(spark, rows)


def test_latest_store_rewrites_a_copy_as_often_as_batches_can_be_halved(spark, finding, folders, monkeypatch):
    written, write = [], LatestStore._write
    monkeypatch.setattr(LatestStore, "_write", lambda self, rows, folder: written.append((folder, rows.count())) or write(self, rows, folder))
    store = LatestStore(folders("latest"), compact_every=2, buckets=1)
    rows = [{**finding, "id": f"n{i}", "arn": f"a{i}"} for i in range(16)]
    rows[15] = {**rows[15], "id": "n0", "updatedAt": "2025-04-01T00:00:00Z", "arn": "later"}
    for n, row in enumerate(rows[:14]):
        store.merge(table(spark, row), n)
    assert [deltas for _, deltas in store.manifest(spark)["buckets"]["0"]["base"]] == [8, 4, 2]
    assert {r.Arn for r in store.read(spark).collect()} == {f"a{i}" for i in range(14)}
    for n, row in enumerate(rows[14:]):
        store.merge(table(spark, row), 14 + n)
    # 2, 4, 2, 8, 2, 4, 2, and all 15 ids: with the whole bucket at every compaction it would be 71.
    assert sum(count for folder, count in written if folder.startswith("base")) == 39
    assert {r.Id: r.Arn for r in store.read(spark).collect()} == {f"n{i}": f"a{i}" for i in range(1, 15)} | {"n0": "later"}


def test_rows_on_disk_are_one_column_and_computed_once(spark, finding):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(value):
        seen.add(1)
        return value

    rows = table(spark, *copies(finding, 7, 3)).withColumn("Arn", counted("Arn"))
    with rows_on_disk(rows) as kept:
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "InMemoryTableScan [row#" in plan and kept.schema == rows.schema
        assert kept.count() == 7 and {r.Arn for r in kept.collect()} == {f"arn:3:{i}" for i in range(7)}
    assert seen.value == 7


def test_latest_store_is_read_in_small_splits(spark, finding, folders):
    store = LatestStore(folders("latest"), compact_every=2, buckets=1)
    store.merge(table(spark, finding), 0)
    fresh = spark.newSession()
    assert store.read(fresh).count() == 1 and int(fresh.conf.get("spark.sql.files.maxPartitionBytes")) == SPLIT_BYTES


def test_latest_store_shreds_runs_and_leaves_deltas_whole(spark, finding, folders):
    store = LatestStore(folders("latest"), compact_every=2, buckets=1)
    rows = [{**finding, "id": f"n{i}", "arn": f"a{i}"} for i in range(5)]
    option = "spark.sql.variant.writeShredding.enabled"
    before = spark.conf.get(option)
    for n in range(3):
        store.merge(table(spark, *rows[n : n + 3]), n)
    assert spark.conf.get(option) == before
    (bucket,) = store.manifest(spark)["buckets"].values()
    (run, _), (delta,) = *bucket["base"], bucket["open"]
    shredded = [b"typed_value" in next(Path(f"{store.path}/{f}").glob("*.parquet")).read_bytes() for f in (run, delta)]
    assert shredded == [True, False]
    whole = spark.read.schema(FINDINGS).parquet(f"{store.path}/{run}", f"{store.path}/{delta}")
    assert {r[0] for r in whole.select(F.to_json("ServiceDetails")).collect()} == {r[0] for r in table(spark, finding).select(F.to_json("ServiceDetails")).collect()}
    assert {r.Id: r.Arn for r in store.read(spark).collect()} == {f"n{i}": f"a{i}" for i in range(5)}


def test_latest_store_rewrites_and_shuffles_open_buckets_only(spark, finding, folders):
    store = LatestStore(folders("latest"), compact_every=2, buckets=8)
    rows = [{**finding, "id": f"n{i}", "arn": f"a{i}"} for i in range(60)]
    store.merge(table(spark, *rows), 0)
    store.merge(table(spark, *rows), 1)
    state = store.manifest(spark)["buckets"]
    assert len(state) == 8 and all(s["base"] and not s["open"] for s in state.values())
    plan = lambda: store.read(spark)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan() and store.read(spark).count() == 60
    later = {**rows[0], "updatedAt": "2025-04-01T00:00:00Z", "arn": "later"}
    store.merge(table(spark, later), 2)
    after = store.manifest(spark)["buckets"]
    changed = [b for b in state if state[b] != after[b]]
    assert len(changed) == 1 and "Exchange" in plan()
    store.merge(table(spark, later), 3)
    compacted = store.manifest(spark)["buckets"]
    assert [b for b in state if state[b] != compacted[b]] == changed and not compacted[changed[0]]["open"]
    assert {r.Id: r.Arn for r in store.read(spark).collect()} == {f"n{i}": f"a{i}" for i in range(60)} | {"n0": "later"}


def test_retried_ingest_batches_alert_and_count_once(spark, finding, folders):
    rows = copies(finding, 40, 6)
    for r in rows[::4]:
        r["severity"] = 8.5
    drop_file(folders, "one", *rows[:20])
    lines = stream_findings(spark, folders("in"), glob="*.jsonl", max_files=1)

    def run():
        start_ingest(lines, folders("t"), folders("q"), folders("cp")).awaitTermination()
        monitors.start_urgent(spark, folders("t"), folders("alerts"), folders("cp1")).awaitTermination()
        monitors.start_hourly(spark, folders("t"), folders("counts"), folders("cp2")).awaitTermination()

    run()
    # The files of batch 0 are replaced by others of the same rows, as a retry does, and batch 1 follows.
    write_micro_batch(checked_events(stream_free(spark, folders, "one")), 0, folders("t"), folders("q"))
    drop_file(folders, "two", *rows[20:], "{cut")
    run()
    run()
    log = CommitLog(folders("t"))
    assert log.batches(spark) == [0, 1] and all(log.folders(spark, n) for n in (0, 1))
    alerts = spark.read.option("recursiveFileLookup", "true").parquet(folders("alerts"))
    stored = table(spark, *rows)
    expected = monitors.urgent_stream(stored)
    assert sorted(map(tuple, alerts.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)
    totals = monitors.hourly_totals(spark, folders("counts"))
    whole = monitors.partial_counts(stored)
    assert sorted(map(tuple, totals.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    assert totals.agg(F.sum("Findings")).first()[0] == 40


def test_late_hours_and_missing_times_are_counted(spark, finding, folders):
    assert monitors.hourly_totals(spark, folders("counts")).collect() == []
    times = ["2031-01-01T00:00:00Z", "2025-03-18T05:10:00Z", "2019-02-03T04:59:59Z", "2025-03-18T05:50:00Z"]
    for n, time_ in enumerate(times):
        drop_file(folders, f"part{n}", {**finding, "id": f"f{n}", "createdAt": time_})
        lines = stream_findings(spark, folders("in"), glob="*.jsonl", max_files=1)
        start_ingest(lines, folders("t"), folders("q"), folders("cp")).awaitTermination()
        monitors.start_hourly(spark, folders("t"), folders("counts"), folders("cp2")).awaitTermination()
    found = {str(r.Hour): r.Findings for r in monitors.hourly_totals(spark, folders("counts")).collect()}
    assert found == {"2031-01-01 00:00:00": 1, "2025-03-18 05:00:00": 2, "2019-02-03 04:00:00": 1}
    bare = table(spark, finding).withColumns({"TimeCreated": F.lit(None).cast("timestamp"), "TimeGenerated": F.lit(None).cast("timestamp")})
    assert [(r.Hour, r.Findings) for r in monitors.partial_counts(bare).collect()] == [(None, 1)]


def test_urgent_and_hourly_streams(spark, finding, folders):
    rows = copies(finding, 60, 4)
    write_findings(table(spark, *rows), folders("t"))
    stored = findings(spark, folders("t"))
    query = (
        monitors.urgent_stream(monitors.stream_table(spark, folders("t"), max_files=2))
        .writeStream.format("parquet")
        .option("path", folders("urgent"))
        .option("checkpointLocation", folders("cp1"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    alerts = spark.read.parquet(folders("urgent"))
    assert alerts.count() == stored.filter("Severity >= 7").count()
    assert {r.SeverityLevel for r in alerts.collect()} == {"High", "Critical"}
    query = (
        monitors.hourly_counts(monitors.stream_table(spark, folders("t")), "1 hour")
        .writeStream.format("memory")
        .queryName("hourly")
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert spark.table("hourly").agg(F.sum("Findings")).first()[0] == 60


def test_monitor_reports_while_findings_are_silent(spark, finding, folders):
    write_findings(table(spark, finding), folders("t"))
    later = AS_OF + timedelta(days=1)
    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    reader = monitors.table_reader(spark, folders("t"), "2d", later)
    query = monitors.start_monitor(clock, reader, folders("alerts"), folders("cp"), later, {"processingTime": "1 second"})
    for _ in range(60):
        if query.lastProgress and query.lastProgress["batchId"] >= 1:
            break
        time.sleep(0.5)
    query.stop()
    report = spark.read.option("recursiveFileLookup", "true").parquet(folders("alerts"))
    assert {(r.HealthStatus, r.LagStatus) for r in report.collect()} == {
        ("No recent data - check connector", "No data - check KMS permissions")
    }
