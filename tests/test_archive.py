from __future__ import annotations

import glob
from collections import Counter
from datetime import date, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import AS_OF, lines, table
from test_streams import copies
from watchtide.plans import sketches
from watchtide.sources.table import findings
from watchtide.storage import child_names, matching_paths
from watchtide.streaming.archive import DayArchive
from watchtide.streaming.commits import CommitLog
from watchtide.streaming.ingest import checked_events, write_micro_batch


def ingest(spark, path, batch, *documents):
    """A committed micro-batch, as the stream writes it."""
    write_micro_batch(checked_events(lines(spark, *documents)), batch, f"{path}/t", f"{path}/q")
    found = matching_paths(spark, f"{path}/t/GeneratedDate=*/ingest_batch={batch}")
    CommitLog(f"{path}/t").add(spark, batch, ["/".join(p.split("/")[-2:]) for p in found])


def arns(df):
    return Counter(r.Arn for r in df.select("Arn").collect())


def test_archived_days_lose_and_double_nothing(spark, finding, tmp_path):
    rows, path = copies(finding, 60, 4), str(tmp_path)
    for i in range(4):
        ingest(spark, path, i, *rows[i * 12 : (i + 1) * 12])
    store = DayArchive(f"{path}/t", f"{path}/a")
    live = arns(findings(spark, f"{path}/t"))
    assert arns(store.read(spark)) == live and sum(live.values()) == 48
    day = (AS_OF - timedelta(days=1)).date()
    done = store.compact(spark, day)
    assert done and all(date.fromisoformat(d) < day for d in done)
    assert arns(store.read(spark)) == live
    assert store.compact(spark, day) == []
    # Late rows of archived days are read from the live table, then taken in; a retried batch is no other batch.
    ingest(spark, path, 4, *rows[48:])
    ingest(spark, path, 4, *rows[48:])
    assert arns(store.read(spark)) == arns(findings(spark, f"{path}/t")) == arns(table(spark, *rows))
    assert store.compact(spark, day)
    assert arns(store.read(spark)) == arns(table(spark, *rows))
    for lookback in ("1d", "30h", "3d"):
        assert arns(store.read(spark, lookback, AS_OF)) == arns(findings(spark, f"{path}/t", lookback, AS_OF).filter(F.col("TimeGenerated") >= F.lit(AS_OF - (timedelta(hours=30) if lookback == "30h" else timedelta(days=int(lookback[0]))))))
    before = arns(store.read(spark))
    store.vacuum(spark)
    assert arns(store.read(spark)) == before and store.versions(spark) == [1]
    named = {s["folder"] for s in store.manifest(spark).values()}
    kept = {f"{v}/{d}" for v in child_names(spark, f"{path}/a") if v.startswith("version=") for d in child_names(spark, f"{path}/a/{v}") if "=" in d}
    assert kept == named


def test_a_day_is_sorted_and_has_filters(spark, finding, tmp_path):
    """Files of a day hold ranges of ids that do not meet, and a filter that tells which ids are not there."""
    path = str(tmp_path)
    rows = [{**finding, "id": f"id-{i:04d}", "updatedAt": "2025-03-10T08:00:00Z"} for i in range(400)]
    for i in range(2):
        ingest(spark, path, i, *rows[i::2])
    store = DayArchive(f"{path}/t", f"{path}/a", max_file_rows=100)
    assert store.compact(spark, date(2025, 3, 11)) == ["2025-03-10"]
    files = glob.glob(f"{path}/a/version=0/GeneratedDate=2025-03-10/*.parquet")
    ranges = []
    for name in files:
        ids = pq.read_table(name, columns=["Id"])["Id"].to_pylist()
        assert ids == sorted(ids) and len(ids) <= 100
        ranges.append((ids[0], ids[-1]))
    ranges.sort()
    assert len(ranges) >= 4 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    one = store.read(spark).filter("Id = 'id-0123'")
    assert one.count() == 1
    text = one._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(Id), EqualTo(Id,id-0123)]" in text


def test_empty_archives_and_bounds(spark, tmp_path):
    store = DayArchive(f"{tmp_path}/t", f"{tmp_path}/a")
    assert store.compact(spark, date(2025, 1, 1)) == [] and store.read(spark).count() == 0
    assert store.read(spark, "7d", AS_OF).count() == 0
    store.vacuum(spark)
    with pytest.raises(ValueError):
        DayArchive("t", "a", max_file_rows=0)


def test_sketches_count_over_days(spark, finding, tmp_path):
    rows = copies(finding, 300, 9)
    for i, row in enumerate(rows):
        row.update(id=f"f{i % 150}", type=f"Trojan:EC2/T{i % 9}")
    stored, path = table(spark, *rows), str(tmp_path / "s")
    sketches.write_sketches(stored, path)
    whole = sketches.distinct_counts(sketches.read_sketches(spark, path)).first()
    assert (whole.Records, whole.FindingTypes, whole.Accounts, whole.Regions) == (300, 9, 1, 1)
    assert abs(whole.Findings - 150) <= 3
    # A day that is written again replaces itself, and the range begins with a whole day.
    day = stored.filter("to_date(TimeGenerated) = '2025-03-18'")
    sketches.write_sketches(day, path)
    assert sketches.distinct_counts(sketches.read_sketches(spark, path)).first() == whole
    ranged = sketches.distinct_counts(sketches.read_sketches(spark, path), "1d", AS_OF).first()
    assert (ranged.Days, ranged.Records) == (1, day.count())
    none = sketches.distinct_counts(sketches.daily_sketches(stored.limit(0))).first()
    assert tuple(none) == (0, 0, 0, 0, 0, 0)
    blank = table(spark, finding, {**finding, "id": "", "region": ""}).withColumn("AccountId", F.lit(None).cast("string"))
    assert tuple(sketches.distinct_counts(sketches.daily_sketches(blank)).first()) == (1, 2, 2, 1, 0, 2)
    unknown = table(spark, {**finding, "updatedAt": "not a time"})
    assert sketches.daily_sketches(unknown).count() == 0
