from driver_checks import sources as S

SF = "/root/testdata/sf0.001"


def test_lines_are_made_after_events_are_dealt(spark):
    """The given file is one split: the copies of its events are made in as many tasks as there are files to write."""
    lines = S.export_lines(spark, SF, 6)
    assert lines.rdd.getNumPartitions() == 6
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("AS raw#") < plan.index("Repartition 6, true") < plan.index("Relation [event_id")
    assert lines.count() == S.given(spark, SF, "events").count()
    # Three narrow columns are shuffled, and no text is.
    dealt = plan[plan.index("Repartition 6, true") :].splitlines()[1]
    assert plan.count("Repartition") == 1 and "Project [event_id" in dealt and "value" not in dealt and "raw" not in dealt


def test_a_streamed_export_grows_in_lines_before_it_grows_in_files():
    """A stream takes a file or two per trigger, so its files hold 250,000 lines once there are 24; others keep 50,000."""
    assert [S.task_count(n, 4, streamed=True) for n in (1_000, 600_000, 2_400_000, 6_000_000, 36_000_000)] == [4, 12, 24, 24, 144]
    assert [S.task_count(n, 8) for n in (1_000, 600_000, 36_000_000)] == [8, 12, 720]


def test_the_bare_export_has_the_files_of_a_streamed_one(spark, monkeypatch):
    """Stores read it three or four files per trigger: with 50,000 lines a file a large export had 240 triggers."""
    for name, value in (("TASK_LINES", 10), ("LONGEST_FILE", 50), ("STREAMED", 12), ("_STORED", {})):
        monkeypatch.setattr(S, name, value)
    assert S.given(spark, SF, "events").count() == 1000
    read = spark.read.text(S.finding_export(spark, SF))
    assert len(read.inputFiles()) == 20 and read.count() == 1000


def test_an_export_is_packed_at_the_fastest_level(spark, tmp_path):
    """Less time to write, more bytes, the same rows."""
    lines = S.export_lines(spark, SF, 1)
    S._write_lines(lines, str(tmp_path / "fast"))
    lines.select("raw").write.option("compression", "gzip").text(str(tmp_path / "plain"))
    fast, plain = (sum(f.stat().st_size for f in (tmp_path / n).glob("*.gz")) for n in ("fast", "plain"))
    assert plain < fast
    read = [sorted(r.value for r in spark.read.text(str(tmp_path / n)).collect()) for n in ("fast", "plain")]
    assert read[0] == read[1] and len(read[0]) == S.given(spark, SF, "events").count()
