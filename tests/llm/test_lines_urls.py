from __future__ import annotations

import random

from watchtide.llm.line_dedup import LineRule, LineRuns, dedup_lines
from watchtide.llm.url_filter import Reputation, Rule, host_reputation, url_verdicts
from watchtide.llm.queries import URL_RULES

BLANKS = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def plain(rows, shortest=10):
    owner = {}
    for doc, text in rows:
        for line in (text or "").split("\n") if doc is not None else []:
            owner[key(line)] = min(owner.get(key(line), doc), doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or len(key(x)) < shortest or owner[key(x)] == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def lines(spark, rows, rule=LineRule()):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = dedup_lines(df, rule).collect()
    return sorted([(r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in got], key=repr)


def test_line_edges(spark):
    rows = [
        (5, None), (6, ""), (7, "\n"), (1, "A line of text\n a LINE of text \nshort\nshort"), (2, "a line of text\nshort\n\x0ba line of text\r"),
        (3, "É line of text\né line of text"), (4, "é line of text"), (8, "\xa0a line of text"), (9, "a line of text" * 9000 + "\n" * 3000),
        (None, "a line of text"), (10, "a line of text\nown line here"), (10, "a line of text\nown line here"), (10, "own line here\nanother"),
        (11, "own line here\nß line of text\nss line of text"), (-4, "only here, twice\nonly here, twice"),
    ]
    assert lines(spark, rows) == plain(rows)
    assert lines(spark, []) == []


def test_random_lines_in_any_batches(spark):
    draw = random.Random(2)
    pool = [f"line number {i} of the pool" for i in range(40)] + ["tiny", ""]
    rows = [(i, "\n".join(draw.choice(pool) for _ in range(draw.randrange(12)))) for i in draw.sample(range(1000), 60)]
    for batches, fan_in in ((1, 2), (4, 3), (7, 2)):
        assert lines(spark, rows, LineRule(batches=batches, fan_in=fan_in)) == plain(rows)


def test_own_columns_give_way(spark):
    df = spark.createDataFrame([(1, "a", "mine", 2)], "doc_id long, text string, key string, n_lines int")
    got = dedup_lines(df)
    assert got.columns == ["doc_id", "text", "key", "n_lines", "n_dropped", "kept_text"] and got.first().key == "mine"


def test_runs_are_compacted(spark):
    runs = LineRuns(spark, fan_in=2)
    for i in range(5):
        batch = spark.createDataFrame([(bytes([k]), 10 * i) for k in range(i, i + 3)], "key binary, id long")
        shared = {(bytes(r.key), r.owner) for r in runs.add(batch).collect()}
        assert shared == ({(bytes([i]), max(0, 10 * (i - 2))), (bytes([i + 1]), 10 * (i - 1))} if i else set())
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    held = [(bytes(r.key), r.owner) for level in runs.levels for run in level for r in run.collect()]
    assert sorted(k for k, _ in held) == [bytes([k]) for k in range(7)]


def test_compacted_runs_are_read_without_a_shuffle(spark):
    runs = LineRuns(spark, fan_in=9)
    for i in range(2):
        runs.add(spark.createDataFrame([(bytes([i, k]), i) for k in range(50)], "key binary, id long"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = runs.levels[0][0].join(runs.levels[0][1].withColumnRenamed("owner", "o"), "key")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def judge(spark, urls, outcomes=(), rules=URL_RULES):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    bad = spark.createDataFrame(list(outcomes), "page_id long, bad int")
    return {r.page_id: r for r in url_verdicts(pages, bad, rules).collect()}


def test_hosts_paths_and_rules(spark):
    cases = {
        None: ("", "", None),
        "": ("", "", None),
        "no scheme.com/": ("", "", None),
        "http://COM/": ("com", "/", "com/"),
        "http://x.com": ("x.com", "", None),
        "https://A.example.com/en/1?x#y": ("a.example.com", "/en/1", "example.com/en/"),
        "https://www.Example.com/en/?/": ("www.example.com", "/en/", "www.example.com/en/"),
        "https://b.www.example.com/en/": ("b.www.example.com", "/en/", "www.example.com/en/"),
        "https://notexample.com/en/": ("notexample.com", "/en/", "com/"),
        "ftp://É.net/es/a://b": ("É.net", "/es/a://b", "net/es/"),
        "x://net/fr/": ("net", "/fr/", "net/fr/"),
        "x://net/FR/": ("net", "/FR/", None),
        "a\nb://h\n.net#/fr/": ("h\n.net", "", None),
        "://?": ("", "", None),
    }
    got = judge(spark, list(cases))
    assert [(got[i].host, got[i].path, got[i].rule) for i in range(len(cases))] == list(cases.values())
    assert got[5].verdict == "block" and got[6].verdict == "allow"
    assert judge(spark, []) == {} and judge(spark, ["http://a.com/"], rules=())[0].rule is None


def test_few_bad_pages_do_not_block_but_many_do(spark):
    urls = ["http://bad.org/"] * 200 + ["http://new.org/"] + ["http://fine.org/"] * 400 + ["http://unseen.org/"]
    got = judge(spark, urls, [(i, 1) for i in range(201)] + [(i, 0) for i in range(201, 601)] + [(0, 0), (None, 1), (5, None), (9999, 1)])
    assert {got[i].verdict for i in range(200)} == {"block"}
    assert {got[i].verdict for i in range(200, 602)} == {"allow"}
    assert got[0].n == 200 and got[601].n == 0 and got[601].low < got[601].mean


def test_reputation_without_outcomes(spark):
    pages = spark.createDataFrame([(1, "a.b.co.uk"), (2, "a.com"), (3, "")], "page_id long, host string")
    rows = host_reputation(pages, spark.createDataFrame([], "page_id long, bad int"), Reputation()).collect()
    assert {(r.host, r.n, round(r.mean, 6)) for r in rows} == {("a.b.co.uk", 0, 0.5), ("a.com", 0, 0.5), ("", 0, 0.5)}


def test_rules_are_plain_values():
    assert Rule("allow", "com", "/") in URL_RULES
