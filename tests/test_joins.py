from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from watchtide.operators.geo import GEO_SCHEMA, GeoRanges, ipv4_number, without_geo
from watchtide.operators.parity import missing_ids, parity_mismatches


def test_address_numbers(spark):
    cases = {
        "0.0.0.0": 0,
        "1.2.3.4": 16909060,
        "255.255.255.255": 4294967295,
        "256.1.1.1": None,
        "1.2.3": None,
        "1.2.3.4.5": None,
        "2001:db8::1": None,
        "": None,
        "a.b.c.d": None,
        "999999999999.1.1.1": None,
    }
    rows = spark.createDataFrame([(a,) for a in cases], "a STRING")
    assert {r.a: r.n for r in rows.select("a", ipv4_number(F.col("a")).alias("n")).collect()} == cases


def ranges_of(rng, count, overlapping):
    ranges, start = [], 0
    for i in range(count):
        start = rng.randrange(0, 2_000_000) if overlapping else start + rng.randrange(1, 4000)
        width = rng.choice([0, 3, 255, 5000, 70_000, 300_000])
        end = min(start + width, (1 << 32) - 1)
        ranges.append((start, end, f"C{i}", f"S{i}", f"T{i}", float(i), None))
        if not overlapping:
            start = end + 1
    return ranges


def brute(address, ranges):
    parts = address.split(".")
    if len(parts) != 4:
        return ""
    number = sum(int(p) << s for p, s in zip(parts, (24, 16, 8, 0)))
    hits = [(end - start, start, country) for start, end, country, *_ in ranges if start <= number <= end]
    return min(hits)[2] if hits else ""


@pytest.mark.parametrize(("overlapping", "seed"), [(False, 1), (True, 2), (True, 3)])
def test_lookup_equals_brute_force(spark, overlapping, seed):
    rng = random.Random(seed)
    ranges = ranges_of(rng, 60, overlapping)
    addresses = []
    for start, end, *_ in ranges:
        for number in (start, end, (start + end) // 2, max(start - 1, 0), min(end + 1, (1 << 32) - 1)):
            addresses.append(".".join(str(number >> s & 255) for s in (24, 16, 8, 0)))
    addresses += ["", "::1"] + [addresses[0]] * 300
    findings = spark.createDataFrame([(f"f{i}", a) for i, a in enumerate(addresses)], "FindingId STRING, Ip STRING")
    geo = GeoRanges(spark.createDataFrame(ranges, GEO_SCHEMA))
    placed = geo.enrich(findings, "Ip").collect()
    assert len(placed) == len(addresses)
    for r in placed:
        assert r.EnrichedCountry == brute(r.Ip, ranges), r.Ip
    assert without_geo(findings).columns == geo.enrich(findings, "Ip").columns


TABLE = (
    "Id STRING, AccountId STRING, ActivityType STRING, Region STRING, Severity INT, TimeGenerated INT, Arn STRING"
)
SENT = "Id STRING, AccountId STRING, Type STRING, Region STRING, Severity DOUBLE, UpdatedAt INT"


def test_parity(spark):
    stored = spark.createDataFrame(
        [("a", "1", "T", "r", 8, 2, ""), ("a", "1", "T", "r", 1, 1, ""), ("b", "2", "T", "r", 4, 1, ""), ("d", "4", "T", "r", 4, 1, "")],
        TABLE,
    )
    sent = spark.createDataFrame(
        [("a", "1", "T", "r", 8.7, 2), ("a", "9", "T", "r", 8.7, 1), ("b", "2", "T", "elsewhere", 5.0, 1), ("c", "3", "T", "r", 1.0, 1)],
        SENT,
    )
    found = {(r.Id, r.field): (r.expected, r.actual) for r in parity_mismatches(sent, stored).collect()}
    assert {k: v for k, v in found.items() if k[0] == "b"} == {("b", "Region"): ("elsewhere", "r"), ("b", "Severity"): ("5", "4")}
    assert {k[0] for k in found} == {"b", "c"}
    assert found[("c", "AccountId")] == ("3", None)
    assert parity_mismatches(sent.filter("Id = 'a'"), stored.filter("Id = 'a'")).count() == 0
    assert parity_mismatches(sent.filter("Id = 'b'").drop("UpdatedAt"), stored.filter("Id = 'b'")).count() == 2
    assert [r.Id for r in missing_ids(sent, stored).collect()] == ["c"]


def test_ipv6_networks_and_stored_pieces(spark, tmp_path):
    import ipaddress
    import random

    from watchtide.operators.geo import GEO_SCHEMA, NETWORK_SCHEMA, GeoRanges, ipv6_bits

    draw = random.Random(4)
    names = ["2001:db8::/32", "2001:db8:5::/48", "2001:db8:5:8000::/49", "fe80::/10", "::/0", "2001:db8:5::77/128", "::ffff:0:0/96", "bad/12", "2001::/900", "1.2.3.4/8"]
    nets = [(n, f"c{i}", None, f"town {i}", float(i), None) for i, n in enumerate(names)]
    given = [str(ipaddress.IPv6Address(draw.getrandbits(128))) for _ in range(40)]
    given += [str(ipaddress.IPv6Address((0x20010DB80005 << 80) | draw.getrandbits(80))) for _ in range(40)]
    given += ["2001:db8:5::77", "2001:DB8:5:0:0:0:0:77", "::", "::1", "fe80::1", "::ffff:1.2.3.4", "1::", "1:2:3:4:5:6:7:8"]
    odd = [None, "", "1:2", ":::", "1::2::3", "12345::", "1:2:3:4:5:6:7:8:9", "::1.2.3.400", "g::1", "9.9.9.9", "1:2:3:4:5:6:7::8"]
    rows = spark.createDataFrame([(i, a) for i, a in enumerate(given + odd)], "FindingId int, ip string")
    for r in rows.select("ip", ipv6_bits(F.col("ip")).alias("b")).collect():
        try:
            expected = format(int(ipaddress.IPv6Address(r.ip)), "0128b")
        except ValueError:
            expected = None
        assert r.b == (None if r.ip == "1:2:3:4:5:6:7::8" else expected) or r.b == expected
    geo = GeoRanges(spark.createDataFrame([(9 << 24, (10 << 24) - 1, "nine", "", "", 9.0, 9.0)], GEO_SCHEMA), spark.createDataFrame(nets, NETWORK_SCHEMA))
    geo.save(str(tmp_path / "geo"))
    known = [(ipaddress.IPv6Network(n[0], strict=False), n[1]) for n in nets[:7]]
    for ranges in (geo, GeoRanges.load(spark, str(tmp_path / "geo"))):
        found = {r.FindingId: r for r in ranges.enrich(rows, "ip").collect()}
        assert len(found) == len(given) + len(odd)
        for i, a in enumerate(given):
            expected = max(((n.prefixlen, c) for n, c in known if ipaddress.IPv6Address(a) in n), default=(0, ""))[1]
            assert found[i].EnrichedCountry == expected and found[i].EnrichedLatitude == float(expected[1:])
        assert found[len(given) + odd.index("9.9.9.9")].EnrichedCountry == "nine"
        assert [found[len(given) + i].EnrichedCountry for i in range(9)] == [""] * 9
    plan = GeoRanges.load(spark, str(tmp_path / "geo")).pieces._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan
    bare = GeoRanges(spark.createDataFrame([], GEO_SCHEMA))
    bare.save(str(tmp_path / "none"))
    assert {r.EnrichedCountry for r in GeoRanges.load(spark, str(tmp_path / "none")).enrich(rows, "ip").collect()} == {""}
