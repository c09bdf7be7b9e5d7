"""Nested ranges against a search of all ranges, and the as-of look-up over many partitions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from mooclens.sources import geo as G


def key(n, family="4"):
    return family + format(n, f"0{G.FAMILIES[family]}x")


def best(ranges, n, family="4"):
    over = [(hi - lo, -lo, rid) for f, lo, hi, rid in ranges if f == family and lo <= n <= hi]
    return min(over)[2] if over else None


def made(rng, count, top):
    """Nested, overlapping and touching ranges without equal ones, of both families."""
    seen, out = set(), []
    while len(out) < count:
        lo = rng.randrange(top)
        hi = min(top - 1, lo + rng.choice([0, 1, 3, 15, 63, 255]))
        f = rng.choice("446")
        if (f, lo, hi) not in seen:
            seen.add((f, lo, hi))
            out.append((f, lo, hi, len(out)))
    return out


def test_sweep_equals_search():
    rng = random.Random(2)
    for _ in range(200):
        ranges = made(rng, rng.randint(1, 25), 120)
        segments = list(G.disjoint([(key(lo, f), key(hi, f), rid) for f, lo, hi, rid in ranges]))
        assert all(a[1] < b[0] for a, b in zip(segments, segments[1:]))
        for f in "46":
            for n in range(125):
                found = [rid for lo, hi, rid in segments if lo <= key(n, f) <= hi]
                assert (found or [None])[0] == best(ranges, n, f)


@pytest.mark.parametrize("partitions", ["1", "7", "40"])
def test_many_partitions(spark, partitions):
    """Ranges that reach over range partitions, partitions without a segment, addresses before the first one."""
    rng = random.Random(int(partitions))
    ranges = made(rng, 150, 4000) + [("4", 10, 3990, 1000), ("6", 0, 2000, 1001)]
    keep = {c: spark.conf.get(c, None) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        segments = G.flatten_ranges(spark.createDataFrame([(key(lo, f), key(hi, f), rid) for f, lo, hi, rid in ranges], "lo string, hi string, rid long"))
        asked = [(f"{f}{n}", key(n, f)) for f in "46" for n in rng.sample(range(4200), 900)]
        got = {r.ip: r.rid for r in G.place_of(spark.createDataFrame(asked, "ip string, key string"), segments).collect()}
    finally:
        for c, v in keep.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)
    assert got == {ip: b for ip, k in asked if (b := best(ranges, int(k[1:], 16), k[0])) is not None}


def test_one_row_per_address(spark):
    """The most specific range decides, also one without a country; equal ranges and repeated addresses give one row."""
    rows = [("10.0.0.0", "10.0.255.255", "AA"), ("10.0.1.0", "10.0.1.255", "BB"), ("10.0.2.0", "10.0.2.255", None), ("10.0.3.0", "10.0.3.255", "DD"),
            ("10.0.3.0", "10.0.3.255", "CC"), ("10.1.0.0", "10.0.0.0", "XX"), ("junk", "10.9.9.9", "XX"), ("2001::", "2001:ffff:ffff:ffff:ffff:ffff:ffff:ffff", "EE")]
    ranges = spark.createDataFrame(rows, "start_ip string, end_ip string, country_iso string")
    for c in ("country_name", "continent", "city", "subdivision_iso", "subdivision", "postal_code"):
        ranges = ranges.withColumn(c, F.col("country_iso"))
    ranges = ranges.withColumn("latitude", F.lit(0.0)).withColumn("longitude", F.lit(0.0))
    ips = spark.createDataFrame([(t,) for t in ("10.0.0.9", "10.0.1.7", "10.0.1.7", "10.0.2.1", "10.0.3.3", "10.1.0.0", "2001:1::", "x", None)], "ip string")
    out = G.geolocate_ips(ips, ranges, at=dt.datetime(2024, 1, 2)).collect()
    assert sorted((r.ip, r.country) for r in out) == [("10.0.0.9", "AA"), ("10.0.1.7", "BB"), ("10.0.3.3", "CC"), ("2001:1::", "EE")]
    assert {r.timestamp for r in out} == {dt.datetime(2024, 1, 2)}
    assert G.geolocate_ips(ips, ranges.limit(0)).count() == 0 and G.geolocate_ips(ips.limit(0), ranges).count() == 0
