"""Locations of client addresses (I17): flatten nested ranges, then look addresses up as of their place.

A location table names ranges inside ranges (a country's block, a city's part of
it). ``flatten_ranges`` turns them into disjoint segments, each with the most specific range
over it, by one sweep per range partition: the ranges are spread by their start, and a
range that reaches into later partitions is copied to each of them, so every
partition holds all that is open at its start and is swept on its own. ``place_of`` then merges
the sorted segments and the sorted addresses: within a partition the last segment
that starts at or before an address is carried along, and an address
before the first segment of its partition takes the last one of the partitions before it.
Neither step has a key that a range or an address block could make hot.
"""

from __future__ import annotations

import datetime as dt
import heapq
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mooclens.session import stored_scratch

FAMILIES = {"4": 8, "6": 32}  # leading character of a key: hex digits that follow


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated, and written into the plan, once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def ip_to_number(ip) -> Column:
    """IPv4 address as a number; NULL unless four parts of 0 to 255."""
    def number(p):
        n = [F.get(p, F.lit(i)) for i in range(4)]
        ok = (F.size(p) == 4) & F.forall(p, lambda x: x.between(0, 255))
        return F.when(ok, ((n[0] * 256 + n[1]) * 256 + n[2]) * 256 + n[3])

    parts = F.split(ip if isinstance(ip, Column) else F.col(ip), r"\.")
    return _let(F.transform(parts, lambda x: x.try_cast("bigint")), number)


def ip_key(ip) -> Column:
    """An address as text that sorts like the address: ``4`` and 8 hex digits, or ``6`` and 32 (NULL: neither).

    ``::`` stands for as many zero groups as are missing; a dotted tail counts as two groups.
    """
    dotted = r"\d+\.\d+\.\d+\.\d+$"

    def grouped(c):
        """The text with a dotted tail as two groups."""
        groups = lambda n: F.concat_ws(":", F.lower(F.hex((n / 65536).cast("bigint"))), F.lower(F.hex(n % 65536)))
        tail = _let(ip_to_number(F.regexp_extract(c, f"({dotted})", 1)), lambda n: F.when(n.isNotNull(), groups(n)))
        return F.when(c.contains("."), F.concat(F.regexp_replace(c, dotted, ""), tail)).otherwise(c)

    def full(sides):
        """Eight groups, or NULL; ``sides``: the groups before and after the gap."""
        left, right = sides[0], F.coalesce(F.get(sides, F.lit(1)), F.array().cast("array<string>"))
        gap = F.lit(8) - F.size(left) - F.size(right)
        return F.when(F.size(sides) == 1, left).when((F.size(sides) == 2) & (gap >= 1), F.concat(left, F.array_repeat(F.lit("0"), gap), right))

    def sixth(groups):
        good = (F.size(groups) == 8) & F.forall(groups, lambda g: g.rlike("^[0-9a-f]{1,4}$"))
        return F.when(good, F.concat(F.lit("6"), F.array_join(F.transform(groups, lambda g: F.lpad(g, 4, "0")), "")))

    def key(c):
        sides = F.transform(F.split(grouped(c), "::"), lambda side: F.filter(F.split(side, ":"), lambda g: g != ""))
        v4 = _let(ip_to_number(c), lambda n: F.when(n.isNotNull(), F.concat(F.lit("4"), F.lpad(F.lower(F.hex(n)), 8, "0"))))
        return F.coalesce(v4, _let(_let(sides, full), sixth))

    return _let(F.lower(F.trim(ip if isinstance(ip, Column) else F.col(ip))), key)


def distinct_ips(log: DataFrame) -> DataFrame:
    """The distinct client addresses of a log (map-side de-duplicated)."""
    return log.where(F.col("ip").isNotNull() & (F.col("ip") != "")).select("ip").distinct()


# ------------------------------------------------------------------- flatten
def _text(number: int, family: str) -> str:
    return family + format(number, f"0{FAMILIES[family]}x")


def disjoint(ranges: list[tuple[str, str, int]], upto: str | None = None) -> Iterator[tuple[str, str, int]]:
    """Segments (first, last, id) of ranges in ascending order, each with the narrowest range over it
    (of equally wide ones the one that starts last); nothing from the key ``upto`` on."""
    active: list[tuple[int, int, int, int]] = []  # width, -start, end, id
    family, at, held = "", 0, None

    def until(x: int | None):
        """Segments up to but without ``x`` (None: to the end)."""
        nonlocal at, held
        while active and (x is None or at < x):
            width, start, end, rid = active[0]
            if end < at:
                heapq.heappop(active)
                continue
            last = end if x is None else min(end, x - 1)
            if held and held[2] == rid and held[1] == at - 1:
                held = (held[0], last, rid)
            else:
                if held:
                    yield held
                held = (at, last, rid)
            at = last + 1
        if x is not None:
            at = x

    def close():
        nonlocal held
        yield from until(None)
        if held:
            yield held
        held = None

    stop = int(upto[1:], 16) if upto else None
    for lo, hi, rid in sorted(ranges):
        a, b = int(lo[1:], 16), int(hi[1:], 16)
        if lo[0] != family:
            yield from ((_text(x, family), _text(y, family), r) for x, y, r in close())
            family, at = lo[0], a
        width = b - a
        if upto and upto[0] == family:
            b = min(b, stop - 1)
        yield from ((_text(x, family), _text(y, family), r) for x, y, r in until(a))
        heapq.heappush(active, (width, -a, b, rid))
    yield from ((_text(x, family), _text(y, family), r) for x, y, r in close())


def flatten_ranges(ranges: DataFrame) -> DataFrame:
    """Disjoint segments (lo, hi, rid) over ranges (lo, hi, rid) that may nest, overlap or touch.

    ``lo`` and ``hi`` are keys of ``ip_key``, both inclusive; no two ranges are equal."""
    spark = ranges.sparkSession
    spread = ranges.repartitionByRange("lo").withColumn("part", F.spark_partition_id())
    at = stored_scratch(spark, spread, "ranges")
    starts = [(r["part"], r["lo"]) for r in at.groupBy("part").agg(F.min("lo").alias("lo")).orderBy("lo").collect()]  # one row per partition
    if not starts:
        return ranges
    bounds = F.lit([lo for _, lo in starts])
    own = F.array_position(F.lit([p for p, _ in starts]), F.col("part")).cast("int") - 1
    at = at.withColumn("part", own)
    after = lambda n: F.get(bounds, F.col("part") + n)
    reach = F.filter(F.sequence(F.col("part") + 1, F.lit(len(starts) - 1)), lambda k: F.get(bounds, k) <= F.col("hi"))
    copies = at.where(after(1) <= F.col("hi")).withColumn("part", F.explode(reach))
    # the part of a range below its copy's partition does not matter there, but its width does
    every = at.unionByName(copies).withColumn("low", after(0)).withColumn("upto", after(1))

    def sweep(pdf):
        import pandas as pd
        low, upto = pdf["low"].iloc[0], pdf["upto"].iloc[0]
        found = [(max(lo, low), hi, rid) for lo, hi, rid in disjoint(list(zip(pdf["lo"], pdf["hi"], pdf["rid"])), upto) if hi >= low]
        return pd.DataFrame(found, columns=["lo", "hi", "rid"])

    return every.groupBy("part").applyInPandas(sweep, "lo string, hi string, rid long")


# ------------------------------------------------------------------- look up
def place_of(keys: DataFrame, segments: DataFrame) -> DataFrame:
    """(ip, rid) of every row of ``keys`` (ip, key) that lies in a segment (lo, hi, rid): an as-of merge."""
    spark = keys.sparkSession
    rows = segments.select(F.col("lo").alias("key"), F.lit(0).alias("kind"), F.lit(None).cast("string").alias("ip"), "hi", "rid").unionByName(
        keys.select("key", F.lit(1).alias("kind"), "ip", F.lit(None).cast("string").alias("hi"), F.lit(None).cast("long").alias("rid")))
    rows = rows.repartitionByRange("key", "kind").sortWithinPartitions("key", "kind").withColumn("part", F.spark_partition_id())

    texts = {c: object for c in ("ip", "key", "hi")}  # pandas' own text columns may reach Arrow in chunks, which Spark does not take

    def carry(batches):
        import pandas as pd
        last = (None, None)
        part = None
        for pdf in batches:
            if not len(pdf):
                continue
            part = int(pdf["part"].iloc[0])
            seen = pdf["kind"].eq(0)
            which = seen.cumsum()
            starts = pdf[seen]
            hi, rid = [last[0], *starts["hi"]], [last[1], *starts["rid"]]
            out = pdf.loc[~seen, ["part", "ip", "key"]].copy()
            out["hi"] = [hi[k] for k in which[~seen]]
            out["rid"] = pd.array([rid[k] for k in which[~seen]], dtype="Int64")
            last = (hi[-1], rid[-1])
            yield out.astype(texts)
        if part is not None:  # what the next partition starts with
            yield pd.DataFrame({"part": [part], "ip": [None], "key": [None], "hi": [last[0]], "rid": pd.array([last[1]], dtype="Int64")}).astype(texts)

    merged = stored_scratch(spark, rows.mapInPandas(carry, "part int, ip string, key string, hi string, rid long"), "merged")
    ends = merged.where(F.col("key").isNull()).select("part", F.when(F.col("rid").isNotNull(), F.struct("hi", "rid")).alias("end"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    ends = ends.select("part", F.last("end", ignorenulls=True).over(before).alias("end"))
    inside = merged.where(F.col("key").isNotNull() & F.col("rid").isNotNull()).select("ip", "key", "hi", "rid")
    first = merged.where(F.col("key").isNotNull() & F.col("rid").isNull()).join(ends, "part").select("ip", "key", "end.hi", "end.rid")
    return inside.unionByName(first).where(F.col("key") <= F.col("hi")).select("ip", "rid")


def geolocate_ips(ips: DataFrame, ip_ranges: DataFrame, un_regions: DataFrame | None = None, at: dt.datetime | None = None) -> DataFrame:
    """Address -> location, one row per address, IPv4 and IPv6 alike.

    The most specific range with the address decides; of equal ranges the least by
    their columns. Addresses in no range, or whose range names no country, are dropped, like
    texts that are no address. UN region attributes (one row per country) join on the ISO code. ``at`` is the time
    of the look-up (default: now).
    """
    place = F.struct(*[c for c in ip_ranges.columns if c not in ("start_ip", "end_ip")])
    spark = ips.sparkSession
    # keys are long expressions: stored, so that filters and sampling do not repeat them
    r = stored_scratch(spark, ip_ranges.select(place.alias("place"), ip_key("start_ip").alias("lo"), ip_key("end_ip").alias("hi")), "range-keys")
    r = r.where(F.col("lo").isNotNull() & (F.substring("lo", 1, 1) == F.substring("hi", 1, 1)) & (F.col("lo") <= F.col("hi")))
    r = stored_scratch(spark, r.groupBy("lo", "hi").agg(F.min("place").alias("place")).withColumn("rid", F.monotonically_increasing_id()), "places")
    keys = stored_scratch(spark, ips.select("ip").distinct().select("ip", ip_key("ip").alias("key")), "address-keys").where(F.col("key").isNotNull())
    found = place_of(keys, flatten_ranges(r.select("lo", "hi", "rid")))
    j = found.join(r.select("rid", "place"), "rid").select("ip", "place.*").where(F.col("country_iso").isNotNull() & F.col("country_name").isNotNull())
    out = j.select("ip", F.col("country_iso").alias("cc_by_ip"), F.col("country_iso").alias("country"), F.col("country_name").alias("countryLabel"),
                   "continent", "city", F.col("subdivision_iso").alias("region"), "subdivision", F.col("postal_code").alias("postalCode"), "latitude", "longitude",
                   (F.lit(at) if at else F.current_timestamp()).cast("timestamp").alias("timestamp"))
    if un_regions is not None:
        out = out.join(un_regions.withColumnRenamed("iso", "cc_by_ip"), "cc_by_ip", "left")
    return out
