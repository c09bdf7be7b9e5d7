"""Window operators that stay balanced when one key holds a large share of rows.

``previous_values`` is the workhorse of the time-on-task style reports: for every
row, the last non-null value of some expressions over the earlier rows of its
partition (``lag`` is the case of an always-non-null expression).  A plain
``Window.partitionBy(course_id, username)`` sends all of one user's events to
one task; a bot or a load-test account can own a large share of a log.  Here the
window runs on ``keys + [bucket]`` (an hour of time by default), and the value
carried into each bucket from the earlier ones comes from a per-bucket summary
table (one row per key and hour).  The window's rows are stored in
the shared folder, apart by whether they still lack a value: only those that do (the first of
a kind in their key and hour) are joined with the summary, all others never move again.  So the log
is scanned, its expressions evaluated and its rows shuffled once.  Result is identical to the unsplit window.
``before`` carries values in from rows that are not there at all (earlier days).

Keys with few rows gain nothing from that: most of their rows are the first of their hour and take the second path.
``previous_parts`` counts rows by hash cells of the keys first; only keys in cells of more than ``HEAVY`` rows are
split by bucket, all others take the plain window, into which ``before`` comes as one more row per key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mooclens.session import scratch_path, shuffles_end

# Width of the sub-partitions of a key; None runs the plain (unsplit) window.
DEFAULT_BUCKET = "hour"

# Keys are counted in this many cells, whatever their number; a task sorts whole keys of cells up to HEAVY rows.
CELLS = 1 << 16
HEAVY = 200_000


def time_bucket(time_col: str = "time", unit: str | None = DEFAULT_BUCKET) -> Column | None:
    return None if unit is None else F.date_trunc(unit, F.col(time_col))


def previous_values(df: DataFrame, keys: list[str], order: list[str], values: dict[str, Column],
                    bucket: Column | None = None, monotone: bool = False, needed: dict[str, Column] | None = None,
                    before: DataFrame | None = None) -> DataFrame:
    """Add one column per ``values`` entry: the last non-null value of that
    expression among the rows strictly before the current one in its ``keys``
    partition, ordered by ``order`` (which must be unique within a partition).

    ``bucket`` must be monotone in ``order`` (e.g. the hour of the ordering
    time).  Keys must be non-null (callers filter them).

    ``needed`` names rows that want a value at all (default: every row); others get NULL.
    ``before``: ``keys`` and one column per value, the last value of each key before its first row here.

    ``monotone=True`` declares that every value, where non-null, never
    decreases along ``order`` (e.g. ``lag(time)`` ordered by time): the last
    value of a bucket is then its ``max``, a hash aggregate, instead of a
    ``max(struct(order, value))`` that needs a sort-based aggregate.
    """
    names = list(values)
    want = {n: (needed or {}).get(n, F.lit(True)) for n in names}
    if bucket is None:
        bucket = F.lit(0)

    b = "_pv_bucket"
    tmp = {n: f"_pv_{i}" for i, n in enumerate(names)}
    x = df.withColumn(b, bucket).select("*", *[values[n].alias(tmp[n] + "_v") for n in names])

    # in-bucket running values, stored: the bucket summary and the join below read them
    w = Window.partitionBy(*keys, b).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    x = x.select("*", *[F.last(tmp[n] + "_v", ignorenulls=True).over(w).alias(tmp[n] + "_w") for n in names])
    lacks = reduce(lambda p, q: p | q, [F.coalesce(want[n], F.lit(False)) & F.col(tmp[n] + "_w").isNull() for n in names])
    x = x.select(*df.columns, b, *[tmp[n] + "_v" for n in names], *[F.when(want[n], F.col(tmp[n] + "_w")).alias(tmp[n] + "_w") for n in names], lacks.alias("_pv_lacks"))
    path = scratch_path(df.sparkSession, "window")
    with shuffles_end(df.sparkSession):
        x.write.option("compression", "zstd").partitionBy("_pv_lacks").parquet(path)
    x = df.sparkSession.read.schema(x.schema).parquet(path)

    # last non-null value of each expression inside each (keys, bucket)
    ordkey = F.struct(*[F.col(o) for o in order])
    if monotone:
        lasts = [F.max(tmp[n] + "_v").alias(tmp[n] + "_b") for n in names]
    else:
        lasts = [F.max(F.when(F.col(tmp[n] + "_v").isNotNull(),
                              F.struct(ordkey.alias("o"), F.col(tmp[n] + "_v").alias("v"))))
                 .getField("v").alias(tmp[n] + "_b") for n in names]
    last_in_bucket = x.groupBy(*keys, b).agg(*lasts)
    wb = Window.partitionBy(*keys).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    carry = last_in_bucket.select(*keys, b, *[
        F.last(tmp[n] + "_b", ignorenulls=True).over(wb).alias(tmp[n] + "_c") for n in names])
    if before is not None:
        early = before.select(*keys, *[F.col(n).alias(tmp[n] + "_e") for n in names])
        carry = carry.join(early, keys, "left").select(*keys, b, *[F.coalesce(tmp[n] + "_c", tmp[n] + "_e").alias(tmp[n] + "_c") for n in names])
    done = x.where("not _pv_lacks").select(*df.columns, *[F.col(tmp[n] + "_w").alias(n) for n in names])
    rest = x.where("_pv_lacks").join(carry, keys + [b], "left")
    rest = rest.select(*df.columns, *[F.coalesce(F.col(tmp[n] + "_w"), F.when(want[n], F.col(tmp[n] + "_c"))).alias(n) for n in names])
    return done.unionByName(rest)


def previous_parts(df: DataFrame, keys: list[str], order: list[str], values: dict[str, Column], bucket: Column | None = None, monotone: bool = False,
                   needed: dict[str, Column] | None = None, before: DataFrame | None = None) -> list[DataFrame]:
    """``previous_values`` in parts that have no key in common; ``df`` is read once more to count.

    The rows of the first part are partitioned by ``keys``, so that an aggregate by them (and more) needs no shuffle.
    """
    if bucket is None:
        return [previous_values(df, keys, order, values, None, monotone, needed, before)]
    no_null = reduce(lambda p, q: p & q, [F.col(k).isNotNull() for k in keys])
    cell = F.when(no_null, F.pmod(F.xxhash64(*keys), F.lit(CELLS)).cast("int")).otherwise(-1)
    n = F.count(F.lit(1))
    heavy = [r[0] for r in df.groupBy(cell.alias("cell")).agg(n.alias("n")).where((F.col("n") > HEAVY) | (F.col("cell") < 0)).select("cell").collect()]
    if not heavy:
        return [_whole_keys(df, keys, order, values, bucket, needed, before)]
    quiet = _whole_keys(df.where(~cell.isin(heavy)), keys, order, values, bucket, needed, before if before is None else before.where(~cell.isin(heavy)))
    return [quiet, previous_values(df.where(cell.isin(heavy)), keys, order, values, bucket, monotone, needed, before)]


def _whole_keys(df: DataFrame, keys: list[str], order: list[str], values: dict[str, Column], bucket: Column, needed: dict[str, Column] | None,
                before: DataFrame | None) -> DataFrame:
    """``previous_values`` by a plain window; rows without a bucket come first and do not see ``before``."""
    place, names = "_pv_place", list(values)
    x = df.select("*", F.when(bucket.isNull(), 0).otherwise(2).alias(place), *[values[n].alias(f"_pv_{i}") for i, n in enumerate(names)])
    if before is not None:
        early = before.select(*keys, F.lit(1).alias(place), *[F.col(n).alias(f"_pv_{i}") for i, n in enumerate(names)])
        x = x.unionByName(early, allowMissingColumns=True)
    # sorted by a number first: keys are compared only where it is equal
    w = Window.partitionBy("_pv_hash", *keys).orderBy(place, *order).rowsBetween(Window.unboundedPreceding, -1)
    x = x.repartition(*keys).withColumn("_pv_hash", F.xxhash64(*keys))
    x = x.select("*", *[F.last(f"_pv_{i}", ignorenulls=True).over(w).alias(n) for i, n in enumerate(names)]).where(F.col(place) != 1)
    return x.select(*df.columns, *[F.when(needed[n], F.col(n)).alias(n) if n in (needed or {}) else n for n in names])


def last_values(df: DataFrame, keys: list[str], order: list[str], values: dict[str, Column], monotone: bool = False) -> DataFrame:
    """Per ``keys`` the last non-null value of each expression, as a column that ``max`` merges with
    those of later rows: the value itself if it is monotone, else (order, value)."""
    place = F.struct(*order)
    kept = {n: v if monotone else F.when(v.isNotNull(), F.struct(place.alias("o"), v.alias("v"))) for n, v in values.items()}
    return df.groupBy(*keys).agg(*[F.max(v).alias(n) for n, v in kept.items()])


def lag_wrapped(cols: dict[str, str]) -> dict[str, Column]:
    return {f"_lag_{n}": F.struct(F.col(c).alias("v"), F.lit(1).alias("p")) for n, c in cols.items()}


def lag_values(df: DataFrame, keys: list[str], order: list[str], cols: dict[str, str],
               bucket: Column | None = None, before: DataFrame | None = None) -> DataFrame:
    """``lag(col, 1)`` for possibly-null columns: the previous row's value.

    Wrapped in a struct so a NULL value of the previous row is carried as
    such instead of being skipped.  ``before`` has the columns of ``lag_wrapped``.
    """
    x = previous_values(df, keys, order, lag_wrapped(cols), bucket, before=before)
    return x.select(*df.columns, *[F.col(f"_lag_{n}").getField("v").alias(n) for n in cols])


def top1(df: DataFrame, keys: list[str], rank_desc: str, tie_asc: list[str], carry: list[str],
         count_as: str | None = None) -> DataFrame:
    """Row with the largest ``rank_desc`` per key (ties: smallest ``tie_asc``).

    Written as a ``min(struct)`` aggregate instead of ``row_number() == 1`` so
    it combines map-side: a key with millions of candidate rows costs one
    partial aggregate per task, not one sorted partition.
    """
    best = F.min(F.struct((-F.col(rank_desc)).alias("_neg"), *[F.col(c) for c in tie_asc],
                          *[F.col(c) for c in carry if c not in tie_asc])).alias("_best")
    aggs = [best]
    if count_as:
        aggs.append(F.count(F.lit(1)).alias(count_as))
    out = df.groupBy(*keys).agg(*aggs)
    fields = [(-F.col("_best._neg")).alias(rank_desc)] + [F.col(f"_best.{c}").alias(c) for c in tie_asc] + \
             [F.col(f"_best.{c}").alias(c) for c in carry if c not in tie_asc]
    return out.select(*keys, *fields, *([count_as] if count_as else []))
