"""Table upkeep: schema-driven loads, keyed upserts, existence checks (M1, M2, M6)."""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mooclens.session import delete_path, list_folder, move_path, path_exists, read_text, settle_folder, stored_scratch, swap_folder, write_text


class BadRowsError(ValueError):
    """More rows failed to parse than the load allows."""


def read_json_lines(lines: DataFrame, schema: T.StructType, text_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """M1 core: parse JSON lines against a declared schema.

    Keys outside the schema are ignored; a value that does not fit its field
    becomes NULL; a line that is not a JSON object is a bad row.  Returns
    ``(rows, bad_rows)``.
    """
    txt = F.col(text_col)
    is_obj = F.try_parse_json(txt).isNotNull() & F.ltrim(txt).startswith("{") & F.rtrim(txt).endswith("}")
    x = lines.select("*", is_obj.alias("_ok"))
    bad = x.where(~F.col("_ok")).select(txt.alias("data"))
    keep = [c for c in lines.columns if c != text_col]
    rows = (x.where(F.col("_ok")).select(*keep, F.from_json(txt, schema).alias("_r"))
            .select(*keep, "_r.*"))
    return rows, bad


def load_table(spark: SparkSession, paths: str | list[str], schema: T.StructType, target: str,
               fmt: str = "json", append: bool = False, max_bad_rows: int = 0,
               partition_by: list[str] | None = None, csv_options: dict | None = None) -> dict:
    """M1: load files into a parquet table with a declared schema.

    ``append`` adds rows (and lets new nullable columns appear: readers use
    ``mergeSchema``); otherwise the table (or, with ``partition_by``, the
    partitions present in the new data) is replaced.  More than
    ``max_bad_rows`` unparsable rows abort the load before anything is published:
    rows are parsed once, written aside, counted in the same pass (``observe``) and moved in by renames only
    under the budget.  CSV fields in quotes may hold line breaks.
    """
    if max_bad_rows < 0:
        raise ValueError("max_bad_rows must not be negative")
    if fmt == "json":
        parsed = json_rows(spark.read.text(paths), schema)
    elif fmt == "csv":
        corrupt = "_corrupt_record"
        opts = {"header": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt, "multiLine": "true", "escape": '"', **(csv_options or {})}
        raw = spark.read.options(**opts).schema(T.StructType(list(schema.fields) + [T.StructField(corrupt, T.StringType())])) \
            .csv(paths)
        parsed = raw.select(F.col(corrupt).isNull().alias("_ok"), F.struct(*[f.name for f in schema.fields]).alias("_r"))
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    aside, n_bad = stage_rows(parsed, target, max_bad_rows, partition_by)
    publish(spark, aside, target, append, partition_by)
    return {"target": target, "bad_rows": n_bad}


def stage_rows(parsed: DataFrame, target: str, max_bad_rows: int, partition_by: list[str] | None = None) -> tuple[str, int]:
    """Write the good rows of ``parsed`` (``_ok``, ``_r``) beside ``target`` and count the bad ones in
    that pass; above the budget the written rows go and ``BadRowsError`` is raised. Returns the folder and the count."""
    spark = parsed.sparkSession
    seen = Observation()
    rows = parsed.observe(seen, F.count_if(~F.col("_ok")).alias("bad")).where("_ok").select("_r.*")
    parent, _, name = target.rstrip("/").rpartition("/")
    aside = f"{parent}/_new-{name}-{uuid.uuid4().hex}"
    (rows.write.partitionBy(*partition_by) if partition_by else rows.write).parquet(aside)
    bad = seen.get["bad"]
    if bad > max_bad_rows:
        delete_path(spark, aside)
        raise BadRowsError(f"{bad} bad rows (allowed {max_bad_rows})")
    return aside, bad


def publish(spark: SparkSession, aside: str, target: str, append: bool = False, partition_by: list[str] | None = None) -> None:
    """Move a finished folder into the place of ``target``: all of it, its partitions, or (``append``) its files."""
    settle_folder(spark, target)
    if not path_exists(spark, target) or not (append or partition_by):
        return swap_folder(spark, aside, target)
    depth = len(partition_by or [])

    def folders(path: str, level: int) -> list[str]:
        if level == 0:
            return [path]
        return [f for n in list_folder(spark, f"{aside}{path}") if "=" in n for f in folders(f"{path}/{n}", level - 1)]

    for folder in folders("", depth):
        if append:  # file names are unique
            for n in list_folder(spark, aside + folder):
                move_path(spark, f"{aside}{folder}/{n}", f"{target}{folder}/{n}")
        else:
            swap_folder(spark, aside + folder, target + folder)
    delete_path(spark, aside)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Read a loaded table; columns added by later appends are merged in."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def table_exists(spark: SparkSession, path_or_name: str) -> bool:
    """M6: does a table (catalog name or storage path) exist?"""
    if "/" in path_or_name or ":" in path_or_name:
        return path_exists(spark, path_or_name)
    return spark.catalog.tableExists(path_or_name)


def optional_table(spark: SparkSession, path_or_name: str) -> DataFrame | None:
    """M6: the table when it exists, else ``None`` (operators then emit NULL columns)."""
    if not table_exists(spark, path_or_name):
        return None
    if "/" in path_or_name or ":" in path_or_name:
        return read_table(spark, path_or_name)
    return spark.table(path_or_name)


class DuplicateKeyError(ValueError):
    """The merge source has more than one row for a key."""


def merge_into(target: DataFrame, source: DataFrame, keys: list[str], match_equal: list[str] | None = None,
               match_unequal: list[str] | None = None, check_duplicates: bool = True) -> DataFrame:
    """M2: upsert ``source`` into ``target`` on ``keys``; returns the merged table.

    Source rows without a match are inserted.  A matched target row takes all
    non-key values of the source row when every ``match_equal`` column is
    equal and every ``match_unequal`` column differs (``<>``: a NULL on either
    side is not a difference); otherwise it stays.  Keys compare with ``=``,
    so NULL keys never match.  One full outer join, no per-key loops.  A source
    key that appears twice raises, as a warehouse MERGE would; without
    ``check_duplicates`` the caller vouches for the keys.
    """
    if check_duplicates:
        named = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        if not source.where(named).groupBy(*keys).count().where(F.col("count") > 1).isEmpty():
            raise DuplicateKeyError(f"merge source has duplicate keys on {keys}")
    cols = target.columns
    for c in source.columns:
        if c not in cols:
            cols.append(c)
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in target.columns], F.lit(True).alias("_t"))
    s = source.select(*[F.col(c).alias(f"s_{c}") for c in source.columns], F.lit(True).alias("_s"))
    on = reduce(lambda a, b: a & b, [F.col(f"t_{k}") == F.col(f"s_{k}") for k in keys])
    j = t.join(s, on, "full")
    matched = F.col("_t").isNotNull() & F.col("_s").isNotNull()
    cond: Column = F.lit(True)
    for c in match_equal or []:
        cond = cond & (F.col(f"t_{c}") == F.col(f"s_{c}"))
    for c in match_unequal or []:
        cond = cond & (F.col(f"t_{c}") != F.col(f"s_{c}"))
    take_source = F.col("_t").isNull() | (matched & F.coalesce(cond, F.lit(False)))

    def pick(c):
        tc = F.col(f"t_{c}") if c in target.columns else F.lit(None)
        sc = F.col(f"s_{c}") if c in source.columns else F.lit(None)
        if c in keys:
            return F.coalesce(tc, sc).alias(c)
        return F.when(take_source, sc).otherwise(tc).alias(c)

    return j.select(*[pick(c) for c in cols])


# declared field types -> Spark types (fixed values of the schema spec format)
SPEC_TYPES = {"STRING": T.StringType(), "INTEGER": T.LongType(), "INT64": T.LongType(), "FLOAT": T.DoubleType(),
              "FLOAT64": T.DoubleType(), "BOOLEAN": T.BooleanType(), "BOOL": T.BooleanType(),
              "TIMESTAMP": T.TimestampType(), "DATE": T.DateType()}


def schema_from_spec(fields: list[dict]) -> T.StructType:
    """A declared table schema (list of ``{name, field_type, mode, fields}``)
    -> ``StructType``.  ``RECORD``/``STRUCT`` nest, ``mode: REPEATED`` makes an
    array; every field is nullable."""
    out = []
    for f in fields:
        kind = (f.get("field_type") or f.get("type") or "STRING").upper()
        if kind in ("RECORD", "STRUCT"):
            dt: T.DataType = schema_from_spec(f.get("fields") or [])
        else:
            dt = SPEC_TYPES[kind]
        if (f.get("mode") or "").upper() == "REPEATED":
            dt = T.ArrayType(dt)
        out.append(T.StructField(f["name"], dt, True))
    return T.StructType(out)


def load_schema_file(path: str, table: str | None = None) -> T.StructType:
    """Read a JSON schema file: either ``{table: [fields]}`` or a bare list of fields."""
    with open(path, encoding="utf8") as fh:
        spec = json.load(fh)
    if isinstance(spec, dict):
        spec = spec[table] if table else next(iter(spec.values()))
    return schema_from_spec(spec)


def merge_table(spark: SparkSession, path: str, source: DataFrame, keys: list[str], partition_by: list[str] | None = None, **options) -> DataFrame:
    """M2 end to end: merge ``source`` into the stored table at ``path`` (made
    if absent) and write it back.  The merged rows are written beside the table,
    under a name of their own, and swapped in, so a failed job leaves it as it was."""
    settle_folder(spark, path)
    target = read_table(spark, path) if path_exists(spark, path) else source.limit(0)
    parent, _, name = path.rstrip("/").rpartition("/")
    beside = f"{parent}/_new-{name}-{uuid.uuid4().hex}"
    w = merge_into(target, source, keys, **options).write
    (w.partitionBy(*partition_by) if partition_by else w).parquet(beside)
    swap_folder(spark, beside, path)
    return read_table(spark, path)


def merge_bucketed(spark: SparkSession, path: str, source: DataFrame, keys: list[str], buckets: int = 64, **options) -> DataFrame:
    """M2 for large tables: rows are stored by hash bucket of their key, and a merge reads and rewrites
    only the buckets that hold a key of ``source``; the files of all others stay as they are.

    The number of buckets is fixed when the table is made. Each touched bucket is swapped in once all are written."""
    settle_folder(spark, path)
    known = read_text(spark, f"{path}/_buckets")
    if known is None:
        write_text(spark, f"{path}/_buckets", str(buckets))
    n = int(known or buckets)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")
    source = stored_scratch(spark, source.withColumn("bucket", bucket), "merge-source")
    touched = sorted(r[0] for r in source.select("bucket").distinct().collect())  # at most ``n`` numbers
    there = list_folder(spark, path)
    for b in touched:
        settle_folder(spark, f"{path}/bucket={b}")
    aside = f"{path}/_new-{uuid.uuid4().hex}"
    if any(x.startswith("bucket=") for x in there):
        target = spark.read.option("mergeSchema", "true").parquet(path).where(F.col("bucket").isin(touched))
    else:
        target = source.limit(0)
    merged = merge_into(target, source, ["bucket", *keys], **options)
    merged.repartition(n, "bucket").write.partitionBy("bucket").parquet(aside)
    for b in touched:
        swap_folder(spark, f"{aside}/bucket={b}", f"{path}/bucket={b}")
    delete_path(spark, aside)
    return spark.read.option("mergeSchema", "true").parquet(path).drop("bucket")


# --------------------------------------------------------------- schema evolution
WIDER = {("bigint", "double"): "double", ("int", "bigint"): "bigint", ("int", "double"): "double", ("float", "double"): "double", ("date", "timestamp"): "timestamp"}


def widen(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type of the lattice that holds the values of both: integers below doubles, dates below timestamps,
    all single values below text; structs take the fields of both, arrays widen their elements."""
    if a == b:
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        other = {f.name: f.dataType for f in b.fields}
        mine = [T.StructField(f.name, widen(f.dataType, other[f.name]) if f.name in other else f.dataType) for f in a.fields]
        return T.StructType(mine + [T.StructField(f.name, f.dataType) for f in b.fields if f.name not in a.fieldNames()])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widen(a.elementType, b.elementType))
    names = a.simpleString(), b.simpleString()
    if found := WIDER.get(names) or WIDER.get(names[::-1]):
        return T._parse_datatype_string(found)
    if any(isinstance(t, (T.StructType, T.ArrayType, T.MapType)) for t in (a, b)):
        raise ValueError(f"no common type for {names[0]} and {names[1]}")
    return T.StringType()


def schema_versions(spark: SparkSession, path: str) -> list[T.StructType]:
    """The declared schemas of an evolving table, oldest first."""
    out = []
    while (text := read_text(spark, f"{path}/_schema/v{len(out) + 1}")) is not None:
        out.append(T.StructType.fromJson(json.loads(text)))
    return out


def append_evolving(spark: SparkSession, path: str, parsed: DataFrame, max_bad_rows: int = 0) -> int:
    """M1 append that may add columns and widen types: the table's schema becomes the
    ``widen`` of its own and that of ``parsed`` (``_ok``, ``_r``), as a new version if it differs.

    The rows stand in one folder of their version, moved in by a single rename under the budget of bad rows. Returns the number of bad rows."""
    versions = schema_versions(spark, path)
    new = parsed.schema["_r"].dataType
    schema = widen(versions[-1], new) if versions else T.StructType([T.StructField(f.name, f.dataType) for f in new.fields])
    rows = parsed.select("_ok", F.when(F.col("_r").isNotNull(), _widened(F.col("_r"), new, schema)).alias("_r"))
    aside, bad = stage_rows(rows, f"{path}/load", max_bad_rows)
    if not versions or schema != versions[-1]:
        versions.append(schema)
        write_text(spark, f"{path}/_schema/v{len(versions)}", schema.json())
    move_path(spark, aside, f"{path}/version={len(versions)}/load={uuid.uuid4().hex}")
    return bad


def _widened(c: Column, have: T.DataType, want: T.DataType) -> Column:
    if isinstance(want, T.StructType):
        mine = {f.name: f.dataType for f in have.fields}
        return F.struct(*[(_widened(c.getField(f.name), mine[f.name], f.dataType) if f.name in mine else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields])
    if isinstance(want, T.ArrayType):
        return F.transform(c, lambda x: _widened(x, have.elementType, want.elementType))
    return c.cast(want)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """The whole evolving table in its latest schema; rows of older versions are read in their own and cast."""
    versions = schema_versions(spark, path)
    parts = []
    for k, have in enumerate(versions, 1):
        if path_exists(spark, f"{path}/version={k}"):
            rows = spark.read.schema(have).parquet(f"{path}/version={k}/*")
            parts.append(rows.select(*[(_widened(F.col(f"`{f.name}`"), have[f.name].dataType, f.dataType) if f.name in have.fieldNames() else F.lit(None).cast(f.dataType)).alias(f.name)
                                       for f in versions[-1].fields]))
    if not parts:
        return spark.createDataFrame([], versions[-1] if versions else T.StructType())
    return reduce(lambda a, b: a.unionByName(b), parts)


def json_rows(lines: DataFrame, schema: T.StructType, text_col: str = "value") -> DataFrame:
    """JSON lines as ``_ok`` and ``_r``, for ``append_evolving``."""
    text = F.col(text_col)
    is_obj = F.try_parse_json(text).isNotNull() & F.ltrim(text).startswith("{") & F.rtrim(text).endswith("}")
    return lines.select(F.coalesce(is_obj, F.lit(False)).alias("_ok"), F.from_json(text, schema).alias("_r"))
