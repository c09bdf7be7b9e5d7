"""Database dumps: header-led, tab-separated files whose quoted fields may hold tabs, quotes and line breaks.

A line break inside quotes does not end a record, so where a record ends depends on
every quote before it in the file. Plain files are still read by many tasks: a line maps
the state at its start (inside quotes or not) to the state at its end, a file split composes
the maps of its lines, and the composition over the splits before it, a prefix sum of
"last split with one outcome" and "state flips since", tells where each split starts. The second pass reads each split
from its first true record start; the pieces of a record that spans splits are put together
afterwards.

Rules of the fields are those of a lenient CSV reader: a quote opens only at the start of a
field, a doubled quote inside is one quote, text after the closing quote belongs to the field, and a
file that ends inside quotes ends its last record.
"""

from __future__ import annotations

import contextlib
import csv
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mooclens.session import stored_scratch

MAX_SPLITS = 2_000  # at most, beside one for each file
SPLIT_CONFS = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.minPartitionNum")


def ends_inside(line: str, inside: bool, quote: str) -> bool:
    """Whether a line ends inside quotes, for its state at the start."""
    at = 0
    while True:
        if inside:
            end = line.find(quote, at)
            while end >= 0 and line[end + 1:end + 2] == quote:
                end = line.find(quote, end + 2)
            if end < 0:
                return True
            at = end + 1
        elif line.startswith(quote, at):
            at, inside = at + 1, True
            continue
        tab = line.find("\t", at)  # the rest of this field
        if tab < 0:
            return False
        at, inside = tab + 1, False


def parsed(lines: list[str], quote: str | None) -> list[list[str]]:
    """Records of whole lines; empty lines are none."""
    if quote is None:
        return [line.split("\t") for line in lines if line]
    csv.field_size_limit(sys.maxsize)
    return [r for r in csv.reader([line + "\n" for line in lines], delimiter="\t", quotechar=quote) if r]


def _lines(spark: SparkSession, paths) -> DataFrame:
    meta = F.col("_metadata")
    return spark.read.text(paths).select(meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), F.col("value").cast("binary").alias("value"))


def _splits(batches) -> Iterator[tuple[str, int, list[str]]]:
    """(file, block, lines) of neighbouring lines of one split, batch by batch."""
    for batch in batches:
        files, blocks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        lines = [v.as_py().replace(b"\0", b"").decode("utf8", "ignore") for v in batch.column(2)]
        a = 0
        for b in range(1, len(files) + 1):
            if b == len(files) or blocks[b] != blocks[a] or files[b] != files[a]:
                yield files[a], blocks[a], lines[a:b]
                a = b


def split_states(lines: DataFrame, quote: str) -> DataFrame:
    """(file, block, inside): whether each split starts inside quotes."""
    fields = [("file", T.StringType()), ("block", T.LongType()), ("if_out", T.BooleanType()), ("if_in", T.BooleanType())]
    schema = T.StructType([T.StructField(n, t) for n, t in fields])

    def work(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        ends: dict[tuple[str, int], list[bool]] = {}
        for file, block, found in _splits(batches):
            state = ends.setdefault((file, block), [False, True])
            for line in found:
                if quote in line:
                    state[:] = [ends_inside(line, s, quote) for s in state]
        rows = [(*k, *v) for k, v in ends.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(to_arrow_schema(schema))], schema=to_arrow_schema(schema))

    x = lines.mapInArrow(work, schema)
    file = Window.partitionBy("file").orderBy("block")  # one row per split of a file
    so_far = file.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    flip = F.when(~F.col("if_in") & F.col("if_out"), 1).otherwise(0)
    x = x.withColumn("flips", F.sum(flip).over(so_far)).withColumn("sure", F.when(F.col("if_in") == F.col("if_out"), F.struct(F.col("if_in").alias("ends"), "flips")))
    x = x.withColumn("sure", F.last("sure", ignorenulls=True).over(so_far))
    ends = (F.coalesce(F.col("sure.ends").cast("int"), F.lit(0)) + F.col("flips") - F.coalesce("sure.flips", F.lit(0))) % 2 == 1
    return x.select("file", "block", ends.alias("ends")).select("file", "block", F.coalesce(F.lag("ends").over(file), F.lit(False)).alias("inside"))


def _dump_bytes(spark: SparkSession, names: list[str]) -> int:
    """Size of the files that paths or patterns name."""
    total = 0
    for name in names:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        total += sum(fs.getContentSummary(s.getPath()).getLength() for s in fs.globStatus(p) or [])
    return total


@contextlib.contextmanager
def _same_splits(spark: SparkSession, split_bytes: int | None):
    """Both passes must cut the files alike: the settings that decide are held while they run."""
    before = {c: spark.conf.get(c, None) for c in SPLIT_CONFS}
    spark.conf.set(SPLIT_CONFS[1], before[SPLIT_CONFS[1]] or str(spark.sparkContext.defaultParallelism))
    if split_bytes:
        spark.conf.set(SPLIT_CONFS[0], str(split_bytes))
    try:
        yield
    finally:
        for c, v in before.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)


PIECES = T.StructType([T.StructField("file", T.StringType()), T.StructField("block", T.LongType()), T.StructField("n", T.LongType()),
                       T.StructField("kind", T.StringType()), T.StructField("fields", T.ArrayType(T.StringType())), T.StructField("text", T.StringType())])


def _pieces(lines: DataFrame, quote: str | None, inside: dict[tuple[str, int], bool] | None) -> DataFrame:
    """Records ("record") and unfinished ends of splits ("head", "middle", "tail").

    ``inside`` has every split of files in several splits, so it is as long as the scan's own list of splits."""
    def work(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(PIECES)

        def out(file, block, rows):
            cols = [[file] * len(rows), [block] * len(rows), *zip(*rows)] if rows else [[]] * 6
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, arrow)], schema=arrow)

        key, n, open_, state, leading = None, 0, [], False, False

        def finished():
            """What a split leaves open."""
            if open_:
                yield out(*key, [(n, "middle" if leading else "head", None, "\n".join(open_))])

        for file, block, found in _splits(batches):
            if key != (file, block):
                yield from finished()
                key, n, open_ = (file, block), 0, []
                if inside is not None and key not in inside:
                    raise RuntimeError(f"the splits of {file} changed between two reads")
                state = leading = bool(inside) and inside[key]
            if quote is None:
                rows = parsed(found, None)
                yield out(file, block, [(n + i, "record", r, None) for i, r in enumerate(rows)])
                n += len(rows)
                continue
            whole, rows = 0, []  # lines that end a record
            for i, line in enumerate(found):
                if quote in line:
                    state = ends_inside(line, state, quote)
                if not state:
                    whole = i + 1
                    if leading:
                        rows.append((n, "tail", None, "\n".join(open_ + found[:whole])))
                        found[:whole] = [""] * whole
                        open_, leading, n = [], False, n + 1
            if whole:
                for r in parsed([*open_, *found[:whole]], quote):
                    rows.append((n, "record", r, None))
                    n += 1
                open_ = []
            open_ += found[whole:]
            yield out(file, block, rows)
        yield from finished()

    return lines.mapInArrow(work, PIECES)


def dump_records(spark: SparkSession, paths: list[str] | str, quote: str | None = "'", split_bytes: int | None = None) -> DataFrame:
    """Dump files (gzip or plain) -> ``file``, ``at`` (order within the file) and ``r``, a map from
    the names in the file's first line to the texts of a record.

    Files may order their columns differently. NUL bytes and bytes that are no UTF-8 are dropped, fields that a short record
    lacks are NULL, surplus ones are dropped, empty lines are no records. ``quote=None``: no quoting. The records are stored in the
    shared folder. ``split_bytes`` sets the size of a split; dumps of more than ``MAX_SPLITS`` of them are cut into that
    many larger ones, so that neither the tasks nor the list of splits grow without bound.
    """
    names = [paths] if isinstance(paths, str) else list(paths)
    if split_bytes:
        split_bytes = max(split_bytes, -(-_dump_bytes(spark, names) // MAX_SPLITS))
    with _same_splits(spark, split_bytes):
        lines = _lines(spark, paths)
        inside = None
        if quote is not None and not all(p.endswith(".gz") for p in names):
            inside = {(r["file"], r["block"]): r["inside"] for r in split_states(lines, quote).collect()}  # one row per split
        pieces = stored_scratch(spark, _pieces(lines, quote, inside), "dump")
    file = Window.partitionBy("file").orderBy("block", "n")
    parts = pieces.where(F.col("kind") != "record")  # at most two per split
    parts = parts.withColumn("chain", F.sum((F.col("kind") == "head").cast("int")).over(file))
    parts = parts.groupBy("file", "chain").agg(F.array_sort(F.collect_list(F.struct("block", "n", "text"))).alias("texts"))

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def one_record(texts):
        return texts.map(lambda t: (parsed(t.split("\n"), quote) or [[]])[0])

    joined = parts.select("file", F.col("texts")[0]["block"].alias("block"), F.col("texts")[0]["n"].alias("n"),
                          one_record(F.array_join(F.transform("texts", lambda t: t["text"]), "\n")).alias("fields"))
    records = pieces.where("kind = 'record'").select("file", "block", "n", "fields")
    records = records.unionByName(joined) if quote is not None else records
    head = pieces.where("kind = 'record' and block = 0 and n = 0").select("file", F.transform("fields", lambda f: F.trim(f)).alias("names"))
    x = records.where("not (block = 0 and n = 0)").join(F.broadcast(head), "file")  # one row per file
    texts = F.transform(F.sequence(F.lit(0), F.size("names") - 1), lambda i: F.get("fields", i))
    return x.select("file", F.struct("block", "n").alias("at"), F.map_from_arrays("names", texts).alias("r"))
