"""Merkle manifest of a dataset with a proof for every row (operator 11).

Every row is a leaf (``leaf_hash``). The leaves of a group (here a language)
stand in ascending order and are paired level by level up to the group's
subroot; the subroots are paired likewise up to the root. The last node of an odd
level is hashed alone.

The tree is built by a nested-struct rollup. A row's rank in its group is written
in digits of ``DIGIT_BITS`` bits, and ``DIGITS`` digits make a block. Within a block
the lowest digit is grouped away first: its up to 32 nodes become one array, the
levels above them are paired inside the array, and the struct of both is a child of the
next digit's group. One shuffle by (group, block) serves all these aggregations. A block
ends as one row of nested structs with its top hash. The tops are the ranked rows of the next,
1,024 times smaller rollup, the subroots those of the last. What lies above a block comes
back as one more row of that block; grouping both gives the nested struct its upper path, and
one transform with an explode emits every row's proof. No join takes part.

No task holds more than one block. Ranks come from a range partitioning by group and order
(a hot group is many ranges; equal rows are told apart by their place), stored, with one count per range and group.
The only figure that reaches the driver is the size of the largest group. Intermediate tables are written to the shared folder.

Edge cases: nulls count as ``-`` in a leaf; a null group is a group of its own and the first; rows
with equal order stand by their leaf; repeated rows are leaves of their own; empty and very long texts are hashed
whole; an empty table gives an empty result; a group of one row has its leaf for subroot, one group alone its subroot for root, and
then there may be no sibling at all (the hash of the empty string); other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored

DIGIT_BITS = 5
DIGITS = 2
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
ABOVE = "struct<path:array<struct<side:int,h:string>>,subroot:string,root:string>"


def leaf_hash(columns: list[Column]) -> Column:
    """sha256 of the values, each as length in bytes, ``:``, value; ``-`` if null."""
    def part(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*[part(c) for c in columns]), 256)


def ranked(spark: SparkSession, rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """The rows with ``rank`` in their group and the group's size ``n``."""
    rows = rows.withColumn("_tie", F.monotonically_increasing_id())
    spread = rows.repartitionByRange(F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order], "_tie")
    spread = spread.sortWithinPartitions(F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order], "_tie").drop("_tie")
    at = stored(spark, spread.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)), name)
    ranges = at.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_size"))
    whole = Window.partitionBy(group)  # one row per range of the group
    ranges = ranges.select(F.col(group).alias("_group"), F.col("_part").alias("_range"), "_first", F.sum("_size").over(whole).alias("n"),
                           (F.sum("_size").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_size")).alias("_before"))
    found = at.join(ranges, at[group].eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_range")))
    return found.select(*[F.col(c) for c in rows.columns if c != "_tie"], (F.col("_at") - F.col("_first") + F.col("_before")).alias("rank"), "n")


def _paired(nodes: str) -> str:
    return f"transform(sequence(0, (size({nodes}) - 1) div 2), i -> sha2(concat({nodes}[2 * i], coalesce(get({nodes}, 2 * i + 1), '')), 256))"


def _digit(df: DataFrame, keys: list[str], child: Column, level: int, bits: int) -> DataFrame:
    """Groups the lowest remaining digit away: its children in order, and the levels above them."""
    df = df.groupBy("tree", "block", *keys).agg(F.array_sort(F.collect_list(child)).alias("kids"), F.max("levels").alias("levels"))
    df = df.withColumn("l0", F.expr("transform(kids, k -> k.h)"))
    for k in range(bits):
        df = df.withColumn(f"l{k + 1}", F.expr(f"if(levels > {level + k}, {_paired(f'l{k}')}, l{k})"))
    return df.select("tree", "block", *keys, "levels", F.expr(f"l{bits}[0]").alias("h"), F.array(*[F.col(f"l{k}") for k in range(bits)]).alias("rows"), "kids")


def _siblings(node: str, digit: str, level: int, bits: int) -> str:
    """What stands beside the child with this digit, level by level: 1 left, 2 right, 0 none."""
    return (f"transform(filter(sequence(0, {bits - 1}), j -> {level} + j < x.levels), j -> struct("
            f"if(shiftright({digit}, j) % 2 = 1, 1, if(get({node}.rows[j], shiftright({digit}, j) ^ 1) is null, 0, 2)) as side, "
            f"get({node}.rows[j], shiftright({digit}, j) ^ 1) as h))")


def proofs(spark: SparkSession, nodes: DataFrame, rollup: tuple[int, int] = (DIGIT_BITS, DIGITS), depth: int = 0) -> DataFrame:
    """(payload, path, subroot, root) of every node. ``nodes``: tree, rank, n, h, payload.

    ``path``: (side, hash) of the siblings from the node up to the root."""
    bits, digits = rollup
    if digits != 2:
        raise ValueError("blocks have two digits")
    block_bits, low = bits * digits, (1 << bits) - 1
    rows = nodes.select("tree", F.shiftright("rank", block_bits).alias("block"), F.shiftright("rank", bits).bitwiseAND(low).cast("int").alias("d1"),
                        F.col("rank").bitwiseAND(low).cast("int").alias("d0"), "h", "payload",
                        F.when(F.col("n") > 1, F.length(F.conv((F.col("n") - 1).cast("string"), 10, 2))).otherwise(0).alias("levels"), "n")
    rows = rows.repartition("tree", "block")
    one = _digit(rows, ["d1", "n"], F.struct(F.col("d0").alias("d"), "h", "payload"), 0, bits)
    two = _digit(one, ["n"], F.struct(F.col("d1").alias("d"), "h", "rows", "kids"), bits, bits)
    blocks = stored(spark, two, f"merkle-blocks-{depth}")
    tops = blocks.select("tree", F.col("block").alias("rank"), F.shiftright(F.col("n") + ((1 << block_bits) - 1), block_bits).alias("n"), "h",
                         F.struct("tree", "block").alias("payload"))
    largest = tops.agg(F.max("n").alias("n")).first()["n"] or 0
    if largest > 1:
        above = proofs(spark, tops, rollup, depth + 1)
    else:
        above = _over(spark, tops, rollup, depth)
    above = above.select("payload.tree", "payload.block", F.struct("path", "subroot", "root").alias("up"))
    both = blocks.select("tree", "block", F.struct("levels", "rows", "kids").alias("x"), F.lit(None).cast(ABOVE).alias("up")).unionByName(
        above.select("tree", "block", F.lit(None).cast(blocks.select(F.struct("levels", "rows", "kids").alias("x")).schema["x"].dataType).alias("x"), "up"))
    whole = both.groupBy("tree", "block").agg(F.first("x", ignorenulls=True).alias("x"), F.first("up", ignorenulls=True).alias("up"))
    each = whole.select("up", F.explode(F.expr(
        f"flatten(transform(x.kids, a -> transform(a.kids, b -> struct(b.payload as payload, "
        f"concat({_siblings('a', 'b.d', 0, bits)}, {_siblings('x', 'a.d', bits, bits)}) as path))))")).alias("row"))
    return each.select("row.payload", F.concat("row.path", "up.path").alias("path"), "up.subroot", "up.root")


def _over(spark: SparkSession, tops: DataFrame, rollup, depth: int) -> DataFrame:
    """What lies above trees of a single node: the tree of their subroots, or nothing above the one root."""
    schema = dict(tops.dtypes)
    if schema["tree"] == "boolean":  # the tree of subroots is done
        return tops.select("payload", F.expr("cast(array() as array<struct<side:int,h:string>>)").alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("h").alias("root"))
    subroots = ranked(spark, tops.select(F.lit(True).alias("all"), "tree", "h", "payload"), "all", ["tree"], "merkle-subroots")
    nodes = subroots.select(F.col("all").alias("tree"), "rank", "n", "h", F.struct("payload", F.col("h").alias("subroot")).alias("payload"))
    above = proofs(spark, nodes, rollup, depth + 1)
    return above.select("payload.payload", "path", "payload.subroot", "root")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.when(s["side"] == 1, F.concat(s["h"], h)).when(s["side"] == 2, F.concat(h, s["h"])).otherwise(h), 256))


def manifest(spark: SparkSession, rows: DataFrame, key: str = "doc_id", group: str = "lang", columns=LEAF_COLUMNS, keep: dict[str, Column] | None = None,
             rollup: tuple[int, int] = (DIGIT_BITS, DIGITS)) -> DataFrame:
    """key, the columns of ``keep``, leaf, subroot, root and path of every row. Texts are read once and never shuffled."""
    keep = keep or {}
    leaves = rows.select(F.col(group).cast("string").alias("tree"), F.col(key).alias("key"), leaf_hash([F.col(c) for c in columns]).alias("h"),
                         F.struct(F.lit(True).alias("_"), *[v.alias(k) for k, v in keep.items()]).alias("kept"))
    leaves = ranked(spark, stored(spark, leaves, "merkle-leaves"), "tree", ["key", "h"], "merkle-ranges")
    nodes = leaves.select("tree", "rank", "n", "h", F.struct("key", F.col("h").alias("leaf"), "kept").alias("payload"))
    return proofs(spark, nodes, rollup).select(F.col("payload.key").alias(key), *[F.col(f"payload.kept.{k}").alias(k) for k in keep], F.col("payload.leaf").alias("leaf"),
                                              "subroot", "root", "path")


def verified(found: DataFrame, leaf: Column) -> DataFrame:
    """``found`` with the root folded from ``leaf`` and whether it is the manifest's."""
    return found.withColumn("folded_root", folded(leaf, F.col("path"))).withColumn("verified", F.col("folded_root") == F.col("root"))


def manifest_digest(spark: SparkSession, docs: DataFrame, rollup: tuple[int, int] = (DIGIT_BITS, DIGITS)) -> DataFrame:
    """One row per document with its proof's hash; every seventh document (by crc32 of its id) is checked with one more n_chars."""
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0,
                      leaf_hash([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars").cast("decimal(20,0)") + 1, F.col("text")]))
    found = manifest(spark, docs, keep={"tampered": tampered}, rollup=rollup)
    proof = F.sha2(F.array_join(F.transform("path", lambda s: s["h"]), ""), 256)
    return verified(found, F.coalesce("tampered", "leaf")).select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", "verified")


#: The digest in DuckDB: levels by recursion, siblings by joins on level and place.
ORACLE = """
WITH RECURSIVE docs AS (
  SELECT doc_id, lang, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') AS a, coalesce(strlen(source) || ':' || source, '-') AS b,
         coalesce(strlen(lang) || ':' || lang, '-') AS c, coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS e,
         coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') AS e1, coalesce(strlen(text) || ':' || text, '-') AS f,
         list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda crc, byte:
           list_reduce(list_prepend(xor(crc, byte), range(8)), lambda v, i: xor(v // 2, 3988292384 * (v % 2)))) AS rest
  FROM documents
), leaves AS (
  SELECT doc_id, lang, sha256(a || b || c || e || f) AS leaf,
         CASE WHEN xor(rest, 4294967295) % 7 = 0 THEN sha256(a || b || c || e1 || f) ELSE sha256(a || b || c || e || f) END AS told FROM docs
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS n,
         row_number() OVER () AS rid FROM leaves
), tree AS (
  SELECT lang, 0 AS level, place, leaf AS h, n FROM placed
  UNION ALL
  SELECT lang, level + 1, place // 2, sha256(string_agg(h, '' ORDER BY place)), (n + 1) // 2 FROM tree WHERE n > 1 GROUP BY lang, level, place // 2, n
), subroots AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM tree WHERE n = 1
), crown AS (
  SELECT 0 AS level, place, subroot AS h, n FROM subroots
  UNION ALL
  SELECT level + 1, place // 2, sha256(string_agg(h, '' ORDER BY place)), (n + 1) // 2 FROM crown WHERE n > 1 GROUP BY level, place // 2, n
), walk AS (
  SELECT rid, lang, 0 AS level, place, n, told AS h, '' AS proof FROM placed
  UNION ALL
  SELECT w.rid, w.lang, w.level + 1, w.place // 2, (w.n + 1) // 2,
         sha256(CASE WHEN w.place % 2 = 1 THEN coalesce(s.h, '') || w.h ELSE w.h || coalesce(s.h, '') END), w.proof || coalesce(s.h, '')
  FROM walk w LEFT JOIN tree s ON s.lang IS NOT DISTINCT FROM w.lang AND s.level = w.level AND s.place = xor(w.place, 1) WHERE w.n > 1
), rise AS (
  SELECT w.rid, 0 AS level, s.place, s.n, w.h, w.proof, s.subroot FROM walk w JOIN subroots s ON s.lang IS NOT DISTINCT FROM w.lang WHERE w.n = 1
  UNION ALL
  SELECT r.rid, r.level + 1, r.place // 2, (r.n + 1) // 2,
         sha256(CASE WHEN r.place % 2 = 1 THEN coalesce(s.h, '') || r.h ELSE r.h || coalesce(s.h, '') END), r.proof || coalesce(s.h, ''), r.subroot
  FROM rise r LEFT JOIN crown s ON s.level = r.level AND s.place = xor(r.place, 1) WHERE r.n > 1
)
SELECT p.doc_id, p.leaf, r.subroot, t.h AS root, sha256(r.proof) AS proof_sha256, r.h AS folded_root, r.h = t.h AS verified
FROM placed p JOIN rise r ON r.rid = p.rid AND r.n = 1 CROSS JOIN (SELECT h FROM crown WHERE n = 1) t
"""
