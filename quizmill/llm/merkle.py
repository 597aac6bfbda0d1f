"""Merkle manifest of a dataset: a tree per group, a tree over their roots, and a recursive climb that checks every leaf.

H is the lowercase hex sha256 of its concatenated inputs, digests taken as hex
text.  A row's leaf is H over its fields, each ``-`` if null, else the number of
its UTF-8 bytes, ``:`` and the value.  In each group the leaves ascend by the
order column; while several nodes remain, every two consecutive ones, or the last
one alone, become their H.  What remains is the group's root.  Group roots,
ordered by group (null first, bytewise), give the root of all in the same way.

**Building.**  Leaves get their number in the group from a range partitioning:
numbers inside a part plus the sizes of the parts before it, so no group, however
large, is sorted in one task.  ``2 ** stride`` neighbours at a time make a block:
its levels are hashed together and stored as one row.  A pass over the blocks of
one step gives the nodes of the next; a tree of n leaves needs log2(n) / stride
passes.

**Climb.**  The stored levels are read as rows (node, link to the node above the
block, siblings on the way).  A recursive query starts from every leaf with the
digest to be checked, appends the siblings, folds the digest with them, and goes
on at the linked node until there is none.  Siblings are those of the original
tree.  The rows above the first step are 2 ** stride times fewer than the leaves;
Spark broadcasts them where they are small, and joins by shuffle beyond.

Nulls: null fields as above; a null group is a group of its own; a null order
value comes first.  Ties in the order value are ordered by leaf digest, and equal
rows give equal leaves, each with a place of its own.  A single leaf is its
group's root and its proof is H of nothing.  An empty table has no root and gives
no rows.  Only the named fields are read, so other columns, whatever their names,
change nothing.  Field values may be of any length.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged, table

#: Step number of the first pass over the tree of group roots; steps of a group's own tree are below.
TOP = 1000
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with idx (from 0, by ``order``, nulls first) and n within each ``g``; the last of ``order`` must settle ties.

    Equal rows can't be told apart, so they may be spread over parts by a running number.
    """
    ranged = rows.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange("g", *order, "salt")
    parts = staged(ranged.withColumn("part", F.spark_partition_id()), f"{name}-parts")
    sizes = parts.groupBy("g", "part").agg(F.count("*").alias("size"))
    by_group = Window.partitionBy("g")
    before = (sizes.withColumn("before", F.sum("size").over(by_group.orderBy("part")) - F.col("size"))
              .withColumn("n", F.sum("size").over(by_group)).drop("size"))
    place = F.row_number().over(Window.partitionBy("g", "part").orderBy(*[F.col(c).asc_nulls_first() for c in order]))
    return (parts.withColumn("place", place).join(before, ["g", "part"])
            .withColumn("idx", F.col("before") + F.col("place") - 1).drop("salt", "part", "place", "before"))


def blocks_of(nodes: DataFrame, stride: int) -> DataFrame:
    """One row per 2**stride neighbours of (g, idx, n, digest, item): members, levels, and the node above them.

    ``levels[k]`` holds the digests k levels above the members.  A block goes up
    ``stride`` levels, or to the root where the whole level fits into it.
    """
    width = 1 << stride
    depth = F.when(F.col("n") > width, F.lit(stride)).when(F.col("n") < 2, F.lit(0)).otherwise(F.length(F.bin(F.col("n") - 1)))
    grouped = (nodes.groupBy("g", F.floor(F.col("idx") / F.lit(width)).cast("long").alias("block"), "n")
               .agg(F.array_sort(F.collect_list(F.struct("idx", "digest", "item"))).alias("members")))
    above = """transform(sequence(0, (size(last) - 1) div 2), i ->
        sha2(concat(last[2 * i], if(2 * i + 1 < size(last), last[2 * i + 1], '')), 256))"""
    levels = f"""aggregate(if(depth = 0, cast(array() AS array<int>), sequence(1, depth)), array(members.digest),
        (made, k) -> concat(made, array(transform(array(made[size(made) - 1]), last -> {above})[0])))"""
    return (grouped.withColumn("depth", depth.cast("int")).withColumn("levels", F.expr(levels))
            .withColumn("up", F.element_at(F.element_at("levels", -1), 1))
            .withColumn("n_up", F.ceil(F.col("n") / F.lit(width)).cast("long")))


def node_rows(blocks: DataFrame, step: int) -> DataFrame:
    """Every member of the blocks as a row: key (step, g, idx), link (to_step, to_g, to_idx), and its siblings, lowest first.

    The link is null at the root of a tree.
    """
    run = """transform(if(depth = 0, cast(array() AS array<int>), sequence(0, depth - 1)), k -> named_struct(
        'left', (shiftright(at, k) & 1) = 1,
        'digest', try_element_at(levels[k], (shiftright(at, k) ^ 1) + 1)))"""
    rows = blocks.select("*", F.posexplode("members").alias("at", "member"))
    more = F.col("n_up") > 1
    return rows.select(
        F.lit(step).alias("step"), "g", F.col("member.idx").alias("idx"), F.col("member.digest").alias("digest"), F.col("member.item").alias("item"),
        F.expr(run).alias("run"),
        F.when(more, F.lit(step + 1)).alias("to_step"), F.when(more, F.col("g")).alias("to_g"), F.when(more, F.col("block")).alias("to_idx"))


def tree(nodes: DataFrame, first_step: int, stride: int, name: str) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """(rows of the first step, rows of each further step, roots (g, digest)) of the trees over ``nodes``."""
    steps, roots, step = [], None, first_step
    while True:
        blocks = staged(blocks_of(nodes, stride), f"{name}-step{step}")
        steps.append(node_rows(blocks, step))
        tops = blocks.where("n_up = 1").select("g", F.col("up").alias("digest"))
        roots = tops if roots is None else roots.union(tops)
        nodes = blocks.where("n_up > 1").select("g", F.col("block").alias("idx"), F.col("n_up").alias("n"), F.col("up").alias("digest"),
                                                F.lit(None).cast("string").alias("item"))
        if not nodes.take(1):
            return steps[0], steps[1:], roots
        step += 1


CLIMB = """
WITH RECURSIVE climb AS (
  SELECT item, g, digest AS leaf, {fold_start} AS folded, {siblings_start} AS siblings, to_step, to_g, to_idx
  FROM {leaves}
  UNION ALL
  SELECT c.item, c.g, c.leaf, {fold_on}, concat(c.siblings, {siblings_on}), s.to_step, s.to_g, s.to_idx
  FROM climb c JOIN {steps} s ON s.step = c.to_step AND s.g = c.to_g AND s.idx = c.to_idx
)
SELECT item, g, leaf, folded, siblings FROM climb WHERE to_step IS NULL"""


def _fold(start: str, run: str) -> str:
    return (f"aggregate({run}, {start}, (a, s) -> CASE WHEN s.digest IS NULL THEN sha2(a, 256) "
            "WHEN s.left THEN sha2(concat(s.digest, a), 256) ELSE sha2(concat(a, s.digest), 256) END)")


def _siblings(run: str) -> str:
    return f"unhex(array_join(transform(filter({run}, s -> s.digest IS NOT NULL), s -> s.digest), ''))"


def climb(leaves: DataFrame, steps: DataFrame, name: str) -> DataFrame:
    """(item, g, leaf, folded, siblings) after the recursive ascent of every leaf; siblings are raw bytes, lowest first.

    ``item.start`` is the digest to start from.  The query's guard against
    endless recursion counts all rows, so it is lifted while this one runs; the
    links go up only, so the depth is bounded by the tree's.
    """
    spark = leaves.sparkSession
    views = {"leaves": f"leaves_{uuid.uuid4().hex}", "steps": f"steps_{uuid.uuid4().hex}"}
    leaves.createOrReplaceTempView(views["leaves"])
    steps.createOrReplaceTempView(views["steps"])
    before = spark.conf.get(ROW_LIMIT, None)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        return staged(spark.sql(CLIMB.format(**views, fold_start=_fold("item.start", "run"), siblings_start=_siblings("run"),
                                             fold_on=_fold("c.folded", "s.run"), siblings_on=_siblings("s.run"))), name)
    finally:
        spark.conf.unset(ROW_LIMIT) if before is None else spark.conf.set(ROW_LIMIT, before)
        for view in views.values():
            spark.catalog.dropTempView(view)


def manifest(rows: DataFrame, fields: list[str], group: str, order: str, changes: dict[str, Column] | None = None,
             changed: Column | None = None, stride: int = 8, name: str = "merkle") -> DataFrame:
    """A row for each of ``rows``: the order column's value, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``changes`` gives other values for some fields; where ``changed`` is true
    the climb starts from the leaf of those values instead of the stored one.
    """
    leaf = leaf_digest(*[F.col(c) for c in fields])
    other = leaf_digest(*[(changes or {}).get(c, F.col(c)) for c in fields])
    start = F.when(F.coalesce(changed, F.lit(False)), other) if changed is not None else F.lit(None).cast("string")
    group_key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))
    leaves = staged(rows.select(F.col(order).alias("key"), group_key.alias("g"), leaf.alias("digest"), start.alias("changed")), f"{name}-leaves")
    nodes = numbered(leaves, ["key", "digest"], name).select(
        "g", "idx", "n", "digest", F.struct("key", F.coalesce("changed", "digest").alias("start")).alias("item"))
    first, upper, subroots = tree(nodes, 0, stride, name)
    subroots = staged(subroots, f"{name}-subroots")
    tops = staged(numbered(subroots.select(F.lit("").alias("g"), F.col("g").alias("of"), F.col("digest").alias("digest")), ["of", "digest"], f"{name}-top"),
                  f"{name}-tops")
    top_first, top_upper, root = tree(tops.select("g", "idx", "n", "digest", F.lit(None).cast("string").alias("item")), TOP, stride, f"{name}-top")
    root = root.select("digest").first()
    root = F.lit(root[0] if root else None).cast("string")

    # the root of a group's tree links to its place in the tree of group roots, if that has several
    over = tops.where("n > 1").select(F.col("of").alias("g"), F.col("idx").alias("top_idx"))

    def linked(step: DataFrame) -> DataFrame:
        inner = step.where("to_step IS NOT NULL")
        ends = step.where("to_step IS NULL").drop("to_step", "to_g", "to_idx").join(over, "g", "left")
        return inner.unionByName(ends.select("*", F.when(F.col("top_idx").isNotNull(), F.lit(TOP)).alias("to_step"),
                                             F.when(F.col("top_idx").isNotNull(), F.lit("")).alias("to_g"), F.col("top_idx").alias("to_idx")).drop("top_idx"))

    above = [linked(s) for s in upper] + [top_first, *top_upper]
    steps = above[0].drop("item", "digest")
    for s in above[1:]:
        steps = steps.unionByName(s.drop("item", "digest"))
    climbed = climb(linked(first), staged(steps, f"{name}-nodes"), f"{name}-climb")
    of_group = tops.select(F.col("of").alias("g"), F.col("digest").alias("subroot"))
    return climbed.join(of_group, "g").select(
        F.col("item.key").alias(order), "leaf", "subroot", root.alias("root"), F.sha2(F.lower(F.hex("siblings")), 256).alias("proof_sha256"),
        F.col("folded").alias("folded_root"), (F.col("folded") == root).alias("verified"))


def op12_recursive_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of all documents by language; one more is added to n_chars where 7 divides the crc32 of doc_id."""
    one_more = F.expr("cast(n_chars AS decimal(38, 0)) + 1")
    return manifest(table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id",
                    {"n_chars": one_more}, F.crc32(F.col("doc_id").cast("string")) % 7 == 0)


_CRC_BYTE = ("list_reduce([CAST(xor(c & 255, b) AS BIGINT)] || range(8), lambda v, k: "
             "CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)")
_FIELD = "coalesce(octet_length(encode(CAST({0} AS VARCHAR))) || ':' || CAST({0} AS VARCHAR), '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "{n_chars}", "text")) + ")"


def _levels(base: str, name: str) -> str:
    """Recursive levels over ``base`` (g, idx, n, digest), one step at a time."""
    return f"""{name} AS (
  SELECT g, 0 AS level, idx, n, digest FROM {base}
  UNION ALL
  SELECT g, level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx)) FROM {name} WHERE n > 1 GROUP BY g, level, idx // 2, n)"""


OP12_SQL = f"""
WITH RECURSIVE base AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS g, {_LEAF.format(n_chars='n_chars')} AS digest,
         CASE WHEN xor(list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
                         lambda c, b: xor(c >> 8, {_CRC_BYTE})), 4294967295) % 7 = 0
              THEN {_LEAF.format(n_chars='(n_chars + 1)')} END AS other
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, digest) - 1 AS idx, count(*) OVER (PARTITION BY g) AS n FROM base),
{_levels('leaves', 'nodes')},
tops AS (
  SELECT '' AS g, g AS of, digest, row_number() OVER (ORDER BY g) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1),
{_levels('tops', 'top_nodes')},
climb AS (
  SELECT doc_id, g AS of, g, digest AS leaf, coalesce(other, digest) AS folded, '' AS siblings, 0 AS level, idx, n, false AS in_top FROM leaves
  UNION ALL
  SELECT c.doc_id, c.of, c.g,
         c.leaf, CASE WHEN c.n > 1 THEN sha256(CASE WHEN c.idx % 2 = 1 THEN s.digest || c.folded ELSE c.folded || coalesce(s.digest, '') END) ELSE c.folded END,
         c.siblings || coalesce(s.digest, ''), CASE WHEN c.n > 1 THEN c.level + 1 ELSE 0 END,
         CASE WHEN c.n > 1 THEN c.idx // 2 ELSE t.idx END, CASE WHEN c.n > 1 THEN (c.n + 1) // 2 ELSE t.n END, c.in_top OR c.n = 1
  FROM climb c
  LEFT JOIN (SELECT false AS in_top, * FROM nodes UNION ALL SELECT true, * FROM top_nodes) s
    ON c.n > 1 AND s.in_top = c.in_top AND s.g = CASE WHEN c.in_top THEN '' ELSE c.of END AND s.level = c.level AND s.idx = xor(c.idx, 1)
  LEFT JOIN tops t ON c.n = 1 AND t.of = c.of
  WHERE c.n > 1 OR NOT c.in_top)
SELECT c.doc_id, c.leaf, t.digest AS subroot, r.digest AS root, sha256(c.siblings) AS proof_sha256, c.folded AS folded_root, c.folded = r.digest AS verified
FROM climb c JOIN tops t USING (of) CROSS JOIN (SELECT digest FROM top_nodes WHERE n = 1) r
WHERE c.in_top AND c.n = 1"""
