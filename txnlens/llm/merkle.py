"""A Merkle manifest of a dataset, whose trees are climbed by lag and lead windows.

A leaf is the hash of a row's fields. Per group, leaves stand in order of their
key; every FANOUT consecutive nodes become the hash of their digests, until one is
left, the group's subroot. Subroots, in order of their group, make the root the
same way. A row's path holds the digests beside its own on every level; with them,
the root can be computed again from the leaf alone.

A node lives in the row of its first leaf. So on level l, nodes stand FANOUT^l rows
apart, and a lag or lead by that many rows, masked by the node's slot in its run and
by the run's length, supplies a sibling; the rows of first children hash the parents.
Runs never cross the border of a block of FANOUT^LEVELS leaves, so a window holds one
block, however large the group is. The blocks' tops are the leaves of the next climb,
and paths are handed down from there, block by block.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnlens.llm.common import id_remainder, materialize, positions, table

FANOUT = 2
#: Rows of a block, at most.
BLOCK_ROWS = 4096
#: The fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hex sha256 of texts put together."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` if null, else the number of UTF-8 bytes, ``:`` and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(columns: Sequence[str | Column] = FIELDS) -> Column:
    return digest(*[field(F.col(c) if isinstance(c, str) else c) for c in columns])


def tree_of(group: Column) -> Column:
    """A text without nulls that sorts as groups do: null first, then by UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the digests beside it lead to."""
    return F.aggregate(path, leaf, lambda mine, x: digest(x["before"], mine, x["after"]))


def proof(path: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda x: F.concat(x["before"], x["after"])), ""))


def levels_of(fanout: int) -> int:
    """Levels that a block has at most."""
    levels = 1
    while fanout ** (levels + 1) <= BLOCK_ROWS:
        levels += 1
    return levels


def climb(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """``nodes`` with ``block``, the ``path`` of each up to its block's top, and that ``top``.

    ``nodes`` has tree, at (place in the tree's level), n (nodes of that level) and node (digest).
    """
    at, n = F.col("at"), F.col("n")
    block = Window.partitionBy("tree", "block").orderBy("at")
    rows = nodes.withColumns({"block": F.floor(at / fanout**levels), "node_0": F.col("node")})
    sizes = []
    for level in range(levels):
        step, mine = fanout**level, f"node_{level}"
        beside = {}
        for i in range(1, fanout):
            beside[f"lag_{i}"] = F.lag(mine, i * step).over(block)
            beside[f"lead_{i}"] = F.lead(mine, i * step).over(block)
        size = F.floor((n + (step - 1)) / step)
        index = F.floor(at / step)
        slot = index % fanout
        run = F.least(F.lit(fanout), size - (index - slot))
        before = F.concat_ws("", *[F.when(slot >= i, F.col(f"lag_{i}")) for i in range(fanout - 1, 0, -1)])
        after = F.concat_ws("", *[F.when(slot + i < run, F.col(f"lead_{i}")) for i in range(1, fanout)])
        side = F.when((at % step == 0) & (size > 1), F.struct(before.alias("before"), after.alias("after")))
        rows = rows.withColumns(beside).withColumn(f"side_{level}", side).drop(*beside)
        parent = F.when(size > 1, digest(F.col(mine), F.col(f"side_{level}.after"))).otherwise(F.col(mine))
        rows = rows.withColumn(f"node_{level + 1}", F.when(at % (step * fanout) == 0, parent)).drop(mine)
        sizes.append(size)
    upto = block.rowsBetween(Window.unboundedPreceding, 0)
    sides = [F.last(f"side_{level}", ignorenulls=True).over(upto) for level in range(levels)]
    rows = rows.withColumns({f"side_{i}": side for i, side in enumerate(sides)} | {"top": F.first(f"node_{levels}").over(upto)})
    listed = F.filter(F.array(*[F.col(f"side_{i}") for i in range(levels)]), lambda x: x.isNotNull())
    return rows.select(*nodes.columns, "block", listed.cast(PATH).alias("path"), "top")


def grow(spark: SparkSession, nodes: DataFrame, fanout: int, crown: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``nodes`` with the ``path`` of each, and what ``crown`` says of its tree.

    ``crown`` gets the trees' tops (tree, top), a row each, and returns tree, path (from the top on) and other columns.
    """
    levels = levels_of(fanout)
    rows = fanout**levels
    climbed = []
    while True:
        climbed.append(materialize(spark, climb(nodes, fanout, levels), "merkle-nodes"))
        firsts = climbed[-1].filter(F.col("at") % rows == 0)
        nodes = firsts.select("tree", F.col("block").alias("at"), F.floor((F.col("n") + (rows - 1)) / rows).alias("n"), F.col("top").alias("node"))
        if nodes.filter("n > 1").isEmpty():
            break
    above = crown(nodes.select("tree", F.col("node").alias("top")))
    said = [c for c in above.columns if c not in ("tree", "path")]
    above = above.withColumn("at", F.lit(0).cast("long"))
    for level in reversed(climbed):
        here = above.select("tree", F.col("at").alias("block"), F.col("path").alias("rest"), *said)
        above = level.drop("top").join(here, ["tree", "block"]).withColumn("path", F.concat("path", "rest")).drop("rest")
    return above.drop("block", "at", "n")


def manifest(leaves: DataFrame, *, fanout: int = FANOUT) -> DataFrame:
    """``leaves`` with their ``path``, ``subroot`` and ``root``; a row per row.

    ``leaves`` has tree (see ``tree_of``), key and node (the leaf's digest), other columns are kept but may not be
    named as those that are made here (at, n, block, top, path, subroot, root). Leaves of a tree ascend by key,
    null keys first, those of one key by their digest; equal leaves stand side by side and each has its own path.
    An empty table has no root and gives no rows.
    """
    if not 2 <= fanout <= BLOCK_ROWS:
        raise ValueError(f"a node has from 2 to {BLOCK_ROWS} children")
    taken = {"at", "n", "block", "top", "path", "subroot", "root", "rest"} & {c.lower() for c in leaves.columns}
    if taken:
        raise ValueError(f"columns of leaves can't be named {sorted(taken)}")
    spark = leaves.sparkSession

    def of_tree(tops: DataFrame) -> DataFrame:
        """Paths of subroots: a tree of trees."""
        subroots = tops.select(F.col("tree").alias("key"), F.col("top").alias("node"), F.lit("").alias("tree"))
        subroots = positions(subroots, ["tree"], ["key"])
        root = grow(spark, subroots, fanout, lambda top: top.select("tree", F.array().cast(PATH).alias("path"), F.col("top").alias("root")))
        return root.select(F.col("key").alias("tree"), "path", F.col("node").alias("subroot"), "root")

    return grow(spark, positions(leaves, ["tree"], ["key", "node"]), fanout, of_tree)


def dataset_leaves(docs: DataFrame, *, key: str = "doc_id", group: str = "lang", fields=FIELDS, **more: Column) -> DataFrame:
    """The leaves of a table's rows, written once so that texts are read once; nulls in any field are ``-``."""
    made = docs.select(tree_of(F.col(group)).alias("tree"), F.col(key).alias("key"), leaf_of(fields).alias("node"), *[c.alias(n) for n, c in more.items()])
    return materialize(docs.sparkSession, made, "merkle-leaves")


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's proof, and whether the row still leads to the root where some rows were changed."""
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    changed = F.when(id_remainder("doc_id", 7) == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    changed = leaf_of([changed if c == "n_chars" else c for c in FIELDS])
    proved = manifest(dataset_leaves(docs, changed=changed))
    folded = proved.withColumns({"proof_sha256": proof(F.col("path")), "folded_root": fold(F.col("changed"), F.col("path"))})
    return folded.select(
        F.col("key").alias("doc_id"), F.col("node").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def crc_sql(text: str) -> str:
    """crc32 of an ASCII text; needs the table ``crc_table`` (one row, ``t``: a list of 256 numbers)."""
    byte = f"CAST(ascii(substr({text}, CAST(i AS INTEGER), 1)) AS BIGINT)"
    bytes_ = f"list_transform(range(1, length({text}) + 1), lambda i: {byte})"
    step = "xor(c >> 8, t[CAST(xor(c & 255, b) AS INTEGER) + 1])"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bytes_}), lambda c, b: {step}), 4294967295)"


CRC_TABLE_SQL = """
crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""


def oracle(fanout: int = FANOUT) -> str:
    def leaf(n_chars: str) -> str:
        parts = [n_chars if c == "n_chars" else c for c in FIELDS]
        each = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in parts]
        return f"sha256({' || '.join(each)})"

    def tree(name: str) -> str:
        """Nodes of all levels."""
        return f"""
{name}_nodes AS (
  SELECT tree, 0 AS level, pos, n, h FROM {name}
  UNION ALL
  SELECT tree, level + 1, pos // {fanout}, (n + {fanout - 1}) // {fanout}, sha256(string_agg(h, '' ORDER BY pos))
  FROM {name}_nodes WHERE n > 1 GROUP BY tree, level, n, pos // {fanout}),
{name}_sides AS (
  SELECT a.tree, a.level, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS before,
         coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS after
  FROM {name}_nodes a JOIN {name}_nodes b ON a.tree = b.tree AND a.level = b.level AND a.pos // {fanout} = b.pos // {fanout}
  WHERE a.n > 1 GROUP BY a.tree, a.level, a.pos),
{name}_paths AS (
  SELECT l.tree, l.pos, coalesce(list(struct_pack(before := s.before, after := s.after) ORDER BY s.level) FILTER (s.level IS NOT NULL), []) AS path
  FROM {name} l LEFT JOIN {name}_sides s ON s.tree = l.tree AND s.pos = l.pos // CAST(pow({fanout}, s.level) AS BIGINT)
  GROUP BY l.tree, l.pos)"""

    return f"""WITH RECURSIVE {CRC_TABLE_SQL.strip()},
leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {leaf('n_chars')} AS h,
         CASE WHEN {crc_sql("coalesce(CAST(doc_id AS VARCHAR), '')")} % 7 = 0 THEN {leaf('(n_chars + 1)')} ELSE {leaf('n_chars')} END AS changed
  FROM documents, crc_table),
low AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
  FROM leaves),{tree('low')},
tops AS (SELECT tree AS of_tree, h FROM low_nodes WHERE n = 1),
high AS (SELECT '' AS tree, of_tree, h, row_number() OVER (ORDER BY of_tree) - 1 AS pos, count(*) OVER () AS n FROM tops),{tree('high')},
proved AS (
  SELECT l.doc_id, l.h AS leaf, l.changed, h.h AS subroot, (SELECT h FROM high_nodes WHERE n = 1) AS root, list_concat(p.path, q.path) AS path
  FROM low l JOIN low_paths p ON p.tree = l.tree AND p.pos = l.pos
  JOIN high h ON h.of_tree = l.tree JOIN high_paths q ON q.pos = h.pos),
folded AS (
  SELECT *, list_reduce(list_prepend(struct_pack(before := '', h := changed, after := ''),
         list_transform(path, lambda x: struct_pack(before := x.before, h := '', after := x.after))),
         lambda a, x: struct_pack(before := '', h := sha256(x.before || a.h || x.after), after := '')).h AS folded_root
  FROM proved)
SELECT doc_id, leaf, subroot, root, sha256(list_aggregate(list_prepend('', list_transform(path, lambda x: x.before || x.after)), 'string_agg', '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM folded"""
