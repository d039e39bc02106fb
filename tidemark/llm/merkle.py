"""Merkle manifest of a dataset by time-forward processing.

A node's label is (level, number). Every node sends its digest forward to its parent through
a priority queue ordered by label, so a parent meets all its children at once; a reversed
sweep sends each node the siblings on its way to the root, down to the leaves.

The trees are cut into aligned blocks of ``ARITY ** BLOCK_LEVELS`` nodes. Inside a block the
queue is a heap of bounded size. Between blocks the queue is external: block roots are the
messages, and a shuffle by (tree, block) delivers them to the next layer, and the proof
suffixes back. A tree with most of all leaves is therefore many equal groups, and a lost
executor repeats single blocks.
"""

from __future__ import annotations

import hashlib
import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import load, written

ARITY = 3
BLOCK_LEVELS = 7  # 2187 nodes a block

PROOF = "array<struct<left:string,right:string>>"
_NODE = ["_tree", "_place", "_size", "_digest"]


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# ---- one block


def forward(digests: list[str], levels: int, arity: int = ARITY) -> list[list[str]]:
    """Digests of every level of a block, leaves first. Nodes come off the queue in label
    order; all children of a node lie next to each other in it."""
    known = [digests]
    queue = [(1, i // arity, i % arity, d) for i, d in enumerate(digests)] if levels else []
    heapq.heapify(queue)
    while queue:
        level, node, _, digest = heapq.heappop(queue)
        children = [digest]
        while queue and queue[0][:2] == (level, node):
            children.append(heapq.heappop(queue)[3])
        parent = sha256_hex("".join(children))
        if node == 0:
            known.append([])
        known[level].append(parent)
        if level < levels:
            heapq.heappush(queue, (level + 1, node // arity, node % arity, parent))
    return known


def backward(known: list[list[str]], suffix: list[dict], arity: int = ARITY) -> list[list[dict]]:
    """The proof of every leaf: per level the digests left and right of the node on the way.
    The reversed sweep takes labels from the root down and hands each child the suffix of
    its parent with the child's own siblings in front."""
    proofs: list[list[dict]] = [[] for _ in known[0]]
    queue = [(1 - len(known), 0, suffix)]
    while queue:
        level, node, onward = heapq.heappop(queue)
        if level == 0:
            proofs[node] = onward
            continue
        below = known[-level - 1]
        children = below[node * arity : (node + 1) * arity]
        for slot in range(len(children)):
            siblings = {"left": "".join(children[:slot]), "right": "".join(children[slot + 1 :])}
            heapq.heappush(queue, (level + 1, node * arity + slot, [siblings, *onward]))
    return proofs


def levels_of(size: int, arity: int, block_levels: int) -> int:
    """Levels that a block of a tree of ``size`` nodes adds: all up to the root where the
    tree is one block, else every level of a block, however few nodes the last one has."""
    levels = 0
    while levels < block_levels and arity**levels < size:
        levels += 1
    return levels


# ---- layers of blocks


def placed(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """Add ``_place`` (from 0 by ``order``, nulls first) and ``_size`` of each ``tree``.

    Rows are cut by range of (tree, order), numbered inside (tree, cut), and the counts of
    the cuts give the number at which each one begins; no task holds a large tree. Equal
    rows are cut as well: their order makes no difference."""
    known = rows.withColumn("_any", F.monotonically_increasing_id())
    ranges = known.repartitionByRange(tree, *order, "_any").withColumn("_cut", F.spark_partition_id())
    cut = written(ranges, "merkle-order")
    counts = cut.groupBy(tree, "_cut").agg(F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy(tree)
    before = whole.orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        tree, "_cut", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"), F.sum("_rows").over(whole).alias("_size")
    )
    inside = Window.partitionBy(tree, "_cut").orderBy(*order, "_any")
    numbered = cut.withColumn("_inside", F.row_number().over(inside) - 1).join(starts, [tree, "_cut"])
    place = (F.col("_start") + F.col("_inside")).cast("long").alias("_place")
    return numbered.select(*rows.columns, place, F.col("_size").cast("long").alias("_size"))


class MerkleTrees:
    """One tree for each ``_tree`` of ``nodes`` (``_tree``, ``_place``, ``_size``,
    ``_digest`` and any other columns), reduced layer by layer."""

    def __init__(self, nodes: DataFrame, arity: int = ARITY, block_levels: int = BLOCK_LEVELS):
        self.arity, self.block_levels = arity, block_levels
        self.width = arity**block_levels
        self.layers = [written(self._with_block(nodes), "merkle-nodes")]
        self.ups: list[DataFrame] = []
        largest = self.layers[0].agg(F.max("_size")).first()[0] or 0
        while True:
            up = written(self._reduced(self.layers[-1]), "merkle-roots")
            self.ups.append(up)
            if largest <= self.width:
                break
            largest = -(-largest // self.width)
            self.layers.append(self._with_block(up.where("NOT _done").select(*_NODE)))

    def _with_block(self, nodes: DataFrame) -> DataFrame:
        return nodes.withColumn("_block", F.floor(F.col("_place") / self.width).cast("long"))

    def _reduced(self, nodes: DataFrame) -> DataFrame:
        arity, block_levels, width = self.arity, self.block_levels, self.width
        schema = "_tree string, _place long, _size long, _digest string, _done boolean"

        def reduce(table: pa.Table) -> pa.Table:
            table = table.sort_by("_place")
            size = table["_size"][0].as_py()
            known = forward(table["_digest"].to_pylist(), levels_of(size, arity, block_levels), arity)
            out = [table["_tree"][0].as_py()], [table["_block"][0].as_py()], [-(-size // width)], [known[-1][0]], [size <= width]
            return pa.table([pa.array(c) for c in out], ["_tree", "_place", "_size", "_digest", "_done"])

        return nodes.select(*_NODE, "_block").groupBy("_tree", "_block").applyInArrow(reduce, schema)

    def roots(self) -> DataFrame:
        """``_tree`` and ``_digest`` of its root."""
        out = None
        for up in self.ups:
            done = up.where("_done").select("_tree", "_digest")
            out = done if out is None else out.unionByName(done)
        return out

    def proofs(self, heads: DataFrame) -> DataFrame:
        """The nodes with ``_roots`` and ``_proof``. ``heads`` says for each ``_tree`` which
        ``_roots`` lie above it and the ``_proof`` that leads from its own root to them."""
        down = None
        for layer, up in zip(reversed(self.layers), reversed(self.ups), strict=True):
            ended = up.where("_done").select("_tree", F.lit(0).cast("long").alias("_block"), "_digest")
            tops = ended.join(heads, "_tree").select(
                "_tree", "_block", F.concat(F.array("_digest"), F.col("_roots")).alias("_roots"), "_proof"
            )
            if down is not None:
                tops = tops.unionByName(down.select("_tree", F.col("_place").alias("_block"), "_roots", "_proof"))
            down = self._swept(layer, tops)
        return down

    def _swept(self, nodes: DataFrame, tops: DataFrame) -> DataFrame:
        arity, block_levels = self.arity, self.block_levels
        from pyspark.sql.pandas.types import to_arrow_schema

        kept = [f for f in nodes.schema.fields if f.name != "_block"]
        tail = T._parse_datatype_string(f"_roots array<string>, _proof {PROOF}")
        schema = T.StructType(kept + tail.fields)
        arrow = to_arrow_schema(schema)

        def sweep(block: pa.Table, top: pa.Table) -> pa.Table:
            if not block.num_rows:
                return arrow.empty_table()
            block = block.sort_by("_place")
            levels = levels_of(block["_size"][0].as_py(), arity, block_levels)
            known = forward(block["_digest"].to_pylist(), levels, arity)
            proofs = backward(known, top["_proof"][0].as_py(), arity)
            roots = [top["_roots"][0].as_py()] * block.num_rows
            rest = [pa.array(roots, arrow.field("_roots").type), pa.array(proofs, arrow.field("_proof").type)]
            columns = [block[f.name].cast(arrow.field(f.name).type) for f in kept]
            return pa.table(columns + rest, schema=arrow)

        keys = ["_tree", "_block"]
        return nodes.groupBy(*keys).cogroup(tops.groupBy(*keys)).applyInArrow(sweep, schema)


# ---- rows as leaves


def field_text(column: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = column.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*[field_text(c) for c in columns]), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to, in SQL expressions."""
    return F.aggregate(proof, leaf, lambda at, s: F.sha2(F.concat(s["left"], at, s["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def manifest(
    docs: DataFrame,
    columns: list[str],
    id_col: str = "doc_id",
    group_col: str = "source",
    claims: dict[str, Column] | None = None,
    arity: int = ARITY,
    block_levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """One row per input row: ``id_col``, ``group_col``, ``leaf``, ``place`` in its group's
    tree, ``subroot``, ``root``, ``proof`` and the columns of ``claims`` (computed from the
    row in the same pass, for example the digest of a row that somebody presents).

    The rows of each ``group_col`` make one tree in the order of ``id_col``; the roots of
    these, in the order of the groups, make the tree above them.

    Null values in any column count as ``-``; a null group is a group of its own and the
    first; null ids come first in their group, repeated ids in the order of their digests,
    and repeated rows are separate leaves with equal digests. Texts of any length are hashed
    whole. An empty table has no rows and no root. Columns not named are ignored, so names
    cannot clash.
    """
    claims = claims or {}
    tree = F.when(F.col(group_col).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col(group_col).cast("string")))
    leaves = docs.select(
        F.col(id_col).alias("_id"),
        F.col(group_col).alias("_group"),
        tree.alias("_tree"),
        leaf_digest([F.col(c) for c in columns]).alias("_digest"),
        *[c.alias(f"_claim_{name}") for name, c in claims.items()],
    )
    leaves = written(leaves, "merkle-leaves")
    groups = MerkleTrees(placed(leaves, "_tree", ["_id", "_digest"]), arity, block_levels)
    subroots = groups.roots().select(F.col("_tree").alias("_name"), F.lit("").alias("_tree"), "_digest")
    above = MerkleTrees(placed(subroots, "_tree", ["_name"]), arity, block_levels)
    start = docs.sparkSession.range(1).select(
        F.lit("").alias("_tree"), F.array().cast("array<string>").alias("_roots"), F.array().cast(PROOF).alias("_proof")
    )
    heads = above.proofs(start).select(F.col("_name").alias("_tree"), "_roots", "_proof")
    found = groups.proofs(heads)
    return found.select(
        F.col("_id").alias(id_col),
        F.col("_group").alias(group_col),
        F.col("_digest").alias("leaf"),
        F.col("_place").alias("place"),
        F.col("_roots")[0].alias("subroot"),
        F.col("_roots")[1].alias("root"),
        F.col("_proof").alias("proof"),
        *[F.col(f"_claim_{name}").alias(name) for name in claims],
    )


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def op11_merkle_manifest(spark, directory):
    """Leaves, roots and proofs of all documents, and whether rows that lost their line
    ends still lead to the root. A row without an id is not tampered with."""
    docs = load(spark, directory, "documents")
    changed = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    cleaned = F.when(changed, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    presented = leaf_digest([cleaned if c == "text" else F.col(c) for c in COLUMNS])
    found = manifest(docs, COLUMNS, claims={"presented": presented})
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("proof")).alias("proof_sha256"),
        fold(F.col("presented"), F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {"op11_merkle_manifest": op11_merkle_manifest}

# ---- checking SQL

# CRC-32 of a short ASCII text: polynomial 0xEDB88320, from a table of 256 entries.
CRC32_TABLE_SQL = """list_transform(range(256), lambda i: list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
  lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))"""


def crc32_sql(text: str, table: str) -> str:
    """Unsigned CRC-32 of an ASCII expression; ``table`` names a list of 256 entries."""
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    step = f"lambda c, x: xor(c // 256, {table}[CAST(xor(c % 256, x) AS INTEGER) + 1])"
    return f"xor(list_reduce(list_concat([4294967295], {codes}), {step}), 4294967295)"


def _field_sql(name: str, value: str | None = None) -> str:
    text = value or f"CAST({name} AS VARCHAR)"
    return f"CASE WHEN {name} IS NULL THEN '-' ELSE concat(strlen({text}), ':', {text}) END"


def _tree_sql(name: str, leaves: str, tree: str, levels: int) -> str:
    """CTEs ``<name>_0`` (tree, place, digest) to ``<name>_<levels>``, each level from the one
    below; a tree of one node stays as it is."""
    parts = [f"{name}_0 AS (SELECT {tree} AS tree, place, digest, count(*) OVER (PARTITION BY {tree}) AS n FROM {leaves})"]
    for k in range(1, levels + 1):
        parts.append(
            f"{name}_{k} AS (SELECT tree, place // 3 AS place, CASE WHEN n = 1 THEN max(digest) ELSE sha256(string_agg(digest, '' ORDER BY place)) END AS digest,"
            f" max((n + 2) // 3) AS n FROM {name}_{k - 1} GROUP BY tree, place // 3, n)"
        )
    return ",\n".join(parts)


def _fold_sql(name: str, source: str, tree: str, levels: int, tables: str) -> str:
    """CTEs ``<name>_0`` .. that add, level by level, the siblings to ``path`` and fold ``here``."""
    parts = [f"{name}_0 AS (SELECT * FROM {source})"]
    for k in range(levels):
        run = f"(SELECT tree, place // 3 AS run, n, list(digest ORDER BY place) AS ds FROM {tables}_{k} GROUP BY ALL)"
        parts.append(
            f"""{name}_{k + 1} AS (SELECT f.* EXCLUDE (path, here, {tree}_place), {tree}_place // 3 AS {tree}_place,
  CASE WHEN r.n = 1 THEN path ELSE path || array_to_string(list_filter(r.ds, lambda d, i: i <> {tree}_place % 3 + 1), '') END AS path,
  CASE WHEN r.n = 1 THEN here ELSE sha256(array_to_string(list_transform(r.ds, lambda d, i: CASE WHEN i = {tree}_place % 3 + 1 THEN here ELSE d END), '')) END AS here
  FROM {name}_{k} f JOIN {run} r ON r.tree = f.{tree} AND r.run = {tree}_place // 3)"""
        )
    return ",\n".join(parts)


_LEVELS = 12  # 3 ** 12 rows a source
_TOP_LEVELS = 8

ORACLES = {
    "op11_merkle_manifest": f"""
WITH crc AS (SELECT {CRC32_TABLE_SQL} AS entries),
cleaned AS (SELECT d.*, CASE WHEN {crc32_sql("CAST(doc_id AS VARCHAR)", "entries")} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS other FROM documents d, crc),
hashed AS (SELECT doc_id, CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS source,
  sha256({" || ".join(_field_sql(c) for c in COLUMNS)}) AS digest,
  sha256({" || ".join(_field_sql(c, "other" if c == "text" else None) for c in COLUMNS)}) AS presented FROM cleaned),
leaves AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, digest) - 1 AS place FROM hashed),
{_tree_sql("low", "leaves", "source", _LEVELS)},
subroots AS (SELECT tree AS source, digest, row_number() OVER (ORDER BY encode(tree)) - 1 AS place FROM low_{_LEVELS}),
{_tree_sql("top", "(SELECT '' AS whole, * FROM subroots)", "whole", _TOP_LEVELS)},
start AS (SELECT doc_id, l.source, l.digest AS leaf, s.digest AS subroot, (SELECT digest FROM top_{_TOP_LEVELS}) AS root, l.place AS source_place, s.place AS whole_place,
  '' AS whole, '' AS path, presented AS here FROM leaves l JOIN subroots s USING (source)),
{_fold_sql("up", "start", "source", _LEVELS, "low")},
{_fold_sql("over", f"up_{_LEVELS}", "whole", _TOP_LEVELS, "top")}
SELECT doc_id, leaf, subroot, root, sha256(path) AS proof_sha256, here AS folded_root, here = root AS verified FROM over_{_TOP_LEVELS}
"""
}
