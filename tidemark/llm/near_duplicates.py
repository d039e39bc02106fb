"""Near-duplicate documents by a chosen-path set similarity join.

Every document is a set of word shingles. A tree branches documents by minwise tokens: at
the root one coordinate is chosen per tree, and documents with the same minimum there share
a node. Nodes with few documents are compared exhaustively; a larger node chooses, by its
own hash, one or two further coordinates, and its documents branch again. Independent trees
repeat, and what no level divides is compared in blocks. Links are confirmed on the full
sets, and components are found with distributed label passing.

The trees find most links cheaply but may miss some, above all in crowds. An exact join
completes them: two sets at the threshold share some shingles among the first ones of both,
in any common order of shingles, so documents of different components that share as many
there, and that no bound on the intersection parts, are compared on their full sets.

Documents with equal sets stand for each other, so copies never meet in a node.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_schema, chunks_of_bytes, load, mix, scratch, word_hashes, written
from tidemark.llm.components import components

WORDS = 5
THRESHOLD = 0.8
TREES = 12  # a pair at 0.8 misses all first-level nodes with chance 0.2 ** 12
DEPTH = 4  # levels of branching below which a node is compared in blocks
FURTHER = 24  # coordinates from which deeper nodes choose
COORDINATES = TREES + FURTHER
NODE_LIMIT = 64  # documents that are compared exhaustively
HUBS = 4  # documents that all blocks of an undivided node have in common
# The exact join puts shingles that many documents have last in the order. Which ones are
# known to be such decides how many documents meet, never what is found.
COMMON_SHINGLES = 1_000_000
SEEN_OFTEN = 3  # minwise tokens that are this shingle
SIGNATURE_WORDS = 8  # 64 parities of shingles each
NEEDED = 32  # a set of n shingles asks a partner for 1 + n // NEEDED of its first ones
SALTED = 1000  # documents with one shingle that are met by one task

_SEEDS = mix(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_XOR, _FACTOR = _SEEDS[:COORDINATES], _SEEDS[COORDINATES:] | np.uint64(1)
_INVERSE = np.array([pow(int(f), -1, 1 << 64) for f in _FACTOR], np.uint64)
_WORD_FACTOR = np.uint64(0xA0761D6478BD642F)


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the shingles of each text (A-Z lower-cased); fewer
    words than ``width`` are one shingle, no words none."""
    raw = [(t or "").encode().lower() for t in texts]
    out: list[np.ndarray] = []
    for first, last in chunks_of_bytes(raw):
        words, begins = word_hashes(raw[first:last])
        rolled = np.zeros(max(0, len(words) - width + 1), np.uint64)
        for i in range(width):
            rolled = rolled * _WORD_FACTOR + words[i : i + len(rolled)]
        rolled = mix(rolled)
        for a, b in zip(begins[:-1], begins[1:]):
            if b - a >= width:
                out.append(np.unique(rolled[a : b - width + 1]))
            elif b > a:
                own = np.full(1, b - a, np.uint64)
                for i in range(a, b):
                    own = own * _WORD_FACTOR + words[i : i + 1]
                out.append(mix(own))
            else:
                out.append(np.empty(0, np.uint64))
    return out


def minimums(sets: list[np.ndarray]) -> np.ndarray:
    """Minwise tokens of every set: one row of coordinates each; sets are not empty."""
    joined = np.concatenate(sets)
    begins = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), COORDINATES), np.uint64)
    for c in range(COORDINATES):
        out[:, c] = np.minimum.reduceat((joined ^ _XOR[c]) * _FACTOR[c], begins)
    return out


def sketches(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``n_shingles``, ``digest`` of the set and ``tokens``, its minwise tokens."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_shingles long, digest binary, tokens array<long>"
    target = arrow_schema(schema, docs.sparkSession)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            sets = shingle_sets(batch.column(1).to_pylist(), width)
            full = [s for s in sets if len(s)]
            values = minimums(full).view(np.int64).ravel() if full else np.empty(0, np.int64)
            sizes = np.array([len(s) for s in sets], np.int64)
            ends = np.concatenate([[0], np.cumsum((sizes > 0) * COORDINATES)]).astype(np.int32)
            tokens = pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            columns = [batch.column(0), pa.array(sizes), pa.array(digests, pa.binary()), tokens.cast(target.field("tokens").type)]
            yield pa.RecordBatch.from_arrays(columns, schema=target)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def node_members(sets: DataFrame) -> DataFrame:
    """Groups of documents to compare: ``members``, sorted ids of the documents of one small
    node, or of one block of a node that no level divides; each group once. Rows carry ids
    alone until a node is known to branch."""
    groups = None
    level = sets.select("id", F.posexplode(F.slice("tokens", 1, TREES)).alias("tree", "token")).select(
        "id", F.xxhash64("tree", "token").alias("node")
    )
    for depth in range(1, DEPTH + 1):
        counts = level.groupBy("node").agg(F.count(F.lit(1)).alias("rows"))
        counts = written(counts.where("rows > 1"), f"nodes-{depth}")
        shared = level.join(counts.hint("merge"), "node")
        shared = written(shared, f"level-{depth}")
        small = shared.where(F.col("rows") <= NODE_LIMIT).groupBy("node").agg(F.array_sort(F.collect_list("id")).alias("members"))
        small = small.select("members")
        groups = small if groups is None else groups.union(small)
        large = shared.where(F.col("rows") > NODE_LIMIT)
        if depth == 1:
            large = large.join(sets.select("id", "tokens"), "id")
        if depth < DEPTH:
            # A node chooses one further coordinate, and every fourth node a second.
            first = F.pmod(F.xxhash64("node"), F.lit(FURTHER))
            second = F.pmod(first + 1 + F.pmod(F.xxhash64("node", F.lit(1)), F.lit(FURTHER - 1)), F.lit(FURTHER))
            chosen = F.when(F.pmod(F.xxhash64("node", F.lit(2)), F.lit(4)) == 0, F.array(first, second)).otherwise(F.array(first))
            token = F.element_at("tokens", (F.col("at") + TREES + 1).cast("int"))
            level = written(
                large.withColumn("at", F.explode(chosen)).select("id", "tokens", F.xxhash64("node", "at", token).alias("node")),
                f"branches-{depth}",
            )
    # What is still together is alike: blocks that share some documents.
    hubs = large.groupBy("node").agg(
        *[F.min(F.struct(F.xxhash64("id", F.lit(h)).alias("place"), "id")).alias(f"hub{h}") for h in range(HUBS)]
    )
    hubs = written(hubs.select("node", F.array(*[f"hub{h}.id" for h in range(HUBS)]).alias("hubs")), "hubs")
    block = F.pmod(F.xxhash64("id", "node"), F.ceil(F.col("rows") / (NODE_LIMIT - HUBS)))
    blocks = (
        large.withColumn("block", block)
        .groupBy("node", "block")
        .agg(F.collect_list("id").alias("members"))
        .join(hubs, "node")
        .select(F.array_sort(F.array_distinct(F.concat("members", "hubs"))).alias("members"))
    )
    return groups.union(blocks).distinct()


def likely_groups(groups: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """``members``: sorted ids of documents that may be linked, each group once. Members
    whose minwise tokens agree too little with all others are left out: a pair at the
    threshold agrees less than this with a chance under one in ten million."""
    schema = f"members {groups.schema['members'].dataType.simpleString()}"
    target = arrow_schema(schema, groups.sparkSession)
    deviation = (COORDINATES * threshold * (1 - threshold)) ** 0.5
    least = int(COORDINATES * threshold - 5.5 * deviation)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            members = batch.column(0)
            flat, begins = members.flatten(), members.offsets.to_numpy() - members.offsets[0].as_py()
            ids, lists = flat.field("id").to_pylist(), flat.field("tokens")
            tokens = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, COORDINATES)
            for a, b in zip(begins[:-1], begins[1:]):
                own = tokens[a:b]
                root = list(range(b - a))
                for i in range(b - a):
                    for j in np.flatnonzero((own[i + 1 :] == own[i]).sum(axis=1) >= least) + i + 1:
                        _union(root, i, int(j))
                parts: dict[int, list] = {}
                for i in range(b - a):
                    parts.setdefault(_find(root, i), []).append(ids[a + i])
                out += [sorted(p) for p in parts.values() if len(p) > 1]
            yield pa.RecordBatch.from_arrays([pa.array(out, target.field(0).type)], schema=target)

    named = written(groups.withColumn("group", F.xxhash64("members")), "nodes")
    full = named.select("group", F.explode("members").alias("id")).join(sets.select("id", "tokens").hint("merge"), "id")
    gathered = full.groupBy("group").agg(F.collect_list(F.struct("id", "tokens")).alias("members"))
    return gathered.select("members").mapInArrow(run, schema).distinct()


def _find(root: list[int], i: int) -> int:
    while root[i] != i:
        root[i] = root[root[i]]
        i = root[i]
    return i


def _union(root: list[int], i: int, j: int) -> None:
    i, j = _find(root, i), _find(root, j)
    if i != j:
        root[max(i, j)] = min(i, j)


def confirmed_links(groups: DataFrame, docs: DataFrame, sets: DataFrame, width: int, threshold: float, id_col: str, text_col: str) -> DataFrame:
    """``a``, ``b``: links that join the linked documents of every group, by intersection
    and union of the full sets. Only texts of documents in a group are read again."""
    groups = written(groups.withColumn("group", F.xxhash64("members")), "groups")
    wanted = groups.select("group", F.explode("members").alias("id"))
    kind = docs.schema[id_col].dataType.simpleString()
    digest = sets.select("id", "digest").join(wanted.select("id").distinct(), "id", "left_semi")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # The same join at every size: texts move once, and only those of a group go on.
    texts = texts.join(written(digest, "wanted").hint("merge"), "id")
    schema = f"id {kind}, shingles binary"
    target = arrow_schema(schema, docs.sparkSession)

    def whole(batches):
        import pyarrow as pa

        for batch in batches:
            sets = shingle_sets(batch["text"].to_pylist(), width)
            rows = [
                (key, s.tobytes())
                for key, s, d in zip(batch["id"].to_pylist(), sets, batch["digest"].to_pylist())
                if hashlib.blake2b(s.tobytes(), digest_size=16).digest() == d
            ]
            columns = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(target)]
            yield pa.RecordBatch.from_arrays(columns, schema=target)

    full = written(texts.mapInArrow(whole, schema).dropDuplicates(["id"]), "sets")
    percent = round(100 * threshold)
    linked = arrow_schema(f"a {kind}, b {kind}", docs.sparkSession)

    def compare(table):
        import pyarrow as pa

        ids = table["id"].to_pylist()
        order = sorted(range(len(ids)), key=ids.__getitem__)
        own = [np.frombuffer(table["shingles"][i].as_py(), np.uint64) for i in order]
        root, out = list(range(len(ids))), []
        for i in range(len(own)):
            for j in range(i + 1, len(own)):
                small, large = sorted((len(own[i]), len(own[j])))
                if 100 * small < percent * large or _find(root, i) == _find(root, j):
                    continue
                both = len(np.intersect1d(own[i], own[j], assume_unique=True))
                if 100 * both >= percent * (small + large - both):
                    _union(root, i, j)
                    out.append((ids[order[i]], ids[order[j]]))
        columns = [pa.array([r[k] for r in out], f.type) for k, f in enumerate(linked)]
        return pa.Table.from_arrays(columns, schema=linked)

    return wanted.join(full, "id").select("group", "id", "shingles").groupBy("group").applyInArrow(compare, f"a {kind}, b {kind}").distinct()


def common_shingles(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that the minwise tokens, a sample of each set, show most often, sorted, and
    how often they were seen; at most ``COMMON_SHINGLES``. They decide the order in which
    the exact join looks at shingles, not what it finds."""
    target = arrow_schema("shingle long", sets.sparkSession)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            tokens = batch.column(0).flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, COORDINATES)
            yield pa.RecordBatch.from_arrays([pa.array(((tokens * _INVERSE) ^ _XOR).view(np.int64).ravel())], schema=target)

    seen = sets.select("tokens").mapInArrow(run, "shingle long").groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    seen = written(seen.where(F.col("n") >= SEEN_OFTEN), "seen-shingles")
    # How often one must be seen so that few enough are: from counts of counts, in steps of a
    # sixteenth of a power of two. No task sorts or holds the shingles.
    step = F.floor(F.log2("n") * 16).cast("long")
    left, least = COMMON_SHINGLES, None
    for row in sorted(seen.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("rows")).collect(), reverse=True):
        left -= row["rows"]
        if left < 0:
            break
        least = row["step"]
    found = (seen.where(step >= least) if least is not None else seen.limit(0)).toPandas()
    shingles, n = found["shingle"].to_numpy(np.int64).view(np.uint64), found["n"].to_numpy(np.int64)
    order = np.argsort(shingles)
    return shingles[order], n[order]


def first_shingles(docs: DataFrame, sets: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``digest``, ``size``, ``signature`` and ``first``: so many shingles, rare ones
    first, that two sets at the threshold have as many of them in common as the smaller
    asks for."""
    shared = docs.sparkSession.sparkContext.broadcast(common_shingles(sets))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, digest binary, size long, signature array<long>, first array<long>"
    target = arrow_schema(schema, docs.sparkSession)

    def run(batches):
        import pyarrow as pa

        common, seen = shared.value
        for batch in batches:
            rows = []
            for key, own in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1).to_pylist(), width)):
                if key is None or not len(own):
                    continue
                often = np.zeros(len(own), np.int64)
                if len(common):
                    at = np.minimum(np.searchsorted(common, own), len(common) - 1)
                    often = np.where(common[at] == own, seen[at], 0)
                # At least ceil(percent of n) are common; the k-th of them has so many behind it.
                first = own[np.lexsort((own, often))[: len(own) - -(-percent * len(own) // 100) + 1 + len(own) // NEEDED]]
                # Parities of the shingles that fall on each bit.
                odd = np.bincount((own >> np.uint64(20)).astype(np.int64) % (64 * SIGNATURE_WORDS), minlength=64 * SIGNATURE_WORDS) & 1
                signature = np.packbits(odd.astype(np.uint8)).view(np.int64)
                rows.append((key, hashlib.blake2b(own.tobytes(), digest_size=16).digest(), len(own), signature, first.view(np.int64)))
            columns = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(target)]
            yield pa.RecordBatch.from_arrays(columns, schema=target)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def possible_pairs(firsts: DataFrame, percent: int) -> DataFrame:
    """``a``, ``b``: keys of sets of different components that share enough of their first
    shingles and may be at the threshold by their sizes, the places of these shingles and
    their signatures. ``firsts`` has ``key``, ``component``, ``size``, ``signature``, ``first``."""
    rows = firsts.select("key", "component", "size", F.posexplode("first").alias("place", "shingle"))
    counts = rows.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("rows"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    counts = written(counts.where("low <> high").select("shingle", "rows"), "shared-shingles")
    words = [F.col("signature")[i].alias(f"s{i}") for i in range(SIGNATURE_WORDS)]
    signatures = firsts.select("key", *words)
    near = written(rows.join(counts.hint("merge"), "shingle").join(signatures.hint("merge"), "key"), "near")
    # One shingle of many documents is met by several tasks: each takes a part of one side.
    parts = F.ceil(F.col("rows") / SALTED).cast("int")
    left = near.withColumn("part", F.pmod(F.xxhash64("key"), parts).cast("int"))
    right = near.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    a, b = left.alias("a"), right.alias("b")
    both = F.col("a.size") + F.col("b.size")
    apart = sum((F.bit_count(F.col(f"a.s{i}").bitwiseXOR(F.col(f"b.s{i}"))) for i in range(SIGNATURE_WORDS)), F.lit(0))
    needed = F.lit(1) + F.floor(F.least("a.size", "b.size") / NEEDED)
    alike = needed + F.least(F.col("a.size") - F.col("a.place"), F.col("b.size") - F.col("b.place")) - 1
    meet = (
        (F.col("a.shingle") == F.col("b.shingle"))
        & (F.col("a.part") == F.col("b.part"))
        & (F.col("a.key") < F.col("b.key"))
        & (F.col("a.component") != F.col("b.component"))
        & (100 * F.least("a.size", "b.size") >= percent * F.greatest("a.size", "b.size"))
        & (alike * (100 + percent) >= percent * both)
        & ((both - apart) * (100 + percent) >= 2 * percent * both)
    )
    met = a.join(b.hint("merge"), meet).select(F.col("a.key").alias("a"), F.col("b.key").alias("b"), needed.alias("needed"))
    return met.groupBy("a", "b", "needed").agg(F.count(F.lit(1)).alias("n")).where("n >= needed").select("a", "b")


def missed_links(docs: DataFrame, sets: DataFrame, found: DataFrame, width: int, threshold: float, id_col: str, text_col: str) -> DataFrame:
    """``a``, ``b``: every link between documents of different components of ``found``."""
    percent = round(100 * threshold)
    kind = docs.schema[id_col].dataType.simpleString()
    named = sets.select("id", "digest").join(found, F.col("id") == F.col("node"), "left")
    named = named.select("id", "digest", F.xxhash64("digest").alias("key"), F.coalesce("component", "id").alias("component"))
    named = written(named, "named")
    firsts = first_shingles(docs, sets, width, percent, id_col, text_col).dropDuplicates(["id", "digest"])
    firsts = written(firsts.join(named, ["id", "digest"]).select("key", "component", "size", "signature", "first"), "firsts")
    pairs = written(possible_pairs(firsts, percent), "pairs")
    wanted = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
    wanted = written(named.join(wanted, "key").select("id", "digest", "key"), "wanted")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(wanted.hint("merge"), "id")
    schema = f"id {kind}, key long, digest binary, shingles binary"
    target = arrow_schema(schema, docs.sparkSession)

    def whole(batches):
        import pyarrow as pa

        for batch in batches:
            own = [s.tobytes() for s in shingle_sets(batch["text"].to_pylist(), width)]
            rows = [
                (key, place, d, s)
                for key, place, d, s in zip(batch["id"].to_pylist(), batch["key"].to_pylist(), batch["digest"].to_pylist(), own)
                if hashlib.blake2b(s, digest_size=16).digest() == d
            ]
            columns = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(target)]
            yield pa.RecordBatch.from_arrays(columns, schema=target)

    full = written(texts.mapInArrow(whole, schema).dropDuplicates(["digest"]), "whole-sets").drop("digest")
    linked = arrow_schema(f"a {kind}, b {kind}", docs.sparkSession)

    def compare(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for a, b, s, t in zip(*(batch[name].to_pylist() for name in ("a", "b", "of_a", "of_b"))):
                s, t = np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)
                both = len(np.intersect1d(s, t, assume_unique=True))
                if 100 * both >= percent * (len(s) + len(t) - both):
                    out.append((a, b))
            columns = [pa.array([r[k] for r in out], f.type) for k, f in enumerate(linked)]
            yield pa.RecordBatch.from_arrays(columns, schema=linked)

    of_a = full.select(F.col("key").alias("key_a"), F.col("id").alias("a"), F.col("shingles").alias("of_a"))
    of_b = full.select(F.col("key").alias("key_b"), F.col("id").alias("b"), F.col("shingles").alias("of_b"))
    met = pairs.select(F.col("a").alias("key_a"), F.col("b").alias("key_b")).join(of_a, "key_a").join(of_b, "key_b")
    return met.select("a", "b", "of_a", "of_b").mapInArrow(compare, f"a {kind}, b {kind}").distinct()


def near_duplicates(
    docs: DataFrame, width: int = WORDS, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: ``id_col``, ``n_shingles``, ``component_id``, ``kept``.

    Documents without words are linked with nothing. Rows of one id count as one document:
    if their texts differ, the links of each hold for both. Rows with a null id are linked
    with nothing and kept; their ``component_id`` is null. An empty table gives no rows;
    other columns are ignored, whatever their names.
    """
    rows = written(sketches(docs, width, id_col, text_col), "sketches")
    full = rows.where("id is not null and n_shingles > 0")
    sets = full.groupBy("digest").agg(F.min(F.struct("id", "tokens")).alias("first"))
    sets = written(sets.select("digest", "first.*"), "sets-of-documents")
    spark = docs.sparkSession
    with scratch(spark) as keep:
        groups = likely_groups(node_members(sets), sets, threshold)
        links = confirmed_links(groups, docs, sets, width, threshold, id_col, text_col)
        copies = rows.select("id", "digest").join(sets.select("digest", F.col("id").alias("first")), "digest")
        own = copies.where("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b"))
        found = keep(components(links.union(own.distinct())))
    with scratch(spark) as keep:
        missed = keep(written(missed_links(docs, sets, found, width, threshold, id_col, text_col), "missed"))
    known = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
    found = components(known.union(missed)) if missed.limit(1).count() else found
    joined = rows.join(found, F.col("id") == F.col("node"), "left")
    component = F.coalesce("component", "id")
    return joined.select(
        F.col("id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def op3_near_duplicates(spark, directory):
    """Components of documents whose sets of four-word shingles are alike to 0.8."""
    return near_duplicates(load(spark, directory, "documents"), width=4)


QUERIES = {"op3_near_duplicates": op3_near_duplicates}

ORACLES = {
    "op3_near_duplicates": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 3], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0) x),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * shared >= 80 * (na.n + nb.n - shared)),
reach AS (
  SELECT doc_id AS node, doc_id AS seen FROM d
  UNION
  SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.seen)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT node AS doc_id, min(seen) AS component_id FROM reach GROUP BY node) c LEFT JOIN n USING (doc_id)
"""
}
