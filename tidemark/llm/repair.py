"""Conversation structure repair by weighted interval parsing.

A sound conversation is ``(s?(ua)+)?`` over the initials of its roles. The repair grammar has
one nonterminal (p, q) for "these rows lead from state p to state q" and is in Chomsky normal
form: (p, q) -> (p, r) (r, q), or one row that is kept, given another role or deleted, or an
inserted row without input. Insertions are closed around every row first, so the chart needs
no empty spans. A cell holds the least (cost, audit) of its span, and spans are combined
bottom-up by length.

Equal cost and equal rows mean that no audit is a proper prefix of another (an insertion
costs), so the least audit of two halves is the least of the whole and cells may be joined.
That lets a long conversation be parsed in blocks whose cells are parsed again as terminals.

Rows are reduced to (turn, role, digest of the row, flags, count) before they are ordered, and
the order is cut by range, so the turns of one conversation may lie in many tasks. Texts move
once, to be written out beside their audit.
"""

from __future__ import annotations

import functools
import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import load, written
from tidemark.llm.merkle import CRC32_TABLE_SQL, crc32_sql

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
ROLE_NAMES = {"u": "user", "a": "assistant"}

# States: 0 nothing yet, 1 after s, 2 after u, 3 after a. A role initial leads on:
START, AFTER_S, AFTER_U, AFTER_A = range(4)
LEADS = {"s": [(START, AFTER_S)], "u": [(START, AFTER_U), (AFTER_S, AFTER_U), (AFTER_A, AFTER_U)], "a": [(AFTER_U, AFTER_A)]}
FINAL = [(START, START), (START, AFTER_A)]

# One row for the grammar: role initial (o for any other), upper case if truncated; x must go.
GONE = "x"
BLOCK_ROWS = 16

BLANKS = " \t\n\x0b\x0c\r"
STOPS = (".", "!", "?")

Cells = dict[tuple[int, int], tuple[int, str]]


# ---- the chart


def _joined(left: Cells, right: Cells, into: Cells) -> None:
    """Binary rules: (p, q) -> (p, r) (r, q), the least (cost, audit) of each."""
    for (p, r), (cost, audit) in left.items():
        for (s, q), (more, rest) in right.items():
            if r == s:
                whole = (cost + more, audit + rest)
                if (p, q) not in into or whole < into[p, q]:
                    into[p, q] = whole


def _insertions() -> Cells:
    """Least insertions that lead from p to q without a row, by closure over the rules."""
    cells: Cells = {(p, p): (0, "") for p in range(4)}
    for name in ROLE_NAMES:
        cells |= {lead: (INSERT_COST, INSERT) for lead in LEADS[name]}
    while True:
        closed = dict(cells)
        _joined(cells, cells, closed)
        if closed == cells:
            return cells
        cells = closed


INSERTED = _insertions()


@functools.lru_cache(maxsize=None)
def terminal(symbol: str) -> Cells:
    """Cells of one row with any insertions around it. There are nine symbols."""
    cells: Cells = {(p, p): (DELETE_COST, DELETE) for p in range(4)}
    if symbol != GONE:
        extra = TRUNCATED_COST if symbol.isupper() else 0
        for initial, leads in LEADS.items():
            if initial == symbol.lower():
                edit = (extra, KEEP)
            elif initial in ROLE_NAMES:
                edit = (REROLE_COST + extra, REROLE)
            else:
                continue
            for lead in leads:
                cells[lead] = min(edit, cells.get(lead, edit))
    before: Cells = {}
    _joined(INSERTED, cells, before)
    around: Cells = {}
    _joined(before, INSERTED, around)
    return around


def chart(spans: list[Cells]) -> Cells:
    """Cells of the whole, combined bottom-up by span length over every split."""
    n = len(spans)
    table = {(i, i + 1): cells for i, cells in enumerate(spans)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            cells: Cells = {}
            for k in range(i + 1, i + length):
                _joined(table[i, k], table[k, i + length], cells)
            table[i, i + length] = cells
    return table[0, n] if n else INSERTED


@functools.lru_cache(maxsize=4096)
def _block(symbols: str) -> Cells:
    return chart([terminal(s) for s in symbols])


def combine(parts: list[Cells]) -> Cells:
    """Neighbouring spans of any number, a bounded chart at a time."""
    while len(parts) > 1:
        parts = [chart(parts[i : i + BLOCK_ROWS]) for i in range(0, len(parts), BLOCK_ROWS)]
    return parts[0] if parts else INSERTED


def parse(symbols: str) -> Cells:
    return combine([_block(symbols[i : i + BLOCK_ROWS]) for i in range(0, len(symbols), BLOCK_ROWS)])


def cheapest(cells: Cells) -> tuple[int, str]:
    return min(cells[span] for span in FINAL if span in cells)


class Writer:
    """Repaired rows of one conversation while its rows pass: ``role:text`` by line."""

    def __init__(self, audit: str):
        self.edits = iter(audit)
        self.state = START
        self.digest = hashlib.sha256()
        self.lines = 0

    def _line(self, role: str, text: str) -> None:
        self.digest.update(("\n" if self.lines else "").encode() + role.encode() + b":" + text.encode())
        self.lines += 1

    def _step(self) -> str:
        """Initial of the next role and the state after it, where it is not a system row."""
        initial = "a" if self.state == AFTER_U else "u"
        self.state = AFTER_A if initial == "a" else AFTER_U
        return initial

    def row(self, role: str, text: str) -> None:
        edit = next(self.edits)
        while edit == INSERT:
            self._line(ROLE_NAMES[self._step()], "")
            edit = next(self.edits)
        if edit == DELETE:
            return
        if edit == KEEP and self.state == START and role[:1] == "s":
            self.state = AFTER_S
            self._line(role, text)
            return
        initial = self._step()
        self._line(role if edit == KEEP else ROLE_NAMES[initial], text)

    def end(self) -> str:
        for edit in self.edits:
            if edit != INSERT:
                raise ValueError("the audit has more edits than the conversation has rows")
            self._line(ROLE_NAMES[self._step()], "")
        return self.digest.hexdigest()


# ---- conversations as tables

# One segment: the turns of one conversation that lie in one task, in order.
COUNTS = "blank long, duplicate long, truncated long, illegal long, turns long"
EDGES = "low long, high long, first_initial string, last_initial string"
CELLS = "cells array<struct<p:int,q:int,cost:long,audit:string>>"
SEGMENT = f"key string, part int, seq int, edge boolean, rows long, {COUNTS}, {EDGES}, {CELLS}"
LEGAL = {"su", "ua", "au"}


class _Segment:
    def __init__(self, key: str):
        self.key = key
        self.symbols: list[str] = []
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.first = self.last = None

    def add(self, turn, role: str, copies: int, is_first: bool, blank: bool, truncated: bool) -> None:
        if not copies:
            return
        initial = role[:1]
        if self.rows:
            self.illegal += self.last + initial not in LEGAL
        else:
            self.first = initial
        self.illegal += copies - 1
        self.last = initial
        self.rows += copies
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        again = copies - 1 if is_first else copies
        if blank:
            self.blank += copies
            self.symbols.append(GONE * copies)
            return
        self.duplicate += again
        if is_first:
            self.truncated += truncated
            symbol = initial if initial in LEADS else "o"
            self.symbols.append(symbol.upper() if truncated else symbol)
        self.symbols.append(GONE * again)

    def row(self, part: int, seq: int, edge: bool) -> dict:
        cells = parse("".join(self.symbols))
        packed = [{"p": p, "q": q, "cost": c, "audit": a} for (p, q), (c, a) in cells.items()]
        return {
            "key": self.key, "part": part, "seq": seq, "edge": edge, "rows": self.rows,
            "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated,
            "illegal": self.illegal, "turns": self.turns, "low": self.low, "high": self.high,
            "first_initial": self.first, "last_initial": self.last, "cells": packed,
        }


def _summary(segments: list[dict]) -> dict:
    """Counts, cost and audit of a conversation from its segments in order."""
    held = [s for s in segments if s["rows"]]
    out = {name: sum(s[name] for s in held) for name in ("blank", "duplicate", "truncated", "illegal")}
    for left, right in zip(held, held[1:]):
        out["illegal"] += left["last_initial"] + right["first_initial"] not in LEGAL
    turned = [s for s in held if s["low"] is not None]
    turns = sum(s["turns"] for s in turned) - sum(a["high"] == b["low"] for a, b in zip(turned, turned[1:]))
    out["gaps"] = turned[-1]["high"] - turned[0]["low"] + 1 - turns if turned else 0
    cells = combine([{(c["p"], c["q"]): (c["cost"], c["audit"]) for c in s["cells"]} for s in held])
    out["cost"], out["audit"] = cheapest(cells)
    return {"key": segments[0]["key"], **out}


SUMMARY = "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def key_of(column: Column) -> Column:
    return F.when(column.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), column.cast("string")))


def row_digest(role: Column, text: Column) -> Column:
    return F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))


def _reduced(rows: DataFrame) -> DataFrame:
    """Distinct (conversation, turn, role, text) with copies, flags and whether it is the
    first of its role and text in the conversation."""
    last = F.rtrim(F.col("text"), F.lit(BLANKS))
    distinct = rows.select(
        "key", "turn", "role", "copies",
        F.when(F.col("copies") > 0, row_digest(F.col("role"), F.col("text"))).otherwise(F.lit("")).alias("digest"),
        (last == "").alias("blank"),
        (~F.right(last, F.lit(1)).isin(*STOPS)).alias("truncated"),
    ).groupBy("key", "turn", "role", "digest", "blank", "truncated").agg(F.sum("copies").alias("copies"))
    # A null turn comes first: a struct of (turn is known, turn) orders like that.
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("at"))
    firsts = distinct.groupBy("key", "digest").agg(F.min(place).alias("_first"))
    return distinct.join(firsts, ["key", "digest"]).withColumn("is_first", F.col("_first") == place).drop("_first")


def summaries(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """``rows`` (key, turn, role, text, copies; nothing but turn may be null; a row of no
    copies only names its conversation) to one row of counts, cost and audit for each key."""
    order = ["key", "turn", "role", "digest"]
    cut = _reduced(rows).repartitionByRange(*([partitions] if partitions else []), *order).sortWithinPartitions(*order)
    names = ["key", "turn", "role", "copies", "is_first", "blank", "truncated"]
    schema = _arrow(SEGMENT, rows)

    def segments(batches):
        part = TaskContext.get().partitionId()
        now, seq, out = None, 0, []
        for batch in batches:
            for key, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or key != now.key:
                    if now is not None:
                        out.append(now.row(part, seq, seq == 0))
                        seq += 1
                    now = _Segment(key)
                now.add(*row)
            if len(out) >= 256:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        if now is not None:
            out.append(now.row(part, seq, True))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    # Only the first and the last conversation of a task may have rows in another one.
    found = written(cut.select(*names).mapInArrow(segments, SEGMENT), "repair-segments")
    summary = _arrow(SUMMARY, rows)

    def alone(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pylist([_summary([s]) for s in batch.to_pylist()], schema=summary)

    def together(table: pa.Table) -> pa.Table:
        ordered = sorted(table.to_pylist(), key=lambda s: (s["part"], s["seq"]))
        return pa.Table.from_pylist([_summary(ordered)], schema=summary)

    inner = found.where("NOT edge").mapInArrow(alone, SUMMARY)
    edges = found.where("edge").groupBy("key").applyInArrow(together, SUMMARY)
    return inner.unionByName(edges)


def _arrow(ddl: str, df: DataFrame) -> pa.Schema:
    from tidemark.llm.common import arrow_schema

    return arrow_schema(ddl, df.sparkSession)


def repair(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    copies: Column | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """One row per conversation: ``conv_col``, ``gaps``, ``blank``, ``duplicate``,
    ``truncated``, ``illegal``, ``cost``, ``audit``, ``repaired_sha256``. ``copies`` says how
    often a row stands in its conversation (by default once; 0 keeps only its name).

    Rows are ordered by turn, nulls first, equal turns by role and digest of the row; equal
    rows stand side by side and all but the first are duplicates. A null role or text counts
    as one space, which is blank as a text and no role; a null conversation id is one
    conversation. An empty table has no rows; a conversation without rows has zeros, an empty
    audit and the digest of no bytes. Texts of any length stay whole: they are read once by
    the task that writes out their conversation, row by row, and only the audit is held. The
    audit and a digest are of one conversation, so its last pass is one task, whatever its
    length; parsing and counting are not. Columns not named are ignored.
    """
    known = rows.select(
        key_of(F.col(conv_col)).alias("key"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(role_col, F.lit(" ")).alias("role"),
        F.coalesce(text_col, F.lit(" ")).alias("text"),
        (F.lit(1) if copies is None else copies).cast("long").alias("copies"),
    )
    # What a row without copies holds does not matter.
    empty = F.col("copies") == 0
    known = known.withColumns(
        {"turn": F.when(~empty, F.col("turn")), "role": F.when(empty, F.lit("")).otherwise(F.col("role")),
         "text": F.when(empty, F.lit("")).otherwise(F.col("text"))}
    )
    audits = summaries(known, partitions)
    counts = [f.strip().split()[0] for f in SUMMARY.split(",")[1:]]
    none = F.lit(None)
    heads = audits.select(
        "key", F.lit(0).alias("kind"), none.cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("digest"),
        F.lit("").alias("text"), F.lit(0).cast("long").alias("copies"), F.struct(*counts).alias("found"),
    )
    texts = known.where("copies > 0").select(
        "key", F.lit(1).alias("kind"), "turn", "role", row_digest(F.col("role"), F.col("text")).alias("digest"),
        "text", "copies", none.cast(heads.schema["found"].dataType).alias("found"),
    )
    order = ["key", "kind", "turn", "role", "digest"]
    lined = heads.unionByName(texts).repartition("key").sortWithinPartitions(*order)
    result = f"{SUMMARY}, repaired_sha256 string"
    schema = _arrow(result, rows)

    def write(batches):
        now, head, out = None, None, []
        for batch in batches:
            for key, role, text, times, found in zip(*(c.to_pylist() for c in batch.columns)):
                if found is not None:
                    if head is not None:
                        out.append({**head, "repaired_sha256": now.end()})
                    now, head = Writer(found["audit"]), {"key": key, **found}
                    continue
                for _ in range(times):
                    now.row(role, text)
            if len(out) >= 256:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        if head is not None:
            out.append({**head, "repaired_sha256": now.end()})
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    done = lined.select("key", "role", "text", "copies", "found").mapInArrow(write, result)
    conv = F.when(F.col("key") != "0", F.substring("key", 2, 2**31 - 1)).cast(rows.schema[conv_col].dataType)
    return done.select(conv.alias(conv_col), *counts, "repaired_sha256")


# ---- the query


def damaged(rows: DataFrame) -> tuple[DataFrame, Column]:
    """The rows with the faults of the contract, and how often each one stands there."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(name.cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    out = rows.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"), text.alias("text"), kind.alias("_kind")
    )
    copies = F.when(F.col("_kind") == 0, F.lit(0)).when(F.col("_kind") == 3, F.lit(2)).otherwise(F.lit(1))
    return out, copies


def op12_conversation_repair(spark, directory):
    """All conversations after damage, with their faults and cheapest repair."""
    rows, copies = damaged(load(spark, directory, "conversations"))
    return repair(rows, copies=copies)


QUERIES = {"op12_conversation_repair": op12_conversation_repair}

_BLANK_CLASS = r"\x20\x09-\x0D"

ORACLES = {
    "op12_conversation_repair": f"""
WITH RECURSIVE crc AS (SELECT {CRC32_TABLE_SQL} AS entries),
numbered AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {crc32_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')", "entries")} % 20 AS kind FROM conversations, crc),
changed AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
  CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM numbered),
ordered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(strlen(role) || ':' || role || text), copy) AS pos FROM changed),
flagged AS (SELECT *, regexp_replace(text, '[{_BLANK_CLASS}]+$', '') AS body, min(pos) OVER (PARTITION BY conv_id, role, text) < pos AS seen,
  lag(substring(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || substring(role, 1, 1) AS pair FROM ordered),
faults AS (SELECT *, CASE WHEN body = '' THEN 'blank' WHEN seen THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM flagged),
moves(role, p, q) AS (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)),
-- inserted rows before an edit: from, to, cost, letters, lines
gaps(p, q, cost, audit, lines) AS (
  VALUES (0, 0, 0, '', []), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []), (0, 2, 3, 'I', ['user:']), (1, 2, 3, 'I', ['user:']), (3, 2, 3, 'I', ['user:']),
  (2, 3, 3, 'I', ['assistant:']), (0, 3, 6, 'II', ['user:', 'assistant:']), (1, 3, 6, 'II', ['user:', 'assistant:'])),
edits AS (
  SELECT conv_id, pos, p, p AS q, 4 AS cost, 'D' AS audit, [] AS lines FROM faults, (SELECT unnest(range(4)) AS p) s
  UNION ALL SELECT conv_id, pos, p, q, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END, 'K', [f.role || ':' || text]
    FROM faults f JOIN moves m ON m.role = substring(f.role, 1, 1) WHERE fault NOT IN ('blank', 'duplicate')
  UNION ALL SELECT conv_id, pos, p, q, 3 + CASE fault WHEN 'truncated' THEN 3 ELSE 0 END, 'R', [CASE m.role WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text]
    FROM faults f, moves m WHERE m.role <> 's' AND fault NOT IN ('blank', 'duplicate')),
walk AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS pos, 0 AS state, 0 AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS lines FROM conversations
  UNION ALL
  SELECT conv_id, pos, state, best.cost, best.audit, best.lines FROM (
    SELECT w.conv_id, e.pos, e.q AS state, min({{'cost': w.cost + g.cost + e.cost, 'audit': w.audit || g.audit || e.audit, 'lines': w.lines || g.lines || e.lines}}) AS best
    FROM walk w JOIN gaps g ON g.p = w.state JOIN edits e ON e.conv_id IS NOT DISTINCT FROM w.conv_id AND e.pos = w.pos + 1 AND e.p = g.q GROUP BY ALL) x),
sizes AS (SELECT conv_id, max(turn) AS high, min(turn) AS low, count(DISTINCT turn) AS turns, count(*) AS n, count(*) FILTER (fault = 'blank') AS blank,
  count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id),
ends AS (SELECT w.conv_id, min({{'cost': w.cost + g.cost, 'audit': w.audit || g.audit, 'lines': w.lines || g.lines}}) AS best
  FROM walk w JOIN gaps g ON g.p = w.state AND g.q IN (0, 3) LEFT JOIN sizes s ON s.conv_id IS NOT DISTINCT FROM w.conv_id WHERE w.pos = coalesce(s.n, 0) GROUP BY w.conv_id)
SELECT e.conv_id, coalesce(high - low + 1 - turns, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, best.cost::BIGINT AS cost, best.audit AS audit, sha256(array_to_string(best.lines, chr(10))) AS repaired_sha256
FROM ends e LEFT JOIN sizes s ON s.conv_id IS NOT DISTINCT FROM e.conv_id
"""
}
