"""Conversation structure repair (11): weighted CYK interval parsing.

A conversation's turns, in order, are parsed against a repair grammar in
Chomsky normal form whose language is the legal role sequences
``(s?(ua)+)?``.  A nonterminal X_pq derives a span of turns that leads from
state p (nothing yet, after s, after u, after a) to state q; its rules are
X_pq -> X_pr X_rq, and a single turn derives X_pq by Keep, Rerole or Delete.
The insertion closure adds inserted turns on both sides of a turn.  A cell
holds the least (cost, audit) per nonterminal, and cells are combined
bottom-up by span length: 1, 2, 4, ... turns.  Since X_pq -> X_pr X_rq exists
for every r, each cut of a span derives the same cell, so one cut per span is
enough (``table`` fills all spans with all cuts; tests compare the two).
Two audits of equal cost over the same turns are never prefixes of each
other, so the least of a concatenation is made of the least of its parts.

Spans of ``block`` turns are parsed in tasks of their own and their cells
combined ``fan`` at a time in further rounds, so a conversation of any length
spreads over tasks; what remains per conversation is its audit, which the
result holds anyway.  The walk along the audit streams the turns in order and
keeps one turn in memory.

Defined cases: a null role or text counts as one space; a null id is a
conversation of its own; null turns stand first; rows of equal turn stand by
role, then text (64 characters, then a hash); equal rows are repeats.  No rows: no conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, drop, only, tune
from .order import prefix_sums

#: states: 0 nothing yet, 1 after s, 2 after u, 3 after a; what an output role leads to
STEP = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
#: nonterminals: state pairs that a span can lead between
PAIRS = [(0, 0), (0, 1), (0, 2), (0, 3), (1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (3, 2), (3, 3)]
INDEX = {pq: i for i, pq in enumerate(PAIRS)}
#: binary rules by left side: (index of X_pr, index of X_rq)
RULES = [[(INDEX[p, r], INDEX[r, q]) for r in range(4) if (p, r) in INDEX and (r, q) in INDEX] for p, q in PAIRS]
WHITE = " \t\n\x0b\x0c\r"
Cell = tuple  # per nonterminal: (cost, audit) or None


@dataclass(frozen=True)
class Costs:
    """Edit costs; a truncated turn that stays adds ``truncated``."""
    rerole: int = 2
    delete: int = 3
    insert: int = 2
    truncated: int = 1
    block: int = 1024   # turns of a span that one task parses
    fan: int = 32       # cells combined at a time


# --- grammar -------------------------------------------------------------------------------

def combine(x: Cell, y: Cell) -> Cell:
    """The cell of two adjoining spans: per rule the sum of costs and the joined audits, the least of them."""
    out = []
    for rules in RULES:
        best = None
        for a, b in rules:
            if x[a] is None or y[b] is None:
                continue
            cost = x[a][0] + y[b][0]
            if best is None or cost <= best[0]:
                got = (cost, x[a][1] + y[b][1])
                best = got if best is None else min(best, got)
        out.append(best)
    return tuple(out)


def _insertions(c: Costs) -> Cell:
    """Cells of the empty span: the cheapest inserted turns between two states."""
    out = [(0, "") if p == q else None for p, q in PAIRS]
    for i, (p, q) in enumerate(PAIRS):
        at, n = p, 0
        while p != q and n < 4 and at != q:
            at, n = (STEP[at].get("u") or STEP[at].get("a")), n + 1
        if p != q and at == q:
            out[i] = (n * c.insert, "I" * n)
    return tuple(out)


@lru_cache(maxsize=256)
def leaf(symbol: str, c: Costs) -> Cell:
    """The cell of one turn, closed under insertions on both sides.

    ``symbol``: role initial s, u, a or o (any other), upper case if truncated; d must go.
    """
    role, more = symbol.lower(), c.truncated if symbol.isupper() else 0
    out: list = [None] * len(PAIRS)

    def offer(p: int, q: int, cost: int, audit: str) -> None:
        i = INDEX.get((p, q))
        if i is not None and (out[i] is None or (cost, audit) < out[i]):
            out[i] = (cost, audit)
    for p in range(4):
        offer(p, p, c.delete, "D")
        if symbol != "d":
            for to, q in STEP[p].items():
                if to == role:
                    offer(p, q, more, "K")
                elif to != "s":
                    offer(p, q, c.rerole + more, "R")
    gap = _insertions(c)
    return combine(combine(gap, tuple(out)), gap)


def parse(symbols: str, c: Costs) -> Cell:
    """The cell of a whole span, combined bottom-up by span length."""
    row = [leaf(s, c) for s in symbols]
    while len(row) > 1:
        row = [combine(row[i], row[i + 1]) if i + 1 < len(row) else row[i] for i in range(0, len(row), 2)]
    return row[0]


def table(symbols: str, c: Costs) -> Cell:
    """The same by the full table: all spans, all cuts. For tests."""
    n = len(symbols)
    t = {(i, i + 1): leaf(symbols[i], c) for i in range(n)}
    for size in range(2, n + 1):
        for i in range(n - size + 1):
            cells = [combine(t[i, k], t[k, i + size]) for k in range(i + 1, i + size)]
            t[i, i + size] = tuple(min((x[j] for x in cells if x[j] is not None), default=None) for j in range(len(PAIRS)))
    return t[0, n]


def verdict(cell: Cell) -> tuple[int, str]:
    """Least (cost, audit) of a legal sequence: nothing at all, or one that ends after an assistant."""
    return min(x for x in (cell[INDEX[0, 0]], cell[INDEX[0, 3]]) if x is not None)


# --- in tasks --------------------------------------------------------------------------------

CELLS = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))])
CELLS_SQL = "conv_id long, block long, costs array<long>, audits array<string>"


def _cells(conv, block, cells: list[Cell]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([conv, block, pa.array([[x and x[0] for x in c] for c in cells], CELLS.field(2).type),
                                       pa.array([[x and x[1] for x in c] for c in cells], CELLS.field(3).type)], schema=CELLS)


def _parse_blocks(c: Costs):
    def run(batches):
        short = lru_cache(maxsize=20_000)(lambda s: parse(s, c))
        for b in batches:
            yield _cells(b.column(0), b.column(1), [short(s) if len(s) <= 24 else parse(s, c) for s in b.column(2).to_pylist()])
    return run


def _combine_blocks(batches):
    for b in batches:
        out = []
        for parts in b.column(2).to_pylist():
            row = [tuple(None if k is None else (k, a) for k, a in zip(x["costs"], x["audits"], strict=True)) for x in parts]
            while len(row) > 1:
                row = [combine(row[i], row[i + 1]) if i + 1 < len(row) else row[i] for i in range(0, len(row), 2)]
            out.append(row[0])
        yield _cells(b.column(0), b.column(1), out)


def _verdicts(batches):
    for b in batches:
        best = [verdict(tuple(None if k is None else (k, a) for k, a in zip(x, y, strict=True)))
                for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x[0] for x in best], pa.int64()), pa.array([x[1] for x in best], pa.string())],
                                         names=["conv_id", "cost", "audit"])


class _Walk:
    """One conversation, turn by turn in order: what the audit makes of it, and its counts."""

    def __init__(self, conv, audit: str, cost: int):
        self.conv, self.audit, self.cost, self.at, self.prev = conv, audit, cost, 0, ""
        self.n = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.before, self.low, self.high, self.turns = None, None, None, 0

    def _fill(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            role = "assistant" if self.prev == "u" else "user"
            self.prev = role[0]
            yield "I", role, ""

    def turn(self, turn, role: str, text: str, fault: str | None) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of the turns that come out for this turn, inserted ones before it included."""
        if turn is not None and turn != self.high:  # turns come in order
            self.turns, self.low, self.high = self.turns + 1, turn if self.low is None else self.low, turn
        if fault:
            self.n[fault] += 1
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.n["illegal"] += 1
        self.before = role[:1]
        yield from self._fill()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            role = "assistant" if self.prev == "u" else "user"
        if edit != "D":
            self.prev = role[0]
            yield edit, role, text

    def end(self) -> Iterator[tuple[str, str, str]]:
        yield from self._fill()

    @property
    def gaps(self) -> int:
        return self.high - self.low + 1 - self.turns if self.turns else 0


def _walks(batches) -> Iterator[tuple[_Walk, tuple | None]]:
    """(walk, turn) for rows sorted by conversation, its verdict first; (walk, None) at a conversation's end."""
    walk = None
    for b in batches:
        for conv, pos, turn, role, text, fault, cost, audit in zip(*[c.to_pylist() for c in b.columns], strict=True):
            if pos < 0:
                if walk:
                    yield walk, None
                walk = _Walk(conv, audit, cost)
            else:
                yield walk, (turn, role, text, fault)
    if walk:
        yield walk, None


def _batched(rows: Iterator[tuple], schema: pa.Schema, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += 64 + sum(len(x) for x in r if isinstance(x, str))
        if size > most:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x, strict=True)) for x in held], schema=schema)
            held, size = [], 0
    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x, strict=True)) for x in held], schema=schema)


REPORT = pa.schema([("conv_id", pa.int64())] + [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
                   + [("audit", pa.string()), ("repaired_sha256", pa.string())])
REPORT_SQL = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
TURNS = pa.schema([("conv_id", pa.int64()), ("seq", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
TURNS_SQL = "conv_id long, seq long, edit string, role string, text string"


def _report(batches):
    def rows():
        sha, any_ = hashlib.sha256(), False
        for walk, turn in _walks(batches):
            for _, role, text in (walk.turn(*turn) if turn else walk.end()):
                sha.update(f"{chr(10) if any_ else ''}{role}:{text}".encode())
                any_ = True
            if turn is None:
                n = walk.n
                yield (walk.conv, walk.gaps, n["blank"], n["duplicate"], n["truncated"], n["illegal"], walk.cost, walk.audit, sha.hexdigest())
                sha, any_ = hashlib.sha256(), False
    yield from _batched(rows(), REPORT)


def _turns(batches):
    def rows():
        seq = 0
        for walk, turn in _walks(batches):
            for edit, role, text in (walk.turn(*turn) if turn else walk.end()):
                yield walk.conv, seq, edit, role, text
                seq += 1
            seq = seq if turn else 0
    yield from _batched(rows(), TURNS)


# --- operator ----------------------------------------------------------------------------------

def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by crc32 of ``conv_id:turn`` modulo 20 (nulls: one space), for tests of the repair:
    0 drops, 1 empties, 2 removes ``[.!?]``, 3 repeats, 4 sets the role to user."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    d = only(conversations, conv_id="conv_id", turn="turn", role="role", text="text").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), word("role").alias("role"), word("text").alias("text"),
        (F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn"))) % 20).alias("hit")).where("hit != 0")
    text = (F.when(F.col("hit") == 1, F.lit("")).when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    copies = F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return d.select("conv_id", "turn", F.when(F.col("hit") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"),
                    copies.alias("copy")).drop("copy")


def _symbol() -> Column:
    first = F.substring("role", 1, 1)
    base = F.when(first.isin("s", "u", "a"), first).otherwise(F.lit("o"))
    return (F.when(F.col("fault").isin("blank", "duplicate"), F.lit("d")).when(F.col("fault") == "truncated", F.upper(base)).otherwise(base))


def _judged(rows: DataFrame, c: Costs) -> tuple[DataFrame, DataFrame]:
    """(turns with position and fault, verdicts with cost and audit): written tables."""
    word = lambda k: F.coalesce(F.col(k), F.lit(" ")).alias(k)
    r = only(rows, conv_id="conv_id", turn="turn", role="role", text="text").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), word("role"), word("text"), F.lit(1).cast("long").alias("one"))
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.substring("text", 1, 64).asc(), F.xxhash64("text").asc()]
    placed = prefix_sums(r, "conv_id", order, "one", "cr-placed").withColumnRenamed("before", "pos").withColumn("md", F.md5(F.col("text").cast("binary")))
    # where a role and text stand first, for those that stand twice or more
    seen = (placed.groupBy("conv_id", "role", "md").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
            .select(F.col("conv_id").alias("c2"), F.col("role").alias("r2"), F.col("md").alias("m2"), "first"))
    found = placed.join(seen, F.col("conv_id").eqNullSafe(F.col("c2")) & (F.col("role") == F.col("r2")) & (F.col("md") == F.col("m2")), "left")
    rest = F.rtrim(F.col("text"), F.lit(WHITE))
    fault = (F.when(rest == "", F.lit("blank")).when(F.col("pos") > F.col("first"), F.lit("duplicate"))
             .when(~F.substring(rest, -1, 1).isin(".", "!", "?"), F.lit("truncated")))
    turns = cut(found.select("conv_id", "pos", "turn", "role", "text", fault.alias("fault")), "cr-turns")
    symbols = (turns.select("conv_id", "pos", F.floor(F.col("pos") / c.block).cast("long").alias("block"), _symbol().alias("symbol"))
               .groupBy("conv_id", "block").agg(F.sort_array(F.collect_list(F.struct("pos", "symbol"))).alias("s"))
               .select("conv_id", "block", F.array_join("s.symbol", "").alias("symbols")))
    cells = cut(symbols.mapInArrow(_parse_blocks(c), CELLS_SQL), "cr-cells")
    while cells.agg(F.max("block")).first()[0]:  # rounds: log of the longest conversation, to the base fan
        up = F.floor(F.col("block") / c.fan).cast("long")
        grown = cut(cells.groupBy("conv_id", up.alias("up")).agg(F.sort_array(F.collect_list(F.struct("block", "costs", "audits"))).alias("parts"))
                    .select("conv_id", "up", "parts").mapInArrow(_combine_blocks, CELLS_SQL), "cr-cells")
        drop(cells)
        cells = grown
    verdicts = cut(cells.mapInArrow(_verdicts, "conv_id long, cost long, audit string"), "cr-verdicts")
    drop(cells)
    return turns, verdicts


def _in_order(turns: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Each conversation in one run of rows: its verdict, then its turns in order."""
    none = F.lit(None)
    head = verdicts.select("conv_id", F.lit(-1).cast("long").alias("pos"), none.cast("long").alias("turn"), none.cast("string").alias("role"),
                           none.cast("string").alias("text"), none.cast("string").alias("fault"), "cost", "audit")
    body = turns.select("*", none.cast("long").alias("cost"), none.cast("string").alias("audit"))
    return head.unionByName(body).repartition("conv_id").sortWithinPartitions("conv_id", "pos")


def repaired_turns(rows: DataFrame, c: Costs = Costs()) -> DataFrame:
    """The repaired conversations: conv_id, seq (from 0), edit (K, R or I), role, text."""
    tune(rows.sparkSession)
    return _in_order(*_judged(rows, c)).mapInArrow(_turns, TURNS_SQL)


def reports(rows: DataFrame, every: DataFrame | None = None, c: Costs = Costs()) -> DataFrame:
    """Per conversation: faults, cost, audit and the digest of the repaired turns. A written table.

    ``every``: a frame whose conv_ids get a row even if ``rows`` has none of theirs.
    """
    tune(rows.sparkSession)
    turns, verdicts = _judged(rows, c)
    heads = verdicts
    if every is not None:
        ids = only(every, conv_id="conv_id").select(F.col("conv_id").cast("long"), F.lit(0).cast("long").alias("cost"), F.lit("").alias("audit"))
        heads = verdicts.unionByName(ids).groupBy("conv_id").agg(F.max("cost").alias("cost"), F.max("audit").alias("audit"))
    out = cut(_in_order(turns, heads).mapInArrow(_report, REPORT_SQL), "cr-report")
    drop(turns, verdicts)
    return out
