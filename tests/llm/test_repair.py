"""Conversation repair against exhaustive search over edits."""

import hashlib
import itertools
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import repair
from tidemark.llm.repair import Costs, parse, table, verdict

LEGAL = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def best_edit(symbols: str) -> tuple[int, str]:
    """Least (cost, audit) over all edits, by trying all of them with at most two insertions in a gap."""
    best = None
    gaps = ["", "u", "a", "ua", "au"]
    per_row = []
    for s in symbols:
        more = s.isupper()
        opts = [(3, "D", "")]
        if s != "d":
            opts += [(more, "K", s.lower())] + [(2 + more, "R", r) for r in "ua"]
        per_row.append(opts)
    for rows in itertools.product(*per_row):
        for fill in itertools.product(gaps, repeat=len(symbols) + 1):
            out = fill[0] + "".join(r[2] + f for r, f in zip(rows, fill[1:], strict=True))
            if LEGAL.fullmatch(out):
                cost = sum(r[0] for r in rows) + 2 * sum(map(len, fill))
                audit = "I" * len(fill[0]) + "".join(r[1] + "I" * len(f) for r, f in zip(rows, fill[1:], strict=True))
                if best is None or (cost, audit) < best:
                    best = (cost, audit)
    return best


@pytest.mark.parametrize("n, letters", [(1, "suaoSUAOd"), (2, "suaoSUAOd"), (3, "suUd")])
def test_all_short_sequences(n, letters):
    for s in itertools.product(letters, repeat=n):
        assert verdict(parse("".join(s), Costs())) == best_edit("".join(s)), s


def test_one_cut_equals_all_cuts():
    import random
    rng = random.Random(5)
    for _ in range(40):
        s = "".join(rng.choice("suaoSUAOd") for _ in range(rng.randrange(1, 16)))
        assert parse(s, Costs()) == table(s, Costs()), s


def by_hand(rows):
    """The contract in plain Python; the edit by a shortest path over states."""
    ids, out = {r[0] for r in rows}, {}
    convs = {c: [] for c in ids}
    sp = lambda x: " " if x is None else str(x)
    for c, t, role, text in rows:
        hit = zlib.crc32(f"{sp(c)}:{sp(t)}".encode()) % 20
        role, text = sp(role), sp(text)
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        role = "user" if hit == 4 else role
        convs[c] += [(t, role, text)] * {0: 0, 3: 2}.get(hit, 1)
    for c, rs in convs.items():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, n, sym = set(), {"blank": 0, "duplicate": 0, "truncated": 0}, []
        for _, role, text in rs:
            t = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not t else "duplicate" if (role, text) in seen else "truncated" if t[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                n[fault] += 1
            sym.append((role[:1], fault))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rs, rs[1:], strict=False))
        turns = [t for t, *_ in rs if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        nxt = {"": "u", "s": "u", "u": "a", "a": "u"}
        states = {"": (0, "", ())}

        def inserts(states):
            for _ in range(3):
                for st, (cost, audit, o) in list(states.items()):
                    r = nxt[st]
                    new = (cost + 2, audit + "I", o + ((None, r),))
                    if r not in states or new[:2] < states[r][:2]:
                        states[r] = new
            return states
        states = inserts(states)
        for k, (role, fault) in enumerate(sym):
            new = {}

            def offer(st, got, new=new):
                if st not in new or got[:2] < new[st][:2]:
                    new[st] = got
            more = fault == "truncated"
            for st, (cost, audit, o) in states.items():
                offer(st, (cost + 3, audit + "D", o))
                if fault not in ("blank", "duplicate"):
                    if role == nxt[st] or (role == "s" and st == ""):
                        offer(role, (cost + more, audit + "K", o + ((k, None),)))
                    if role != nxt[st]:
                        offer(nxt[st], (cost + 2 + more, audit + "R", o + ((k, nxt[st]),)))
            states = inserts(new)
        cost, audit, o = min(states[s] for s in ("", "a") if s in states)
        full = {"u": "user", "a": "assistant"}
        text = "\n".join(f"{full[r] if r else rs[k][1]}:{rs[k][2] if k is not None else ''}" for k, r in o)
        out[c] = (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


COLS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def got(df):
    rows = df.collect()
    out = {r.conv_id: tuple(r[c] for c in COLS) for r in rows}
    assert len(out) == len(rows)
    return out


def test_whole_table(spark):
    t = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in t.select("conv_id", "turn", "role", "text").collect()]
    assert got(repair.reports(repair.damage(t), t)) == by_hand(rows)


ODD = [(None, 1, "user", "a."), (None, None, None, None), (None, 2, "assistant", "b"), (1, None, "user", "x."), (1, None, "user", "x."),
       (1, 5, "system", "s."), (2, 0, "tool", "call."), (2, 9, "", "y!"), (2, 9, "assistant", ""), (3, 7, "system", "only."), (4, -3, "user", " \t\n"),
       (5, 1, "user", "long " * 50_000), (5, 2, "assistant", "z."), (5, 2, "assistant", "z."), (5, 2, "user", "q?")]


def test_odd_rows_and_long_conversations_over_blocks(spark):
    rows = ODD + [(9, i, ("system", "user", "assistant", "user")[i * i % 4], f"turn {i * i % 83}" + "." * (i % 3)) for i in range(700)]
    t = spark.createDataFrame(rows, SCHEMA).withColumn("pos", F.lit("clash")).withColumn("symbol", F.lit(1)).repartition(5)
    want = by_hand(rows)
    assert got(repair.reports(repair.damage(t), t)) == want
    assert got(repair.reports(repair.damage(t), t, Costs(block=16, fan=3))) == want
    legal = repair.repaired_turns(repair.damage(t)).orderBy("conv_id", "seq").collect()
    by = {}
    for r in legal:
        by[r.conv_id] = by.get(r.conv_id, "") + r.role[:1]
    assert all(LEGAL.fullmatch(x) for x in by.values()) and len(by[9]) > 100


def test_empty(spark):
    t = spark.createDataFrame([], SCHEMA)
    assert repair.reports(repair.damage(t), t).count() == 0 and repair.repaired_turns(t).count() == 0
