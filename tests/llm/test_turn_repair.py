"""Conversation repair against a plain dynamic program and, for short ones, all edits."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

from geogrid.llm import oracles, queries, turn_repair

WORD = re.compile(r"[^\x20\x09-\x0D]")
SCHEMA = "conv_id long, turn long, role string, text string"
PATTERN = re.compile(r"(s?(ua)+)?")


def damaged(rows):
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        yield from [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)


def with_faults(rows):
    """(role, text, fault) by turn."""
    seen, out = set(), []
    for _, _, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode())):
        marks = WORD.findall(text)
        fault = "blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def plain(rows):
    """The cheapest (cost, audit, rows), by state."""
    best = {"": (0, "", ())}

    def put(to, key, cost, letter, row=None):
        c, a, o = best_before[key] if key in best_before else here[key]
        new = (c + cost, a + letter, o if row is None else (*o, row))
        here[to] = min(here.get(to, new), new)

    def insert():
        for _ in range(3):
            for key in list(here):
                role = "assistant" if key == "u" else "user"
                put(role[0], key, 5, "I", f"{role}:")

    best_before, here = {}, best
    insert()
    for role, text, fault in rows:
        best_before, here = here, {}
        extra = 5 if fault == "truncated" else 0
        for key in best_before:
            put(key, key, 2, "D")
            if fault in ("blank", "duplicate"):
                continue
            fits = "assistant" if key == "u" else "user"
            put(fits[0], key, 1 + extra, "R", f"{fits}:{text}")
            if role[:1] == fits[0] or (key == "" and role[:1] == "s"):
                put(role[:1], key, extra, "K", f"{role}:{text}")
        best_before_kept, best_before = best_before, {}
        insert()
        best_before = best_before_kept
    return min(here[k] for k in ("", "a") if k in here)


def every(rows):
    """The cheapest (cost, audit) among all edits with at most three insertions at a place."""
    gaps = [("I",) * k for k in range(4)]
    found = []
    for edits in itertools.product("DKR", repeat=len(rows)):
        for places in itertools.product(gaps, repeat=len(rows) + 1):
            audit = "".join("".join(g) + e for g, e in zip(places, edits, strict=False)) + "".join(places[-1])
            fixed = iter(rows)
            cost, made, fine = 0, [], True
            for x in audit:
                role, _, fault = next(fixed) if x != "I" else ("", "", "")
                cost += {"D": 2, "K": 0, "R": 1, "I": 5}[x] + (5 if fault == "truncated" and x != "D" else 0)
                fine &= x == "D" or fault not in ("blank", "duplicate")
                if x != "D":
                    made.append(role[:1] if x == "K" else "?")
            if fine and any(PATTERN.fullmatch("".join(m)) for m in itertools.product(*[m if m != "?" else "ua" for m in made])):
                found.append((cost, audit))
    return min(found)


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = list(damaged(r for r in rows if r[0] == conv))
        turns = [r[1] for r in own if r[1] is not None]
        marked = with_faults(own)
        count = [sum(f == x for *_, f in marked) for x in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(marked))
        cost, audit, made = plain(marked)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest())
    return out


def awkward(n=300, seed=5):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "sudo", "", None, "User", "ü"]
    texts = ["Yes.", "no", "", " \t\n", None, "Why?", "ends \r\n", "done! \x0b", "x.y", ".", "é😀", "a" * 3000 + "."]
    rows = []
    for conv in range(n):
        for k in range(rng.choice([0, 1, 2, 3, 5, 9, 14])):
            role = rng.choice(roles) if rng.random() < 0.3 else ("user", "assistant")[k % 2]
            rows.append((conv, rng.choice([k, k, k, 3 * k, k // 2, None]), role, rng.choice(texts) if rng.random() < 0.5 else f"text {k} of {conv}."))
    rows += [(None, t, r, x) for t, r, x in [(1, "user", "a."), (None, "assistant", "b."), (2, None, None)]]
    rows += [(-7, -(2**62), "user", "a."), (-7, 2**62, "assistant", "b.")]
    rows += [(10**6, k, ("user", "assistant")[k % 2] if k % 17 else "system", f"turn {k % 900}{'.' * (k % 13 > 0)}") for k in range(6000)]
    return rows


def test_plain_version_is_cheapest_of_all():
    rng = random.Random(1)
    for _ in range(60):
        rows = [(rng.choice(["user", "assistant", "system", "tool"]), str(k), rng.choice(["", "", "truncated", "blank"])) for k in range(rng.randint(0, 3))]
        assert plain(rows)[:2] == every(rows)


@pytest.mark.parametrize("block", [1, 2, 3, 5])
def test_tables_of_any_block(block):
    rng = random.Random(block)
    t = turn_repair.Tables(block)
    assert len(t.vectors) < 64 and t.block.shape == (len(t.vectors), 9**block)
    for _ in range(200):
        symbols = [rng.randrange(9) for _ in range(block)]
        v = rng.randrange(len(t.vectors))
        code = 0
        want = t.vectors[v]
        for s in reversed(symbols):
            code = code * 9 + s
            want = turn_repair._before(want, s)
        got = t.vectors[t.block[v, code]]
        assert tuple(c - min(want) for c in want) == got


def test_query_on_awkward_rows(spark, tmp_path):
    rows = awkward()
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as fault", "2 as gone", "3 as nth", "'x' as symbol", "4 as edge")
    df.repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    out = queries.op11_turn_repair(spark, str(tmp_path))
    got = {r["conv_id"]: tuple(r)[1:] for r in out.collect()}
    want = expected(rows)
    assert got == want and len(got) == len({r[0] for r in rows})
    con = duckdb.connect()
    few = [r for r in rows if r[0] is None or r[0] < 10**6]
    spark.createDataFrame(few, SCHEMA).write.parquet(str(tmp_path / "few"))
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/few/*.parquet'")
    sql = {r[0]: r[1:] for r in con.sql(oracles.TURN_REPAIR).fetchall()}
    assert sql == {c: v for c, v in want.items() if c is None or c < 10**6}


def test_repaired_rows(spark):
    rows = [r for r in awkward(40) if r[0] is None or r[0] < 10**6]
    done = turn_repair.damage(spark.createDataFrame(rows, SCHEMA))
    by_conv = {}
    for r in sorted(turn_repair.repaired(done).collect(), key=lambda r: r["place"]):
        by_conv.setdefault(r["conv_id"], []).append(r)
    for conv, want in expected(rows).items():
        made = by_conv.get(conv, [])
        assert [r["place"] for r in made] == list(range(len(made)))
        assert PATTERN.fullmatch("".join(r["role"][0] for r in made))
        assert "".join(r["edit"] for r in made) == want[6].replace("D", "")
        assert hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in made).encode()).hexdigest() == want[7]
    kept = turn_repair.report(turn_repair.undamaged(spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes.")], SCHEMA))).collect()
    assert [tuple(r)[1:8] for r in kept] == [(0, 0, 0, 0, 0, 0, "KK")]


def test_edges(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    assert turn_repair.report(turn_repair.damage(empty)).collect() == [] and turn_repair.repaired(turn_repair.damage(empty)).collect() == []
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = turn_repair.report(turn_repair.damage(spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA))).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    named = spark.createDataFrame([("a", None, "user", "Hi."), (None, None, None, None)], "conv_id string, turn int, role string, text string")
    assert {r["conv_id"] for r in turn_repair.report(turn_repair.damage(named)).collect()} == {"a", None}
