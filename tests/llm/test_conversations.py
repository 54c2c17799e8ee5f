"""Conversation repair against a plain search over edit strings."""

import hashlib
import random
import zlib
from functools import cache

import pytest

from starmart.llm import conversations, queries

NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
WANT = "uuau"
FULL = {"u": "user", "a": "assistant"}
SPACE = " \t\n\x0b\x0c\r"


def brute(rows):
    """The contract's columns of one conversation: rows of (turn, role, text) in order."""
    turns = {t for t, _, _ in rows if t is not None}
    kinds, seen = [], set()
    for _, role, text in rows:
        last = text.rstrip(SPACE)[-1:]
        kinds.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    initials = [r[:1] for _, r, _ in rows]

    @cache
    def best(i, q, put):
        ways = []
        if i == len(rows) and q in (0, 3):
            ways.append((0, "", ""))
        if put < 3:
            c = best(i, NEXT[q, WANT[q]], put + 1)
            ways.append((5 + c[0], "I" + c[1], WANT[q] + c[2]))
        if i < len(rows):
            c = best(i + 1, q, 0)
            ways.append((2 + c[0], "D" + c[1], "-" + c[2]))
            if kinds[i] not in ("blank", "duplicate"):
                stay = 5 * (kinds[i] == "truncated")
                if (q, initials[i]) in NEXT:
                    c = best(i + 1, NEXT[q, initials[i]], 0)
                    ways.append((stay + c[0], "K" + c[1], "-" + c[2]))
                c = best(i + 1, NEXT[q, WANT[q]], 0)
                ways.append((stay + 1 + c[0], "R" + c[1], WANT[q] + c[2]))
        return min(ways, default=(10 ** 9, "", ""))

    cost, audit, roles = best(0, 0, 0)
    lines, i = [], 0
    for edit, role in zip(audit, roles, strict=True):
        if edit == "I":
            lines.append(f"{FULL[role]}:")
            continue
        if edit != "D":
            lines.append(f"{rows[i][1] if edit == 'K' else FULL[role]}:{rows[i][2]}")
        i += 1
    pairs = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *map(kinds.count, ("blank", "duplicate", "truncated")), pairs,
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fault == 1 else text.translate(dict.fromkeys(map(ord, ".!?"))) if fault == 2 else text
        role = "user" if fault == 4 else role
        out += [(conv, turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    out = []
    for conv in [*range(150), None]:
        for turn in range(rng.randint(1, 12)):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None, "User"])
            text = rng.choice(["Good.", "Yes?", f"Say {turn}.", f"No {turn}", "cut", "", " \x0b\n", None, "Ends! \t", "é…", " "])
            out.append((conv, rng.choice([turn, turn, turn, turn + 40, None]), role, text))
    return [*{(c, t): (c, t, r, x) for c, t, r, x in out}.values()]


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("most", [(conversations.ROWS, conversations.BYTES), (4, 1 << 26), (0, 0), (100, 20)])
def test_repair_equals_brute_force_whole_and_in_units(spark, rows, most):
    got = conversations.repair(conversations.damage(spark.createDataFrame(rows, SCHEMA)), *most)
    parts: dict = {}
    for conv, turn, role, text in sorted(damaged(rows), key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2], r[3])):
        parts.setdefault(conv, []).append((turn, role, text))
    assert {r.conv_id: tuple(r[c] for c in COLUMNS) for r in got.collect()} == {c: brute(p) for c, p in parts.items()}


def test_a_long_conversation_spans_many_units(spark):
    rng = random.Random(2)
    rows = [(1, i, rng.choice(["user", "assistant"]), rng.choice([f"t{i}.", "same.", f"cut {i}"])) for i in range(3000)] + [(2, 0, "user", "Hi.")]
    df = spark.createDataFrame(rows, SCHEMA)
    one, many = (sorted(conversations.repair(df, n).drop("repaired").collect()) for n in (10 ** 6, 100))
    assert one == many and len(many) == 2
    pieces = conversations._features(df).where("conv_id = 1").repartitionByRange(8, "turn").rdd.glom().map(len).collect()
    assert sum(n > 0 for n in pieces) > 4


def test_ties_repeats_extra_columns_and_empty_table(spark):
    rows = [(1, 0, "user", "b.", 1), (1, 0, "user", "a.", 2), (1, 0, "user", "a.", 3), (1, None, "system", "s.", 4)]
    got = conversations.repair(spark.createDataFrame(rows, SCHEMA + ", symbol int")).collect()
    assert [tuple(r[c] for c in COLUMNS[:-1]) for r in got] == [brute([(None, "system", "s."), *((0, "user", x) for x in ("a.", "a.", "b."))])[:-1]]
    assert conversations.repair(spark.createDataFrame([], SCHEMA)).count() == 0


def test_vectors_are_few_and_blocks_equal_single_steps():
    t = conversations.tables()
    assert len(t.vectors) < 64
    rng = random.Random(1)
    for _ in range(200):
        v, block = rng.randrange(len(t.vectors)), [rng.randrange(10) for _ in range(conversations.BLOCK)]
        cost, at = 0, v
        for x in reversed(block):
            before = conversations._before(x, t.vectors[at])
            cost, at = cost + min(before), t.step[at, x]
        code = int("".join(map(str, block)))
        assert (t.block[v, code], t.cost[v, code]) == (at, cost)


def test_registered_query_keeps_conversations_without_rows(spark, tmp_path):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "Hi."), (5001, 0, "user", "Hi."), (5001, 1, "assistant", "Ho."), (None, None, None, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    out = queries.queries()["op12_conversation_repair"](spark, str(tmp_path))
    assert dict(out.dtypes) == {"conv_id": "bigint", "audit": "string", "repaired_sha256": "string"} | {c: "bigint" for c in COLUMNS[:6]}
    found = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in out.collect()}
    parts = {c: [r[1:] for r in damaged(rows) if r[0] == c] for c in (gone, 5001, None)}
    assert found == {c: brute(p) for c, p in parts.items()}
    assert found[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
