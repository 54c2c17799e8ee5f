"""Conversation structure repair with Four-Russians block tables.

A conversation's rows, by turn (nulls first; ties by role, then text), become
one symbol each: role initial s, u, a or other, whole or truncated; blank and
repeated rows share one symbol, they have to go.  A repair keeps, re-roles
(cost 1), deletes (2) or inserts (5) so that the role initials read
``(s?(ua)+)?``; a truncated row that stays costs 5.  Costs to go from the
automaton's four states form a vector; less its smallest entry only a few
dozen vectors exist.  For every vector and every block of BLOCK symbols a
table holds the vector before the block and the cost it adds, so a
conversation is worked from its end by one lookup a block, all conversations
of a batch at once.  The edits are then read from the front: each block is
expanded again to the vectors inside, and the ASCII-least edit whose cost
meets the cost to go is taken, which is the least audit among the cheapest.

Conversations are dealt by id and stream through their tasks.  One with more
than ROWS rows or BYTES of text is cut into units by range instead: a unit's
table walk is done for every possible vector at its end, the few results of
its units are composed, and every unit is then traced on its own; only the
digest, one hash over the whole conversation, reads it in order, row by row.

Null role and text are one space.  Equal rows are repeats of the first.  Rows
of a null conv_id are one conversation.  Other columns are left out.  An
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections import deque
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import arrow_rows, cut

BLOCK = 4
ROWS, BYTES = 100_000, 1 << 26
BATCH_ROWS = 8192
BLANKS = "' \\t\\n\\u000b\\u000c\\r'"   # as SQL text
GONE, PAD = 8, 9                       # symbols: role * 2 + truncated, must go, no row
REPAIRED = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
            "audit string, repaired string, repaired_sha256 string")

# automaton of (s?(ua)+)?: states start, after s, after u, after a
_START, _S, _U, _A = range(4)
_NEXT = {(_START, 0): _S, (_START, 1): _U, (_S, 1): _U, (_U, 2): _A, (_A, 1): _U}
_WANTS = [1, 1, 2, 1]                  # the role that a new or re-roled row takes
_ROLES = {1: "user", 2: "assistant"}
_END = (0, 10, 5, 0)


def _before(symbol: int, after: tuple) -> tuple:
    """Costs to go before a row, from those after it."""
    if symbol == PAD:
        return after
    here = []
    for q in range(4):
        ways = [2 + after[q]]
        if symbol != GONE:
            role, stay = symbol >> 1, 5 * (symbol & 1)
            if (q, role) in _NEXT:
                ways.append(stay + after[_NEXT[q, role]])
            ways.append(stay + 1 + after[_NEXT[q, _WANTS[q]]])
        here.append(min(ways))
    for _ in range(2):
        here = [min(c, 5 + here[_NEXT[q, _WANTS[q]]]) for q, c in enumerate(here)]
    return tuple(here)


def _edits(symbol: int, before: tuple, after: tuple, q: int) -> tuple[str, int]:
    """Edits of one row from state q, ASCII-least among the cheapest, as pairs of
    initial and role (u, a or - for the row's own), and the state behind it."""
    done = ""
    while True:
        want = _WANTS[q]
        left = before[q]
        if symbol == PAD:
            return done, q
        if 2 + after[q] == left:
            return done + "D-", q
        if 5 + before[_NEXT[q, want]] == left:
            done, q = done + "I" + "sua"[want], _NEXT[q, want]
            continue
        role, stay = symbol >> 1, 5 * (symbol & 1)
        if (q, role) in _NEXT and stay + after[_NEXT[q, role]] == left:
            return done + "K-", _NEXT[q, role]
        return done + "R" + "sua"[want], _NEXT[q, want]


class Tables:
    """Vectors, block transitions and row edits."""

    def __init__(self):
        ids, queue, step = {_END: 0}, deque([_END]), {}
        while queue:
            v = queue.popleft()
            for x in range(10):
                w = _before(x, v)
                low = min(w)
                w = tuple(c - low for c in w)
                if w not in ids:
                    ids[w] = len(ids)
                    queue.append(w)
                step[ids[v], x] = ids[w], low
        self.vectors = list(ids)
        n = len(ids)
        self.step = np.array([[step[v, x][0] for x in range(10)] for v in range(n)], np.int16)
        add = np.array([[step[v, x][1] for x in range(10)] for v in range(n)], np.int64)
        # blocks, from their last symbol to their first
        self.block, self.cost = np.arange(n, dtype=np.int16)[:, None], np.zeros((n, 1), np.int64)
        for _ in range(BLOCK):
            # a symbol in front of the known ones
            moved, paid = self.step[self.block], add[self.block]
            self.cost = (self.cost[:, :, None] + paid).transpose(0, 2, 1).reshape(n, -1)
            self.block = moved.transpose(0, 2, 1).reshape(n, -1)
        # edits of a row by (vector behind it, symbol, state)
        self.words, known = [""], {"": 0}
        self.edit, self.state = np.zeros((n, 10, 4), np.uint8), np.zeros((n, 10, 4), np.uint8)
        for v, vector in enumerate(self.vectors):
            for x in range(10):
                for q in range(4):
                    word, after = _edits(x, _before(x, vector), vector, q)
                    if word not in known:
                        known[word] = len(self.words)
                        self.words.append(word)
                    self.edit[v, x, q], self.state[v, x, q] = known[word], after


@cache
def tables() -> Tables:
    return Tables()


_PLACES = 10 ** np.arange(BLOCK - 1, -1, -1)
TAILS = ["", "IuIa", "Ia", ""]         # inserted behind the last row, by state


def _codes(symbols: np.ndarray) -> np.ndarray:
    """Block numbers of a sequence, padded in front."""
    pad = -len(symbols) % BLOCK
    return np.concatenate([np.full(pad, PAD, np.uint8), symbols]).reshape(-1, BLOCK) @ _PLACES


def walk(sequences: list[np.ndarray], ends: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, tuple]:
    """Block walk of all sequences at once, from the end vectors ``ends``: block
    codes, vector at the front, added cost, and what ``trace`` needs."""
    t = tables()
    codes = [_codes(s) for s in sequences]
    sizes = np.array([len(c) for c in codes], np.int64)
    first = np.cumsum(sizes) - sizes
    flat = np.concatenate(codes) if codes else np.zeros(0, np.int64)
    order = np.argsort(-sizes, kind="stable")
    behind = np.zeros(len(flat), np.int16)
    v, cost = np.array(ends, np.int16), np.zeros(len(sizes), np.int64)
    for k in range(int(sizes.max(initial=0))):
        live = order[:np.searchsorted(-sizes[order], -k)]
        at = first[live] + sizes[live] - 1 - k
        behind[at] = v[live]
        cost[live] += t.cost[v[live], flat[at]]
        v[live] = t.block[v[live], flat[at]]
    return codes, v, cost, (flat, behind, first, sizes, order)


def trace(sequences: list[np.ndarray], walked: tuple, q: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Edit words of every row from the states ``q`` on, and the states behind."""
    t = tables()
    flat, behind, first, sizes, order = walked
    words = np.zeros(len(flat) * BLOCK, np.uint8)
    q = np.array(q, np.uint8)
    for k in range(int(sizes.max(initial=0))):
        live = order[:np.searchsorted(-sizes[order], -k)]
        at = first[live] + k
        symbols = flat[at][:, None] // _PLACES % 10
        inside = [behind[at]]
        for i in range(BLOCK - 1, 0, -1):      # expand the block backward
            inside.append(t.step[inside[-1], symbols[:, i]])
        for i, v in enumerate(reversed(inside)):
            words[at * BLOCK + i] = t.edit[v, symbols[:, i], q[live]]
            q[live] = t.state[v, symbols[:, i], q[live]]
    out = [words[(f + n) * BLOCK - len(s):(f + n) * BLOCK] for s, f, n in zip(sequences, first, sizes, strict=True)]
    return out, q


def _lines(word: str, role: str, text: str) -> list[str]:
    """What the edits of one row leave of it, behind what they insert."""
    return [f"{role}:{text}" if e == "K" else f"{_ROLES['sua'.index(r)]}:{text if e == 'R' else ''}"
            for e, r in zip(word[::2], word[1::2], strict=True) if e != "D"]


def _tally(turns: list, roles: np.ndarray, symbols: np.ndarray, kinds: np.ndarray) -> tuple:
    known = {x for x in turns if x is not None}
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    pairs = roles[:-1] * 4 + roles[1:]
    return (gaps, *((kinds == k).sum().item() for k in (1, 2, 3)), (~np.isin(pairs, (1, 6, 9))).sum().item())


def _solve(convs: list[tuple]) -> pa.RecordBatch:
    """Repaired rows of whole conversations: (id, turns, roles, texts, symbols)."""
    t, made, sequences = tables(), [], []
    for _, turns, roles, texts, symbols in convs:
        symbols = np.array(symbols, np.uint8)
        initial = np.array(["sua".find(r[:1]) if r else 3 for r in roles])
        initial[initial < 0] = 3
        seen: set = set()
        kinds = np.where(symbols == GONE, 1, np.where(symbols & 1, 3, 0))
        for i, row in enumerate(zip(roles, texts, strict=True)):
            if row in seen and kinds[i] != 1:
                symbols[i], kinds[i] = GONE, 2
            seen.add(row)
        sequences.append(symbols)
        made.append(_tally(turns, initial, symbols, kinds))
    _, v, cost, walked = walk(sequences, np.zeros(len(convs)))
    words, q = trace(sequences, walked, np.zeros(len(convs)))
    rows = []
    for i, (key, _, roles, texts, _) in enumerate(convs):
        each = [t.words[w] for w in words[i].tolist()]
        lines = [x for w, r, s in zip(each, roles, texts, strict=True) for x in _lines(w, r, s)]
        audit = "".join(each) + TAILS[q[i]]
        repaired = "\n".join(lines + _lines(TAILS[q[i]], "", ""))
        rows.append((key, *made[i], int(cost[i]) + t.vectors[v[i]][_START], audit[::2], repaired,
                     hashlib.sha256(repaired.encode()).hexdigest()))
    names = [f.split()[0] for f in REPAIRED.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.string()] * 3
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _whole(batches):
    """Repair the conversations of a sorted partition, a few thousand rows at a time."""
    convs: list[tuple] = []
    held = 0
    for batch in batches:
        for key, turn, role, text, symbol in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if not convs or convs[-1][0] != key:
                if held >= BATCH_ROWS:
                    yield _solve(convs)
                    convs, held = [], 0
                convs.append((key, [], [], [], []))
            for column, value in zip(convs[-1][1:], (turn, role, text, symbol), strict=True):
                column.append(value)
            held += 1
    if convs:
        yield _solve(convs)


def _features(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, symbol (repeats not yet known)."""
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    bare = F.expr(f"trim(TRAILING {BLANKS} FROM text)")
    kind = F.instr(F.lit("sua"), F.substring("role", 1, 1)) - 1
    kind = F.when((F.length("role") == 0) | (kind < 0), 3).otherwise(kind)
    symbol = F.when(bare == "", GONE).otherwise(2 * kind + F.when(F.right(bare, F.lit(1)).isin(".", "!", "?"), 0).otherwise(1))
    return rows.withColumn("symbol", symbol.cast("byte"))


def damage(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with faults planted by
    crc32(``conv_id:turn``) % 20: 0 drops, 1 empties, 2 takes out the sentence
    ends, 3 repeats, 4 makes the role user."""
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    key = F.concat(conv, F.lit(":"), turn)
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                       F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (rows.where("fault <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("_copy"))
            .drop("_copy"))


def repair(rows: DataFrame, most_rows: int = ROWS, most_bytes: int = BYTES) -> DataFrame:
    """One row of REPAIRED for each conv_id of ``rows`` (conv_id, turn, role,
    text).  ``repaired`` is null for a conversation beyond ``most_rows`` or
    ``most_bytes`` (its digest is not)."""
    found = _features(rows)
    large = cut(found.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b"))
                .where((F.col("n") > most_rows) | (F.col("b") > most_bytes)).select(F.col("conv_id").alias("_large")), "long-conversations")
    same = F.col("conv_id").eqNullSafe(F.col("_large"))
    rest = found if large.isEmpty() else found.join(large, same, "left_anti")
    whole = (rest.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
             .mapInArrow(_whole, REPAIRED))
    if large.isEmpty():
        return whole
    return whole.unionByName(_repair_long(found.join(large, same, "left_semi")))


# conversations in units -------------------------------------------------------------------

def _unit_rows(batches):
    """One row a unit: symbols and role initials in order."""
    key, parts = None, []

    def row():
        first, symbols, kinds, roles = parts[0][0], *(b"".join(p[i] for p in parts) for i in (1, 2, 3))
        return {"conv_id": key[0], "unit": key[1], "pos": first, "symbols": symbols, "kinds": kinds, "roles": roles}

    for batch in batches:
        for conv, unit, pos, symbol, kind, role in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != (conv, unit) and parts:
                yield pa.RecordBatch.from_pylist([row()], schema=_UNIT)
                parts = []
            key = conv, unit
            parts.append((pos, bytes([symbol]), bytes([kind]), bytes([role])))
    if parts:
        yield pa.RecordBatch.from_pylist([row()], schema=_UNIT)


_UNIT = pa.schema([("conv_id", pa.int64()), ("unit", pa.int64()), ("pos", pa.int64()), ("symbols", pa.binary()),
                   ("kinds", pa.binary()), ("roles", pa.binary())])


def _unit_map(batches):
    """For every vector at a unit's end: vector at its front, cost, states behind."""
    n = len(tables().vectors)
    for batch in batches:
        for r in batch.to_pylist():
            s = np.frombuffer(r["symbols"], np.uint8)
            roles, kinds = (np.frombuffer(r[c], np.uint8).astype(int) for c in ("roles", "kinds"))
            _, v, cost, walked = walk([s] * n, np.arange(n))
            states = [trace([s] * n, walked, np.full(n, q))[1] for q in range(4)]
            tally = _tally([], roles, s, kinds)[1:]
            yield pa.RecordBatch.from_pylist([{
                "conv_id": r["conv_id"], "unit": r["unit"], "front": v.tolist(), "cost": cost.tolist(),
                "states": np.array(states).T.ravel().tolist(), "tally": tally, "ends": [int(roles[0]), int(roles[-1])]}], schema=_MAP)


_MAP = pa.schema([("conv_id", pa.int64()), ("unit", pa.int64()), ("front", pa.list_(pa.int64())), ("cost", pa.list_(pa.int64())),
                  ("states", pa.list_(pa.int64())), ("tally", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))])
_COMPOSED = ("conv_id long, unit long, behind long, state long, last boolean, blank long, duplicate long, truncated long, "
             "illegal long, cost long")


def _compose(units):
    """Vector behind each unit of one conversation and the state before it, with
    the conversation's totals on its last unit."""
    units = units.sort_values("unit").reset_index(drop=True)
    behind, v, cost = [0] * len(units), 0, 0
    for i in range(len(units) - 1, -1, -1):
        behind[i] = v
        cost += units["cost"][i][v]
        v = units["front"][i][v]
    cost += tables().vectors[v][_START]
    states, q = [], _START
    for i in range(len(units)):
        states.append(q)
        q = units["states"][i][4 * behind[i] + q]
    total = [sum(x) for x in zip(*units["tally"], strict=True)]
    total[3] += sum((a[1], b[0]) not in ((0, 1), (1, 2), (2, 1)) for a, b in zip(units["ends"][:-1], units["ends"][1:], strict=True))
    out = units[["conv_id", "unit"]].assign(behind=behind, state=states, last=[False] * (len(units) - 1) + [True])
    return out.assign(**dict(zip(("blank", "duplicate", "truncated", "illegal"), total, strict=True)), cost=cost)


def _unit_edits(batches):
    """Edits of every row of a unit, (conv_id, pos, edits)."""
    words = tables().words
    for batch in batches:
        for r in batch.to_pylist():
            s = np.frombuffer(r["symbols"], np.uint8)
            *_, walked = walk([s], np.array([r["behind"]]))
            found, q = trace([s], walked, np.array([r["state"]]))
            edits = [words[w] for w in found[0].tolist()]
            if r["last"]:
                edits[-1] += TAILS[q[0]]
            for lo in range(0, len(edits), 10_000):
                part = edits[lo:lo + 10_000]
                yield pa.RecordBatch.from_arrays([pa.array(range(r["pos"] + lo, r["pos"] + lo + len(part)), pa.int64()), pa.array(part)],
                                                 names=["_pos", "edits"])


def _digest(batches):
    """Audit and hash of each conversation of a sorted partition, streamed."""
    key, audit, digest = None, None, None

    def row():
        return pa.RecordBatch.from_pylist([{"conv_id": key[0], "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}],
                                          schema=pa.schema([("conv_id", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]))

    for batch in batches:
        for conv, role, text, word in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "edits")), strict=True):
            if key != (conv,):
                if key:
                    yield row()
                key, audit, digest, begun = (conv,), [], hashlib.sha256(), False
            audit.append(word[::2])
            for line in _lines(word, role, text):
                digest.update((b"\n" if begun else b"") + line.encode())
                begun = True
    if key:
        yield row()


def _repair_long(found: DataFrame) -> DataFrame:
    """Conversations of any length: see the module's text."""
    spark = found.sparkSession
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role"]
    keyed = found.withColumn("_id", F.monotonically_increasing_id()).withColumn("_hash", F.xxhash64("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (keyed.repartitionByRange(parts, *order, "_hash", "_id").sortWithinPartitions(*order, "text", "_id")
              .withColumn("_pos", F.monotonically_increasing_id()))
    with arrow_rows(spark, 1000):
        placed = cut(placed.drop("_id", "_hash"), "long-rows")
        gaps = (placed.groupBy("conv_id", "turn").agg(F.count("*").alias("n")).groupBy("conv_id")
                .agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps")))
        first = (placed.where(F.col("symbol") != GONE)
                 .groupBy("conv_id", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")).alias("k"))
                 .agg(F.min("_pos").alias("_first")))
        initial = F.instr(F.lit("sua"), F.substring("role", 1, 1)) - 1
        narrow = placed.select("conv_id", F.shiftright("_pos", 33).alias("unit"), "_pos", "symbol",
                               F.when((F.length("role") == 0) | (initial < 0), 3).otherwise(initial).cast("byte").alias("role"))
        marked = narrow.join(first.select("_first"), F.col("_pos") == F.col("_first"), "left")
        again = F.col("_first").isNull() & (F.col("symbol") != GONE)
        kind = F.when(F.col("symbol") == GONE, 1).when(again, 2).when(F.col("symbol") % 2 == 1, 3).otherwise(0)
        units = cut(marked.select("conv_id", "unit", "_pos", F.when(again, GONE).otherwise(F.col("symbol")).cast("byte").alias("symbol"),
                                  kind.cast("byte").alias("kind"), "role")
                    .repartition("conv_id", "unit").sortWithinPartitions("conv_id", "unit", "_pos")
                    .mapInArrow(_unit_rows, "conv_id long, unit long, pos long, symbols binary, kinds binary, roles binary"), "long-units")
        maps = units.mapInArrow(_unit_map, "conv_id long, unit long, front array<long>, cost array<long>, states array<long>, "
                                           "tally array<long>, ends array<long>")
        composed = cut(maps.groupBy("conv_id").applyInPandas(_compose, _COMPOSED), "long-composed")
        place = composed.select(F.col("conv_id").alias("_c"), F.col("unit").alias("_u"), "behind", "state", "last")
        edits = (units.join(place, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("unit") == F.col("_u")))
                 .select("pos", "symbols", "behind", "state", "last").mapInArrow(_unit_edits, "_pos long, edits string"))
        digests = cut(placed.select("conv_id", "_pos", "role", "text").join(edits, "_pos")
                      .repartition("conv_id").sortWithinPartitions("conv_id", "_pos")
                      .mapInArrow(_digest, "conv_id long, audit string, repaired_sha256 string"), "long-digests")
        totals = composed.where("last").drop("unit", "behind", "state", "last")
        same = lambda c: F.col("conv_id").eqNullSafe(F.col(c))
        return (totals.join(gaps.withColumnRenamed("conv_id", "_g"), same("_g"))
                .join(digests.withColumnRenamed("conv_id", "_d"), same("_d"))
                .select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                        F.lit(None).cast("string").alias("repaired"), "repaired_sha256"))

