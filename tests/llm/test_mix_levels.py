"""The levels that the mix deals by, against sorted siblings one by one."""

import random
from fractions import Fraction

from starmart.llm import mixing


def dealt(given, children):
    """{child: budget} by the order of capacity per weight."""
    rows = sorted((Fraction(c, w), name, c, w) for name, c, w in children if w > 0)
    out, left, weight = {name: 0 for name, _, w in children if w <= 0}, given, sum(r[3] for r in rows)
    while rows and rows[0][2] * weight <= left * rows[0][3]:
        _, name, c, w = rows.pop(0)
        out[name], left, weight = c, left - c, weight - w
    return out | {name: left * w // weight for _, name, _, w in rows}


def test_budgets_of_many_siblings(spark):
    rnd = random.Random(5)
    cases = {"en": [(f"s{i}", int(10 ** rnd.uniform(0, 6)), rnd.choice([1, 1, 2, 7, 0])) for i in range(400)],
             "de": [(f"s{i}", 100, 1) for i in range(50)], "fr": [("s0", 0, 1), ("s1", 0, 3)],
             "es": [("s0", 5, 0)], "none": [(f"t{i}", 2 ** i, 1) for i in range(40)]}
    weights = {"s0": 3, "s1": 0, "s2": 7, "s9": 2}
    cases = {lang: [(n, c, weights.get(n, 1)) for n, c, _ in rows] for lang, rows in cases.items()}
    children = spark.createDataFrame([(lang, n, c) for lang, rows in cases.items() for n, c, _ in rows], "lang string, source string, capacity long")
    for part in (0, 0.001, 0.1, 0.5, 0.99, 1, 2):
        given = {lang: int(sum(c for _, c, _ in rows) * part) for lang, rows in cases.items()}
        parents = spark.createDataFrame(list(given.items()), "lang string, given long")
        got = {(r.lang, r.source): r.budget for r in mixing._deal(children, parents, ["lang"], "source", weights).collect()}
        assert got == {(lang, n): b for lang, rows in cases.items() for n, b in dealt(given[lang], rows).items()}, part
