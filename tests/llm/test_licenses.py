"""Licence scan: every template in noise, versions told apart, brute-force containment."""

import random

import pytest

from starmart.llm import licenses

T = licenses.TEMPLATES
SCHEMA = "doc_id long, text string"


def noise(rng, n):
    return " ".join(f"w{rng.randrange(400)}" for _ in range(n))


def names(spark, rows, schema=SCHEMA):
    return sorted(((r.doc_id, r.license) for r in licenses.scan(spark.createDataFrame(rows, schema)).collect()), key=str)


def grams(words, n):
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def contained(template, text):
    """Share of the template's distinct shingles that stand in the text."""
    t, w = (licenses._WORD(x.lower()) for x in (template, text))
    n = min(licenses.N, len(t))
    return len(grams(t, n) & grams(w, n)) / len(grams(t, n))


def test_every_template_is_found_in_noise_and_alone(spark):
    rng = random.Random(3)
    rows = [(i, f"{noise(rng, 700)} {t}, {noise(rng, 90)}") for i, t in enumerate(T.values())]
    rows += [(1000 + i, t.upper()) for i, t in enumerate(T.values())]
    want = [(i, n) for i, n in enumerate(T)] + [(1000 + i, n) for i, n in enumerate(T)]
    assert names(spark, rows) == sorted(want, key=str)


def test_versions_decide(spark):
    gpl = "This work is licensed under the GNU General Public License, version {}"
    texts = {"2": gpl.format(2), "3": gpl.format(3), "4": gpl.format(4), "lgpl": T["lgpl-or-later-2.1"], "apache": "Licensed under the Apache License, Version 2.0",
             "apache 1.1": "Licensed under the Apache License, Version 1.1", "software 1.1": T["apache-software-1.1"], "mpl": T["mpl-1.1"]}
    got = {list(texts)[i]: n for i, n in names(spark, list(enumerate(texts.values())))}
    assert got == {"2": "gpl-line-2.0", "3": "gpl-line-3.0", "lgpl": "lgpl-or-later-2.1", "apache": "apache-line-2.0",
                   "software 1.1": "apache-software-1.1", "mpl": "mpl-1.1"}


def test_parts_and_changed_words_against_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for i in range(150):
        name = rng.choice(list(T))
        words = T[name].split()
        lo = rng.randrange(max(1, len(words) // 5))
        words = words[lo:len(words) - rng.randrange(max(1, len(words) // 5))]
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = "changed"
        rows.append((i, f"{noise(rng, 300)} {' '.join(words)} {noise(rng, 60)}"))
    got = names(spark, rows)
    found = dict(got)
    assert len(got) == len(found)   # one notice planted, one match
    for i, text in rows:
        likely = {n: contained(t, text) for n, t in T.items()}
        stated = {n for n in T if licenses._numbers(n, licenses._WORD(T[n].lower())) <= set(licenses._WORD(text.lower()))}
        if i in found:
            assert likely[found[i]] >= licenses.CONTAINMENT and found[i] in stated
            size = lambda n: round(likely[n] * len(grams(licenses._WORD(T[n].lower()), 5)))
            assert not any(likely[n] >= licenses.CONTAINMENT and size(n) > size(found[i]) for n in stated)
        else:
            assert not any(c >= licenses.CONTAINMENT and n in stated and not licenses._VERSION.search(n) for n, c in likely.items())


def test_edges(spark):
    rows = [(None, T["isc"], 1), (1, None, 1), (2, "", 1), (3, "licensed under", 1), (4, f"{T['isc']} {noise(random.Random(1), 500)} {T['isc']}", 1),
            (5, T["mit-line"], 1), (5, T["mit-line"], 1)]
    got = names(spark, rows, SCHEMA + ", license int")
    assert got == sorted([(None, "isc"), (4, "isc"), (4, "isc"), (5, "mit-line"), (5, "mit-line")], key=str)
    assert licenses.scan(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("name", ["gpl-or-later-2.0", "cc-by-sa-4.0", "bsd-3-clause"])
def test_version_words(name):
    want = {"gpl-or-later-2.0": {"2"}, "cc-by-sa-4.0": {"4", "0"}, "bsd-3-clause": set()}
    assert licenses._numbers(name, licenses._WORD(T[name].lower())) == want[name]
