"""Pairs of blocks of large clusters: what is sent whole, and what stays on disk."""

import glob
import random

import numpy as np
import pytest

from starmart import session
from starmart.llm import ngram_join
from starmart.llm.common import components, cut
from starmart.session import shuffles_freed


def one_cluster(spark, monkeypatch):
    """Tie all documents, as a part that is common to all does."""
    def ties(docs, n, num, den):
        ids = ngram_join.signatures(docs, n).where("sid is not null and doc_id is not null").select("sid").collect()
        return spark.createDataFrame([(ids[0].sid, r.sid) for r in ids], "a long, b long")
    monkeypatch.setattr(ngram_join, "_ties", ties)


def text(rng, words=60):
    return " ".join(f"w{rng.randrange(4000)}" for _ in range(words))


def test_documents_that_cannot_link_are_not_sent_whole_to_every_pair_of_blocks(spark, monkeypatch):
    one_cluster(spark, monkeypatch)
    rng = random.Random(3)
    texts = [text(rng, 50 + i % 25) for i in range(60)]
    texts[41] = f"{texts[7]} end"   # the one link
    products, sent = ngram_join._products, []

    def counted(pairs, num, den):
        sent.append(pairs.count())
        return products(pairs, num, den)

    monkeypatch.setattr(ngram_join, "_products", counted)
    monkeypatch.setattr(ngram_join, "PAIRS_AT_ONCE", 20)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(docs, 3, 80, 100, 4).collect()}
    assert got == {i: 7 if i == 41 else i for i in range(60)}
    assert len(sent) > 2 and sum(sent[1:]) <= 2   # every one of some hundred pairs of blocks held all its documents before


@pytest.mark.parametrize("num,den", [(80, 100), (90, 100), (1, 3)])
def test_bitmaps_leave_out_no_link(num, den):
    rng = np.random.default_rng(5)
    base = [rng.integers(0, 2**64, size, np.uint64) for size in (1, 2, 30, 63, 64, 65, 120, 130, 1000)]
    sets = [np.unique(np.append(b[:int(len(b) * share)], rng.integers(0, 2**64, more, np.uint64)))
            for b in base for share in (1, 0.95, 0.85, 0.5) for more in (0, 1, 3, 20, 150) if int(len(b) * share) + more]
    rows = [(k, len(s), ngram_join._bits(s)) for k, s in enumerate(sets)]
    a, b = list(range(0, len(sets), 2)), list(range(1, len(sets), 2))
    hit_a, hit_b = ngram_join._maybe([rows[k] for k in a], [rows[k] for k in b], num, den)
    pairs = ngram_join.linked([sets[k] for k in a], [sets[k] for k in b], num, den)
    assert len(pairs) and hit_a[pairs[:, 0]].all() and hit_b[pairs[:, 1]].all()
    assert not hit_a.all() or den == 3
    same = [(0, *r[1:]) for r in rows]   # of one component already: nothing to find
    assert not any(x.any() for x in ngram_join._maybe([same[k] for k in a], [same[k] for k in b], num, den))


def test_rounds_of_components_leave_only_the_last_on_disk(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_root", lambda spark: str(tmp_path))
    edges = spark.range(200).selectExpr("id a", "id + 1 b")   # a chain: several rounds
    found = components(edges)
    assert len(glob.glob(f"{tmp_path}/*")) == 1 and found.count() == 201 and {r.component for r in found.collect()} == {0}


def test_a_cut_leaves_no_shuffle_files(spark):
    tracker = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffled():
        return sum(1 for f in _each(tracker.getAllFiles()) if f.getName().startswith("shuffle_") and f.getName().endswith(".data"))

    def _each(files):
        return [files.apply(i) for i in range(files.size())]

    before = shuffled()
    df = spark.range(1000).selectExpr("id % 10 k").groupBy("k").count()
    assert cut(df, "t").count() == 10 and shuffled() <= before
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name)
    with pytest.raises(ZeroDivisionError), shuffles_freed(spark):
        assert spark.conf.get(name) == "true"
        raise ZeroDivisionError
    assert spark.conf.get(name) == was
