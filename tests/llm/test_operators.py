"""Brute force, round trips and edge rows of the training-data operators."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from starmart.llm import ann, bpe, licenses, line_dedup, mixing, ngram_join, quality, topk, toxicity, warc
from starmart.llm.common import components

WORDS = [f"w{i}" for i in range(400)]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    base = [prose(rng, rng.randint(1, 120)) for _ in range(60)]
    for k in range(40):  # near copies, some chained
        words = rng.choice(base).split()
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        base.append(" ".join(words))
    return [*base, base[0], base[0], None, "", "  \n ", "One Two", "one two", prose(rng, 20000)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en" if i % 3 else None, f"src{i % 7}" if i % 5 else None, len(t or ""), "x") for i, t in enumerate(texts)]
    rows.append((None, texts[0], "en", "src1", 5, "x"))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")


def links(texts, n, num, den):
    sets = [set(ngram_join.shingles(t, n).tolist()) for t in texts]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and den * both >= num * (len(a) + len(sets[j]) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))]


@pytest.mark.parametrize("n,num,den,block", [(3, 90, 100, 256), (5, 80, 100, 4), (2, 50, 100, 8)])
def test_jaccard_components_equal_brute_force(docs, texts, n, num, den, block):
    got = ngram_join.jaccard_components(docs, n, num, den, block).collect()
    assert len(got) == len(texts) + 1
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == dict(enumerate(links(texts, n, num, den)))
    assert [r.component_id for r in got if r.doc_id is None] == [None]


def test_keep_one_keeps_one_of_each_group(docs, texts):
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {None, *(links(texts, 5, 80, 100))}


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (3, 2), (9, 8), (8, 7), (5, 5), (4, 9), (1, 2)], "a long, b long")
    assert {r.id: r.component for r in components(edges).collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 7: 4, 8: 4, 9: 4}
    assert components(edges.limit(0)).count() == 0


def test_bpe_is_that_of_the_library(spark, docs):
    ranks = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    odd = spark.createDataFrame([(1, "a b  é日本語🙂\r\n\t'll <|endoftext|>" + "z" * 3000)], "doc_id long, text string")
    for frame in (docs, odd, docs.limit(0)):
        want = {r.doc_id: r.text or "" for r in frame.collect()}
        for r in bpe.round_trip(frame, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect():
            assert bytes(r.ids) == np.array(enc.encode_ordinary(want[r.doc_id]), "<u4").tobytes()
            assert bytes(r.decoded).decode() == want[r.doc_id]


def test_bpe_cache_bound_changes_nothing(monkeypatch):
    model, ranks = bpe.serialise(bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")))
    a = bpe.Codec(model, ranks, P.PATTERN)
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 5)
    b = bpe.Codec(model, ranks, P.PATTERN)
    text = prose(random.Random(1), 300)
    assert [a.encode(t) for t in (text, text[5:], "")] == [b.encode(t) for t in (text, text[5:], "")]


VECTORS = "vec_id long, embedding array<float>, label int"


def vectors(spark, n=700, seed=5, d=12):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d)).astype(np.float32)
    x[n // 2:n // 2 + 60] = x[0]  # copies
    rows = [(int(i), [float(v) for v in r], 0) for i, r in enumerate(x)]
    bad = [(9000, None, 0), (9100, [], 0), (9200, [1.0, None], 0), (9300, [float("nan")] * d, 0), (9400, [float("inf")] * d, 0), rows[3]]
    return spark.createDataFrame([*rows, *bad], VECTORS), x.astype(float)


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 128)
    df, x = vectors(spark)
    z = np.floor(1024 * x).astype(np.int64)
    got = {}
    for r in topk.top_k(topk.scaled(df), F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = {i: [(j, int(z[j] @ z[i])) for j in sorted((j for j in range(len(z)) if j != i), key=lambda j: (-(z[j] @ z[i]), j))[:10]]
            for i in range(0, len(z), 100)}
    assert got == want
    assert topk.top_k(topk.scaled(df.limit(0)), F.col("vec_id") % 100 == 0).count() == 0


def test_nearest_recall_and_scores(spark):
    df, x = vectors(spark)
    got = {}
    for r in ann.nearest(ann.usable(df), F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
        assert r.score == pytest.approx(np.sqrt(((x[r.query_id] - x[r.vec_id]) ** 2).sum()), abs=1e-9)
    hit = 0
    for i in range(0, len(x), 100):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        hit += len(set(got[i]) & set(sorted((j for j in range(len(x)) if j != i), key=lambda j: (d[j], j))[:10]))
    assert hit >= 0.9 * 10 * len(got) and all(len(v) == 10 for v in got.values())


def test_nearest_of_few_or_no_rows(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [0.0, 0.0], 0)], VECTORS)
    assert [(r.query_id, r.vec_id) for r in ann.nearest(ann.usable(few), F.col("vec_id") % 100 == 0).collect()] == [(0, 1)]
    assert ann.nearest(ann.usable(few.limit(0)), F.col("vec_id") % 100 == 0).count() == 0


def test_warc_round_trip(spark):
    rows = [(3, "http://a/\r\nX: y", "<p>same</p>"), (1, None, "<p>same</p>"), (2, "http://b", None), (7, "http://c", ""),
            (5, "http://d", "é\r\n\r\nbody" * 50), (None, "http://e", "<p>same</p>"), (5, "http://d", "é\r\n\r\nbody" * 50)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    index = warc.write(pages)
    got = sorted(((r.page_id or 0), r.payload_bytes, r.record_type, r.refers_to or 0) for r in warc.resolved(index).collect())
    size = len("é\r\n\r\nbody".encode()) * 50
    assert got == [(0, 11, "revisit", 1), (1, 11, "response", 0), (2, 0, "response", 0), (3, 11, "revisit", 1),
                   (5, size, "response", 0), (5, size, "response", 0), (7, 0, "revisit", 2)]
    one = warc.read(index.where("page_id = 1")).collect()
    assert [bytes(r.payload) for r in one] == [b"<p>same</p>"]
    assert one[0].digest == warc.base32_sha1(b"<p>same</p>")
    assert warc.resolved(warc.write(pages.limit(0))).count() == 0
    assert warc.ranges([(0, 5), (5, 5), (1000, 5)], gap=10, span=100) == [(0, 10, [0, 1]), (1000, 1005, [2])]


def test_line_dedup_edges(spark):
    own = [f"own words of page {i} that stand nowhere else" for i in range(8)]
    rows = [(i, f"{own[i]}\n Accept all cookies \n\nend {i}", f"s{i}", "x") for i in range(6)]
    rows += [(6, "Accept all cookies", "s6", "x"), (7, None, None, "x"), (8, "", "s1", "x"), (9, own[0], "s0", "x"), rows[0]]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_removed string")
    got = line_dedup.remove_boilerplate(df)
    out = {r.doc_id: r for r in got.collect()}
    assert got.count() == len(rows)
    assert out[0].text == f"{own[0]}\n\nend 0" and out[0].n_removed == 1
    assert out[6].text == "" and out[6].n_removed == 1  # nothing but boilerplate, and no copy of another text
    assert out[7].text is None and out[8].text == "" and out[9].n_removed == 0
    assert line_dedup.remove_boilerplate(df.limit(0)).count() == 0


def test_mix_redistributes_among_siblings_first(spark):
    rows = [(i, "a b c d", "en", "src0") for i in range(10)] + [(100 + i, "a b c d", "en", "src4") for i in range(100)] \
        + [(500 + i, "a b c d", "de", "src1") for i in range(100)] + [(900, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = mixing.mix(df, share=(1, 2), max_epochs=1, domain_weights={}, lang_weights={}).collect()
    by = {}
    for r in got:
        by[r.source] = by.get(r.source, 0) + r.n_tokens
    # half of 840 tokens, dealt evenly to two domains; src0 has 40 only, the rest goes to its sibling src4
    assert by["src0"] == 40 and 160 <= by["src4"] <= 170 and 204 <= by["src1"] <= 210
    assert len({r.doc_id for r in got}) == len(got)
    twice = mixing.mix(df.where("source = 'src1'"), share=(3, 2), max_epochs=2).collect()
    assert sorted({r.epoch for r in twice}) == [0, 1] and sum(r.epoch == 0 for r in twice) == 100 and len(twice) == 150
    assert mixing.mix(df.limit(0)).count() == 0


def test_toxicity_and_quality_on_edges(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for module in (toxicity, quality):
        model = module.train(docs, none, lambda c: F.lit(True))
        rows = module.score(docs, model).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert module.score(docs.limit(0), model).count() == 0


def test_pu_training_finds_the_words(spark):
    rng = random.Random(9)
    rows = [(i, prose(rng, 40) + (" Nasty!" if i % 6 == 0 else ""), 1 if i % 6 == 0 else 0) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(df, df.select("doc_id", "toxic"), lambda c: F.col(c) % 2 == 0)
    assert max(model[0], key=model[0].get) == "nasty"
    wrong = [r for r in toxicity.score(df, model).collect() if (r.score >= 0.3) != (r.toxic == 1)]
    assert not wrong


def test_crf_marginals_equal_enumeration():
    rng = np.random.default_rng(2)
    node, edge = rng.standard_normal((4, 2)), rng.standard_normal((2, 2))
    at, mask = quality._padded(np.array([3, 1]))
    log_z, good, _ = quality.marginals(node, edge, at, mask)
    weight = {}
    for code in range(8):
        y = [code >> k & 1 for k in range(3)]
        weight[tuple(y)] = np.exp(sum(node[k, y[k]] for k in range(3)) + edge[y[0], y[1]] + edge[y[1], y[2]])
    total = sum(weight.values())
    assert log_z[0] == pytest.approx(np.log(total))
    for k in range(3):
        assert good[0, k] == pytest.approx(sum(w for y, w in weight.items() if y[k]) / total)
    assert good[1, 0] == pytest.approx(1 / (1 + np.exp(node[3, 0] - node[3, 1])))


def test_digests_are_those_of_the_bytes(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None)], "doc_id long, text string")
    out = bpe.round_trip(df, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).select("doc_id", F.sha2("decoded", 256).alias("d")).collect()
    assert {r.doc_id: r.d for r in out} == {1: hashlib.sha256(b"abc").hexdigest(), 2: hashlib.sha256(b"").hexdigest()}
