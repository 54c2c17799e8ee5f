"""The corpus pipeline on small tables: its stages' decisions, odd rows, empty tables, contract columns of the scored queries."""

import random
import zlib

import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline
from starmart.llm import queries
from starmart.llm.bpe import read_ranks
from starmart.llm.common import cut

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"
MILD = [f"calm{i}" for i in range(300)]
HARSH = [f"vile{i}" for i in range(12)]
NAV = "home about contact imprint"


def write(spark, path, docs, labels):
    spark.createDataFrame(docs, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{path}/labels.parquet")
    return str(path)


def prose(rng, n, extra=()):
    words = [rng.choice(MILD) for _ in range(n)]
    for w in extra:
        words.insert(rng.randrange(len(words)), w)
    return " ".join(words)


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    rng = random.Random(7)
    docs, labels = [], []
    for i in range(400):
        toxic = i % 8 == 0
        text = f"{prose(rng, 40, [rng.choice(HARSH) for _ in range(6)] if toxic else ())}\n{NAV}"
        docs.append([i, text, "en" if i % 3 else "de", f"site{i % 9}", len(text)])
        labels.append((i, i % 2, int(toxic)))
    copy = docs[1][1]
    docs += [[500, copy, "en", "site3", 1], [501, copy.replace("calm", "calm", 1), "en", "site4", 1]]
    docs += [[600, None, None, None, None], [601, "", "en", "site1", 0], [602, "  \n ", "en", None, 4], [None, prose(rng, 40), "en", "site2", 5],
             [603, prose(rng, 20000), "en", "site5", 9], [700, "one text of an id", "en", "site1", 1], [700, "another text of that id", "en", "site1", 1]]
    return write(spark, tmp_path_factory.mktemp("pipeline"), docs, labels), docs


def test_stages_decide_and_keep_columns(spark, sf):
    path, docs = sf
    toxic = {d[0] for d in docs if d[0] is not None and d[0] < 400 and d[0] % 8 == 0}
    at = spark.read.parquet(f"{path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = cut(stage(spark, at, path), f"test-{name}")
        assert at.columns == corpus_pipeline.COLUMNS
        seen[name] = at.collect()
    ids = {name: [r.doc_id for r in rows] for name, rows in seen.items()}
    assert len(toxic & set(ids["toxicity"])) <= 0.1 * len(toxic)
    clean = [d for d in docs if d[0] not in toxic]
    assert len(ids["toxicity"]) >= 0.98 * len(clean)
    assert len(ids["line_dedup"]) == len(ids["toxicity"])
    assert not any(NAV in (r.text or "") for r in seen["line_dedup"])
    kept = ids["ngram_jaccard"]
    assert (1 in kept) and not {500, 501} & set(kept)                   # one of three copies
    assert kept.count(700) == 2 and {600, 601, 602, 603, None} <= set(kept)
    assert set(ids["source_mix"]) <= set(kept)
    out = corpus_pipeline.STAGES[-1][1](spark, at, path)
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    texts = {(r.doc_id, r.lang, r.source, r.text) for r in seen["source_mix"]}
    want = sorted((str(i), len(enc.encode_ordinary(t or ""))) for i, _, _, t in texts)
    assert sorted((str(r.doc_id), r.n_tokens) for r in out.collect()) == want


def test_run_equals_its_stages_and_takes_empty_tables(spark, tmp_path):
    path = write(spark, tmp_path, [], [])
    out = corpus_pipeline.run(spark, path)
    assert out.count() == 0 and out.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "decoded_sha256"]


@pytest.mark.parametrize("name,modulus,fold,least", [("op5_line_crf", 3, 1, 0.5), ("op9_pu_toxicity", 4, 2, 0.3)])
def test_scored_queries_hold_out_by_id(spark, sf, name, modulus, fold, least):
    path, docs = sf
    rows = queries.queries()[name](spark, path).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % modulus == fold)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= least)
    if name == "op9_pu_toxicity":
        held = [r for r in rows if r.held_out and r.doc_id < 400]
        assert sum(r.predicted == (r.doc_id % 8 == 0) for r in held) >= 0.95 * len(held)
