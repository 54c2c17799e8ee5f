"""Token alignment against a plain search for common ends."""

import hashlib
import json
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from starmart.llm import alignment, queries
from starmart.llm.common import cut

FILES = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(*(open(f, "rb").read() for f in FILES), P.PATTERN)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = ["token", "alignment", "Überstrahlung", "naïve", "日本語", "x=1;", "\n\n", "1234567", "don't", "🙂", "<|endoftext|>", "<s>"]
    made = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(40)]
    return [*made, made[0], None, "", " ", "   ", "a▁b", "\x00", "<0x41>", "x" * 5000, " ".join(words) * 400]


def brute(aligner, text):
    """n_a, n_b, groups as text, Counter of linked id pairs."""
    ids = aligner.tokens([text])[0] if text else None
    if ids is None:
        return 0, 0, "", Counter()
    ends = []
    for side, entries in zip(ids, (aligner.bytes_a, aligner.bytes_b), strict=True):
        at, out = 0, {}
        for i in side:
            at += len(entries[i])
            out[at] = i
        ends.append(out)
    common = sorted(ends[0].keys() & ends[1].keys())
    lo, groups = 0, []
    for hi in common:
        groups.append("|".join(",".join(str(i) for e, i in side.items() if lo < e <= hi) for side in ends))
        lo = hi
    return len(ids[0]), len(ids[1]), ";".join(groups), Counter((ends[0][e], ends[1][e]) for e in common)


def test_pointers_end_at_the_terminal_token_of_each_component():
    a, b, ends = alignment.groups_of(np.array([2, 4, 6, 7, 9]), np.array([3, 5, 7, 8, 9]))
    assert (a.tolist(), b.tolist(), ends.tolist()) == ([0, 0, 0, 0, 1], [0, 0, 0, 1, 1], [2, 4])


def test_rank_encoder_makes_every_entry_by_its_listed_merge(aligner):
    model, chars = json.load(open(FILES[0]))["model"], alignment._byte_chars()
    raw = lambda t: bytes(map(chars.__getitem__, t))
    listed = [tuple(map(raw, m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    ids = [aligner.ranks[a + b] for a, b in listed]
    assert ids == sorted(ids) and len(aligner.ranks) == len(ids) + 256
    for a, b in listed:
        parts = [bytes([c]) for c in a + b]
        while len(parts) > 2:
            _, k = min((aligner.ranks.get(parts[k] + parts[k + 1], 1 << 30), k) for k in range(len(parts) - 1))
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        assert parts == [a, b]


def test_rank_encoder_equals_the_file_own_library(aligner, texts):
    own = Tokenizer.from_file(FILES[0])
    own.encode_special_tokens = True
    some = [t for t in texts if t] + [f"a{chr(c)}b 1{chr(c)}2 {chr(c)}{chr(c)} '{chr(c)}s" for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    for t, e in zip(some, own.encode_batch([f" {t}" for t in some], add_special_tokens=False), strict=True):
        assert aligner.a.encode_to_numpy(f" {t}", disallowed_special=()).tolist() == e.ids


def test_linked_pairs_are_bounded_by_the_vocabularies(aligner):
    assert min(aligner.size_a) > 0 and min(aligner.size_b) > 0
    assert len(set(aligner.bytes_a)) == len(aligner.bytes_a)


def test_alignment_equals_brute_force(spark, aligner, texts):
    rows = [(i, t, f"own{i}", 7) for i, t in enumerate(texts)] + [(None, texts[0], "own", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pairs string, extra int")
    got = alignment.score_links(cut(alignment.align(docs, *FILES, P.PATTERN), "test-alignment"))
    assert got.columns == ["doc_id", "extra", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
    want = [brute(aligner, t) for t in [*texts, texts[0]]]
    total = sum((w[3] for w in want), Counter())
    top = {}
    for (_, b), n in total.items():
        top[b] = max(top.get(b, 0), n)
    found = {r.doc_id: r for r in got.collect()}
    assert len(found) == len(rows) and {r.extra for r in found.values()} == {7}
    for (i, *_), (n_a, n_b, groups, links) in zip(rows, want, strict=True):
        r, n = found[i], sum(links.values())
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups or "") == (n_a, n_b, n, n, groups)
        assert (r.groups is None) == (n_a == 0)
        assert r.n_best == sum(k for p, k in links.items() if total[p] == top[p[1]])
        assert r.count_sum == sum(k * total[p] for p, k in links.items())


def test_slices_do_not_change_the_result(aligner, texts, monkeypatch):
    whole = aligner.align(texts)
    monkeypatch.setattr(alignment, "SLICE", 100)
    parts = [r for lo, hi in alignment._slices(texts) for r in aligner.align(texts[lo:hi])]
    assert [r[:5] for r in whole] == [r[:5] for r in parts]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.score_links(cut(alignment.align(docs, *FILES, P.PATTERN), "test-alignment")).count() == 0


def test_registered_query(spark, aligner, tmp_path):
    spark.createDataFrame([(1, "one two three"), (2, None), (3, "a▁b"), (1, "one two")], "doc_id long, text string").write.parquet(
        str(tmp_path / "documents.parquet"))
    out = queries.queries()["op11_token_alignment"](spark, str(tmp_path))
    assert dict(out.dtypes) == {"doc_id": "bigint", "groups_sha256": "string"} | {
        c: "bigint" for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")}
    rows = sorted(map(tuple, out.select("doc_id", "n_a", "groups_sha256").collect()))
    hashed = {t: hashlib.sha256(brute(aligner, t)[2].encode()).hexdigest() for t in ("one two", "one two three")}
    assert rows == sorted([(1, 3, hashed["one two three"]), (1, 2, hashed["one two"]), (2, 0, ""), (3, 0, "")])
