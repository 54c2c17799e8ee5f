"""Alignment of two tokenizations of every text, by pointer jumping.

Each text is encoded by a byte-level BPE (A) and a sentencepiece model (B);
both cover the bytes of a space and the text.  A's file is read into ranks and
merged by the rank encoder: ids rise along the file's merges, and every entry
is built by the very merge the file lists for it, so both pick the same merge
at every step (a test shows it for the whole vocabulary).  The tokens of a slice of texts
lie end to end on one byte axis.  Every token points to the token that
overlaps it and reaches farthest right (B's where both end together, so such
a token is terminal).  Doubling all pointers at once, succ = succ[succ], until
nothing changes takes every token to its component's terminal token, which
labels its group; the number of doublings is the logarithm of the longest
chain.  Groups are the parts between byte offsets where A and B both end.

A link is an A and a B token occurrence that end together.  Linked tokens are
suffixes of one another, so the distinct linked id pairs are at most the
summed lengths of both vocabularies' entries, whatever the corpus: their
corpus-wide counts are one aggregation and a broadcast of that proven size.

Null and empty texts, and texts whose joined token bytes differ from space
and text, have no tokens: zero counts, null ``groups``, no pairs.  Repeated
rows each give a row and count each.  Columns of ``docs`` that bear an
output's name are replaced, others pass through.  An empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE = 1 << 20      # characters of texts that are aligned at once
MADE = {"n_a": T.LongType(), "n_b": T.LongType(), "n_groups": T.LongType(), "n_links": T.LongType(),
        "groups": T.StringType(), "pairs": T.ArrayType(T.LongType()), "times": T.ArrayType(T.LongType())}
_loaded: dict = {}


def groups_of(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group of each A and B token and the B tokens that end a group, from
    strictly rising end offsets with the same last one."""
    na, nb = len(ends_a), len(ends_b)
    right_b = np.searchsorted(ends_b, ends_a)
    right_a = np.searchsorted(ends_a, ends_b)
    last = ends_a[right_a] == ends_b
    succ = np.concatenate([na + right_b, np.where(last, na + np.arange(nb), right_a)])
    while not np.array_equal(jumped := succ[succ], succ):
        succ = jumped
    ends = np.flatnonzero(last)
    label = np.searchsorted(na + ends, succ)
    return label[:na], label[na:], ends


def _byte_chars() -> dict[str, int]:
    """Characters that stand for bytes in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def byte_ranks(byte_json: bytes) -> dict[bytes, int]:
    """Token bytes and ids of a byte-level vocabulary file, without special tokens."""
    model, chars = json.loads(byte_json)["model"], _byte_chars()
    merges = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
    made = {a + b for a, b in merges}
    return {bytes(map(chars.__getitem__, t)): i for t, i in model["vocab"].items() if len(t) == 1 or t in made}


class Aligner:
    """Both tokenizers and their tables in one Python worker."""

    def __init__(self, byte_json: bytes, piece_model: bytes, pattern: str):
        import sentencepiece
        import tiktoken

        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        self.ranks = byte_ranks(byte_json)
        self.a = tiktoken.Encoding("byte-level", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})
        self.bytes_a = [b""] * (max(self.ranks.values()) + 1)
        for token, i in self.ranks.items():
            self.bytes_a[i] = token
        na, nb = len(self.bytes_a), self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(nb)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(t) for t in x], np.int64) for x in (self.bytes_a, self.bytes_b))
        ids = [*map(str, range(na)), *map(str, range(nb))]
        self.words = np.array([f"{i}{sep}" for sep in ",|;" for i in ids], object)
        self.na, self.all = na, na + nb

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, list[int]] | None]:
        """Ids of A and B of each text; None where one does not give its bytes back."""
        out = []
        for t, b in zip(texts, self.b.encode(texts, num_threads=1), strict=True):
            a, whole = self.a.encode_to_numpy(f" {t}", disallowed_special=()), f" {t}".encode()
            # A's tokens are parts of the text in order: their length decides
            same = self.size_a[a].sum() == len(whole) and b"".join(map(self.bytes_b.__getitem__, b)) == whole
            out.append((a, b) if same else None)
        return out

    def align(self, texts: list[str | None]) -> list[tuple]:
        """The values of MADE for each text."""
        at = [i for i, t in enumerate(texts) if t]
        found = [(i, x) for i, x in zip(at, self.tokens([texts[i] for i in at]), strict=True) if x] if at else []
        rows = [(0, 0, 0, 0, None, [], [])] * len(texts)
        if not found:
            return rows
        a = np.concatenate([np.asarray(x[0], np.int64) for _, x in found])
        b = np.concatenate([np.asarray(x[1], np.int64) for _, x in found])
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        label_a, label_b, ends = groups_of(ends_a, ends_b)
        # output place of every token: by group, A before B
        n = len(ends)
        in_a, in_b = np.bincount(label_a, minlength=n), np.bincount(label_b, minlength=n)
        first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        start = first_a + first_b
        word = np.empty(len(a) + len(b), np.int64)
        word[start[label_a] + np.arange(len(a)) - first_a[label_a]] = a
        word[(start + in_a)[label_b] + np.arange(len(b)) - first_b[label_b]] = self.na + b
        word[start + in_a - 1] += self.all
        word[start + in_a + in_b - 1] += 2 * self.all
        words = self.words[word].tolist()
        pair = (a[np.searchsorted(ends_a, ends_b[ends])] << 32) | b[ends]
        # borders of the texts in tokens and groups
        stop_a, stop_b = (np.cumsum([len(x[k]) for _, x in found]) for k in (0, 1))
        stop_g = label_b[stop_b - 1] + 1
        la = lb = lg = 0
        for (i, _), ha, hb, hg in zip(found, stop_a.tolist(), stop_b.tolist(), stop_g.tolist(), strict=True):
            keys, times = np.unique(pair[lg:hg], return_counts=True)
            rows[i] = (ha - la, hb - lb, hg - lg, hg - lg, "".join(words[la + lb:ha + hb])[:-1], keys, times)
            la, lb, lg = ha, hb, hg
        return rows


def _aligner(shared) -> Aligner:
    byte_json, piece_model, pattern, name = shared.value
    if name not in _loaded:
        _loaded[name] = Aligner(byte_json, piece_model, pattern)
    return _loaded[name]


def _slices(texts: list[str | None]):
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= SLICE:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def align(docs: DataFrame, byte_vocabulary: str, piece_model: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with n_a, n_b, n_groups, n_links, ``groups``
    (``a1,a2|b1;a3|b2`` in ids), and the distinct linked ``pairs`` (A id times
    2^32 plus B id) with their ``times``.  Both models are broadcast."""
    with open(byte_vocabulary, "rb") as f, open(piece_model, "rb") as g:
        models = f.read(), g.read()
    name = hashlib.sha256(b"".join([*models, pattern.encode()])).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast((*models, pattern, name))
    keep = [c for c in docs.columns if c != text and c not in MADE]
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text))
    schema = T.StructType([*docs.select(*[f"`{c}`" for c in keep]).schema.fields,
                           *[T.StructField(c, t) for c, t in MADE.items()]])
    kinds = [pa.int64()] * 4 + [pa.string()] + [pa.list_(pa.int64())] * 2

    def run(batches):
        aligner = _aligner(shared)
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            for lo, hi in _slices(texts):
                made = zip(*aligner.align(texts[lo:hi]), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(lo, hi - lo) for c in batch.columns[:len(keep)]),
                     *(pa.array(x, k) for x, k in zip(made, kinds, strict=True))], names=schema.names)

    return source.mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, n (links of the whole corpus that hold it), best (n is the highest
    of its B id).  Pairs are summed map-side; what is left is bounded by the
    vocabularies."""
    links = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    n = links.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("n"))
    top = n.groupBy((F.col("pair").bitwiseAND(0xFFFFFFFF)).alias("b")).agg(F.max("n").alias("top"))
    return (n.withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF)).join(top, "b")
            .select("pair", "n", (F.col("n") == F.col("top")).alias("best")))


def score_links(aligned: DataFrame) -> DataFrame:
    """``aligned`` (a written table: it is read twice) with ``n_best`` (links
    whose pair has its B id's highest count) and ``count_sum`` (counts summed
    over links) in place of pairs and times."""
    counts = pair_counts(aligned).toArrow().sort_by("pair")
    shared = aligned.sparkSession.sparkContext.broadcast(
        [counts.column(c).to_numpy() for c in ("pair", "n", "best")])
    keep = [c for c in aligned.columns if c not in ("pairs", "times")]
    schema = T.StructType([*aligned.select(*[f"`{c}`" for c in keep]).schema.fields,
                           T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def run(batches):
        pair, n, best = shared.value
        for batch in batches:
            pairs, times = batch.column(len(keep)), batch.column(len(keep) + 1)
            sizes = np.diff(pairs.offsets.to_numpy())
            at = np.searchsorted(pair, pairs.flatten().to_numpy(zero_copy_only=False))
            times = times.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(sizes)), sizes)
            n_best, count_sum = np.zeros((2, len(sizes)), np.int64)
            np.add.at(n_best, row, times * best[at])
            np.add.at(count_sum, row, times * n[at])
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(n_best), pa.array(count_sum)],
                                             names=schema.names)

    source = aligned.select(*[F.col(f"`{c}`") for c in keep], "pairs", "times")
    return source.mapInArrow(run, schema)
