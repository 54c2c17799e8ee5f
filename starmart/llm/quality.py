"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad by a two-state chain whose node scores are
linear in features of the line and of its two neighbours, and whose edge
scores are free.  Forward-backward gives each line's marginal; a document's
score is the mean marginal of *good*, weighted by line length in bytes.

Only documents are labelled, so in training each line carries its document's
label; the fit maximises the conditional likelihood of whole label sequences
of a bounded sample of the training fold (at most MAX_DOCS documents, each with
all its lines).

Null and empty texts are one empty line.  Without both labels in the sample
the score is the only label seen (1 if none).  Repeated rows each give a row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_DOCS = 4000   # bound on the documents of the fit

# byte classes, each counted per line
_CLASSES = (b"abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100)), b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789",
            b" \t\r", b".,;:", b"!?", b"|", b"%$&#*@^~_=+\\/<>{}[]")
_CLASS = np.full(256, len(_CLASSES), np.uint8)
for _i, _chars in enumerate(_CLASSES):
    _CLASS[list(_chars)] = _i
N_OWN = 17


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line of every text, lengths of lines, and the first
    line of each text (with the total at the end)."""
    raw = [(t or "").encode() for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    ends = np.flatnonzero(data == 10)
    starts = np.append(0, ends[:-1] + 1)
    size = (ends - starts).astype(float)
    kind = _CLASS[data]
    counts = np.stack([np.add.reduceat((kind == k).astype(np.int32), starts) for k in range(len(_CLASSES))], 1)
    space = kind == 3
    word = np.add.reduceat((~space[:] & (data != 10) & np.append(True, space[:-1] | (data[:-1] == 10))).astype(np.int32), starts)
    same = np.add.reduceat((np.append(False, data[1:] == data[:-1]) & (data != 10)).astype(np.int32), starts)
    first = np.cumsum([0, *[r.count(b"\n") + 1 for r in raw]])
    share = counts / np.maximum(size, 1)[:, None]
    per_word = size / np.maximum(word, 1)
    marks = (counts[:, 4] + counts[:, 5] + counts[:, 6] + counts[:, 7]) / np.maximum(word, 1)
    final = data[np.maximum(ends - 1, 0)]
    again, fresh = np.zeros(len(ends)), np.zeros(len(ends))
    row = 0
    for r in raw:  # lines seen before in the text; share of distinct words
        seen = set()
        for line in r.split(b"\n"):
            again[row] = line in seen
            seen.add(line)
            words = line.split()
            fresh[row] = len(set(words)) / len(words) if words else 1
            row += 1
    own = np.column_stack([share, per_word / 10, np.minimum(per_word, 40) ** 2 / 400, np.minimum(marks, 3),
                           np.log1p(size) / 8, np.log1p(word) / 6, (final == 46), same / np.maximum(size, 1),
                           again, fresh])
    own[size == 0] = 0
    return own, size, first


def with_neighbours(own: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Own features, those of the lines before and after (zero outside the
    text), marks of the text's ends, and a constant."""
    before, after = np.roll(own, 1, 0), np.roll(own, -1, 0)
    top, last = first[:-1], first[1:] - 1
    before[top], after[last] = 0, 0
    edge = np.zeros((len(own), 3))
    edge[:, 2], edge[top, 0], edge[last, 1] = 1, 1, 1
    return np.hstack([own, before, after, edge])


def _padded(lengths: np.ndarray, start: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows of each sequence (from ``start``, or one after the other) and which are its own."""
    width = int(lengths.max())
    start = np.cumsum(lengths) - lengths if start is None else start
    mask = np.arange(width)[None, :] < lengths[:, None]
    at = np.where(mask, start[:, None] + np.arange(width)[None, :], 0)
    return at, mask


def _groups(lengths: np.ndarray):
    """Indices of texts of like numbers of lines together."""
    order = np.argsort(lengths, kind="stable")
    lo = 0
    while lo < len(order):
        hi = lo + 1
        while hi < len(order) and lengths[order[hi]] <= max(8, 2 * lengths[order[lo]]) and \
                (hi - lo + 1) * lengths[order[hi]] <= 1 << 18:
            hi += 1
        yield order[lo:hi]
        lo = hi


def marginals(node: np.ndarray, edge: np.ndarray, at: np.ndarray, mask: np.ndarray):
    """Forward-backward in logarithms over padded sequences: log partition,
    marginal of state 1 per position, and expected transitions."""
    n, width = at.shape
    x = node[at]                                       # n, width, 2
    fwd, bwd = np.zeros_like(x), np.zeros_like(x)
    fwd[:, 0] = x[:, 0]
    for t in range(1, width):
        step = np.logaddexp(fwd[:, t - 1, :1] + edge[0], fwd[:, t - 1, 1:] + edge[1]) + x[:, t]
        fwd[:, t] = np.where(mask[:, t, None], step, fwd[:, t - 1])
    log_z = np.logaddexp(fwd[:, -1, 0], fwd[:, -1, 1])
    for t in range(width - 2, -1, -1):
        follow = x[:, t + 1] + bwd[:, t + 1]
        step = np.logaddexp(follow[:, :1] + edge[:, 0], follow[:, 1:] + edge[:, 1])
        bwd[:, t] = np.where(mask[:, t + 1, None], step, 0)
    good = np.exp(np.minimum(fwd[:, :, 1] + bwd[:, :, 1] - log_z[:, None], 0))
    pairs = np.zeros((2, 2))
    for t in range(width - 1):
        follow = x[:, t + 1] + bwd[:, t + 1]
        p = np.exp(fwd[:, t, :, None] + edge[None] + follow[:, None, :] - log_z[:, None, None])
        pairs += (p * mask[:, t + 1, None, None]).sum(0)
    return log_z, good, pairs


def fit(own: np.ndarray, first: np.ndarray, label: np.ndarray, steps: int = 160, rate: float = 0.06, decay: float = 1e-3):
    """Weights of node and edge scores by Adam on the mean conditional log
    likelihood, each document weighing the same whatever its number of lines."""
    scale = own.std(0) + 1e-6
    x = with_neighbours(own / scale, first)
    lengths = np.diff(first)
    groups = [_padded(lengths[group], first[:-1][group]) for group in _groups(lengths)]
    doc = np.repeat(np.arange(len(lengths)), lengths)
    y = label[doc].astype(float)
    theta, edge = np.zeros(x.shape[1]), np.zeros((2, 2))
    m1, m2 = np.zeros(len(theta) + 4), np.zeros(len(theta) + 4)
    kept = np.zeros((2, 2))
    for v in (0, 1):
        kept[v, v] = (lengths[label == v] - 1).sum()
    for step in range(1, steps + 1):
        node = np.column_stack([np.zeros(len(x)), x @ theta])
        good, pairs = np.zeros(len(x)), np.zeros((2, 2))
        for at, mask in groups:
            _, inside, moves = marginals(node, edge, at, mask)
            good[at[mask]] = inside[mask]
            pairs += moves
        g = np.append(x.T @ (good - y), (pairs - kept).ravel()) / len(x)
        g += decay * np.append(theta, edge.ravel())
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        move = rate * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.999 ** step)) + 1e-8)
        theta, edge = theta - move[:-4], edge - move[-4:].reshape(2, 2)
    return scale, theta, edge


def score_texts(texts: list[str | None], model) -> np.ndarray:
    """Length-weighted mean marginal of *good* per text."""
    if not texts:
        return np.zeros(0)
    own, size, first = line_features(texts)
    if model[1] is None:
        return np.full(len(texts), model[0], float)
    scale, theta, edge = model
    node = np.column_stack([np.zeros(len(own)), with_neighbours(own / scale, first) @ theta])
    lengths, out = np.diff(first), np.zeros(len(texts))
    for group in _groups(lengths):
        at, mask = _padded(lengths[group], first[:-1][group])
        _, good, _ = marginals(node, edge, at, mask)
        weight = np.where(mask, size[at] + 1, 0)
        out[group] = (good * weight).sum(1) / weight.sum(1)
    return np.clip(out, 0, 1)


def train(docs: DataFrame, labels: DataFrame, in_training):
    """The model from labelled rows where ``in_training(doc_id)`` holds; the
    sample is the first MAX_DOCS by a hash of doc_id."""
    pick = (labels.select("doc_id", "quality").where(in_training("doc_id") & F.col("quality").isin(0, 1))
            .groupBy("doc_id").agg(F.min("quality").alias("quality"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_DOCS))
    sample = docs.select("doc_id", "text").join(F.broadcast(pick), "doc_id").select("text", "quality")

    def features(batches):
        for batch in batches:
            own, _, first = line_features(batch.column(0).to_pylist()) if batch.num_rows else (None, None, [0])
            kept = [own[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k.astype("<f4").tobytes() for k in kept], pa.binary()), batch.column(1).cast(pa.int32())],
                names=["own", "quality"])

    rows = sorted((r["own"], r["quality"]) for r in sample.mapInArrow(features, "own binary, quality int").collect())
    label = np.array([r[1] for r in rows], int)
    if len(set(label.tolist())) < 2:
        return (float(label[0]) if len(label) else 1.0, None, None)
    own = [np.frombuffer(r[0], "<f4").reshape(-1, N_OWN).astype(float) for r in rows]
    return fit(np.vstack(own), np.cumsum([0, *map(len, own)]), label)


def score(docs: DataFrame, model) -> DataFrame:
    """``docs`` with ``score`` in [0, 1], higher for good."""
    keep = [c for c in docs.columns if c != "score"]
    source = docs.select(*[F.col(f"`{c}`") for c in keep])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*source.schema.fields, T.StructField("score", T.DoubleType())])
    at = keep.index("text")

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(score_texts(part.column(at).to_pylist(), shared.value))],
                    names=[*keep, "score"])

    return source.mapInArrow(run, schema)
