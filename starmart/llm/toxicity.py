"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic examples are the positives; a bounded sample of all texts of
the training fold, whatever their label, is the unlabelled set.  A linear
classifier over word presence is trained in numpy on the risk

    prior * R_p(+)  +  max(0, R_u(-) - prior * R_p(-))

whose second term is what the unlabelled texts say about negatives once the
share of positives among them is taken out; where it falls below zero only
that excess is unlearned.  The prior is the share of toxic among the labelled
rows of the training fold.  The learned weights (a bounded vocabulary) are
broadcast, and every whole text is scored in one pass.

Null and empty texts get the score of no words.  Repeated rows each give a
row.  Without a positive or an unlabelled example every score is the prior
(0 if there are no labels either).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.common import cut

WORD = re.compile(r"\w+").findall
MAX_POSITIVE = 4000     # bound on the positives of the fit
MAX_UNLABELLED = 8000   # bound on the unlabelled texts of the fit
MAX_VOCABULARY = 20000  # bound on the words of the model
TEXTS = 500             # texts of a batch held as Python strings, and sent back, at once


def words_of(text: str | None) -> set[str]:
    return set(WORD(text.lower())) if text else set()


def _sample(docs: DataFrame, picked: DataFrame, side: int) -> DataFrame:
    """(side, words) of the picked documents."""
    def run(batches):
        for batch in batches:
            words = [sorted(words_of(t)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([side] * len(words), pa.int32()), pa.array(words, pa.list_(pa.string()))],
                                             names=["side", "words"])
    return (docs.join(F.broadcast(picked), "doc_id", "left_semi").select("text")
            .mapInArrow(run, "side int, words array<string>"))


def vocabulary(sample: DataFrame, n_p: int, n_u: int, least_z: float = 4.5) -> list[str]:
    """Words whose document frequency differs between the two sides by more
    than ``least_z`` standard errors: rare words seen by chance stay out."""
    counts = (sample.select("side", F.explode("words").alias("word"))
              .groupBy("word").agg(F.sum("side").alias("p"), F.count("*").alias("n")).where("n >= 3"))
    both = (F.col("n") + 1) / (n_p + n_u + 2)
    apart = F.abs(F.col("p") / n_p - (F.col("n") - F.col("p")) / n_u)
    scored = counts.withColumn("z", apart / F.sqrt(both * (1 - both) * (1 / n_p + 1 / n_u))).where(F.col("z") > least_z)
    return [r["word"] for r in scored.orderBy(F.desc("z"), "word").limit(MAX_VOCABULARY).select("word").collect()]


def _columns(sample: DataFrame, vocab: list[str]) -> tuple[list[list[int]], list[list[int]]]:
    """Vocabulary words of each positive and each unlabelled document."""
    shared = sample.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(vocab)})

    def run(batches):
        index = shared.value
        for batch in batches:
            found = [sorted(index[w] for w in words if w in index) for words in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], names=["side", "words"])

    rows = sorted((r["side"], r["words"]) for r in sample.mapInArrow(run, "side int, words array<int>").collect())
    return [w for s, w in rows if s], [w for s, w in rows if not s]


def fit(positive: list[list[int]], unlabelled: list[list[int]], v: int, prior: float,
        steps: int = 600, rate: float = 0.05, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights of ``v`` words and bias; logistic loss, Adam, L2 penalty ``decay``."""
    if not positive or not unlabelled or not 0 < prior < 1:
        odds = np.log(prior / (1 - prior)) if 0 < prior < 1 else (30.0 if prior >= 1 else -30.0)
        return np.zeros(v), float(odds)

    def matrix(lists):
        return np.array([i for c in lists for i in c], np.int64), np.repeat(np.arange(len(lists)), [len(c) for c in lists])

    (pc, pr), (uc, ur) = matrix(positive), matrix(unlabelled)
    n_p, n_u = len(positive), len(unlabelled)
    theta, m1, m2 = np.zeros(v + 1), np.zeros(v + 1), np.zeros(v + 1)
    theta[v] = np.log(prior / (1 - prior))
    for step in range(1, steps + 1):
        z_p = np.bincount(pr, theta[pc], n_p) + theta[v]
        z_u = np.bincount(ur, theta[uc], n_u) + theta[v]
        s_p, s_u = 1 / (1 + np.exp(-z_p)), 1 / (1 + np.exp(-z_u))
        # logistic loss: log(1 + e^-z) as positive, log(1 + e^z) as negative
        negative = np.logaddexp(0, z_u).mean() - prior * np.logaddexp(0, z_p).mean()
        if negative >= 0:
            g_u = s_u / n_u
            g_p = prior * (s_p - 1) / n_p - prior * s_p / n_p
        else:  # the corrected risk is below zero: unlearn that excess only
            g_u = -s_u / n_u
            g_p = prior * s_p / n_p
        grad = np.append(np.bincount(pc, g_p[pr], v) + np.bincount(uc, g_u[ur], v) + decay * theta[:v],
                         g_p.sum() + g_u.sum())
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.999 * m2 + 0.001 * grad * grad
        theta = theta - rate * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.999 ** step)) + 1e-8)
    return theta[:v], float(theta[v])


def train(docs: DataFrame, labels: DataFrame, in_training) -> tuple[dict[str, float], float]:
    """The model from rows where ``in_training(doc_id)`` holds; the samples are
    the first by a hash of doc_id, so any run takes the same."""
    docs = docs.select("doc_id", "text").where(in_training("doc_id"))
    known = labels.select("doc_id", "toxic").where(in_training("doc_id") & F.col("toxic").isNotNull())
    n, toxic = known.agg(F.count("*"), F.sum(F.col("toxic").cast("long"))).first()
    prior = (toxic or 0) / n if n else 0.0
    order = [F.xxhash64("doc_id"), "doc_id"]
    toxic_ids = known.where("toxic = 1").select("doc_id").distinct().orderBy(*order).limit(MAX_POSITIVE)
    any_ids = docs.select("doc_id").distinct().orderBy(*order).limit(MAX_UNLABELLED)
    sample = cut(_sample(docs, toxic_ids, 1).unionByName(_sample(docs, any_ids, 0)), "toxicity-sample")
    sides = {r["side"]: r["count"] for r in sample.groupBy("side").count().collect()}
    vocab = vocabulary(sample, sides[1], sides[0]) if len(sides) == 2 else []
    positive, unlabelled = _columns(sample, vocab)
    weights, bias = fit(positive, unlabelled, len(vocab), prior)
    return dict(zip(vocab, map(float, weights), strict=True)), bias


def score(docs: DataFrame, model: tuple[dict[str, float], float]) -> DataFrame:
    """``docs`` with ``score`` in [0, 1]; the whole text counts."""
    keep = [c for c in docs.columns if c != "score"]
    source = docs.select(*[F.col(f"`{c}`") for c in keep])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*source.schema.fields, T.StructField("score", T.DoubleType())])
    at = keep.index("text")

    def run(batches):
        weights, bias = shared.value
        vocab, get = weights.keys(), weights.__getitem__
        for whole in batches:
            for lo in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(lo, TEXTS)
                z = np.array([bias + sum(map(get, sorted(vocab & words_of(t)))) for t in batch.column(at).to_pylist()], float)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(1 / (1 + np.exp(-np.clip(z, -700, 700))))], names=[*keep, "score"])

    return source.mapInArrow(run, schema)
