"""Exact top-k by inner product over an impact-ordered, score-at-a-time index.

Vectors are integers floor(scale * x).  The index is cut into blocks of about
BLOCK vectors by a hash of the id.  A block's postings are segments: the
vectors of one dimension whose component falls in one quantisation step.  For
a query, a segment's impact is the largest contribution that its step allows,
counted above the least that the block has in that dimension; segments are
processed by descending impact in waves.  After each wave a vector's score is
at most the block's floor, plus the impacts of its processed segments, plus
for each dimension not yet seen the next impact (or all that the dimension
has, if that is less).  Vectors whose bound is below a threshold that k exact
scores reach cannot be among the k; processing stops when few others are left,
or when all postings are done, and those are rescored exactly.

The threshold is a query's k-th best exact score over the first eighth of the
blocks, which are searched before the others (and over the best so far of the
block itself).  The others then stop early: the README has the share of
postings read.  Queries travel in blocks; each block of queries meets each
block of the index once, and a window keeps the k best of a query's results.

Vectors with a scaled component from 2^26 on (less where vectors are longer
than 1024), for which integer sums could overflow, meet all others, as queries
and as candidates, in Python integers instead.  Where a score among the k best
exceeds a long the query fails, as it does where a scaled component exceeds a
double.

Vectors that are null, empty or hold null or non-finite components take no
part.  Rows that share an id count once, as the smallest vector.
Missing trailing components count as zero.  Ties go to the smaller id.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import arrow_rows, cut, runs

BLOCK = 1024      # vectors of an index block
QUERIES = 128     # queries of a query block
STEP_BITS = 5     # a quantisation step is 2^5 units
FIRST = 8         # one block of so many is searched for the thresholds
SHARES = (0.4, 0.5, 0.6, 0.7, 0.85, 1.0)   # postings read after each wave
_LIMIT = float(1 << 26)


def valid(column: str):
    """Vectors that may take part."""
    return F.col(column).isNotNull() & (F.size(column) > 0) & F.forall(
        column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def scaled(df: DataFrame, scale: int = 1024) -> DataFrame:
    """(vec_id, v): one vector of integers, as doubles, per id."""
    def whole(x):
        y = F.lit(scale) * x.cast("double")
        return (F.when(F.abs(y) < F.lit(float(1 << 53)), F.floor(y).cast("double"))  # doubles from 2^53 on are whole
                .when(F.abs(y) < F.lit(float("inf")), y).otherwise(F.raise_error(F.lit("a scaled component exceeds a double")).cast("double")))

    v = F.transform("embedding", whole)
    return (df.select(F.col("vec_id").cast("long"), "embedding").where(F.col("vec_id").isNotNull() & valid("embedding"))
            .select("vec_id", v.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v")))


def matrix(vectors: list[list[float]], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


class Block:
    """Posting segments of a block of vectors."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        n, d = x.shape
        self.ids, self.x = ids, x
        level = x >> STEP_BITS
        order = np.argsort(level, 0, kind="stable")
        self.postings = order.T.ravel()
        flat = np.take_along_axis(level, order, 0).T.ravel()
        dim = np.repeat(np.arange(d), n)
        self.start = np.flatnonzero(np.append(True, (flat[1:] != flat[:-1]) | (dim[1:] != dim[:-1])))
        self.length = np.diff(np.append(self.start, len(flat)))
        self.dim, self.low = dim[self.start], flat[self.start] << STEP_BITS
        self.first = np.flatnonzero(np.append(True, self.dim[1:] != self.dim[:-1]))
        self.read = 0      # postings processed so far, over all searches

    def search(self, q: np.ndarray, own: int, k: int, least: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the k best for q among those that may reach ``least``,
        the vector of id ``own`` left out."""
        n, d = self.x.shape
        w = q[self.dim]
        impact = np.where(w > 0, w * (self.low + (1 << STEP_BITS) - 1), w * self.low).astype(float)
        most = d * np.abs(impact).max(initial=0)  # of any sum below; floats hold sums below 2^51 exactly
        slack = 0.0 if most < 1 << 49 else most * d * 2.0 ** -46
        floor = np.minimum.reduceat(impact, self.first)
        impact -= floor[self.dim]
        reach = np.maximum.reduceat(impact, self.first)
        floor = floor.sum() + slack
        order = np.argsort(-impact, kind="stable")
        done = np.cumsum(self.length[order])
        out = np.flatnonzero(self.ids == own)
        bound, seen = np.zeros(n), np.zeros(n)
        lo = 0
        for share in SHARES:
            hi = min(len(order), int(np.searchsorted(done, done[-1] * share)) + 1)
            segments = order[lo:hi]
            lengths = self.length[segments]
            at = np.repeat(self.start[segments] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
            rows = self.postings[at]
            bound += np.bincount(rows, np.repeat(impact[segments], lengths), n)
            seen += np.bincount(rows, minlength=n)
            lo = hi
            following = impact[order[lo]] if lo < len(order) else 0.0
            # dimensions with a processed segment reach beyond the next impact
            upper = bound - following * seen + (floor + np.minimum(reach, following).sum())
            upper[out] = -np.inf
            if least == -np.inf or lo == len(order):
                best = np.argpartition(-upper, min(2 * k, n) - 1)[:2 * k]
                exact = np.sort(self.x[best[np.isfinite(upper[best])]] @ q)[::-1]
                if len(exact) >= k:
                    least = max(least, float(exact[k - 1]))
            members = np.flatnonzero(np.isfinite(upper) & (upper >= least - abs(least) * 2.0 ** -50))
            if len(members) <= max(4 * k, n // 4):
                break
        self.read += int(done[lo - 1])
        score = self.x[members] @ q
        first = np.lexsort((self.ids[members], -score))[:k]
        return members[first], score[first]


_LONG = 1 << 63


def exact(ids: np.ndarray, x: np.ndarray, q: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
    """(id, score) of the k best for q in Python integers.  A score above a
    long would be among the k; one below is held as -2^63 - 1."""
    score = x @ q
    best = sorted(((-s, i) for s, i in zip(score.tolist(), ids.tolist(), strict=True) if i != own))[:k]
    if best and -best[0][0] >= _LONG:
        raise OverflowError(f"a score of query {own} exceeds a long")
    return [(i, max(-s, -_LONG - 1)) for s, i in best]


def top_k(vectors: DataFrame, is_query, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other vectors of each row of
    ``vectors`` (vec_id, v) for which the condition ``is_query`` holds."""
    spark = vectors.sparkSession
    vectors = cut(vectors, "vectors")
    width = vectors.agg(F.max(F.size("v"))).first()[0] or 1
    small = F.forall("v", lambda x: F.abs(x) < min(_LIMIT, 2.0 ** 31 / width ** 0.5))  # a score stays below 2^62
    n, n_q, wide, wide_q = vectors.agg(F.count_if(small), F.count_if(small & is_query), F.count_if(~small),
                                       F.count_if(~small & is_query)).first()

    def count(rows, of):
        return max(1, -(-rows // of))

    blocks, q_blocks = count(n, BLOCK), count(n_q, QUERIES)

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def packed(batches):
        for (block,), rows in runs(batches, ["block"]):
            x = matrix([r["v"] for r in rows], width)
            least = [-np.inf if r["least"] is None else r["least"] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([np.array([r["vec_id"] for r in rows], np.int64).tobytes()], pa.binary()),
                 pa.array([x.tobytes()], pa.binary()), pa.array([np.array(least, float).tobytes()], pa.binary())],
                names=["block", "ids", "x", "least"])

    def pack(df, count):
        """Blocks of ``df`` (vec_id, v, least); a count of tasks that AQE leaves as it is."""
        return (df.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(count))).repartition(max(1, min(count, tasks)), "block")
                .sortWithinPartitions("block", "vec_id").select("block", "vec_id", "v", "least")
                .mapInArrow(packed, "block long, ids binary, x binary, least binary"))

    def pairs(index, queries, first, last):
        """Blocks [first, last) of the packed index, each with each block of queries."""
        asked = (queries.select(F.col("ids").alias("q_ids"), F.col("x").alias("q"), "least")
                 .withColumn("block", F.explode(F.sequence(F.lit(first).cast("long"), F.lit(last - 1).cast("long")))))
        some = index.where((F.col("block") >= first) & (F.col("block") < last)).drop("least")
        parts = max(1, min(last - first, 4 * tasks))
        return some.repartition(parts, "block").join(asked.repartition(parts, "block"), "block")

    def unpacked(row, ids, x):
        ids = np.frombuffer(row[ids], np.int64)
        return ids, np.frombuffer(row[x]).reshape(len(ids), width)

    def search(batches):
        held, block = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if held != row["block"]:
                    ids, x = unpacked(row, "ids", "x")
                    held, block = row["block"], Block(ids, x.astype(np.int64))
                q_ids, q = unpacked(row, "q_ids", "q")
                found = [block.search(x, i, k, t) for i, x, t in zip(q_ids, q.astype(np.int64), np.frombuffer(row["least"]), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(q_ids, [len(r) for r, _ in found])),
                     pa.array(block.ids[np.concatenate([r for r, _ in found])]),
                     pa.array(np.concatenate([s for _, s in found]).astype(np.int64))], names=["query_id", "vec_id", "score"])

    def whole(x):
        return np.array([int(v) for v in x.ravel().tolist()], object).reshape(x.shape)

    def search_wide(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, x = unpacked(row, "ids", "x")
                q_ids, q = unpacked(row, "q_ids", "q")
                x, q = whole(x), whole(q)
                found = [(i, *m) for i, y in zip(q_ids.tolist(), q, strict=True) for m in exact(ids, x, y, i, k)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()),
                     pa.array([Decimal(f[2]) for f in found], pa.decimal128(20, 0))], names=["query_id", "vec_id", "score"])

    kind = "query_id long, vec_id long, score long"
    free = F.lit(None).cast("double")
    with arrow_rows(spark, 16):  # rows of blocks are large
        few = vectors.where(small).withColumn("least", free)
        index = cut(pack(few, blocks), "index")
        queries = few.where(is_query)
        first = -(-blocks // FIRST)
        found = cut(pairs(index, pack(queries, q_blocks), 0, first).mapInArrow(search, kind), "first-results")
        if first < blocks:
            # the k-th best score of each query that has k already
            kth = (found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"))))
                   .where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("least")))
            asked = queries.drop("least").join(kth, "vec_id", "left")
            found = found.unionByName(cut(pairs(index, pack(asked, q_blocks), first, blocks).mapInArrow(search, kind), "block-results"))
        if wide:
            rare, kind = vectors.where(~small).withColumn("least", free), "query_id long, vec_id long, score decimal(20,0)"
            found = found.withColumn("score", F.col("score").cast("decimal(20,0)"))
            n_wide = count(wide, BLOCK)
            found = found.unionByName(cut(pairs(pack(rare, n_wide), pack(queries, q_blocks), 0, n_wide).mapInArrow(search_wide, kind), "wide"))
            if wide_q:
                every, n_every = vectors.withColumn("least", free), count(n + wide, BLOCK)
                rare_q = pack(rare.where(is_query), count(wide_q, QUERIES))
                found = found.unionByName(cut(pairs(pack(every, n_every), rare_q, 0, n_every).mapInArrow(search_wide, kind), "wide"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    score = F.col("score")
    if wide:
        score = F.when(score < F.lit(-_LONG), F.raise_error(F.lit("a score exceeds a long")).cast("long")).otherwise(score.cast("long"))
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", score.alias("score")))
