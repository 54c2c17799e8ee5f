"""Approximate nearest neighbours: NN-descent graph and greedy graph search.

Equal vectors are one vertex (smallest id); its members' k + 1 smallest ids
are enough for any answer.  The graph starts from chunks of at most CHUNK
consecutive vertices in several orders (signs of random projections, then one
projection), each vertex keeping its K nearest in the chunk.  NN-descent then
joins the graph with itself: around every vertex its neighbours and a bounded
sample of its reverse neighbours are compared with each other, pairs closer
than what either holds are proposed, and each vertex keeps its K nearest.
Only pairs with a neighbour that is new since the last round are compared.
The orders grow with the logarithm of the vertices, and descents go on until a
round replaces at most a share DELTA of the list entries.  A row is a vertex
with its whole list; lists travel as ids, and only the members of a list with
a new entry get their vectors, as codes of one byte a component.

A query starts from its own vertex' neighbours and LANDMARKS fixed vertices,
and in each round opens its OPEN nearest unopened vertices: their neighbours,
and sampled reverse neighbours, are joined in and the EF nearest are kept,
until none of those is left to open.  Graph and search compare by codes; those
kept are measured again, Euclidean in double precision on the original vectors.

Vectors that are null, empty, zero or hold null or non-finite components take
no part.  Rows that share an id count once, as the smallest vector; shorter
vectors are filled up with zeros.  Components beyond single precision count as
infinite while searching, so such vectors are found last.  Ties go to the
smaller id.  The sampling bounds are those of NN-descent; recall against brute
force is in the README.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from starmart.llm.common import arrow_rows, cut
from starmart.llm.topk import valid

K, REVERSE = 32, 16    # neighbours of a vertex; sampled reverse neighbours
CHUNK, ORDERS = 1024, 8  # vertices of a chunk; orders up to 2^16 vertices, one more each doubling
DELTA = 0.001          # share of replaced list entries that ends the descent
EF, OPEN = 400, 200    # vertices a query keeps; opens in a round
LANDMARKS = 64
LISTS, STATES = 512, 32  # neighbour lists, and query states with all they reached, of an Arrow batch


def usable(df: DataFrame) -> DataFrame:
    """(vec_id, v): one vector per id."""
    return (df.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"))
            .where(F.col("vec_id").isNotNull() & valid("v") & F.exists("v", lambda x: x != 0))
            .groupBy("vec_id").agg(F.min("v").alias("v")))


def _filled(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) with all vectors of one length."""
    width = vectors.agg(F.max(F.size("v"))).first()[0] or 1
    return vectors.select("vec_id", F.concat("v", F.array_repeat(F.lit(0.0), F.lit(width) - F.size("v"))).alias("v"))


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    """Lists of one length as rows."""
    return column.flatten().to_numpy().astype(np.float64).reshape(rows, -1)


def _near(x: np.ndarray, k: int):
    """Places and distances of the k nearest others of each row."""
    sq = (x * x).sum(1)
    d = sq[:, None] + sq[None, :] - 2 * x @ x.T
    np.fill_diagonal(d, np.inf)
    k = min(k, len(x) - 1)
    at = np.argpartition(d, k - 1, 1)[:, :k] if k else np.zeros((len(x), 0), int)
    return at, np.sqrt(np.maximum(np.take_along_axis(d, at, 1), 0))


# codes: a vector's scale in single precision, then its components in steps of the scale, one byte each

def encode(x: np.ndarray) -> list[bytes]:
    scale = np.maximum(np.abs(x).max(1, initial=0), np.float32(1e-30)).astype(np.float32) / np.float32(127)
    steps = np.rint(np.divide(x, scale[:, None], where=np.isfinite(scale)[:, None], out=np.zeros_like(x))).astype(np.int8)
    out = np.concatenate([scale.view(np.uint8).reshape(-1, 4), steps.view(np.uint8)], 1)
    return [row.tobytes() for row in out]


def decode(codes: list[bytes]) -> np.ndarray:
    """Vectors of codes; infinite where a component is."""
    raw = np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1)
    scale = np.ascontiguousarray(raw[:, :4]).view(np.float32)
    with np.errstate(invalid="ignore"):
        return np.where(np.isfinite(scale), raw[:, 4:].view(np.int8) * scale, np.float32(1e18))


def _flat(batch: pa.RecordBatch, names: list[str]) -> tuple[np.ndarray, ...]:
    """Row of each entry, and the entries, of list columns of equal lengths."""
    columns = [batch.column(c) for c in names]
    row = np.repeat(np.arange(batch.num_rows), columns[0].value_lengths().to_numpy())
    return row, *(c.flatten().to_numpy(zero_copy_only=False) for c in columns)


def _lists(row: np.ndarray, rows: int, *values: pa.Array) -> list[pa.Array]:
    """Lists of entries sorted by row."""
    at = pa.array(np.append(0, np.cumsum(np.bincount(row, minlength=rows))), pa.int32())
    return [pa.ListArray.from_arrays(at, v) for v in values]


def _least(row: np.ndarray, n: np.ndarray, d: np.ndarray, late: np.ndarray, k: int) -> np.ndarray:
    """Places of the k entries of least (d, n) of each row, sorted so; of entries
    with the same n the one that is not ``late``."""
    order = np.lexsort((late, n, row))
    order = order[np.append(True, (np.diff(row[order]) != 0) | (np.diff(n[order]) != 0))[:len(order)]]
    order = order[np.lexsort((n[order], d[order], row[order]))]
    r = row[order]
    first = np.searchsorted(r, r)
    return order[np.arange(len(r)) - first < k]


def _one_each(df: DataFrame, key: str, *lists: str, **ones) -> DataFrame:
    """The lists of each key, joined end to end."""
    return df.groupBy(key).agg(*[F.flatten(F.collect_list(c)).alias(c) for c in lists], *[c.alias(k) for k, c in ones.items()])


_LISTS = "n array<long>, d array<float>, fresh array<boolean>"


def _kept(batches):
    """Rows (id, code, n, d, fresh) cut to the K nearest; an edge is fresh if no
    earlier round had it."""
    for batch in batches:
        if batch.num_rows:
            row, n, d, fresh = _flat(batch, ["n", "d", "fresh"])
            at = _least(row, n, d, fresh, K)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("code"),
                 *_lists(row[at], batch.num_rows, pa.array(n[at]), pa.array(d[at], pa.float32()), pa.array(fresh[at]))],
                names=["id", "code", "n", "d", "fresh"])


def _start(nodes: DataFrame, n: int) -> DataFrame:
    """The nearest of each vertex in its chunk, in every order: rows (id, code, n, d, fresh)."""
    many = orders(n)
    spark = nodes.sparkSession
    # a range of some chunks each, and no more tasks than shuffles have, up to 64 chunks a task
    parts = max(1, min(many * n // CHUNK, max(int(spark.conf.get("spark.sql.shuffle.partitions")), many * n // (64 * CHUNK))))

    def places(batches):
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("f"), batch.num_rows)
                codes = pa.array(encode(x.astype(np.float32)), pa.binary())
                for order in range(many):
                    with np.errstate(invalid="ignore"):
                        p = x @ np.random.default_rng(1000 + order).standard_normal((x.shape[1], 13))
                    bits = ((p[:, :12] > 0) @ (1 << np.arange(11, -1, -1))).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(order * 4096 + bits), pa.array(p[:, 12]), batch.column("id"), codes],
                                                     names=["place", "along", "id", "code"])

    def chunks(batches):
        for batch in batches:
            # a batch holds the end of one order and the start of the next at most a few times
            order = np.asarray(batch.column("place")) // 4096
            ids, codes = np.asarray(batch.column("id")), batch.column("code").to_pylist()
            for lo in np.flatnonzero(np.append(True, np.diff(order) != 0))[:len(order)]:
                hi = lo + int((order == order[lo]).sum())
                at, d = _near(decode(codes[lo:hi]), K)
                row = np.repeat(np.arange(hi - lo), at.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[lo:hi]), pa.array(codes[lo:hi], pa.binary()),
                     *_lists(row, hi - lo, pa.array(ids[lo:hi][at.ravel()]), pa.array(d.ravel(), pa.float32()), pa.array(np.ones(len(row), bool)))],
                    names=["id", "code", "n", "d", "fresh"])

    with arrow_rows(spark, CHUNK):
        placed = cut(nodes.select("id", "f").mapInArrow(places, "place long, along double, id long, code binary"), "places")
        found = (placed.repartitionByRange(parts, "place", "along", "id").sortWithinPartitions("place", "along", "id")
                 .mapInArrow(chunks, f"id long, code binary, {_LISTS}"))
        return _one_each(found, "id", "n", "d", "fresh", code=F.first("code")).mapInArrow(_kept, f"id long, code binary, {_LISTS}")


def _around(graph: DataFrame) -> DataFrame:
    """(id, n, fresh): lists of neighbours and the nearest REVERSE vertices that
    hold the vertex."""
    def backward(batches):
        for batch in batches:
            if batch.num_rows:
                ids = np.asarray(batch.column("id"))
                row, n, d, fresh = _flat(batch, ["n", "d", "fresh"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), *(batch.column(c) for c in ("n", "d", "fresh")),
                     *_lists(row, len(ids), pa.array(np.ones(len(row), bool)))], names=["id", "n", "d", "fresh", "own"])
                to, at = np.unique(n, return_inverse=True)
                keep = _least(at, ids[row], d, np.zeros(len(row), bool), REVERSE)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to), *_lists(at[keep], len(to), pa.array(ids[row[keep]]), pa.array(d[keep], pa.float32()),
                                           pa.array(fresh[keep]), pa.array(np.zeros(len(keep), bool)))],
                    names=["id", "n", "d", "fresh", "own"])

    def around(batches):
        for batch in batches:
            if batch.num_rows:
                row, n, d, fresh, own = _flat(batch, ["n", "d", "fresh", "own"])
                back = np.flatnonzero(~own)
                back = back[_least(row[back], n[back], d[back], np.zeros(len(back), bool), REVERSE)]
                at = np.concatenate([np.flatnonzero(own), back])
                # an entry that is fresh on either side is fresh
                at = at[_least(row[at], n[at], d[at], ~fresh[at], K + REVERSE)]
                yield pa.RecordBatch.from_arrays([batch.column("id"), *_lists(row[at], batch.num_rows, pa.array(n[at]), pa.array(fresh[at]))],
                                                 names=["id", "n", "fresh"])

    both = graph.select("id", "n", "d", "fresh").mapInArrow(backward, f"id long, {_LISTS}, own array<boolean>")
    return _one_each(both, "id", "n", "d", "fresh", "own").mapInArrow(around, "id long, n array<long>, fresh array<boolean>")


def _descend(graph: DataFrame) -> DataFrame:
    """One round: the members around every vertex are compared with each other."""
    held = graph.select(F.col("id").alias("w"), F.when(F.size("d") < K, F.lit(float("inf"))).otherwise(F.array_max("d")).cast("float").alias("r"), "code")
    # only lists with a fresh entry ask for their members' vectors
    asked = (_around(graph).where(F.exists("fresh", lambda x: x))
             .select("id", F.explode(F.arrays_zip("n", "fresh")).alias("e")))
    lists = (asked.select("id", F.col("e.n").alias("w"), F.col("e.fresh").alias("new")).join(held, "w")
             .groupBy("id").agg(F.collect_list(F.struct("w", "new", "r", "code")).alias("l")))  # K + REVERSE at most

    def compare(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column(0)
            at = np.append(0, np.cumsum(lists.value_lengths().to_numpy()))
            ids, new, r, codes = lists.flatten().flatten()
            ids, new, r, x = np.asarray(ids), new.to_numpy(zero_copy_only=False), np.asarray(r), decode(codes.to_pylist())
            found = []
            for lo, hi in zip(at[:-1], at[1:], strict=True):
                one, some, y = ids[lo:hi], new[lo:hi], x[lo:hi]
                sq = (y * y).sum(1)
                d = np.sqrt(np.maximum(sq[:, None] + sq[None, :] - 2 * y @ y.T, 0))
                i, j = np.nonzero((d < r[lo:hi, None]) & (some[:, None] | some[None, :]) & (one[:, None] != one[None, :]))
                found.append((one[i], one[j], d[i, j]))
            a, b, d = map(np.concatenate, zip(*found, strict=True))
            to, row = np.unique(a, return_inverse=True)
            keep = _least(row, b, d, np.zeros(len(row), bool), K)
            yield pa.RecordBatch.from_arrays(
                [pa.array(to, pa.int64()), pa.nulls(len(to), pa.binary()),
                 *_lists(row[keep], len(to), pa.array(b[keep], pa.int64()), pa.array(d[keep], pa.float32()), pa.array(np.ones(len(keep), bool)))],
                names=["id", "code", "n", "d", "fresh"])

    found = lists.select("l").mapInArrow(compare, f"id long, code binary, {_LISTS}")
    before = graph.withColumn("fresh", F.transform("fresh", lambda _: F.lit(False)))
    merged = _one_each(before.unionByName(found), "id", "n", "d", "fresh", code=F.first("code", ignorenulls=True))
    return merged.mapInArrow(_kept, f"id long, code binary, {_LISTS}")


def orders(n: int) -> int:
    """Start orders of n vertices."""
    return ORDERS + max(0, (max(n, 1) - 1).bit_length() - 16)


def build(nodes: DataFrame, delta: float = DELTA) -> DataFrame:
    """The neighbour graph, rows (id, code, n, d, fresh), of vertices (id, f), f
    in single precision and of one length."""
    spark, n = nodes.sparkSession, nodes.count()
    graph = _start(nodes, n)
    while True:
        new = Observation()
        with arrow_rows(spark, LISTS):  # a row holds the vectors of a whole list
            graph = cut(graph.observe(new, F.sum(F.size(F.filter("fresh", lambda x: x))).alias("fresh")), "graph")
        if (new.get["fresh"] or 0) <= delta * K * n:  # a descent's own entries are fresh
            return graph
        graph = _descend(graph)


def distance(a: str, b: str):
    """Euclidean distance of vectors of one length."""
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: x - y), F.lit(0.0), lambda s, x: s + x * x))


_STATE = "query long, q binary, n array<long>, d array<float>, open array<boolean>"


def search(graph: DataFrame, queries: DataFrame, ef: int = EF) -> DataFrame:
    """(query, node): up to ``ef`` near vertices of each query (query, q its
    code, node: its own vertex in the graph, or null)."""
    spark = graph.sparkSession
    codes = graph.select(F.col("id").alias("node"), "code")
    # LANDMARKS rows, whatever the size of the table
    marks = [r["node"] for r in codes.select("node").orderBy(F.xxhash64("node"), "node").limit(LANDMARKS).collect()]
    none = F.array().cast("array<long>")

    def merged(batches):
        """State rows with the vertices seen joined in, the ef nearest kept."""
        for batch in batches:
            if batch.num_rows:
                row, n, d, opened = _flat(batch, ["n", "d", "open"])
                q = decode(batch.column("q").to_pylist())
                seen = batch.column("seen")
                r2 = np.repeat(np.arange(batch.num_rows), seen.value_lengths().to_numpy())
                n2, c2 = seen.flatten().flatten()
                d2 = np.zeros(len(r2), np.float32)
                for lo in range(0, len(r2), 1 << 16):
                    gap = decode(c2.slice(lo, 1 << 16).to_pylist()) - q[r2[lo:lo + (1 << 16)]]
                    d2[lo:lo + (1 << 16)] = np.sqrt((gap * gap).sum(1))
                row, n, d = np.concatenate([row, r2]), np.concatenate([n, np.asarray(n2)]), np.concatenate([d, d2])
                opened = np.concatenate([opened, np.zeros(len(r2), bool)]).astype(bool)
                at = _least(row, n, d, ~opened, ef)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("query"), batch.column("q"),
                     *_lists(row[at], batch.num_rows, pa.array(n[at], pa.int64()), pa.array(d[at], pa.float32()), pa.array(opened[at]))],
                    names=["query", "q", "n", "d", "open"])

    def measured(state, wanted):
        """``state`` with the vertices ``wanted`` (query, node) measured and joined in."""
        replies = (wanted.join(codes, "node").groupBy("query").agg(F.collect_list(F.struct("node", "code")).alias("seen")))
        both = state.join(replies, "query", "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<struct<node:long,code:binary>>")))
        return both.mapInArrow(merged, _STATE)

    def turn(batches):
        """The OPEN nearest unopened of each state row are opened."""
        for batch in batches:
            if batch.num_rows:
                row, n, d, opened = _flat(batch, ["n", "d", "open"])
                opened = opened.astype(bool)
                closed = np.flatnonzero(~opened)
                now = np.zeros(len(row), bool)
                now[closed[_least(row[closed], n[closed], d[closed], np.zeros(len(closed), bool), OPEN)]] = True
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("query", "q", "n", "d")), *_lists(row, batch.num_rows, pa.array(opened | now)),
                     *_lists(row[now], batch.num_rows, pa.array(n[now]))], names=["query", "q", "n", "d", "open", "now"])

    with arrow_rows(spark, LISTS):
        adjacent = cut(_around(graph).select(F.col("id").alias("node"), F.col("n").alias("next")), "adjacent")
    with arrow_rows(spark, STATES):
        begin = queries.select("query", "q", none.alias("n"), F.array().cast("array<float>").alias("d"), F.array().cast("array<boolean>").alias("open"))
        own = queries.where("node is not null").select("query", "node")
        first = (own.join(adjacent, "node").select("query", F.explode("next").alias("node")).unionByName(own)
                 .unionByName(queries.select("query", F.explode(F.array(*map(F.lit, marks)).cast("array<long>")).alias("node"))).distinct())
        state = cut(measured(begin, first).mapInArrow(turn, f"{_STATE}, now array<long>"), "search")
        while not state.where(F.size("now") > 0).isEmpty():
            reached = (state.select("query", F.explode("now").alias("node")).join(adjacent, "node")
                       .groupBy("query").agg(F.array_distinct(F.flatten(F.collect_list("next"))).alias("next")))
            # at most OPEN * (K + REVERSE) a query
            wanted = cut(reached.join(state.select("query", "n"), "query")
                         .select("query", F.explode(F.array_except("next", "n")).alias("node")), "wanted")
            state = cut(measured(state.drop("now"), wanted).mapInArrow(turn, f"{_STATE}, now array<long>"), "search")
    return state.select("query", F.explode("n").alias("node"))


def nearest(vectors: DataFrame, is_query, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row of
    ``vectors`` (vec_id, v) for which ``is_query`` holds."""
    vectors = cut(_filled(cut(vectors, "vectors")), "filled")
    nodes = cut(vectors.groupBy("v").agg(F.min("vec_id").alias("id"))
                .select("id", "v", F.col("v").cast("array<float>").alias("f")), "nodes")
    of = cut(vectors.join(nodes.select("id", "v"), "v").select("vec_id", F.col("id").alias("node")), "members")
    place = Window.partitionBy("node").orderBy("vec_id")
    members = of.withColumn("k", F.row_number().over(place)).where(F.col("k") <= k + 1).drop("k")
    graph = build(nodes)
    asked = of.where(is_query)
    # copies of a query ask once
    queries = cut(asked.select("node").distinct().join(graph.select(F.col("id").alias("node"), "code"), "node")
                  .select(F.col("node").alias("query"), F.col("code").alias("q"), "node"), "queries")
    found = search(graph, queries)
    exact = nodes.select("id", "v")
    found = (found.join(exact.select(F.col("id").alias("node"), "v"), "node")
             .join(queries.select("query").join(exact.select(F.col("id").alias("query"), F.col("v").alias("q")), "query"), "query")
             .select("query", "node", distance("q", "v").alias("d")))
    near = Window.partitionBy("query").orderBy("d", "node")
    found = found.withColumn("k", F.row_number().over(near)).where(F.col("k") <= k + 1).select("query", "node", "d")
    answers = found.join(members, "node").select("query", "vec_id", "d")
    place = Window.partitionBy("query").orderBy("d", "vec_id")
    answers = answers.withColumn("k", F.row_number().over(place)).where(F.col("k") <= k + 1).drop("k")
    each = asked.select(F.col("vec_id").alias("query_id"), F.col("node").alias("query")).join(answers, "query")
    rank = Window.partitionBy("query_id").orderBy("d", "vec_id")
    return (each.where("vec_id <> query_id").withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", F.col("d").alias("score")))
