"""Exact Jaccard join of documents on word n-grams, with link components.

Two documents link when ``den * |A & B| >= num * |A | B|`` over their sets of
distinct word n-grams.  A linked pair differs in at most
``(den-num)/(den+num) * (|A|+|B|)`` n-grams, and its sizes differ by at most the
factor num/den.  From these size-derived bounds:

1. Documents fall in classes of like size; one near the top of its class also
   counts in the next, so a linked pair shares a class.  In a class whose
   pairs differ in at most d n-grams, every set is dealt by hash into d + 1
   parts: a linked pair agrees on at least one whole part.  Parts are known by
   a 64-bit sum; documents with an equal part are tied into clusters.  No pair
   is emitted, only each document's tie to the smallest id of its part.
2. Inside a cluster the document by n-gram incidence matrix is multiplied by
   its transpose in blocks of about BLOCK documents.  Blocks hold whole sets,
   the products are exact overlap counts, pairs below the bound are dropped in
   the task, and only the edges that join two components leave it.
3. A cluster of many blocks first multiplies each block with itself and with
   block 0.  What is then not one component multiplies its other pairs of
   blocks, save those whose documents all belong to one component already.
   Blocks hold documents by chance, so these pairs grow with the square of a
   cluster: PAIRS_AT_ONCE at a time, each document goes to its pairs as a bitmap
   of about one bit an n-gram (documents differ in an n-gram at least for each
   bit that differs), and whole only to those in which some document of another
   component may link with it.

Equal sets are merged first and stand for one vertex, however many copies.
N-grams are known by 64-bit hashes, whole sets by 128 bits; ties between parts
know a set by half of them, which can only widen a cluster.  Texts have A-Z
lower-cased and are split at blanks and control characters 9 to 13; with fewer than n words the
whole sequence is one n-gram; null, empty and blank texts have none and link
with nothing.  Rows of equal doc_id are one document with several sets; rows
of null doc_id never link.  Other columns are not read.
"""

from __future__ import annotations

import struct
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import arrow_rows, components, cut, runs, unused
from starmart.session import discard, scratch_dir

BLOCK = 256            # documents of a block of the product
CLASS_RATIO = 1.25     # largest to smallest size of a class
SPARE = 0.4            # parts left out, as a share of d + 1
PAIRS_AT_ONCE = 20_000  # pairs of blocks that are multiplied in one job
MEMBERS_BROADCAST = 1_000_000  # up to so many clustered documents are broadcast to the texts
_WORDS = 1 << 16       # words whose hashes are kept; a full table is emptied
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_known: dict[bytes, int] = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _M[3]
    return x ^ (x >> np.uint64(29))


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams of a text."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    ids = list(map(_known.get, words))
    if None in ids:
        if len(_known) + len(words) > _WORDS:
            _known.clear()
        for w, known in zip(words, ids, strict=True):
            if known is None or w not in _known:
                _known[w] = xxhash.xxh3_64_intdigest(w)
        ids = list(map(_known.__getitem__, words))
    h = np.array(ids, np.uint64)
    k = min(n, len(h))
    grams = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        grams = mix(grams * _M[0] + h[i:len(h) - k + 1 + i] * _M[1])
    return np.unique(grams)


def classes(size: int, num: int, den: int) -> list[tuple[int, int]]:
    """(class, d) of a set: its class of sizes and those a larger linked set
    may have; d bounds the difference of pairs that meet there."""
    c = int(np.log(size) / np.log(CLASS_RATIO))
    while _least(c + 1) <= size:
        c += 1
    while _least(c) > size:
        c -= 1
    found = [c]
    while num * _least(found[-1] + 1) <= den * size:
        found.append(found[-1] + 1)
    # both sizes of a pair that meets in class c are below those of class c + 1
    return [(k, (den - num) * 2 * (_least(k + 1) - 1) // (den + num)) for k in found]


def _least(c: int) -> int:
    return int(np.ceil(CLASS_RATIO ** c - 1e-9))


def part_keys(grams: np.ndarray, num: int, den: int) -> np.ndarray:
    """Keys of the parts of a set: class, place and sum of its members' mixes.
    Where pairs cannot differ (d = 0) there are none: equal sets are merged."""
    out = [np.zeros(0, np.uint64)]
    mixed = mix(grams * _M[1] + _M[2])
    for c, d in classes(len(grams), num, den):
        if d == 0:
            continue
        spare = int(np.ceil(SPARE * (d + 1)))
        parts = d + 1 + spare
        place = ((grams >> np.uint64(11)) % np.uint64(parts)).astype(np.int64)
        size = np.bincount(place, minlength=parts)
        total = np.zeros(parts, np.uint64)
        np.add.at(total, place, mixed)
        used = np.argsort(size, kind="stable")[spare:].astype(np.uint64)
        out.append(mix(total[used.astype(np.int64)] + mix(used * _M[0] + np.full(1, c + 1, np.uint64) * _M[2])))
    return np.concatenate(out)


def _sid(grams: np.ndarray) -> tuple[int | None, int | None]:
    """The two halves of the 128-bit hash of a set (null if it is empty)."""
    return struct.unpack("<qq", xxhash.xxh3_128_digest(grams.tobytes())) if len(grams) else (None, None)


def signatures(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, n_shingles and the halves sid and sid2 of the set's hash."""
    def run(batches):
        for batch in batches:
            sets = [shingles(t, n) for t in batch.column(1).to_pylist()]
            own = [_sid(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), *(pa.array([x[k] for x in own], pa.int64()) for k in (0, 1))],
                names=["doc_id", "n_shingles", "sid", "sid2"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_shingles long, sid long, sid2 long")


def _overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Overlap counts of two blocks of sets: the product of their incidence
    matrices over the n-grams that both blocks hold."""
    left, right = np.concatenate(a), np.concatenate(b)
    shared = np.intersect1d(left, right)
    out = np.zeros((len(a), len(b)), np.float32)

    def incidence(flat, sets):
        at = np.searchsorted(shared, flat)
        at[at == len(shared)] = 0
        hit = shared[at] == flat if len(shared) else np.zeros(len(flat), bool)
        return np.repeat(np.arange(len(sets)), [len(s) for s in sets])[hit], at[hit]

    (ra, ca), (rb, cb) = incidence(left, a), incidence(right, b)
    oa, ob = np.argsort(ca, kind="stable"), np.argsort(cb, kind="stable")
    ra, ca, rb, cb = ra[oa], ca[oa], rb[ob], cb[ob]
    for lo in range(0, len(shared), 4096):  # columns at a time
        hi = lo + 4096
        (i, j), (k, m) = np.searchsorted(ca, (lo, hi)), np.searchsorted(cb, (lo, hi))
        x, y = np.zeros((len(a), 4096), np.float32), np.zeros((len(b), 4096), np.float32)
        x[ra[i:j], ca[i:j] - lo], y[rb[k:m], cb[k:m] - lo] = 1, 1
        out += x @ y.T  # counts below 2^24: exact
    return out


def linked(a: list[np.ndarray], b: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """Pairs (row of a, row of b) that link."""
    sa, sb = np.array([len(s) for s in a], np.int64), np.array([len(s) for s in b], np.int64)
    both = np.rint(_overlaps(a, b)).astype(np.int64)
    return np.argwhere(den * both >= num * (sa[:, None] + sb[None, :] - both))


def _forest(ids_a: list[int], ids_b: list[int], pairs: np.ndarray) -> list[tuple[int, int]]:
    """The pairs that join two components, one after the other."""
    root: dict[int, int] = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i, j in pairs.tolist():
        x, y = find(ids_a[i]), find(ids_b[j])
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((ids_a[i], ids_b[j]))
    return out


def _bits(grams: np.ndarray) -> np.ndarray:
    """The n-grams as a bitmap, in 64-bit words: a power of two of bits, at
    least as many as n-grams."""
    width = max(64, 1 << (len(grams) - 1).bit_length())
    bits = np.zeros(width, np.uint8)
    bits[mix(grams * _M[1]) & np.uint64(width - 1)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def _folded(maps: list[np.ndarray], words: int) -> np.ndarray:
    """Bitmaps of so many words or more, as rows of so many words."""
    return np.stack([np.bitwise_or.reduce(m.reshape(-1, words), axis=0) for m in maps])


def _maybe(a: list[tuple], b: list[tuple], num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows (component, size, bitmap) of a, and which of b, may link with
    a row of the other side that is of another component."""
    (ca, na, ma), (cb, nb, mb) = (zip(*x, strict=True) for x in (a, b))
    ca, na, cb, nb = (np.array(x, np.int64) for x in (ca, na, cb, nb))
    wa, wb = (np.array([len(m) for m in x]) for x in (ma, mb))
    hit_a, hit_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    for words in np.unique(np.append(wa, wb)).tolist():  # the narrower side's
        of_a, of_b = np.flatnonzero(wa >= words), np.flatnonzero(wb >= words)
        if not len(of_a) or not len(of_b):
            continue
        right = _folded([mb[k] for k in of_b], words)
        for i, row in zip(of_a, _folded([ma[k] for k in of_a], words), strict=True):
            k = of_b if wa[i] == words else of_b[wb[of_b] == words]
            near = (den * np.minimum(na[i], nb[k]) >= num * np.maximum(na[i], nb[k])) & (ca[i] != cb[k])
            if not near.any():
                continue
            k = k[near]
            apart = np.bitwise_count(right[np.searchsorted(of_b, k)] ^ row).sum(axis=1, dtype=np.int64)
            k = k[(den + num) * apart <= (den - num) * (na[i] + nb[k])]
            hit_a[i] |= len(k) > 0
            hit_b[k] = True
    return hit_a, hit_b


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _products(pairs: DataFrame, num: int, den: int) -> DataFrame:
    """Edges (a, b) out of rows cluster, i, j, block, id, grams: the product of
    blocks i and j of each cluster."""
    def run(batches):
        for (_, i, j), rows in runs(batches, ["cluster", "i", "j"]):
            sides = [[(r["id"], np.frombuffer(r["grams"], np.uint64)) for r in rows if r["block"] == k] for k in (i, j)]
            if not sides[0] or not sides[1] or len(rows) < 2:
                continue
            (ia, a), (ib, b) = (zip(*s, strict=True) for s in sides)
            found = _forest(ia, ib, linked(a, b, num, den))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], names=["a", "b"])

    return (pairs.repartition(_partitions(pairs), "cluster", "i", "j")
            .sortWithinPartitions("cluster", "i", "j", "block", "id", "grams")
            .select("cluster", "i", "j", "block", "id", "grams").mapInArrow(run, "a long, b long"))


def _candidates(pairs: DataFrame, num: int, den: int) -> DataFrame:
    """cluster, i, j, block, id of the documents of a pair of blocks that may link
    across components, out of rows cluster, i, j, block, id, component, size, bits."""
    def run(batches):
        for (cluster, i, j), rows in runs(batches, ["cluster", "i", "j"]):
            sides = [[(r["component"], r["size"], np.frombuffer(r["bits"], np.uint64), r["id"]) for r in rows if r["block"] == k] for k in (i, j)]
            if not sides[0] or not sides[1]:
                continue
            hits = _maybe(*([r[:3] for r in s] for s in sides), num, den)
            ids = [np.unique([r[3] for r, hit in zip(s, h, strict=True) if hit]).astype(np.int64) for s, h in zip(sides, hits, strict=True)]
            n, m = map(len, ids)
            if n:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (
                    *([v] * (n + m) for v in (cluster, i, j)), [i] * n + [j] * m, np.concatenate(ids))], names=["cluster", "i", "j", "block", "id"])

    return (pairs.repartition(_partitions(pairs), "cluster", "i", "j")
            .sortWithinPartitions("cluster", "i", "j", "block", "id", "bits")
            .select("cluster", "i", "j", "block", "id", "component", "size", "bits")
            .mapInArrow(run, "cluster long, i long, j long, block long, id long"))


def _ties(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Ties (a, b) of sets with an equal part, by sid."""
    def combine(batches):
        for batch in batches:
            sids, keys = [], []
            for t in batch.column(0).to_pylist():
                s = shingles(t, n)
                if len(s):
                    keys.append(part_keys(s, num, den).view(np.int64))
                    sids.append(np.full(len(keys[-1]), _sid(s)[0], np.int64))
            flat, ids = (np.concatenate([*x, np.zeros(0, np.int64)]) for x in (keys, sids))
            order = np.lexsort((ids, flat))
            flat, ids = flat[order], ids[order]
            head = np.append(True, flat[1:] != flat[:-1])[:len(flat)]
            first = ids[np.maximum.accumulate(np.where(head, np.arange(len(flat)), 0))]
            same = ~head & (ids != first)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(flat[head], flat[same])), pa.array(np.append(ids[head], ids[same])),
                 pa.array(np.append(ids[head], first[same]))], names=["key", "id", "tie"])

    def tie(batches):
        key, first = None, None  # the run that the last batch ended in
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, ids, tied = (np.asarray(batch.column(k)) for k in range(3))
            head = np.append(keys[0] != key, keys[1:] != keys[:-1])
            at = np.maximum.accumulate(np.where(head, np.arange(len(keys)), -1))
            lead = np.where(at >= 0, ids[np.maximum(at, 0)], first if first is not None else 0)
            key, first = keys[-1], lead[-1]
            a, b = np.append(lead, tied), np.append(ids, ids)
            real = a != b
            if real.any():
                yield pa.RecordBatch.from_arrays([pa.array(a[real]), pa.array(b[real])], names=["a", "b"])

    return (docs.where(F.col("doc_id").isNotNull()).select("text").mapInArrow(combine, "key long, id long, tie long")
            .repartition(_partitions(docs), "key").sortWithinPartitions("key")
            .mapInArrow(tie, "a long, b long"))


def jaccard_components(docs: DataFrame, n: int = 3, num: int = 90, den: int = 100, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links)
    of every row of ``docs``."""
    spark = docs.sparkSession
    with arrow_rows(spark, 1000):
        sigs = cut(signatures(docs, n), "signatures")
        tied = components(_ties(docs, n, num, den))                               # id, component
    reps = cut(sigs.where("sid is not null and doc_id is not null").groupBy("sid", "sid2").agg(F.min("doc_id").alias("rep")), "classes")
    sizes = tied.groupBy("component").agg(F.ceil(F.count("*") / F.lit(block)).alias("blocks"))
    members = cut(tied.join(sizes, "component").join(reps, F.col("id") == F.col("sid"))
                  .select(F.col("rep").alias("doc_id"), "sid", "sid2", F.col("component").alias("cluster"), "blocks",
                          F.pmod(F.xxhash64("rep"), "blocks").alias("block")), "members")

    def whole_sets(batches):
        for batch in batches:
            sets = [shingles(t, n) for t in batch.column("text").to_pylist()]
            own = [_sid(s) for s in sets]  # of rows that share an id, each its own set
            keep = [k for k, (x, y) in enumerate(zip(own, zip(*(batch.column(c).to_pylist() for c in ("sid", "sid2")), strict=True), strict=True)) if x == y]
            part = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("doc_id", "cluster", "blocks", "block")),
                 pa.array([sets[k].tobytes() for k in keep], pa.binary())], names=["id", "cluster", "blocks", "block", "grams"])

    few = members.count() <= MEMBERS_BROADCAST
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(members) if few else members, "doc_id")
    work = scratch_dir(spark, "products")
    with arrow_rows(spark, 1000):
        sets = cut(texts.mapInArrow(whole_sets, "id long, cluster long, blocks long, block long, grams binary"), "sets", work)

    # each block with itself and with block 0
    near = sets.withColumn("other", F.explode(F.when(F.col("block") == 0, F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
                                              .otherwise(F.array(F.lit(0).cast("long"), "block"))))
    near = near.select("cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", "grams")
    with arrow_rows(spark, 500):
        edges = cut(_products(near, num, den), "links")
    large = members.where("blocks > 2").select(F.col("doc_id").alias("id"), "cluster", "block")
    if not large.isEmpty():
        edges = edges.unionByName(_other_pairs(sets, large, components(edges), num, den, work))
    discard(spark, work)
    found = components(edges).select(F.col("id").alias("rep"), F.col("component").alias("found"))
    classes_ = reps.join(found, "rep", "left").select("sid", "sid2", F.coalesce("found", "rep").alias("component"))
    return (sigs.join(classes_, ["sid", "sid2"], "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")))


def _other_pairs(sets: DataFrame, large: DataFrame, found: DataFrame, num: int, den: int, work: str) -> DataFrame:
    """Edges (a, b) out of the pairs of blocks of the clusters ``large`` (id,
    cluster, block) but those with block 0; ``found`` are the components so far."""
    spark = sets.sparkSession
    placed = cut(large.join(found, "id", "left").withColumn("component", F.coalesce("component", "id")).distinct(), "placed", work)
    state = cut(placed.groupBy("cluster", "block").agg(F.min("component").alias("lo"), F.max("component").alias("hi")), "blocks", work)
    whole = state.groupBy("cluster").agg(F.min("lo").alias("all_lo"), F.max("hi").alias("all_hi")).where("all_lo < all_hi")
    open_ = state.join(whole, "cluster").where("block > 0")
    a = open_.select("cluster", F.col("block").alias("i"), F.col("lo").alias("lo_i"), F.col("hi").alias("hi_i"))
    b = open_.select("cluster", F.col("block").alias("j"), F.col("lo").alias("lo_j"), F.col("hi").alias("hi_j"))
    todo = cut(a.join(b, "cluster").where("i < j and not (lo_i = hi_i and lo_j = hi_j and lo_i = lo_j)")
               .select("cluster", "i", "j"), "todo", work)

    def sketch(batches):
        for batch in batches:
            own = [np.frombuffer(g, np.uint64) for g in batch.column("grams").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("cluster", "block", "id", "component")), pa.array([len(g) for g in own], pa.int64()),
                                              pa.array([_bits(g).tobytes() for g in own], pa.binary())],
                                             names=["cluster", "block", "id", "component", "size", "bits"])

    marked = sets.select("cluster", "block", "id", "grams").join(placed, ["cluster", "block", "id"])
    with arrow_rows(spark, 500):
        maps = cut(marked.mapInArrow(sketch, "cluster long, block long, id long, component long, size long, bits binary"), "bitmaps", work)
    jobs = -(-todo.count() // PAIRS_AT_ONCE)
    out = []
    for job in range(jobs):
        now = (todo.where(F.pmod(F.xxhash64("cluster", "i", "j"), F.lit(jobs)) == job)
               .withColumn("block", F.explode(F.array("i", "j"))))
        with arrow_rows(spark, 500):
            maybe = cut(_candidates(now.join(maps, ["cluster", "block"]), num, den), f"candidates-{job}", work)
            rest = maybe.join(sets.select("cluster", "block", "id", "grams"), ["cluster", "block", "id"])
            out.append(cut(_products(rest, num, den), "links"))
    return reduce(DataFrame.unionByName, out) if out else found.select(F.col("id").alias("a"), F.col("component").alias("b")).limit(0)


def keep_one(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one row of each group of linked texts, that of smallest
    doc_id; rows of null doc_id all stay.  Rows are told apart by id and text:
    those that share an id but not their text are documents of their own, equal
    ones are copies, of which one stays (the least by all columns that order)."""
    digest, row, place, of_id, of_digest = (unused(docs.columns, c) for c in ("_digest", "_row", "_place", "_of_id", "_of_digest"))
    every = [F.col(f"`{c}`") for c in docs.columns]
    named = docs.where(F.col("doc_id").isNotNull())
    repeated = cut(named.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "repeated-ids")
    if repeated.isEmpty():
        found = jaccard_components(named, n, num, den).where("doc_id = component_id").select("doc_id")
        kept = named.join(found, "doc_id", "left_semi")
    else:
        # a number for each (doc_id, text), rising with doc_id: a group's least number has its least id
        named = named.withColumn(digest, F.md5("text"))
        ids = cut(named.select(F.col("doc_id").alias(of_id), F.col(digest).alias(of_digest)).distinct()
                  .repartitionByRange(of_id, of_digest).sortWithinPartitions(of_id, of_digest)
                  .withColumn(row, F.monotonically_increasing_id()), "numbers")
        numbered = named.join(ids, (F.col("doc_id") == F.col(of_id)) & F.col(digest).eqNullSafe(F.col(of_digest)))
        least = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
        each = cut(numbered.withColumn(place, F.row_number().over(Window.partitionBy(row).orderBy(*least)))
                   .where(F.col(place) == 1), "one-each")
        found = (jaccard_components(each.select(F.col(row).alias("doc_id"), "text"), n, num, den)
                 .where("doc_id = component_id").select(F.col("doc_id").alias(row)))
        kept = each.join(found, row, "left_semi")
    return kept.select(*every).unionByName(docs.where(F.col("doc_id").isNull()).select(*every))
