"""Secret scans: fixed patterns, and a battery of randomness tests.

Base spans are the matches of three patterns (BASE), leftmost and not
overlapping within a kind, too short ones dropped.  The battery looks at the
other runs of LEAST or more key characters, but not at runs of digits only.

A run's encoding is the smallest alphabet that holds it (ENCODINGS).  Three
tests ask whether its characters are drawn evenly and apart: chi-squared of
the alphabet's counts, Wald and Wolfowitz's runs above and below the
alphabet's middle, and the serial correlation of neighbours.  Fisher's sum of
their logarithms must not refute randomness (RANDOM).  The chi-squared value
is also held against ordinary text: the corpus-wide counts of key characters
outside such runs give, for every encoding, how uneven text is in it, and a
run of L characters of text then has a noncentral chi-squared value whose
noncentrality grows with L.  Its lower tail is the run's p-value, so a short
run can hardly be told from text and a long one can.  Benjamini and
Hochberg's step-up rule at FALSE, within each class of length over the whole
corpus, decides which runs are reported as kind ``random``; p-values are put
into bins of a tenth of a decade and count by their bin's upper end, which
only makes the rule stricter.

Offsets are code points, ends exclusive.  Null and empty texts have no spans.
Repeated rows each give a row and count each.  Columns of ``docs`` named
``base`` or ``random`` are replaced, others pass through.
"""

from __future__ import annotations

import math
import re
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.common import cut

# Kind, pattern, group whose length counts, least length.
BASE = (("assign", r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
        ("access", r"AKIA[A-Z0-9]+", 0, 20),
        ("hex", r"(?<![0-9a-f])[0-9a-f]{24,}", 0, 24))
KINDS = (*(k for k, *_ in BASE), "random")
LEAST = 16            # characters of a run that is tested
RANDOM = 1e-3         # a run whose combined p-value is below is not random
FALSE = 0.01          # share of text among the reported runs
CLASSES = (16, 20, 24, 32, 40, 48, 64, 96, 128, 256)   # lengths from which a class starts
BINS, PER_DECADE = 400, 10

_DIGIT, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = (_DIGIT + "abcdef", _DIGIT + "ABCDEF", _LOWER, _UPPER, _UPPER + "234567", _DIGIT + _LOWER, _DIGIT + _UPPER,
             _UPPER + _LOWER, _DIGIT + _UPPER + _LOWER, _UPPER + _LOWER + _DIGIT + "+/", _UPPER + _LOWER + _DIGIT + "-_",
             _UPPER + _LOWER + _DIGIT + "+/-_")
_RUN = re.compile(r"[A-Za-z0-9+/_-]{%d,}" % LEAST)
_BASE = [(k, re.compile(p), g, n) for k, p, g, n in BASE]
_CODES = np.full((len(ENCODINGS), 256), -1, np.int16)
for _row, _letters in zip(_CODES, ENCODINGS, strict=True):
    _row[np.frombuffer(_letters.encode(), np.uint8)] = np.arange(len(_letters))
SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("end", T.LongType())]))
RUNS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                                 T.StructField("size", T.IntegerType()), T.StructField("bin", T.IntegerType())]))


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end), by start, then kind as listed."""
    found = [(m.start(), i, m.end()) for i, (_, pattern, group, least) in enumerate(_BASE)
             for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return [(s, KINDS[i], e) for s, i, e in sorted(found)]


def free_runs(text: str, spans: list) -> list[tuple[int, int]]:
    """Runs of key characters that no base span touches, not only digits."""
    # the furthest end so far, by start: a run is free of all spans that start before its end
    ends = list(accumulate((e for _, _, e in spans), max))
    out, at = [], 0
    for m in _RUN.finditer(text):
        while at < len(spans) and spans[at][0] < m.end():
            at += 1
        if (at == 0 or ends[at - 1] <= m.start()) and not m.group().isdigit():
            out.append(m.span())
    return out


def _normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _chi_tail(x: float, k: float, more: float = 0.0, upper: bool = True) -> float:
    """Tail of a (noncentral) chi-squared value by Sankaran's normal form."""
    s, u = k + more, k + 2 * more
    h = 1 - 2 * s * (k + 3 * more) / (3 * u * u)
    p, m = u / (s * s), (h - 1) * (1 - 3 * h)
    mean = 1 + h * p * (h - 1 - 0.5 * (2 - h) * m * p)
    z = ((max(x, 1e-12) / s) ** h - mean) / (h * math.sqrt(2 * p) * (1 + 0.5 * m * p))
    return _normal_tail(z if upper else -z)


def battery(run: str) -> tuple[int, float, float]:
    """Encoding of a run, its chi-squared value, and the combined p-value of the
    three tests under even, independent characters."""
    raw = np.frombuffer(run.encode(), np.uint8)
    encoding = next(i for i, row in enumerate(_CODES) if (row[raw] >= 0).all())
    codes, k, n = _CODES[encoding][raw], len(ENCODINGS[encoding]), len(raw)
    counts = np.bincount(codes, minlength=k)
    chi = float(((counts - n / k) ** 2).sum() * k / n)
    p_even = _chi_tail(chi, k - 1)
    # runs above and below the middle: a fair coin each, so n - 1 changes at even odds
    high = codes >= k / 2
    changes = int((high[1:] != high[:-1]).sum())
    p_runs = 2 * _normal_tail(max(0.0, abs(changes - (n - 1) / 2) - 0.5) / math.sqrt((n - 1) / 4))
    x = codes - (k - 1) / 2
    serial = float((x[1:] * x[:-1]).sum() / math.sqrt(n - 1) / ((k * k - 1) / 12))
    p_serial = 2 * _normal_tail(abs(serial))
    half = -sum(math.log(max(p, 1e-300)) for p in (p_even, p_runs, p_serial))   # half of Fisher's sum, 6 degrees
    return encoding, chi, math.exp(-half) * (1 + half + half * half / 2)


def text_p(encoding: int, n: int, chi: float, unevenness: list[float]) -> float:
    """Chance that ``n`` characters of text are as even as that."""
    return _chi_tail(chi, len(ENCODINGS[encoding]) - 1, n * unevenness[encoding], upper=False)


def p_bin(p: float) -> int:
    """Bin of a p-value, 0 the largest; its upper end is 10 ** (-bin / PER_DECADE)."""
    return min(BINS - 1, int(-math.log10(max(p, 1e-300)) * PER_DECADE))


def text_unevenness(docs: DataFrame, text: str = "text") -> list[float]:
    """For every encoding, the noncentrality that a character of ordinary text
    adds: size times the summed squares of its character shares, less one.
    Alphabets of one case count letters of both."""
    def run(batches):
        total = np.zeros(256, np.int64)
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if t:
                    total += np.bincount(np.frombuffer(t.encode(), np.uint8), minlength=256)
                    if runs := "".join(_RUN.findall(t)):
                        total -= np.bincount(np.frombuffer(runs.encode(), np.uint8), minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(128)), pa.array(total[:128])], names=["byte", "n"])

    counts = docs.select(F.col(text)).mapInArrow(run, "byte long, n long").groupBy("byte").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(256)
    for byte, count in counts:
        n[byte] = count
    upper, lower = (np.frombuffer(x.encode(), np.uint8) for x in (_UPPER, _LOWER))
    folded = n.copy()
    folded[upper] = folded[lower] = n[upper] + n[lower]
    out = []
    for letters in ENCODINGS:
        one_case = letters.lower() == letters or letters.upper() == letters
        share = (folded if one_case else n)[np.frombuffer(letters.encode(), np.uint8)] + 1    # no count is certain
        out.append(float(len(letters) * ((share / share.sum()) ** 2).sum() - 1))
    return out


def tested(docs: DataFrame, unevenness: list[float], text: str = "text") -> DataFrame:
    """``docs`` with ``base`` (spans of the patterns) and ``random`` (runs that
    pass the battery, with class of length and bin of their p-value), without
    ``text``."""
    keep = [c for c in docs.columns if c not in (text, "base", "random")]
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text))
    schema = T.StructType([*docs.select(*[f"`{c}`" for c in keep]).schema.fields,
                           T.StructField("base", SPAN), T.StructField("random", RUNS)])
    span = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))
    runs = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("size", pa.int32()), ("bin", pa.int32())]))

    def scan(text):
        if not text:
            return [], []
        spans, out = base_spans(text), []
        for a, b in free_runs(text, spans):
            encoding, chi, p = battery(text[a:b])
            if p >= RANDOM:
                out.append({"start": a, "end": b, "size": int(np.searchsorted(CLASSES, b - a, "right")) - 1,
                            "bin": p_bin(text_p(encoding, b - a, chi, unevenness))})
        return [{"start": s, "kind": k, "end": e} for s, k, e in spans], out

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                found = [scan(t) for t in part.column(len(keep)).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array([f[0] for f in found], span), pa.array([f[1] for f in found], runs)],
                    names=schema.names)

    return source.mapInArrow(run, schema)


def least_bins(scanned: DataFrame, rate: float = FALSE) -> list[int]:
    """Per class of length, the first bin that Benjamini and Hochberg's rule at
    ``rate`` reports (BINS: none), from a histogram of fixed size."""
    rows = (scanned.select(F.explode("random").alias("r")).groupBy("r.size", "r.bin").agg(F.count("*").alias("n")).collect())
    n = np.zeros((len(CLASSES), BINS))
    for size, at, count in rows:
        n[size, at] += count
    upper = 10.0 ** (-np.arange(BINS) / PER_DECADE)
    at_most = n[:, ::-1].cumsum(1)[:, ::-1]
    good = (at_most > 0) & (upper * n.sum(1, keepdims=True) <= rate * at_most)
    return [int(np.argmax(g)) if g.any() else BINS for g in good]


def scan(docs: DataFrame, rate: float = FALSE, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with ``base`` and ``random``: arrays of (start,
    kind, end).  Reads the texts twice (character counts, then the scan)."""
    scanned = cut(tested(docs, text_unevenness(docs, text), text), "secret-scan")
    least = F.array(*map(F.lit, least_bins(scanned, rate)))
    reported = F.filter("random", lambda r: r["bin"] >= least[r["size"]])
    return scanned.withColumn("random", F.transform(reported, lambda r: F.struct(
        r["start"].alias("start"), F.lit(KINDS[-1]).alias("kind"), r["end"].alias("end"))))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of an array of spans, by start, then kind as listed."""
    place = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    keyed = F.transform(spans, lambda s: F.struct(s["start"], place[s["kind"]], F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")).alias("text")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: s["text"]), ",")
