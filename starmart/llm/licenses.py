"""Licence scans: MinHash bands over overlapping windows, then containment.

Templates are grouped by like length.  For a group, a text's words are cut
into overlapping windows that are a quarter longer than its longest template
and a quarter apart, so every passage of a template's length lies in one.  A
window whose MinHash agrees with a template's in any band (one row each)
retrieves it; the number of bands is set from the smallest Jaccard similarity
that a window can have which holds ``containment`` of a template's shingles,
such that such a window is missed with a chance of at most MISS.  Retrieved
templates are verified by exact containment of their distinct five-word
shingles in the window (one shingle of all words for shorter templates).  Per
document and template the windows that match are one match each, overlapping
ones merged.  A template whose name ends in a version also needs the version's
numbers inside the match: most versions of a notice differ in them alone.  Of
overlapping matches of several templates the one of most shingles stays, then
that of highest containment, then that of the least name.

A band can only agree where the window holds the shingle that is a template's
minimum there, so texts without any such shingle are passed over before
windows are made; this loses nothing.

Words are lower-cased runs of letters, digits and underscores.  Null, empty
and unmatched texts, and empty tables, give no rows.  Repeated rows each give
their matches; a null doc_id stays null.  Whole texts are scanned, whatever
their length; columns but doc_id and text are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.license_texts import TEMPLATES

N = 5                # words of a shingle
CONTAINMENT = 0.8
MISS = 1e-4          # chance that a window that holds a template retrieves nothing
_WORD = re.compile(r"\w+").findall
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]
_known: dict[str, int] = {}

_VERSION = re.compile(r"-(\d+)\.(\d+)$")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _M[2]
    return x ^ (x >> np.uint64(29))


def _hashes(words: list[str]) -> np.ndarray:
    if len(_known) + len(words) > 1 << 20:
        _known.clear()
    ids = list(map(_known.get, words))
    if None in ids:
        for w, known in zip(words, ids, strict=True):
            if known is None:
                _known[w] = xxhash.xxh3_64_intdigest(w)
        ids = list(map(_known.__getitem__, words))
    return np.array(ids, np.uint64)


def shingles(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        out = _mix(out * _M[0] + h[i:len(h) - n + 1 + i] * _M[1])
    return out


def _numbers(name: str, words: list[str]) -> set[str]:
    """The words of a template that state the version its name ends in."""
    version = _VERSION.search(name)
    return {w for w in words for v in (version.groups() if version else ()) if w in (v, f"v{v}")}


class Scanner:
    """Template groups with their bands."""

    def __init__(self, templates: dict[str, str], containment: float):
        self.least = containment
        sized = sorted((len(w), name, w) for name, text in templates.items() if (w := _WORD(text.lower())))
        groups: list[list] = []
        for size, name, words in sized:
            n = min(N, size)
            if groups and groups[-1][0][0] * 1.25 >= size and groups[-1][0][3] == n:
                groups[-1].append((size, name, words, n))
            else:
                groups.append([(size, name, words, n)])
        self.groups = []
        self.numbers = {name: _numbers(name, words) for _, name, words in sized}
        for group in groups:
            n, longest = group[0][3], group[-1][0]
            stride = max(1, longest // 4)
            window = longest + stride
            worst = 1.0
            sets = []
            for size, name, words, _ in group:
                s = np.unique(shingles(_hashes(words), n))
                need = int(np.ceil(containment * len(s) - 1e-9))
                worst = min(worst, need / (window - n + 1 + len(s) - need))
                sets.append((name, s, need))
            bands = 1 if worst >= 1 else int(np.ceil(np.log(MISS) / np.log(1 - worst)))
            seeds = _mix(np.arange(1, bands + 1, dtype=np.uint64) * _M[0])
            least = [np.array([s[np.argmin(_mix(s ^ z))] for z in seeds]) for _, s, _ in sets]
            self.groups.append((n, stride, window, seeds, sets, least, np.unique(np.concatenate(least))))
        # any group's minima, by shingle length: most texts hold none
        self.any_least = {n: np.unique(np.concatenate([g[6] for g in self.groups if g[0] == n])) for n in {g[0] for g in self.groups}}

    def scan(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(template, containment, first word, last word) of each match."""
        words = _WORD(text.lower()) if text else []
        if not words:
            return []
        h, found, made = _hashes(words), [], {}
        for n, any_least in self.any_least.items():
            grams = shingles(h, n)
            made[n] = grams, np.flatnonzero(np.isin(grams, any_least))
        for n, stride, window, seeds, sets, least, any_least in self.groups:
            grams, some = made[n]
            if not len(some):
                continue
            hits = some[np.isin(grams[some], any_least)]
            if not len(hits):
                continue
            width = window - n + 1
            # windows that hold such a shingle; the last window is the text's end
            starts = np.unique(np.concatenate([np.clip(hits // stride * stride - k * stride, 0, None) for k in range(-(-width // stride) + 1)]))
            matches: dict[str, list] = {}
            for a in starts.tolist():
                part = grams[a:a + width]
                if not len(part):
                    continue
                mins = np.array([part[np.argmin(_mix(part ^ z))] for z in seeds])
                for (name, s, need), m in zip(sets, least, strict=True):
                    if (mins == m).any():
                        inside = np.flatnonzero(np.isin(part, s))
                        common = len(np.unique(part[inside]))
                        if common >= need:
                            first, last = a + int(inside[0]), a + int(inside[-1]) + n - 1
                            if self.numbers[name] <= set(words[first:last + 1]):
                                matches.setdefault(name, []).append((common, len(s), first, last))
            for name, spans in matches.items():
                merged: list[list] = []
                for common, size, first, last in sorted(spans, key=lambda x: x[2:]):
                    if merged and first <= merged[-1][3]:
                        merged[-1] = [max(merged[-1][0], common), size, merged[-1][2], max(merged[-1][3], last)]
                    else:
                        merged.append([common, size, first, last])
                found += [(name, *m) for m in merged]
        best: list[tuple] = []
        for name, common, size, first, last in sorted(found, key=lambda x: (-x[1], -x[1] / x[2], x[0])):
            if all(last < f or first > e for *_, f, e in best):
                best.append((name, common / size, first, last))
        return sorted(best, key=lambda x: (x[2], x[0]))


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, license, containment, first_word, last_word of every match."""
    def run(batches):
        scanner = Scanner(templates, containment)
        for batch in batches:
            rows = [(i, *m) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                    for m in scanner.scan(t)]
            if rows:
                kinds = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                                 names=["doc_id", "license", "containment", "first_word", "last_word"])
    return (docs.select(F.col("doc_id").cast("long"), "text")
            .mapInArrow(run, "doc_id long, license string, containment double, first_word long, last_word long"))
