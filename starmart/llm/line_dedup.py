"""Cross-site removal of boilerplate lines, in DataFrame functions only.

A line (trimmed of blanks; blank lines never count) is boilerplate when it
stands on at least ``min_sites`` distinct sites.  Sites per line are first
estimated by HyperLogLog sketches merged by aggregation; lines whose estimate
lies within ``margin`` of the threshold get an exact distinct count, the
others are decided by the estimate.  Every occurrence of a boilerplate line
goes; the other lines stay as they were and in order.  Only a text that would
be left without a line and that another row holds too, character by character,
stays whole: it is a copied document, which is for document deduplication to
judge.  Any other text of nothing but boilerplate is left empty.

Hot lines are pre-aggregated before each shuffle (sketches, then distinct
(line, site) pairs).  Lines are known by 96 bits of two hashes and their
length, copied texts by their MD5.  A null site is one site of its own.  Null texts stay null with no
lines; empty texts are one blank line.  Repeated rows each give a row; rows
that share a doc_id lose the lines found in any of them that are boilerplate.
Other columns pass through, whatever their names; ``n_lines`` and ``n_removed``
are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import cut, unused

MIN_SITES = 5      # distinct sites that make a line boilerplate
MARGIN = 0.5       # estimates within this share of the threshold are counted
SALTS = 32         # tasks among which the copies of one text are dealt
SKETCH_BITS = 10   # registers of a sketch: 2^10, an error of about 3 %


def _line_key(line: Column) -> Column:
    """Key of a trimmed line."""
    return F.struct(F.xxhash64(line).alias("h"), F.hash(line).alias("g"), F.length(line).alias("n"))


def boilerplate(docs: DataFrame, site: str, min_sites: int = MIN_SITES, margin: float = MARGIN):
    """(doc_id, line) occurrences once per document, and the keys of
    boilerplate lines."""
    lines = (docs.select("doc_id", F.coalesce(F.col(site).cast("string"), F.lit("\0")).alias("site"),
                         F.explode(F.array_distinct(F.transform(F.split("text", "\n", -1), lambda x: F.trim(x)))).alias("line"))
             .where("line <> ''").select("doc_id", "site", _line_key(F.col("line")).alias("line")))
    lines = cut(lines.select("doc_id", "site", "line.h", "line.g", "line.n"), "lines")
    key = ["h", "g", "n"]
    spread = cut(lines.groupBy(*key).agg(F.hll_sketch_agg("site", F.lit(SKETCH_BITS)).alias("s"))
                 .select(*key, F.hll_sketch_estimate("s").alias("sites"))
                 .where(F.col("sites") >= min_sites * (1 - margin)), "spread")
    sure = spread.where(F.col("sites") > min_sites * (1 + margin)).select(*key)
    near = spread.where(F.col("sites") <= min_sites * (1 + margin)).select(*key)
    exact = (lines.groupBy(*key, "site").agg(F.lit(1).alias("one")).join(near, key, "left_semi")
             .groupBy(*key).agg(F.count("site").alias("sites"))
             .where(F.col("sites") >= min_sites).select(*key))
    return lines, cut(sure.unionByName(exact), "boilerplate")


def copied(docs: DataFrame) -> DataFrame:
    """(doc_id, copies): MD5 of the texts of each id that stand on two rows or more."""
    texts = docs.where("text <> ''").select("doc_id", F.md5("text").alias("copy"), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt"))
    twice = (texts.groupBy("copy").agg(F.count("*").alias("n")).where("n > 1")
             .select("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")))
    # a text of very many copies is met in SALTS tasks
    return texts.join(twice, ["copy", "salt"], "left_semi").groupBy("doc_id").agg(F.collect_set("copy").alias("copies"))


def remove_boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, margin: float = MARGIN) -> DataFrame:
    """``docs`` with boilerplate lines cut out of ``text``, and the columns
    ``n_lines`` (before) and ``n_removed``; ``n_chars``, where there is one,
    follows the new text."""
    lines, bad = boilerplate(docs, site, min_sites, margin)
    docs = docs.drop("n_lines", "n_removed")
    of, marks, twins, kept, gone = (unused(docs.columns, c) for c in ("_id", "_marks", "_twins", "_kept", "_gone"))
    marked = (lines.join(bad, ["h", "g", "n"], "left_semi")
              .groupBy("doc_id").agg(F.collect_set(F.struct("h", "g", "n")).alias("marks")))
    # ids without a boilerplate line need no look at their copies
    per_doc = marked.join(copied(docs.select("doc_id", "text")).withColumnRenamed("doc_id", "of"),
                          F.col("doc_id").eqNullSafe(F.col("of")), "left").select(
        F.col("doc_id").alias(of), F.col("marks").alias(marks), F.col("copies").alias(twins))
    split = F.split("text", "\n", -1)
    rest = F.when(F.col(marks).isNull(), split).otherwise(
        F.filter(split, lambda x: ~F.array_contains(F.col(marks), _line_key(F.trim(x)))))
    empty = ~F.exists(kept, lambda x: F.trim(x) != "")
    whole = empty & F.coalesce(F.array_contains(twins, F.md5("text")), F.lit(False))
    out = (docs.join(per_doc, F.col("doc_id").eqNullSafe(F.col(of)), "left").withColumn(kept, rest)
           .withColumn(kept, F.when(whole, split).otherwise(F.col(kept)))
           .withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(F.size(split)).cast("long"))
           .withColumn(gone, F.when(F.col("text").isNull(), 0).otherwise(F.col("n_lines") - F.size(kept)).cast("long"))
           .withColumn("text", F.when(F.col(gone) > 0, F.array_join(kept, "\n")).otherwise(F.col("text"))))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(gone) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], "n_lines", F.col(gone).alias("n_removed"))


def oracle_sql(min_sites: int = MIN_SITES) -> str:
    """The same by exact counts: doc_id, n_lines, n_removed, text."""
    return f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, source, text, count(*) OVER (PARTITION BY text) AS copies FROM documents),
l AS (SELECT row, coalesce(source, chr(1)) AS site, unnest(string_split(text, chr(10))) AS line,
             unnest(range(len(string_split(text, chr(10))))) AS pos
      FROM d WHERE text IS NOT NULL),
bad AS (SELECT trim(line) AS line FROM l WHERE trim(line) <> '' GROUP BY 1 HAVING count(DISTINCT site) >= {min_sites}),
f AS (SELECT l.row, l.pos, l.line, bad.line IS NOT NULL AS found FROM l LEFT JOIN bad ON trim(l.line) = bad.line),
w AS (SELECT row, bool_and(found OR trim(line) = '') AS nothing_left FROM f GROUP BY row),
m AS (SELECT f.row, f.pos, f.line, f.found AND NOT (w.nothing_left AND d.copies > 1) AS gone
      FROM f JOIN w ON f.row = w.row JOIN d ON f.row = d.row)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE count(m.pos) END AS n_lines,
       CASE WHEN d.text IS NULL THEN 0 ELSE count(m.pos) FILTER (m.gone) END AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL
            ELSE coalesce(string_agg(m.line, chr(10) ORDER BY m.pos) FILTER (NOT m.gone), '') END AS text
FROM d LEFT JOIN m ON d.row = m.row GROUP BY d.row, d.doc_id, d.text
"""
