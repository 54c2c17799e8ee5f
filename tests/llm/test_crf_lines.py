"""The fit of the line field reads every line of its documents."""

import random

import numpy as np
from pyspark.sql import functions as F

from starmart.llm import quality


def test_fit_reads_the_lines_after_the_thirty_second(spark, monkeypatch):
    rng = random.Random(6)
    seen, fit = [], quality.fit

    def watched(own, first, label):
        seen.extend(np.diff(first).tolist())
        return fit(own, first, label)

    monkeypatch.setattr(quality, "fit", watched)
    rows = []
    for i in range(120):  # alike up to line 40; the bad ones end in rows of signs
        lines = [" ".join(f"w{rng.randrange(400)}" for _ in range(8)) for _ in range(40 if i % 2 else 70)]
        rows.append((i, "\n".join(lines + ["| 1 | 2 | $$$ |"] * (60 if i % 2 else 0)), 1 - i % 2))
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = quality.train(df.select("doc_id", "text"), df.select("doc_id", "quality"), lambda c: F.col(c) % 4 < 2)
    assert sorted(seen) == [70] * 30 + [100] * 30
    scores = {r.doc_id: r.score for r in quality.score(df.select("doc_id", "text"), model).collect()}
    assert max(scores[i] for i, _, q in rows if q == 0) < min(scores[i] for i, _, q in rows if q == 1)
