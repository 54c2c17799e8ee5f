"""What a Python worker holds at once does not follow the size of the batches it gets."""

import pyarrow as pa

from starmart.llm import ngram_join, toxicity


def test_texts_are_scored_a_few_at_a_time(spark, monkeypatch):
    df = spark.createDataFrame([], "doc_id long, text string")
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, schema: f)
    run = toxicity.score(df, ({"bad": 2.0}, -1.0))
    n = 3 * toxicity.TEXTS + 7
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(["a bad word" if i % 3 else None for i in range(n)])], names=["doc_id", "text"])
    out = list(run([batch, batch.slice(0, 0)]))
    assert max(b.num_rows for b in out) <= toxicity.TEXTS <= 1000
    whole = pa.Table.from_batches(out)
    assert whole["doc_id"].to_pylist() == list(range(n))
    assert [round(x, 6) for x in whole["score"].to_pylist()] == [0.731059 if i % 3 else 0.268941 for i in range(n)]


def test_the_word_table_stays_small():
    for lo in range(0, 90_000, 300):
        ngram_join.shingles(" ".join(f"w{i}" for i in range(lo, lo + 300)), 5)
    assert len(ngram_join._known) <= 1 << 16
