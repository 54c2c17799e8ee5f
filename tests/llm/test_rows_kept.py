"""No row or line is kept or lost by a switch: line removal against its SQL, one of each group, clashing names."""

import duckdb
import public_tokenizers as P
import pytest

from starmart.llm import bpe, line_dedup, mixing, ngram_join, queries

CASES = [(i, f"own {i}\nnav bar\n\nfooter text", f"s{i % 6}") for i in range(12)] + [
    (20, "nav bar", "s9"), (21, "nav bar\nfooter text", "s8"), (22, "nav bar\nfooter text", "s7"), (22, "nav bar\n \nfooter text", "s7"),
    (23, "x" * 5 + "\nnav bar\nfooter text", "s1"), (24, None, "s1"), (25, "", None), (26, "nav bar \nz", None), (None, "nav bar\nq", "s2")]


def by_sql(sql, path):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/documents.parquet/*.parquet')")
    return sorted(con.execute(f"SELECT doc_id, n_lines, n_removed, text FROM ({sql})").fetchall(), key=str)


def test_line_removal_equals_its_sql(spark, tmp_path):
    spark.createDataFrame(CASES, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.queries()["op3_line_dedup"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_lines", "n_removed", "text"]
    rows = sorted(map(tuple, got.collect()), key=str)
    assert rows == by_sql(line_dedup.oracle_sql(), tmp_path)
    text = {(i, n): t for i, n, _, t in rows}
    assert text[20, 1] == "" and text[23, 3] == "xxxxx" and text[22, 3] == " "  # no share of the text is too large to go
    assert text[21, 2] == "nav bar\nfooter text"                              # a copied document


def test_source_mix_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/sf0.001/documents.parquet')")
    got = queries.queries()["op8_source_mix"](spark, "/root/testdata/sf0.001")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({mixing.oracle_sql()})").fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_columns_that_bear_work_names(spark):
    schema = ("doc_id long, text string, source string, _bad string, _id int, _kept string, _marks int, _twins int, _gone int, "
              "_text string, _digest int, _row int, _place int")
    rows = [(i, t, s, "b", 1, "k", 2, 3, 4, "t", 5, 6, 7) for i, t, s in CASES]
    df = spark.createDataFrame(rows, schema)
    for out in (line_dedup.remove_boilerplate(df), ngram_join.keep_one(df), ngram_join.keep_one(df.where("doc_id < 20"))):
        assert out.columns[:13] == df.columns
        assert {(r._bad, r._id, r._kept, r._marks, r._twins, r._gone, r._text, r._digest, r._row, r._place) for r in out.collect()} == {
            ("b", 1, "k", 2, 3, 4, "t", 5, 6, 7)}
    coded = bpe.round_trip(df, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    assert {r._text for r in coded.collect()} == {"t"}


@pytest.mark.parametrize("rows,kept", [
    ([(1, "a b"), (1, "c d")], [(1, "a b"), (1, "c d")]),
    ([(1, "a b"), (1, "a b"), (2, "a b")], [(1, "a b")]),
    ([(3, "a b"), (1, "c d"), (1, "a b"), (None, "a b"), (2, None), (2, None), (2, "")], [(1, "a b"), (1, "c d"), (2, ""), (2, None), (None, "a b")]),
])
def test_rows_of_one_id_with_unlike_texts_stay(spark, rows, kept):
    got = ngram_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(kept, key=str)


def test_one_of_repeated_rows_is_the_least_by_all_columns(spark):
    rows = [(1, "a b c", 5), (1, "a b c", 3), (2, "a b c", 1)]
    got = ngram_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string, n int"))
    assert [tuple(r) for r in got.collect()] == [(1, "a b c", 3)]
