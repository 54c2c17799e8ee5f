"""The driver contract of __spark_entry__.py."""

import inspect
import re

import __spark_entry__ as entry


def test_entry_schema_is_stable(spark):
    a = entry.entry(spark).schema.simpleString()
    b = entry.entry(spark).schema.simpleString()
    assert a == b == ("struct<customer_region:string,product_category:string,"
                      "revenue:double,orders:bigint>")


def test_query_keys_and_signatures():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    for name, fn in qs.items():
        assert re.fullmatch(r"[a-z][a-z0-9_]*", name)
        assert len(inspect.signature(fn).parameters) == 2
    for name, text in sql.items():
        assert text.strip().upper().startswith("WITH"), name
