import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from starmart.session import build_session
    s = build_session("local[*]", app_name="starmart-tests", shuffle_partitions=8)
    yield s
    s.stop()


EVENT_DEFAULTS = {
    "event_id": "e1", "order_id": "O1", "customer_id": "C1", "customer_name": "Ann",
    "customer_region": "West", "product_id": "P1", "product_name": "Desk",
    "product_category": "Furniture", "unit_price": 10.0, "quantity": 1, "order_total": 10.0,
    "status": "PAID", "event_ts": dt.datetime(2026, 1, 1, 10, 0),
    "ingest_source": "checkout-service-v2", "_ingested_at": dt.datetime(2026, 1, 2),
}


@pytest.fixture
def bronze_rows(spark):
    """Build a bronze frame from dicts overriding EVENT_DEFAULTS."""
    from starmart.functions.schemas import BRONZE_SCHEMA

    def make(*rows):
        data = []
        for r in rows:
            d = dict(EVENT_DEFAULTS)
            d.update(r)
            data.append(tuple(d[f.name] for f in BRONZE_SCHEMA.fields))
        return spark.createDataFrame(data, BRONZE_SCHEMA)
    return make
