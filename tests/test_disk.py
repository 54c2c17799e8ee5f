"""What a query keeps on disk: its tables and what is still to be read, no shuffle files and no copies."""

import glob

import pytest

from starmart import session
from starmart.functions.schemas import BRONZE_SCHEMA
from starmart.plans import increments
from starmart.plans.catalog import registered
from starmart.session import scratch_dir
from starmart.sources import buckets
from starmart.streaming.redelivery import start_redelivery_stream
from tests import test_increments
from tests.conftest import SF_SMALL


@pytest.fixture
def left(tmp_path, monkeypatch):
    """Files with rows in the scratch folders of these names."""
    monkeypatch.setattr(session, "shared_root", lambda spark: str(tmp_path))
    return lambda *names: [f for x in names for f in glob.glob(f"{tmp_path}/{x}-*/**/*.parquet", recursive=True)]


@pytest.fixture
def grouped(monkeypatch):
    """Merges in groups of few buckets; the group sizes."""
    groups, seen = buckets.groups, []

    def noted(*args):
        seen.append([len(g) for g in groups(*args)])
        return groups(*args)

    monkeypatch.setattr(increments, "ROWS_AT_ONCE", 50)
    monkeypatch.setattr(buckets, "groups", noted)
    return seen


def test_merges_in_groups_of_buckets_equal_a_rebuild(spark, bronze_rows, grouped):
    test_increments.test_three_loads_equal_a_rebuild(spark, bronze_rows)
    assert len(grouped) == 8 and sum(len(g) > 1 for g in grouped) >= 2


def test_groups_hold_every_bucket_once():
    assert buckets.groups([3, 5, 9], 10, 100) == [[3, 5, 9]] and buckets.groups([], 0, 100) == [[]]
    assert sorted(x for g in buckets.groups(list(range(64)), 1000, 100) for x in g) == list(range(64))
    assert len(buckets.groups(list(range(64)), 1000, 100)) == 10 and len(buckets.groups([1, 2], 1000, 1)) == 2


def test_a_merge_keeps_no_second_copy_of_silver(spark, bronze_rows, left):
    path = scratch_dir(spark, "s")
    increments.merge_silver(spark, path, bronze_rows(*({"event_id": f"e{i}"} for i in range(100))), 1, 4).close()
    merged = increments.merge_silver(spark, path, bronze_rows({"event_id": "e7", "quantity": 9}), 2, 4)
    assert spark.read.parquet(*left("merge-silver")).count() == 2   # the new row and the one it replaced
    assert merged.added.count() == merged.removed.count() == 1
    merged.close()
    assert not left("merge-silver") and increments.silver(spark, path).count() == 100


def test_loads_and_changes_go_once_merged(spark, left):
    assert registered()["sales_summary_incremental"](spark, SF_SMALL).count() > 0
    assert not left("feed", "merge-silver", "merge-customers", "merge-fact") and left("silver_bucketed") and left("fact_by_customer")


def test_drops_go_once_fed(spark, left):
    tagged = registered()["silver_stream"](spark, SF_SMALL)
    assert not left("redelivery_feed") and left("redelivery_src")
    assert tagged.count() == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()


def test_deliveries_are_dealt_before_they_are_text(spark, bronze_rows):
    src, out, ckpt = (scratch_dir(spark, x) for x in ("src", "out", "ckpt"))
    bronze_rows({"event_id": "a"}, {"event_id": "b"}).write.parquet(src)
    stream = start_redelivery_stream(spark.readStream.schema(BRONZE_SCHEMA).parquet(src), out, ckpt, "10 days", available_now=True)
    stream.awaitTermination()
    plan = stream._jsq.explainInternal(False)
    assert plan.count("Exchange") == 1 and plan.index("AS _rank") < plan.index("Exchange")   # the plan's root is on top
    assert spark.read.parquet(out).count() == 2
