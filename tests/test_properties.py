"""Spark operators against brute force on random small inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starmart.functions.schemas import VALID_STATUSES
from starmart.operators.history import scd2_full_history
from starmart.plans.silver import build_silver
from tests.conftest import EVENT_DEFAULTS

DAYS = [dt.datetime(2026, 1, d) for d in (1, 2, 3)]
ORDER = ("_ingested_at", "event_ts", "product_id", "quantity", "order_total", "status")

event = st.fixed_dictionaries({
    "event_id": st.sampled_from(["e1", "e2", "e3", "e4", None]),
    "customer_id": st.sampled_from(["C1", "C2", None]),
    "customer_name": st.sampled_from(["x", "y"]),
    "customer_region": st.sampled_from(["A", "B", None]),
    "order_total": st.sampled_from([-1.0, 0.0, 5.0, 7.5, None]),
    "status": st.sampled_from(["PAID", "PLACED", "TEST", None]),
    "event_ts": st.sampled_from(DAYS + [None]),
    "quantity": st.integers(1, 3),
})

SETTINGS = dict(max_examples=12, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture,
                                       HealthCheck.too_slow])


def _with_load_times(rows):
    # a distinct load time per row: no ties inside an event's versions
    return [dict(EVENT_DEFAULTS, **r,
                 _ingested_at=dt.datetime(2026, 2, 1) + dt.timedelta(minutes=i))
            for i, r in enumerate(rows)]


def _desc_nulls_last_key(row):
    return tuple((row[c] is not None, row[c]) for c in ORDER)


def brute_silver(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["event_id"], []).append(r)
    out = []
    for versions in groups.values():
        best = max(versions, key=_desc_nulls_last_key)
        total, status = best["order_total"], best["status"]
        if total is not None and total > 0 and status in VALID_STATUSES:
            out.append(best)
    return out


@settings(**SETTINGS)
@given(st.lists(event, min_size=1, max_size=25))
def test_silver_matches_brute_force(bronze_rows, rows):
    rows = _with_load_times(rows)
    got = build_silver(bronze_rows(*rows)).select("event_id", "_ingested_at").collect()
    want = [(r["event_id"], r["_ingested_at"]) for r in brute_silver(rows)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def brute_history(silver_rows):
    by_c = {}
    for r in silver_rows:
        if r["customer_id"] is not None:
            by_c.setdefault(r["customer_id"], []).append(r)
    out = []
    for cid, evs in by_c.items():
        evs.sort(key=lambda r: ((r["event_ts"] is not None, r["event_ts"]),
                                (r["event_id"] is not None, r["event_id"])))
        starts, prev = [], None
        for r in evs:
            attrs = (r["customer_name"], r["customer_region"])
            if prev is None or attrs != prev:
                starts.append((attrs, r["event_ts"].date() if r["event_ts"] else None))
            prev = attrs
        for i, (attrs, start) in enumerate(starts):
            end = starts[i + 1][1] if i + 1 < len(starts) else None
            out.append((cid, attrs[0], attrs[1], start, end, i + 1 == len(starts)))
    return out


@settings(**SETTINGS)
@given(st.lists(event, min_size=1, max_size=25), st.integers(1, 4))
def test_full_history_matches_brute_force(bronze_rows, rows, partitions):
    rows = _with_load_times(rows)
    silver = build_silver(bronze_rows(*rows))
    got = [(r.customer_id, r.customer_name, r.customer_region, r.start_date, r.end_date,
            r.is_current)
           for r in scd2_full_history(silver, partitions=partitions).collect()]
    want = brute_history([r.asDict() for r in silver.collect()])
    assert sorted(got, key=str) == sorted(want, key=str)


def brute_latest(silver_rows):
    by_c = {}
    for r in silver_rows:
        if r["customer_id"] is not None:
            by_c.setdefault(r["customer_id"], []).append(r)
    out = {}
    for cid, evs in by_c.items():
        best = max(evs, key=lambda r: ((r["event_ts"] is not None, r["event_ts"]),
                                       (r["event_id"] is not None, r["event_id"])))
        dates = [r["event_ts"].date() for r in evs if r["event_ts"] is not None]
        out[cid] = {"name": best["customer_name"], "region": best["customer_region"],
                    "eff": best["event_ts"].date() if best["event_ts"] else None,
                    "first": min(dates) if dates else None}
    return out


def _sql_differs(a, b):
    return a is not None and b is not None and a != b


def brute_scd2(rows1, rows_all):
    init = brute_latest(brute_silver(rows1))
    latest = brute_latest(brute_silver(rows_all))
    out = []
    for cid, v in init.items():
        new = latest.get(cid)
        if new and (_sql_differs(new["region"], v["region"]) or _sql_differs(new["name"], v["name"])):
            out.append((cid, v["name"], v["region"], v["first"], new["eff"], False))
            out.append((cid, new["name"], new["region"], new["eff"], None, True))
        else:
            out.append((cid, v["name"], v["region"], v["first"], None, True))
    return out


@settings(**SETTINGS)
@given(st.lists(event, min_size=1, max_size=15), st.lists(event, max_size=15))
def test_scd2_two_loads_match_brute_force(bronze_rows, load1, load2):
    from starmart.operators.scd2 import customer_latest, scd2_apply, scd2_changes, scd2_init
    rows = _with_load_times(load1 + load2)
    rows1 = rows[:len(load1)]
    dim = scd2_init(customer_latest(build_silver(bronze_rows(*rows1))))
    latest = customer_latest(build_silver(bronze_rows(*rows)))
    out = scd2_apply(dim, scd2_changes(latest, dim))
    got = [(r.customer_id, r.customer_name, r.customer_region, r.start_date, r.end_date,
            r.is_current) for r in out.collect()]
    assert sorted(got, key=str) == sorted(brute_scd2(rows1, rows), key=str)
