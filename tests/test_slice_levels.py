"""What the levels of slices write and send: no fields that a signal doesn't read, no groups that lie in one slice."""

import random

import pytest
from pyspark.sql import functions as F

from keyloom.operators import kernels, slices
from keyloom.operators.kernels import prepare, segments
from keyloom.operators.slices import SLICE, cut_slices, entry_anchors
from keyloom.plans import catalog
from keyloom.plans.catalog import READS, SLICED, compute, compute_sliced
from keyloom.sources.fixtures import events_view

SF = "/root/testdata/sf0.001"


@pytest.fixture
def tables(monkeypatch):
    """The columns of each table that is written."""
    found, plain = [], slices.written

    def written(df):
        found.append(set(df.columns))
        return plain(df)

    for module in (slices, kernels, catalog):
        monkeypatch.setattr(module, "written", written)
    return found


@pytest.mark.parametrize("name", ["auth_otp_fallback", "auth_retry_session", "auth_rapid_device_switch", "auth_high_risk_hours"])
def test_slices_carry_what_is_read(spark, tables, name):
    events = events_view(spark, SF, key="half")
    parameters = {"auth_otp_fallback": {"on": 0.35}, "auth_rapid_device_switch": {"on": 6}}.get(name, {})
    rows = lambda d: sorted(map(tuple, d.collect()), key=str)
    got = rows(compute_sliced(name, events, 100, **parameters))
    unread = set(events.columns) - {"entity_id", "ts", "event_id", *READS[name]}
    assert tables and not [t & unread for t in tables if t & unread]
    assert got == rows(compute(name, events, **parameters)) and set(READS) <= SLICED


def test_a_rank_and_times_apart_are_one_level(spark, tables):
    rng = random.Random(6)
    rows = sorted(("ab"[i % 2], rng.choice([0, 0, 5, 7, 4000, 4001, 9000]) + 1000 * (i // 40), i) for i in range(300))
    d = spark.createDataFrame(rows, "entity_id string, ts long, event_id long")
    apart = lambda x: sorted((r["entity_id"], r["rn"], r["ts"], r["event_id"]) for r in prepare(x, nudge=True).collect())
    expected = apart(d)
    assert not tables and apart(cut_slices(d, 20)) == expected
    # the rows once, the totals of the slices once
    assert len(tables) == 2


def test_runs_in_one_slice_have_no_entry(spark):
    """Most runs are short; those that don't cross from slice to slice take no part in the steps of anchors."""
    d = spark.range(2000).selectExpr("'a' AS entity_id", "id * 700 AS ts", "id AS event_id", "id div 7 AS run")
    sliced = cut_slices(d, 50)
    spread = {r["run"] for r in sliced.groupBy("run").agg(F.min(SLICE).alias("a"), F.max(SLICE).alias("b")).where("a < b").collect()}
    entries = entry_anchors(sliced, 1500, False, "run").collect()
    assert spread and {r["run"] for r in entries} == spread
    a, b = (sorted((r["event_id"], r["anchor"]) for r in segments(x, 1500, "run").collect()) for x in (d, sliced))
    assert a == b
