"""Histories as sequences of passes, against a plain pass-by-pass loop; current state; runs."""

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

import numpy as np

from offerledger.operators import current, runs
from offerledger.operators import history as H

SCHEMA = "alias long, kind string, category_label string, value decimal(10,3), unit string, conditions_text string, observed_at timestamp, ordinal long"
DAY = datetime(2024, 1, 1)


def row(alias, value, day=0, kind="purchase", label=None, unit="percent", text=None, ordinal=0):
    return (alias, kind, label, None if value is None else Decimal(str(value)), unit, text, DAY + timedelta(days=day), ordinal)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def kept(df):
    return sorted(((r.alias, r.kind, r.category_label or "", None if r.value is None else float(r.value), r.observed_at.day) for r in df.collect()), key=repr)


def test_write_on_change(spark):
    rows = [row(1, 7.2), row(1, "7.20", 1), row(1, 8, 2), row(1, 8, 3, text=" "), row(1, 8, 4, text="x"), row(2, 1, 0, label=""), row(2, 1, 1), row(3, 5, 0), row(3, 6, 0, ordinal=1), row(3, 5, 1), row(3, 6, 1, ordinal=1)]
    got = kept(H.write_on_change(frame(spark, rows)))
    assert [x[3:] for x in got if x[0] == 1] == [(7.2, 1), (8.0, 3), (8.0, 5)]
    assert [x[3:] for x in got if x[0] == 2] == [(1.0, 1)]
    assert len([x for x in got if x[0] == 3]) == 4  # two rows of one key on a page are both written each time


def test_first_write_against_the_stored_row(spark):
    stored = frame(spark, [row(1, 5), row(2, 6), row(3, None)])
    new = frame(spark, [row(1, 5, 1), row(2, 7, 1), row(3, 2, 1), row(4, 1, 1)])
    assert [x[0] for x in kept(H.write_on_change(new, stored))] == [2, 3, 4]


def test_closures(spark):
    stored = frame(spark, [row(1, 5), row(1, 3, kind="category", label="a"), row(2, 6), row(3, 7), row(4, None), row(5, 1)])
    read = frame(spark, [row(1, 0, 1), row(2, 0, 1), row(4, 0, 1), row(9, 0, 1)]).select("alias", "observed_at")  # 3, 5: not read
    seen = frame(spark, [row(1, 5, 1, label=" ")])
    assert kept(H.closures(H.latest(stored), read, seen)) == [(1, "category", "a", None, 2), (2, "purchase", "", None, 2)]


def test_backfill_equals_a_loop_of_passes(spark):
    r = np.random.default_rng(8)
    obs, passes, want = [], [], []
    for alias in range(40):
        state: dict = {}
        for day in sorted(r.choice(20, int(r.integers(1, 9)), replace=False).tolist()):
            passes.append((alias, DAY + timedelta(days=day)))
            seen = {(k, l): int(r.integers(0, 3)) for k, l in (("purchase", None), ("category", "x"), ("category", "y")) if r.random() < 0.6}
            for (kind, label), value in seen.items():
                obs.append((*row(alias, value, day, kind, label), DAY + timedelta(days=day)))
                if state.get((kind, label), "new") != value:
                    want.append((alias, kind, label or "", float(value), day + 1))
                state[kind, label] = value
            for key, value in state.items():
                if value is not None and key not in seen:
                    state[key] = None
                    want.append((alias, key[0], key[1] or "", None, day + 1))
    df = spark.createDataFrame(obs, SCHEMA + ", pass_at timestamp")
    got = kept(H.backfill(df, spark.createDataFrame(passes, "alias long, pass_at timestamp")))
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_passes_one_by_one_equal_the_backfill(spark):
    history = frame(spark, [])
    days = {0: [row(1, 5), row(2, 6)], 1: [row(1, 5, 1)], 2: [row(1, 4, 2), row(2, 6, 2)]}
    for day, rows in days.items():
        read = frame(spark, [row(1, 0, day), row(2, 0, day)]).select("alias", "observed_at")
        new = H.collect_pass(history, frame(spark, rows), read).select(*history.columns)
        history = spark.createDataFrame([*history.collect(), *new.collect()], history.schema)
    assert kept(history) == sorted([(1, "purchase", "", 5.0, 1), (1, "purchase", "", 4.0, 3), (2, "purchase", "", 6.0, 1), (2, "purchase", "", None, 2), (2, "purchase", "", 6.0, 3)], key=repr)


def test_closed_offers_do_not_come_back(spark):
    history = frame(spark, [row(1, 5), row(1, None, 1), row(2, 6)]).withColumn("effective_value", H.F.col("value"))
    aliases = spark.createDataFrame([(1, 10, 0, DAY), (2, 10, 1, DAY), (3, 11, 0, DAY)], "alias long, merchant_id long, provider_id int, last_checked_at timestamp")
    merchants = spark.createDataFrame([(10, False), (11, False), (12, True)], "merchant_id long, is_published boolean")
    every, main, published = current.refresh(history, aliases, merchants)
    assert [r.alias for r in every.collect()] == [2] == [r.alias for r in main.collect()]
    assert {r.merchant_id: (r.is_published, r.newly_published) for r in published.collect()} == {10: (True, True), 11: (False, False), 12: (True, False)}
    cover = {r.merchant_id: (r.n_platforms, r.n_offers) for r in current.merchant_coverage(merchants, main, every).collect()}
    assert cover == {10: (1, 1), 11: (0, 0), 12: (0, 0)}


def test_previous_run_of_overlapping_runs(spark):
    at = lambda h: DAY + timedelta(hours=h)
    rows = [(1, 0, at(0), at(2), "ok", 100), (2, 0, at(1), at(4), "ok", 50), (3, 0, at(3), at(5), "failed", 0), (4, 0, at(6), at(7), "ok", 60), (5, 1, at(6), at(7), "ok", 1)]
    df = spark.createDataFrame(rows, "run_id long, provider_id int, started_at timestamp, finished_at timestamp, status string, offers_found long").withColumn("pages_empty", H.F.lit(2))
    got = {r.run_id: (r.previous, r.is_drift, r.notes) for r in runs.drift(runs.previous_offers(df)).collect()}
    assert {k: v[0] for k, v in got.items()} == {1: None, 2: None, 3: 100, 4: 50, 5: None}
    assert got[3][1] and not got[4][1] and got[3][2] == "offers 100 -> 0 ; 2 pages without offers"
