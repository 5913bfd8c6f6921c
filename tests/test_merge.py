from __future__ import annotations

from datetime import datetime

import pytest

from curbline.operators import merge, quality

T = "dwid string, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, fare int, note string"
DEC, JAN = datetime(2023, 12, 31, 23), datetime(2024, 1, 1)


@pytest.fixture
def tables(frame):
    target = frame(
        T,
        ("a", DEC, DEC, 1, "old"),
        ("b", DEC, DEC, 2, "old"),
        ("c", JAN, JAN, 3, "old"),
    )
    updates = frame(
        T,
        ("b", DEC, DEC, 20, "new"),
        ("d", DEC, DEC, 40, "new"),
        ("d", DEC, DEC, 41, "new"),
        ("c", JAN, JAN, 30, "new"),
    )
    return target, updates


def short(df):
    return sorted((r.dwid, r.fare, r.note) for r in df.collect())


def test_upsert_month_and_its_repetition(tables):
    target, updates = tables
    once = merge.upsert_month(target, updates, 2023, 12)
    assert short(once) == [("a", 1, "old"), ("b", 20, "new"), ("d", 40, "new")]
    assert short(merge.upsert_month(once, updates, 2023, 12)) == short(once)


def test_upsert_of_some_columns(tables):
    target, updates = tables
    keys = ["dwid", "pickup_datetime", "dropoff_datetime"]
    found = short(merge.upsert_columns(target, updates, keys, ["fare"]))
    assert found == [("a", 1, "old"), ("b", 20, "old"), ("c", 30, "old"), ("d", 40, "new")]


def test_listed_columns_may_become_null(frame):
    target = frame("k int, v int", (1, 5))
    updates = frame("k int, v int", (1, None))
    assert [tuple(r) for r in merge.upsert_columns(target, updates, ["k"], ["v"]).collect()] == [(1, None)]


def test_merge_keeps_one_update_replace_keeps_all(tables):
    target, updates = tables
    assert short(merge.merge_by_key(target, updates, ["dwid"])) == [
        ("a", 1, "old"), ("b", 20, "new"), ("c", 30, "new"), ("d", 40, "new"),
    ]
    assert len(short(merge.replace_by_key(target, updates, ["dwid"]))) == 5


def test_merge_into_or_from_nothing(tables):
    target, updates = tables
    assert short(merge.merge_by_key(target, updates.limit(0), ["dwid"])) == short(target)
    assert short(merge.merge_by_key(target.limit(0), target, ["dwid"])) == short(target)


def test_reload_month(tables):
    target, updates = tables
    assert short(merge.reload_month(target, updates, "2023_12")) == [
        ("b", 20, "new"), ("c", 3, "old"), ("d", 40, "new"), ("d", 41, "new"),
    ]


def test_reconcile_modes(frame):
    truth = frame("dwid string, pickup_datetime timestamp_ntz, fare int", ("a", DEC, 1), ("b", None, 2), ("c", JAN, None))
    other = frame("dwid string, pickup_datetime timestamp_ntz, fare int", ("b", JAN, 20), ("c", JAN, 30), ("d", JAN, 40))
    kept = sorted((r.dwid, r.fare) for r in merge.reconcile(truth, other).collect())
    assert kept == [("a", 1), ("c", None)]
    filled = sorted((r.dwid, r.fare) for r in merge.reconcile(truth, other, mode="coalesce").collect())
    assert filled == [("a", 1), ("b", 2), ("c", 30), ("d", 40)]
    loss = merge.reconcile_loss(truth, other, "moderate").first()
    assert (loss.total_rows, loss.lost_rows, loss.loss_percent, loss.breached) == (4, 2, 50.0, True)
    # What is kept and what is lost add up to everything.
    assert len(kept) + loss.lost_rows == loss.total_rows
    with pytest.raises(ValueError):
        merge.reconcile(truth, other, mode="other")


def losses(frame, lost, total):
    return frame("ts timestamp_ntz", *[(None if i < lost else JAN,) for i in range(total)])


@pytest.mark.parametrize(
    ("lost", "total", "level", "breached"),
    [
        (0, 100, "very_strict", False),
        (1, 100, "very_strict", True),
        (1, 101, "very_strict", False),
        (4, 100, "strict", False),
        (5, 100, "strict", True),
        (100, 100, "moderate", True),
        (0, 0, "moderate", False),
    ],
)
def test_loss_limit_is_itself_too_much(frame, lost, total, level, breached):
    assert merge.loss_report(losses(frame, lost, total), "ts", level).first().breached is breached


def test_loss_gate(frame):
    with pytest.raises(ValueError):
        merge.loss_report(losses(frame, 1, 2), "ts", "lenient")
    with pytest.raises(quality.QualityError):
        quality.check_loss(losses(frame, 1, 2), "ts", "moderate")
    assert quality.check_loss(losses(frame, 0, 2), "ts", "moderate").first().lost_rows == 0
