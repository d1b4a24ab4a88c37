"""First-wins by increments against a full run."""

import random

import pytest

from quillspark.operators import firstwins
from quillspark.operators.firstwins import dedup_first
from quillspark.sources import winners

SCHEMA = "id string, part int, at long, query string"
KEYS, ORDER = ["id", "part"], ["at", "query"]


def rows_of(rng, n):
    # One key holds a third of the rows; some keys are null in part.
    ids = lambda: "hot" if rng.random() < 0.34 else rng.choice([None, "a", "b", "c", "d"])
    return [(ids(), rng.choice([None, 1]), rng.randrange(10**6), rng.choice("xyz")) for _ in range(n)]


@pytest.mark.parametrize("compact_at", [None, 0, 3])
def test_increments_equal_one_full_run(spark, tmp_path, compact_at):
    rng, path, base = random.Random(str(compact_at)), str(tmp_path), -1
    everything, kept = [], set()
    for k in range(5):
        rows = rows_of(rng, 30 if k != 2 else 0)
        rows += rows[:4] + everything[:3]  # repeated rows, and rows known already
        everything += rows
        changes = winners.add_increment(path, spark.createDataFrame(rows, SCHEMA), KEYS, ORDER, k, base).collect()
        added = [tuple(r)[:4] for r in changes if r.op == winners.ADD]
        lost = [tuple(r)[:4] for r in changes if r.op == winners.RETRACT]
        assert set(lost) <= kept and len(set(added)) == len(added) and not set(added) & kept
        kept = kept - set(lost) | set(added)
        full = dedup_first(spark.createDataFrame(everything, SCHEMA), KEYS, ORDER)
        assert kept == {tuple(r) for r in full.collect()}
        if k == compact_at:
            base = winners.compact(spark, path, KEYS, ORDER, k)
            assert base == k
    now = winners.winners(spark, path, KEYS, ORDER, 5, base)
    assert sorted(map(str, (tuple(r) for r in now.collect()))) == sorted(map(str, kept))


def test_a_replayed_increment_changes_nothing(spark, tmp_path):
    path, rng = str(tmp_path), random.Random(1)
    parts = [spark.createDataFrame(rows_of(rng, 20), SCHEMA) for _ in range(3)]
    once = [winners.add_increment(path, p, KEYS, ORDER, k).collect() for k, p in enumerate(parts)]
    again = winners.add_increment(path, parts[1], KEYS, ORDER, 1).collect()
    assert sorted(map(str, again)) == sorted(map(str, once[1]))
    assert winners.winners(spark, path, KEYS, ORDER, 3).count() == len({(r.id, r.part) for p in parts for r in p.collect()})


def test_empty_and_clashing(spark, tmp_path):
    assert winners.winners(spark, str(tmp_path), KEYS, ORDER, 0) is None
    assert winners.compact(spark, str(tmp_path), KEYS, ORDER, 0) == -1
    empty = spark.createDataFrame([], SCHEMA)
    assert winners.add_increment(str(tmp_path), empty, KEYS, ORDER, 0).count() == 0
    assert winners.add_increment(str(tmp_path), spark.createDataFrame([("a", 1, 5, "x")], SCHEMA), KEYS, ORDER, 1).count() == 1
    with pytest.raises(ValueError, match="op"):
        winners.add_increment(str(tmp_path), empty.selectExpr("*", "1 AS op"), KEYS, ORDER, 2)


def test_first_rows_pick_wide_rows_by_narrow_winners(spark):
    data = [("a", 2, "later"), ("a", 1, "first"), (None, 3, "null key"), (None, 4, "again"), ("b", None, "null order"), ("b", 5, "b")]
    df = spark.createDataFrame(data, "k string, pos int, body string")
    same = lambda x, y: sorted(map(tuple, x.collect()), key=str) == sorted(map(tuple, y.collect()), key=str)
    got = firstwins.first_rows(df, ["k"], ["pos"])
    assert same(got, firstwins.dedup_first(df, ["k"], ["pos"])) and got.count() == 3
    aggregates = [line for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate" in line]
    assert aggregates and not any("body" in line for line in aggregates)
    seen = spark.createDataFrame([("a",)], "k string")
    assert same(firstwins.unseen_rows(df, seen, "k", ["pos"]), firstwins.unseen(df, seen, "k", ["pos"]))
