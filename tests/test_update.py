"""Keyed updates: base rows are never added or lost."""

from hexaccess.operators.vector import update_by_key


def test_update_keeps_base_rows(spark):
    base = spark.createDataFrame([(1, 1.0, "a"), (2, 2.0, "b"), (3, 3.0, "c"), (None, 4.0, "d"), (1, 5.0, "e")], "k int, v double, name string")
    upd = spark.createDataFrame([(1, 10.0), (1, 30.0), (1, None), (2, None), (9, 90.0), (None, 0.0)], "k int, v double")
    got = sorted(((r["k"] or 0, r["v"], r["name"]) for r in update_by_key(base, upd, "k", ["v"]).collect()), key=lambda r: r[2])
    assert got == [(1, 30.0, "a"), (2, 2.0, "b"), (3, 3.0, "c"), (0, 4.0, "d"), (1, 30.0, "e")]
    assert update_by_key(base, upd.limit(0), "k", ["v"]).count() == 5
