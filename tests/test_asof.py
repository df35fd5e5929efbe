"""The as-of join with nulls, ties, repeated rows and empty tables."""

from candleforge.operators.asof import asof_backward


def test_asof(spark):
    left = spark.createDataFrame([("a", 5, 1), ("a", 5, 1), ("a", 1, 2), ("b", 9, 3), (None, 9, 4), ("a", None, 5)], "k string, t long, n int")
    right = spark.createDataFrame([("a", 2, 1.0), ("a", 4, 2.0), ("a", 6, 3.0), ("b", 9, None), ("b", 1, 7.0), (None, 1, 8.0), ("a", None, 9.0)], "k string, t long, v double")
    got = asof_backward(left, right, "t", ["k"], ["v"])
    assert got.columns == ["k", "t", "n", "v"]
    assert sorted((r.n, r.v) for r in got.collect() if r.v is not None) == [(1, 2.0), (1, 2.0)]
    assert got.count() == 6
    assert asof_backward(left.limit(0), right, "t", ["k"], ["v"]).count() == 0
    assert {r.v for r in asof_backward(left, right.limit(0), "t", ["k"], ["v"]).collect()} == {None}
