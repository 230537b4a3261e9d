"""Customers looked up on demand, each with its own age."""

from __future__ import annotations

from datetime import datetime, timedelta

from ordertide.operators.enrich import enrich
from ordertide.sources.dimension import PartialDimProvider, keyed_loader

START = datetime(2026, 1, 1)
DIM = "customer_id long, name string, level string, region string"


class Source:
    """A dimension that writes down which keys it is asked for."""

    def __init__(self, spark, rows):
        self.spark, self.rows, self.asked = spark, rows, []

    def __call__(self, keys):
        self.asked.append(sorted(r[0] for r in keys.collect()))
        return keyed_loader(lambda: self.spark.createDataFrame(self.rows, DIM))(keys)


def customers(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "customer_id long")


def levels(df):
    return {r.customer_id: r.level for r in df.collect()}


def test_only_missing_or_aged_keys_are_asked_for(spark):
    source = Source(spark, [(1, "a", "VIP", "x"), (2, "b", "NORMAL", None), (3, "c", None, "z")])
    provider = PartialDimProvider(source, ttl_seconds=600)
    get = lambda seconds, *ids: levels(provider.get(customers(spark, *ids), START + timedelta(seconds=seconds)))
    assert get(0, 1, 1, None, 9) == {1: "VIP"}
    assert get(100, 2, 1) == {1: "VIP", 2: "NORMAL"}
    source.rows[0] = (1, "a", "SVIP", "x")
    assert get(599, 1, 2, 9) == {1: "VIP", 2: "NORMAL"}  # held, a miss too
    assert source.asked == [[1, 9], [2]]
    source.rows.append((9, "n", "VIP", "y"))
    assert get(600, 1, 2, 9, 3) == {1: "SVIP", 2: "NORMAL", 3: None, 9: "VIP"}  # 2 was loaded later and stays
    assert get(650) == {}
    assert get(700, 2, 3) == {2: "NORMAL", 3: None}
    assert source.asked == [[1, 9], [2], [1, 3, 9], [2]]


def test_more_keys_than_are_held(spark):
    source = Source(spark, [(i, "n", "L", "r") for i in range(20)])
    provider = PartialDimProvider(source, max_rows=5)
    assert len(levels(provider.get(customers(spark, *range(20)), START))) == 20
    assert len(levels(provider.get(customers(spark, *range(20)), START))) == 20
    assert source.asked == [list(range(20)), list(range(5, 20))]
    events = customers(spark, 1, 1, 7, 30, None)
    joined = enrich(events, provider.get(events, START + timedelta(seconds=1)))
    assert sorted((r.customer_id or -1, r.customer_level or "") for r in joined.collect()) == [(-1, ""), (1, "L"), (1, "L"), (7, "L"), (30, "")]
