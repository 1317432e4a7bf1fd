import datetime as dt

import pytest

from terrace.operators import joins

D = dt.date


def _facts(spark):
    return spark.createDataFrame([
        ("t1", "AB1", D(1998, 1, 1)),   # first day of a validity
        ("t2", "AB1", D(1998, 6, 30)),  # last day, overlap -> 2 matches
        ("t3", "AB1", D(1980, 1, 1)),   # before any validity
        ("t4", "", D(1998, 3, 1)),      # empty postcode
        ("t5", "ZZ9", D(1998, 3, 1)),   # unknown postcode
        ("t6", "AB1", None),            # no date
    ], "tid string, pc string, d date")


def _versions(spark):
    return spark.createDataFrame([
        ("v1", "AB1", D(1996, 1, 1), D(1998, 6, 30)),
        ("v2", "AB1", D(1998, 1, 1), D(2099, 12, 31)),
        ("v3", "AB2", D(1900, 1, 1), D(2099, 12, 31)),
    ], "vid string, gpc string, valid_from date, valid_to date")


def _run(spark, how, limit):
    out = joins.validity_join(_facts(spark), _versions(spark), "pc", "gpc", "d", how=how, limit=limit)
    return sorted((r.tid, r.vid) for r in out.select("tid", "vid").collect())


def test_left_validity_join_edges(spark):
    want = [("t1", "v1"), ("t1", "v2"), ("t2", "v1"), ("t2", "v2"), ("t3", None), ("t4", None),
            ("t5", None), ("t6", None)]
    assert _run(spark, "left", None) == want


def test_inner_validity_join(spark):
    assert _run(spark, "inner", None) == [("t1", "v1"), ("t1", "v2"), ("t2", "v1"), ("t2", "v2")]


def test_shuffle_path_equals_broadcast_path(spark):
    assert _run(spark, "left", 0) == _run(spark, "left", None)


def test_checked_broadcast_measures(spark):
    df = spark.createDataFrame([("abc", 1)] * 10, "s string, i int")
    _, size = joins.checked_broadcast(df, limit=10_000)
    assert size.rows == 10 and size.broadcast and size.bytes >= 10 * 3
    _, size = joins.checked_broadcast(df, limit=1)
    assert not size.broadcast


def test_unresolved_count(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "k string")
    look = spark.createDataFrame([("a",), ("a",)], "k string")
    r = joins.unresolved_count(rows, look, "k").first()
    assert (r.postcodes, r.unmatched_postcodes) == (4, 2)


def test_hot_key_split_equals_plain_join(spark):
    import random
    rnd = random.Random(3)
    facts = [(f"t{i}", "HOT" if i % 3 == 0 else f"K{rnd.randint(0, 50)}", D(1998, 1 + i % 12, 1))
             for i in range(3000)]
    versions = [("vh1", "HOT", D(1990, 1, 1), D(1998, 6, 30)), ("vh2", "HOT", D(1998, 6, 1), D(2099, 1, 1))]
    versions += [(f"v{k}", f"K{k}", D(1997, 1, 1), D(1998, 8, 31)) for k in range(0, 50, 2)]
    f = spark.createDataFrame(facts, "tid string, pc string, d date")
    v = spark.createDataFrame(versions, "vid string, gpc string, valid_from date, valid_to date")
    assert joins.hot_keys(f, "pc", 0.05, 0.5) == ["HOT"]
    for how in ("left", "inner"):
        plain = joins.validity_join(f, v, "pc", "gpc", "d", how=how, limit=0)
        split = joins.validity_join(f, v, "pc", "gpc", "d", how=how, limit=0, split_hot_keys=True,
                                    hot_share=0.05)
        assert "Union" in split._jdf.queryExecution().optimizedPlan().toString()
        a = sorted(map(tuple, plain.select("tid", "vid").collect()), key=str)
        b = sorted(map(tuple, split.select("tid", "vid").collect()), key=str)
        assert a == b and len(a) >= 3000 if how == "left" else a == b


def test_hot_keys_respect_their_bound(spark):
    from pyspark.sql import functions as F
    # 400 keys of equal weight: none holds more than 1%, so none is hot
    df = spark.range(40000).select((F.col("id") % 400).cast("string").alias("k"))
    assert joins.hot_keys(df, "k", share=0.01, fraction=0.5) == []
    # whatever the data, at most 1/share keys come back
    skewed = spark.range(40000).select(F.when(F.col("id") % 2 == 0, F.lit("A"))
                                       .otherwise((F.col("id") % 7).cast("string")).alias("k"))
    hot = joins.hot_keys(skewed, "k", share=0.2, fraction=0.5)
    assert hot[0] == "A" and len(hot) <= 5


def test_blank_keys_match_nothing_and_are_spread(spark):
    """Facts without a postcode keep their rows in a shuffled left join and do
    not meet in one partition."""
    import datetime as dt
    day = dt.date(2020, 1, 1)
    facts = spark.createDataFrame([(i, "" if i % 3 else None, day) for i in range(300)] + [(1000, "A", day)],
                                  "id int, k string, d date")
    versions = spark.createDataFrame([("A", day, day, "x"), ("", day, day, "never")],
                                     "v string, valid_from date, valid_to date, name string")
    out = joins.validity_join(facts, versions.where("v != ''"), "k", "v", "d", limit=0)
    rows = out.collect()
    assert len(rows) == 301 and [r.id for r in rows if r["name"]] == [1000] and "_key" not in out.columns
    inner = joins.validity_join(facts, versions, "k", "v", "d", how="inner", limit=0)
    assert [r.id for r in inner.collect()] == [1000]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_interval_lists_equal_the_validity_join(spark, how):
    """Overlaps fan out, gaps and blanks find nothing, a hot postcode is one row."""
    day = lambda n: dt.date(2000, 1, 1) + dt.timedelta(days=n)
    facts = spark.createDataFrame([(i, "HOT" if i % 3 else ["A", "", None, "B"][i % 4], day(i % 50) if i % 17 else None)
                                   for i in range(600)], "id int, k string, d date")
    versions = spark.createDataFrame([("HOT", day(0), day(20), 1), ("HOT", day(10), day(30), 2), ("A", day(5), day(5), 3),
                                      ("C", day(0), day(99), 4), (None, day(0), day(99), 5), ("", day(0), day(1), 6)],
                                     "vk string, valid_from date, valid_to date, n int")
    lists = joins.interval_lists(versions, "vk")
    assert lists.count() == lists.select("vk").distinct().count() == 4
    got = joins.interval_list_join(facts, lists, "k", "vk", "d", how=how)
    want = joins.validity_join(facts, versions, "k", "vk", "d", how=how)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
