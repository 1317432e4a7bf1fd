import random

from terrace.operators.merge import keyed_upsert

UPD = ["price", "seq"]
COLS = "k string, price int, seq long, addr string"


def replay(rows):
    """Sequential INSERT .. ON CONFLICT DO UPDATE of price/seq, in seq order."""
    table = {}
    for k, price, seq, addr in sorted(rows, key=lambda r: r[2]):
        if k in table:
            table[k] = (k, price, seq, table[k][3])
        else:
            table[k] = (k, price, seq, addr)
    return sorted(table.values())


def test_keyed_upsert_equals_sequential_replay(spark):
    rnd = random.Random(7)
    rows = [(f"k{rnd.randint(0, 30)}", rnd.randint(1, 999), i, f"a{i}") for i in range(400)]
    b1, b2 = rows[:250], rows[250:]
    t = spark.createDataFrame([], COLS)
    for b in (b1, b2):
        t = keyed_upsert(t, spark.createDataFrame(b, COLS), "k", "seq", UPD)
    assert sorted(tuple(r) for r in t.collect()) == replay(rows)


def test_keyed_upsert_replay_is_idempotent(spark):
    rows = [("a", 1, 1, "x"), ("a", 2, 2, "y"), ("b", 3, 3, "z")]
    t = spark.createDataFrame([], COLS)
    b = spark.createDataFrame(rows, COLS)
    once = keyed_upsert(t, b, "k", "seq", UPD)
    twice = keyed_upsert(once, b, "k", "seq", UPD)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == \
        [("a", 2, 2, "x"), ("b", 3, 3, "z")]


def test_null_update_overwrites(spark):
    t = spark.createDataFrame([("a", 5, 1, "x")], COLS)
    b = spark.createDataFrame([("a", None, 2, "y")], COLS)
    assert [tuple(r) for r in keyed_upsert(t, b, "k", "seq", UPD).collect()] == [("a", None, 2, "x")]


from hypothesis import given, settings, strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abcde"), st.integers(0, 9)), min_size=1, max_size=40),
       st.integers(0, 40))
def test_upsert_property(spark, events, cut):
    rows = [(k, p, i, f"a{i}") for i, (k, p) in enumerate(events)]
    t = spark.createDataFrame([], COLS)
    for b in (rows[:cut], rows[cut:]):
        if b:
            t = keyed_upsert(t, spark.createDataFrame(b, COLS), "k", "seq", UPD)
    assert sorted(tuple(r) for r in t.collect()) == replay(rows)
