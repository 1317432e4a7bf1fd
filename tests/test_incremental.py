import datetime as dt

from pyspark.sql import functions as F

from terrace.operators import incremental as inc
from terrace.sinks.tables import VersionedTable

D = dt.date
COLS = "k string, d date, v int"


def test_high_water_and_replace(spark):
    cur = spark.createDataFrame([("a", D(2000, 1, 1), 1), ("b", D(2000, 2, 1), 1)], COLS)
    src = spark.createDataFrame([("a", D(2000, 1, 1), 9), ("b", D(2000, 3, 1), 2), ("c", D(2000, 2, 1), 3),
                                 ("d", D(2000, 4, 1), 4)], COLS)
    mark = inc.high_water_mark(cur, "d", inc.DEFAULT_DATE_MARK)
    assert mark == D(2000, 2, 1)
    new = inc.newer_than(src, "d", mark)
    out = sorted(tuple(r) for r in inc.replace_by_key(cur, new, "k").collect())
    assert out == [("a", D(2000, 1, 1), 1), ("b", D(2000, 3, 1), 2), ("d", D(2000, 4, 1), 4)]
    late = sorted(r.k for r in inc.late_rows(src, cur, "d", mark, "k").collect())
    assert late == ["c"]


def test_empty_table_mark_defaults(spark):
    empty = spark.createDataFrame([], COLS)
    assert inc.high_water_mark(empty, "d", inc.DEFAULT_DATE_MARK) == inc.DEFAULT_DATE_MARK
    assert inc.high_water_mark(None, "d", inc.DEFAULT_DATE_MARK) == inc.DEFAULT_DATE_MARK


def test_versioned_table_rewrites_only_touched_partitions(spark, tmpdir_run):
    t = VersionedTable(spark, f"{tmpdir_run}/t", lambda: F.year("d"), marks=["d"])
    t.overwrite(spark.createDataFrame([("a", D(1999, 5, 1), 1), ("b", D(2000, 5, 1), 1),
                                       ("c", D(2001, 5, 1), 1)], COLS))
    # key b moves from 2000 to 2002; 2001 untouched
    new = spark.createDataFrame([("b", D(2002, 1, 1), 2), ("e", D(1999, 1, 1), 5)], COLS)
    v = t.upsert(new, "k", lambda cur, n: inc.replace_by_key(cur, n, "k"), batch_id=1, stream="s")
    assert v == 2
    got = sorted(tuple(r) for r in t.read().collect())
    assert got == [("a", D(1999, 5, 1), 1), ("b", D(2002, 1, 1), 2), ("c", D(2001, 5, 1), 1),
                   ("e", D(1999, 1, 1), 5)]
    locs = {p: loc for p, (loc, _) in t.manifest().parts.items()}
    assert "/v=1/" in locs["2001"] and "/v=2/" in locs["1999"] and "2000" not in locs
    assert t.mark("d") == D(2002, 1, 1)
    # replaying batch 1 of stream s changes nothing
    assert t.upsert(new, "k", lambda cur, n: inc.replace_by_key(cur, n, "k"), batch_id=1, stream="s") == 2


def test_marks_follow_replacements_and_streams_are_kept(spark, tmpdir_run):
    t = VersionedTable(spark, f"{tmpdir_run}/m", lambda: F.year("d"), marks=["d", "v"])
    t.overwrite(spark.createDataFrame([("a", D(2001, 5, 1), 1), ("b", D(2000, 1, 1), 7)], COLS),
                batch_id=3, stream="A")
    assert t.mark("d") == D(2001, 5, 1) and t.mark("v") == 7
    # the row holding the newest date moves back in time: the mark follows
    t.upsert(spark.createDataFrame([("a", D(1999, 1, 1), 2)], COLS), "k",
             lambda cur, n: inc.replace_by_key(cur, n, "k"), batch_id=0, stream="B")
    assert t.mark("d") == D(2000, 1, 1)
    assert t.last_batch_id("A") == 3 and t.last_batch_id("B") == 0
    v = t.version()
    assert t.upsert(spark.createDataFrame([("z", D(1999, 1, 1), 2)], COLS), "k",
                    lambda cur, n: inc.replace_by_key(cur, n, "k"), batch_id=3, stream="A") == v


def test_vacuum_keeps_live_versions(spark, tmpdir_run):
    t = VersionedTable(spark, f"{tmpdir_run}/vac", lambda: F.year("d"), marks=["d"])
    t.overwrite(spark.createDataFrame([("a", D(1999, 1, 1), 1), ("b", D(2000, 1, 1), 1)], COLS))
    for i in range(3):  # each rewrites only 2000
        t.upsert(spark.createDataFrame([("b", D(2000, 2, 1), i)], COLS), "k",
                 lambda cur, n: inc.replace_by_key(cur, n, "k"))
    before = sorted(map(tuple, t.read().collect()))
    deleted = t.vacuum(keep_versions=1)
    assert any("/data/v=2" in d for d in deleted) and not any("/data/v=1" in d for d in deleted)
    assert sorted(map(tuple, t.read().collect())) == before  # 1999 still lives in v=1


def test_refcounted_distinct_equals_rebuild(spark):
    from terrace.operators import refcount
    cols = ["a", "b"]
    schema = "k string, a string, b string"
    old = [("1", "x", None), ("2", "x", None), ("3", "y", "p"), ("4", None, None)]
    new = [("2", "z", None), ("3", "y", "p"), ("4", "w", "q"), ("5", None, None)]
    cur_rows = spark.createDataFrame(old, schema)
    inc_rows = spark.createDataFrame(new, schema)
    current = refcount.counts(cur_rows, cols)
    replaced = cur_rows.join(inc_rows.select("k"), "k", "left_semi")
    got = refcount.apply_delta(current, inc_rows, replaced, cols)
    final = inc.replace_by_key(cur_rows, inc_rows, "k")
    want = refcount.counts(final, cols)
    norm = lambda df: sorted((tuple(r) for r in df.select(*cols, refcount.COUNT).collect()), key=repr)
    assert norm(got) == norm(want)
