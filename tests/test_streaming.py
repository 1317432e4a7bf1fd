"""Publish messages, drain them with the streaming consumer, replay safely."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from terrace.sinks.tables import VersionedTable
from terrace.sources import fixtures as fx
from terrace.streaming import ingest, messages


def test_publish_consume_upsert(spark, tmpdir_run):
    raw = fx.raw_ppd(spark, SF_SMALL)
    text = messages.to_file_text(raw)
    msgs = f"{tmpdir_run}/msgs"
    ingest.publish(text.where(F.col("transaction_id").cast("int") % 2 == 0), fx.FIXTURE_INGESTED_AT,
                   "full", folder=msgs)
    ingest.consume(spark, f"{tmpdir_run}/bronze", "full", folder=msgs)
    table = VersionedTable(spark, f"{tmpdir_run}/bronze")
    assert table.read().count() == raw.where(F.col("transaction_id").cast("int") % 2 == 0).count()
    # second run: every row again (duplicates of the first half) -> upsert
    ingest.publish(text, fx.FIXTURE_INGESTED_AT, "incremental", folder=msgs)
    v = ingest.consume(spark, f"{tmpdir_run}/bronze", "incremental", folder=msgs)
    got = table.read()
    assert got.count() == got.select("transaction_id").distinct().count() == raw.count()
    want = raw.withColumn("_source_mode", F.lit("incremental")).select(*got.columns)
    assert got.exceptAll(want).count() == 0
    # draining again finds nothing new; the table version stays
    assert ingest.consume(spark, f"{tmpdir_run}/bronze", "incremental", folder=msgs) == v


def test_messages_without_an_id_are_set_aside(spark, tmpdir_run):
    msgs = f"{tmpdir_run}/msgs"
    spark.createDataFrame([('{"transaction_id": "x1", "price": "1"}',), ('{"price": "2"}',), ("not json",)],
                          "value string").coalesce(1).write.text(msgs)
    ingest.consume(spark, f"{tmpdir_run}/bronze", "incremental", folder=msgs)
    assert [r.transaction_id for r in VersionedTable(spark, f"{tmpdir_run}/bronze").read().collect()] == ["x1"]
    assert ingest.rejected(spark, f"{tmpdir_run}/bronze") == 2
    assert ingest.rejected(spark, f"{tmpdir_run}/none") == 0


def test_a_full_run_empties_the_table_once(spark, tmpdir_run):
    import datetime as dt
    msgs, bronze, run = f"{tmpdir_run}/msgs", f"{tmpdir_run}/bronze", dt.datetime(2026, 1, 1)
    put = lambda *ids: spark.createDataFrame([('{"transaction_id": "%s"}' % i,) for i in ids],
                                             "value string").write.mode("append").text(msgs)
    ids = lambda: sorted(r.transaction_id for r in VersionedTable(spark, bronze).read().collect())
    put("a", "b")
    ingest.consume(spark, bronze, "full", folder=msgs, run_id=run)
    put("c")
    ingest.consume(spark, bronze, "full", folder=msgs, run_id=run)  # the same run, repeated
    assert ids() == ["a", "b", "c"]
    put("d")
    ingest.consume(spark, bronze, "full", folder=msgs, run_id=run + dt.timedelta(days=1))
    assert ids() == ["d"]


def test_decode_absent_and_bad_fields(spark):
    df = spark.createDataFrame([
        ('{"transaction_id": "x1", "price": "12.5", "transfer_date": "2024-02-03 00:00", '
         '"new_build": "TRUE", "_ingested_at": "2026-01-01T00:00:00"}',),
        ('{"transaction_id": "x2", "transfer_date": "bad", "_ingested_at": "2026-01-01T00:00:00.5"}',),
    ], "value string")
    rows = {r.transaction_id: r for r in messages.decode(df).collect()}
    assert str(rows["x1"].price) == "12.50" and rows["x1"].new_build is True
    assert rows["x2"].transfer_date is None and rows["x2"].postcode is None and rows["x2"].new_build is None
    assert rows["x2"]._ingested_at.microsecond == 500000


def test_each_message_is_parsed_once_and_a_replay_reads_none(spark, tmpdir_run):
    """Rows that a batch reads from its source, counted; rejects, merge and
    a replayed batch read the source no further time."""
    values = [('{"transaction_id": "x%d", "price": "1", "transfer_date": "2024-02-03 00:00"}' % i,) for i in range(20)]
    values += [("not json",), ('{"price": "2"}',)]
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for part in batches:
            seen.add(part.num_rows)
            yield part

    source = spark.createDataFrame(values, "value string").mapInArrow(count, "value string").withColumn("_src", F.lit("0"))
    table = VersionedTable(spark, f"{tmpdir_run}/bronze", cluster_by=["transaction_id"])
    first = ingest.merge_batch(table, source, 0, "s")
    assert seen.value == 22
    assert ingest.merge_batch(table, source, 0, "s") == first and seen.value == 22
    assert ingest.merge_batch(table, source, 1, "s") == first + 1 and seen.value == 44
    assert sorted(r.transaction_id for r in table.read().collect()) == sorted(f"x{i}" for i in range(20))
    assert ingest.rejected(spark, table.path) == 4
    assert table._children(f"{table.path}/_incoming") == []
