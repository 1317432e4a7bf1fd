import datetime as dt

from terrace.operators import quality as Q


def test_checks_find_failures(spark):
    silver = spark.createDataFrame(
        [("1", "D", None), ("1", "X", "p"), (None, "Y", "q"), ("2", None, "r")],
        "transaction_id string, property_type string, raw_postcode string")
    u = Q.unique_summary(silver, "s", "transaction_id").first()
    assert u.failures == 1
    nn = {r.column_name: r.failures for r in
          Q.not_null_summary(silver, "s", [("transaction_id", "error"), ("raw_postcode", "warn")]).collect()}
    assert nn == {"transaction_id": 1, "raw_postcode": 1}
    acc = Q.accepted_summary(silver, "s", "property_type", ["D", "S"]).first()
    assert acc.failures == 2  # distinct bad values X, Y; NULL is not a failure


def test_price_and_rowcount(spark):
    fact = spark.createDataFrame([("a", 1.0), ("b", 0.0), ("c", None), ("d", -3.0)],
                                 "transaction_id string, price double")
    assert sorted(r.transaction_id for r in Q.price_failures(fact).collect()) == ["b", "c", "d"]
    assert Q.min_rows_failure(fact, 5).count() == 1
    assert Q.min_rows_failure(fact, 4).count() == 0


def test_freshness_and_gate(spark):
    fact = spark.createDataFrame([(20260101,)], "date_key int")
    assert Q.freshness_failure(fact, dt.date(2026, 2, 9)).count() == 0
    assert Q.freshness_failure(fact, dt.date(2026, 2, 11)).count() == 1
    m6 = Q.metric_freshness(fact, dt.date(2026, 2, 11)).first()
    assert (m6.metric_value, m6.passed) == (41.0, False)
    # A sale beyond the calendar is the newest all the same; no sale is no failure.
    late = spark.createDataFrame([(20010101,), (20350601,)], "date_key int")
    assert Q.freshness_failure(late, dt.date(2026, 2, 11)).count() == 0
    assert Q.metric_freshness(late, dt.date(2035, 6, 3)).first().metric_value == 2.0
    assert Q.freshness_failure(fact.limit(0), dt.date(2026, 2, 11)).count() == 0
    rep = spark.createDataFrame([("m", "c", "unique", "error", 0), ("m", "c", "not_null", "warn", 3)],
                                Q.SUMMARY)
    assert len(Q.gate(rep)) == 2
    bad = spark.createDataFrame([("m", "c", "unique", "error", 1)], Q.SUMMARY)
    try:
        Q.gate(bad)
        raise AssertionError("gate should fail")
    except Q.QualityGateError:
        pass


def test_source_freshness_levels(spark):
    raw = spark.createDataFrame([(dt.datetime(2026, 1, 1),)], "_ingested_at timestamp")
    lv = lambda d: Q.source_freshness(raw, dt.datetime(2026, 1, 1) + dt.timedelta(days=d)).first().status  # noqa
    assert (lv(10), lv(36), lv(41)) == ("pass", "warn", "error")
