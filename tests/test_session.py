from terrace.session import DEFAULT_CONF, checkpoint_dir, stream_checkpoint


def test_checkpoint_dir_comes_from_the_session(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    path = checkpoint_dir(spark)
    if configured:
        assert path == configured
    assert checkpoint_dir(spark) == path  # stable within a session


def test_stream_checkpoints_are_scoped_by_target(spark):
    a = stream_checkpoint(spark, "/w1/raw/ppd", "s")
    b = stream_checkpoint(spark, "/w2/raw/ppd", "s")
    assert a != b and a.startswith(checkpoint_dir(spark)) and a.endswith("/s")
    assert stream_checkpoint(spark, "/w1/raw/ppd/", "s") == a


def test_defaults_keep_ui_off_and_adaptive_on():
    assert DEFAULT_CONF["spark.ui.enabled"] == "false"
    assert DEFAULT_CONF["spark.sql.adaptive.enabled"] == "true"
    assert DEFAULT_CONF["spark.sql.adaptive.skewJoin.enabled"] == "true"
