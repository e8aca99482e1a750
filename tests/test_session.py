"""The checkpoint folder is the session's own; recommended settings apply."""

from possum.plans.session import RECOMMENDED_CONF, checkpoint_dir


def test_checkpoint_dir_comes_from_the_session(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    got = checkpoint_dir(spark)
    assert got
    if configured:
        assert configured.rstrip("/").split(":")[-1] in got
    assert checkpoint_dir(spark) == got   # stable


def test_recommended_settings_are_applied(spark):
    for k, v in RECOMMENDED_CONF.items():
        if k.startswith("spark.sql."):
            assert spark.conf.get(k) == v
