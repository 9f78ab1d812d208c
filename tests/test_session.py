"""Session rules: the configured checkpoint folder is kept; ANSI and UTC are pinned."""

from tablesmith.session import REQUIRED_CONF, apply_required_conf, checkpoint_root, ensure_checkpoint_dir


def test_checkpoint_folder_is_not_replaced(spark):
    current = spark.sparkContext.getCheckpointDir()
    assert current
    assert ensure_checkpoint_dir(spark, fallback="/tmp/should-not-be-used") == current
    assert checkpoint_root(spark) == current


def test_required_settings_are_pinned(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        apply_required_conf(spark)
        for key, value in REQUIRED_CONF.items():
            assert spark.conf.get(key) == value
    finally:
        apply_required_conf(spark)
