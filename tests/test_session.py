"""Shared-folder handling: the session's spark.checkpoint.dir is used."""

from quarry.session import checkpoint_dir, scratch_path


def test_checkpoint_dir_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    got = checkpoint_dir(spark)
    assert configured and configured.rstrip("/").split(":")[-1] in got
    p = scratch_path(spark, "x")
    assert p.startswith(got.rstrip("/")) and p != scratch_path(spark, "x")
