from types import SimpleNamespace

import pytest

from churnlens.session import ensure_checkpoint_dir, pin_time_zone


def fake(master, existing=None, shared=None):
    chosen = [existing]
    context = SimpleNamespace(
        master=master, getCheckpointDir=lambda: chosen[0], setCheckpointDir=lambda d: chosen.__setitem__(0, d)
    )
    conf = SimpleNamespace(get=lambda key, default: {"spark.checkpoint.dir": shared}.get(key) or default)
    return SimpleNamespace(sparkContext=context, conf=conf), lambda: chosen[0]


def test_folder_of_the_cluster_is_used():
    session, folder = fake("spark://host:7077", shared="s3a://bucket/tmp")
    ensure_checkpoint_dir(session)
    assert folder() == "s3a://bucket/tmp"


def test_folder_that_is_set_stays():
    session, folder = fake("local[2]", existing="/already", shared="/other")
    ensure_checkpoint_dir(session)
    assert folder() == "/already"


def test_only_a_local_session_gets_its_own_folder():
    session, folder = fake("local[2]")
    ensure_checkpoint_dir(session)
    assert "churnlens-checkpoint-" in folder()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(fake("yarn")[0])


def test_time_zone_is_pinned(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert pin_time_zone(spark).conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
