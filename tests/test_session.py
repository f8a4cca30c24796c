import os

from orderloom.session import clear_scratch, materialize, scratch_path, scratch_root
from orderloom.sources.tables import Lake


def test_nothing_is_left_behind(spark, monkeypatch, tmp_path):
    """Staged files and scratch databases go together when the scratch folder is cleared."""
    import orderloom.session as session

    own = str(tmp_path / "own")
    monkeypatch.setattr(session, "scratch_root", lambda _: own)
    kept = materialize(spark.range(5))
    assert kept.count() == 5
    Lake(spark, "gone_").create(scratch_path(spark, "lake"))
    before = {d.name for d in spark.catalog.listDatabases()}
    assert any(name.startswith("gone_") for name in before)
    clear_scratch(spark)
    assert not any(d.name.startswith("gone_") for d in spark.catalog.listDatabases())
    assert not os.path.exists(own)


def test_scratch_is_the_shared_folder(spark):
    assert scratch_root(spark).startswith(spark.sparkContext.getConf().get("spark.checkpoint.dir"))
