"""The shared folder and the intermediate tables in it."""

import os
import types

import pytest

from chatlog import session
from chatlog.operators import changes


def test_a_cluster_needs_a_shared_folder():
    context = types.SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    spark = types.SimpleNamespace(conf=types.SimpleNamespace(get=lambda key, default: default), sparkContext=context)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(spark)
    spark.conf.get = lambda key, default: "file:///shared/"
    assert session.shared_dir(spark) == "file:///shared"


def test_intermediate_tables_go(spark):
    with session.scratch(spark):
        df = session.settled(spark.range(10))
        inside = [f for f in os.listdir(session.shared_dir(spark)) if "-scratch-" in f]
        assert df.count() == 10 and inside
    assert not set(inside) & set(os.listdir(session.shared_dir(spark)))
    assert session.settled(spark.range(3)).count() == 3


def test_updates_of_absent_rows_do_nothing(spark):
    base = spark.createDataFrame([(1, "x")], "id long, alias string")
    log = spark.createDataFrame(
        [(1, 1, "delete", None), (1, 2, "update", "back"), (7, 1, "update", "ghost"), (8, 1, "update", "early"), (8, 2, "upsert", None), (8, 3, "update", "late"), (9, 5, "upsert", "new")],
        "id long, seq long, op string, alias string")
    assert sorted(map(tuple, changes.apply_changes(base, log, sets=["alias"]).collect())) == [(8, "late"), (9, "new")]
    assert changes.apply_changes(base, log, sets=["alias"], insert=False).count() == 0
    again = spark.createDataFrame([(1, 1, "update", "y"), (2, 1, "update", "z")], "id long, seq long, op string, alias string")
    assert [tuple(r) for r in changes.apply_changes(base, again, sets=["alias"]).collect()] == [(1, "y")]
