"""Shared tables: where they lie and when they go."""

import os
from types import SimpleNamespace

import pytest

from rasterloom.llm import common


def test_a_cluster_without_a_shared_folder_is_an_error():
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        session = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=context)
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            common.shared_dir(session)


def test_tables_are_removed(spark):
    mark = common.tables_made()
    path = lambda df: df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    made = [common.as_table(spark.range(3).coalesce(1), "t") for _ in range(3)]
    folders = [path(m) for m in made]
    assert all(map(os.path.isdir, folders)) and common.tables_made() == mark + 3
    common.remove_tables(mark, but_last=True)
    assert [os.path.isdir(f) for f in folders] == [False, False, True] and made[2].count() == 3
    common.remove_tables(mark)
    assert not os.path.isdir(folders[2]) and common.tables_made() == mark
