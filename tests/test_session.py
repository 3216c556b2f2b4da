"""Session rules: checkpoint folder from the session; ledger top-k ordering."""

from __future__ import annotations

from datetime import datetime
from types import SimpleNamespace

import pytest

from postline.session import PLAN_CONF, SEMANTIC_CONF, Scratch, configure, ensure_checkpoint_dir
from postline.sources import ledger


def test_checkpoint_dir_is_read_not_replaced(spark):
    first = ensure_checkpoint_dir(spark)
    assert first
    assert ensure_checkpoint_dir(spark) == first      # an existing folder is kept


@pytest.mark.parametrize("master", ["local-cluster[2,1,1024]", "yarn", "spark://host:7077"])
def test_no_machine_local_folder_on_a_cluster(master):
    unset = SimpleNamespace(get=lambda *_: None)
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, getConf=lambda: unset)
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=context, conf=unset))


def test_configure_leaves_the_deployments_sizes_alone(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    assert key in PLAN_CONF
    old = spark.conf.get(key)
    spark.conf.set(key, "12345")
    try:
        configure(spark)
        assert spark.conf.get(key) == "12345"
    finally:
        spark.conf.set(key, old)


def test_scratch_copies_go_at_the_end(spark):
    import os
    with Scratch(spark) as scratch:
        copy = scratch.cut(spark.range(4), "four")
        path = copy.inputFiles()[0].replace("file://", "")
        assert copy.count() == 4 and os.path.exists(path)
    assert not os.path.exists(path)


def test_configure_sets_semantic_confs(spark):
    configure(spark)
    for key, value in SEMANTIC_CONF.items():
        assert spark.conf.get(key) == value


def test_latest_runs_puts_unfinished_first(spark):
    rows = [("a", datetime(2024, 1, 1)), ("b", None), ("c", datetime(2024, 3, 1)), ("d", datetime(2024, 3, 1))]
    df = spark.createDataFrame(rows, "file_md5 string, finished_at timestamp")
    got = [r.file_md5 for r in ledger.latest_runs(df, 3).collect()]
    assert got == ["b", "c", "d"]
