import itertools
import os
import re
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from moorspark.plans.standin import prof
from moorspark.session import CLEANUP, GROWING, materialize, scratch, scratch_path


def test_scratch_tables_go_after_use(spark):
    kept = scratch_path(spark, "kept")
    spark.range(3).write.parquet(kept)
    with pytest.raises(ZeroDivisionError):
        with scratch(spark):
            d = materialize(spark.range(5), "gone")
            assert d.count() == 5
            path = d.inputFiles()[0].removeprefix("file://")
            assert os.path.exists(path)
            1 / 0
    assert not os.path.exists(os.path.dirname(path)) and spark.read.parquet(kept).count() == 3


def test_tasks_of_series_queries_do_not_grow_with_the_input(spark, monkeypatch):
    before = {k: spark.conf.get(k, None) for k in GROWING}
    seen = {}
    monkeypatch.setattr(entry, "_registered", lambda: ({n: lambda s, sf, n=n: seen.update({n: {k: s.conf.get(k, None) for k in GROWING}}) for n in ("l4_gradients", "pipeline")}, {}))
    for name in ("l4_gradients", "pipeline"):
        entry.queries()[name](spark, "")
    assert seen["l4_gradients"] == GROWING and seen["pipeline"] == {k: before[k] for k in GROWING}


def test_profiles_are_dealt_by_order_before_they_are_aggregated(spark):
    plan = prof(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    join = next(i for i, x in enumerate(lines) if "SortMergeJoin" in x)
    assert all("Exchange" not in x for x in lines[:join]) and all("HashAggregate" not in x for x in lines[join:])


@pytest.mark.parametrize("name", ["m6_interpolated_flags", "m6_merged_flags", "m2_merge_sites", "n3_absolute_salinity", "f6_rolling_mean", "l4_gradients"])
def test_tasks_of_a_query_on_profiles_hold_a_part_of_the_orders(spark, name):
    plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString().split("\n")
    assert not any("BroadcastHashJoin [l_orderkey" in x for x in plan)
    joins = [i for i, x in enumerate(plan) if "SortMergeJoin [l_orderkey" in x]
    assert joins
    for i in joins:
        depth = re.search(r"\w", plan[i]).start()
        below = list(itertools.takewhile(lambda x: re.search(r"\w|$", x).start() > depth, plan[i + 1:]))
        parts = GROWING["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]
        assert sum(f", {parts})" in x for x in below if "Exchange hashpartitioning" in x) == 2 and not any("Aggregate" in x for x in below)


def test_full_profiles_are_dealt_once_for_both_readers(spark):
    plan = entry.queries()["l10_full_profiles"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    dealt = [x for x in plan.split("\n") if "Exchange hashpartitioning" in x]
    assert len(dealt) == 2 and all(re.search(r"\(profile_id#\d+L, \d+\), REPARTITION_BY_COL", x) for x in dealt)
    scans = [re.sub(r"#\d+L?", "", x).split("FileScan")[1] for x in plan.split("\n") if "FileScan" in x]
    assert len(set(scans)) == 1 and "[profile_id,pres,temp,salt,time]" in scans[0]


def test_shuffles_of_a_stored_table_are_deleted(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return set(re.findall(r"shuffle_\w+\.data", disk.getAllFiles().mkString(",")))

    before = files()
    d = materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before
    assert sorted((r.k, r["count"]) for r in d.collect())[0] == (0, 143) and spark.conf.get(CLEANUP) == "false"
