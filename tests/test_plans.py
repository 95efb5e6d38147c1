"""Plans that have to hold at scale: what is broadcast, what is split, what survives."""

import os

import pytest
from pyspark.sql import functions as F

from shardleaf import plans
from shardleaf.operators import links, search, tree
from shardleaf.plans import broadcast_if_small, cut_lineage
from shardleaf.plans.bounds import is_small
from shardleaf.sources import extract_links, symbol_entries

from conftest import rows


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def big_data_rules(spark):
    """Make small data behave like big data: nothing is small enough to broadcast, skew shows early."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_links(spark, n=6000):
    """Half of all links go to one place; several files."""
    df = spark.range(0, n, 1, 6).select(
        F.col("id").alias("page_id"), F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id"))).alias("href")
    )
    return cut_lineage(df)



def test_only_small_frames_are_hinted(spark):
    small, big = spark.range(100), spark.range(100_000)
    assert is_small(small, 100) and not is_small(small, 99) and not is_small(small, 100, 50)
    assert broadcast_if_small(big, 1000) is big


def test_a_hot_tooltip_key_is_split(spark, big_data_rules):
    uses = hot_links(spark)
    defs = spark.createDataFrame([(1, "hot", "tip"), (2, "p1", "one")], "def_id int, name string, tip string")
    joined = links.tooltip_join(uses, defs)
    assert "skew=true" in final_plan(joined)
    assert joined.where("tip = 'tip'").count() == 3000 and joined.count() == 6000


def test_a_hot_dangling_url_is_split(spark, big_data_rules):
    resolved = hot_links(spark).withColumn("url", F.concat(F.lit("u/"), "href"))
    pages = spark.createDataFrame([("u/p1",), ("u/p3",)], "url string")
    left = links.dangling_links(resolved, pages)
    assert "skew=true" in final_plan(left) and left.count() == 5998


def test_a_hot_query_is_split(spark, big_data_rules, monkeypatch):
    monkeypatch.setattr(search, "MAX_ROWS", 0)
    monkeypatch.setattr(search, "broadcast_if_small", lambda df: df)
    asked = hot_links(spark).select(F.col("page_id").alias("qid"), F.col("href").alias("q"))
    entries = symbol_entries(spark.createDataFrame([("hot stuff",), ("p1",)], "label string"), "label", "label", F.lit(""), "s")
    counts = search.match_counts(cut_lineage(asked), entries)
    assert "skew=true" in final_plan(counts)
    assert counts.where("n_matches = 1").count() == 3001 and counts.count() == 6000


def test_a_hot_parent_is_split(spark, big_data_rules):
    rows_ = spark.range(0, 6000, 1, 6).select(
        F.when(F.col("id") % 2 == 0, F.concat(F.lit("row_0_"), "id", F.lit("_"))).otherwise(F.concat(F.lit("row_"), "id", F.lit("_"))).alias("id")
    )
    paths = cut_lineage(rows_.union(spark.createDataFrame([("row_0_",)], "id string")))
    children = tree.tree_children(tree.tree_paths(paths))
    assert "skew=true" in final_plan(children) and children.count() == 3000


def test_intermediate_tables_go_to_the_shared_folder(spark):
    root = plans.durable.checkpoint_root(spark)
    table = cut_lineage(spark.range(10))
    assert all(f.split(":", 1)[1].lstrip("/").startswith(root.split(":", 1)[-1].strip("/")) for f in table.inputFiles())
    assert rows(table) == rows(spark.range(10))


def test_scratch_tables_go_with_their_scope(spark, tmp_path):
    kept = cut_lineage(spark.range(3))
    with plans.scratch(spark):
        gone = cut_lineage(spark.range(5))
        files = [f.split(":", 1)[1] for f in gone.inputFiles()]
        gone.write.parquet(str(tmp_path / "out"))
        assert all(os.path.exists("/" + f.lstrip("/")) for f in files)
    assert not any(os.path.exists("/" + f.lstrip("/")) for f in files)
    assert kept.count() == 3 and spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_pages_are_read_by_column(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    plan = extract_links(pages).select("href")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<html:string>" in plan


def test_no_operator_uses_python_or_cross_joins(spark, sf):
    """Built-in expressions only, but for streaming state; no nested loop but the one-row reset table."""
    from shardleaf import workload

    for name, query in workload.queries().items():
        if name.endswith("_stream"):
            continue
        plan = query(spark, sf)._jdf.queryExecution().executedPlan().toString()
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
            assert word not in plan, (name, word)
