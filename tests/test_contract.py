"""Every registered query against its SQL on the smallest tables, and its shape at scale."""

import __spark_entry__ as contract
import pytest
from loomstead.operators import fact_reads, fact_writes
from loomstead.plans import collections, facts, inputs
from loomstead.schemas import ENTITY_SCHEMA, TRIPLE_SCHEMA
from loomstead.session import nothing, written
from oracle import connect, difference
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
OWN = sorted(collections.QUERIES | facts.QUERIES)


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", OWN)
def test_against_sql(spark, duck, name):
    assert difference(duck, contract.oracle_sql()[name], contract.queries()[name](spark, FOLDER)) is None


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", OWN)
def test_no_cross_join_and_no_global_window(spark, name):
    plan = plan_of(contract.queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan  # no row-at-a-time Python
    assert "Window" not in plan or "row_number() windowspecdefinition(query_id" in plan


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    t = inputs.Tables(spark, FOLDER)
    inputs.triples(t).write.parquet(str(tmp_path / "t"))
    stored = spark.read.schema(TRIPLE_SCHEMA).parquet(str(tmp_path / "t"))
    plan = plan_of(fact_reads.query_entity(inputs.entities(t), stored, "Customer#000000007", "2000-06-01"))
    scan = next(x for x in plan.splitlines() if "FileScan" in x and "predicate" in x)
    assert "EqualTo(subject,customer#000000007)" in scan and "extracted_at" not in scan
    plan = plan_of(fact_reads.timeline(inputs.entities(t), stored))
    assert str(tmp_path) not in plan  # the facts were read once, by the top-n


def test_skewed_key_is_split(spark):
    """A third of the facts share one key: the join puts them on several tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.shuffle.partitions": "16",
    }
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id")))
    batch = written(
        spark.range(0, 60_000, 1, 8).select(
            F.col("id").alias("seq"), key.alias("subject"), F.lit("p").alias("predicate"), F.lit("o").alias("object"),
            F.sha2(F.col("id").cast("string"), 512).alias("source_closet"),
            F.when(F.col("id") >= 30, "2025-02-01").alias("valid_to"),
        )
    )
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        out = fact_writes.add_facts(nothing(spark, ENTITY_SCHEMA), nothing(spark, TRIPLE_SCHEMA), batch, inputs.BATCH_TS)
        done = out.triples
        assert len(done.collect()) == 40_001
        assert "skew=true" in plan_of(done)
        ends = batch.select("seq", "subject", "predicate", "object", F.lit("2025-03-01").alias("ended"))
        closed = fact_writes.invalidate(written(done), ends).triples
        assert closed.filter("valid_to IS NULL").count() == 0
    finally:
        for name in settings:
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_hot_key_is_folded_on_the_map_side(spark):
    batch = inputs.purchases(inputs.Tables(spark, FOLDER))
    plan = plan_of(fact_writes.judged(nothing(spark, TRIPLE_SCHEMA), batch, "x"))
    assert "partial_min(seq" in plan and "Window" not in plan and "collect_" not in plan
