"""Outlier estimates where one pool holds most rows."""

import numpy as np
import pandas as pd
from loomstead.llm import robust_outliers
from loomstead.llm.common import cut


def pooled(spark):
    rng = np.random.default_rng(4)
    x = pd.DataFrame(rng.standard_normal((3000, 4)) * [0.2, 0.1, 0.3, 0.2], columns=robust_outliers.X)
    return cut(spark.createDataFrame(x.assign(pool=["hot" if k % 10 else f"p{k % 4}" for k in range(len(x))])))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_estimates_are_the_same_either_way(spark, monkeypatch):
    rows = pooled(spark)
    near = robust_outliers.mcd(rows, 3).toPandas().set_index("pool").sort_index()
    monkeypatch.setattr(robust_outliers, "BROADCAST_ROWS", 0)
    joined = robust_outliers.mcd(rows, 3).toPandas().set_index("pool").sort_index()
    pd.testing.assert_frame_equal(near, joined, rtol=1e-6)
    assert sorted(near.index) == ["hot", "p0", "p2"] and near.loc["hot", "n"] == 2700


def test_a_hot_pool_is_folded_before_it_is_moved(spark, monkeypatch):
    """Rows meet a model without an exchange by pool that the fold could reuse."""
    rows = pooled(spark)
    model = robust_outliers._starts(rows).drop("n")
    assert "Exchange hashpartitioning" not in plan_of(robust_outliers._scored(rows, model))
    monkeypatch.setattr(robust_outliers, "BROADCAST_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        folded = robust_outliers._scored(rows, model).groupBy("pool", "start").count()
        lines = [x.strip(" +-:") for x in plan_of(folded).splitlines() if "Exchange" in x or "Aggregate" in x or "Join" in x]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # From the result down: the final fold, its exchange, the partial fold, then the join.
    kinds = [next(k for k in ("Aggregate", "Exchange", "Join") if k in x) for x in lines]
    assert kinds[:4] == ["Aggregate", "Exchange", "Aggregate", "Join"], lines
