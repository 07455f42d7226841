"""Plan regressions: the physical plans keep the shape the design relies on."""

import re

import pytest

from tests.conftest import SF_SMALL
from tremor.operators import clean as C
from tremor.operators import stats, trends
from tremor.plans import catalog as K
from tremor.plans.catalog import QUERIES
from tremor.plans.explain import executed_nodes, nearest_parts, summarize
from tremor.sources import fixture



def final_plan(df) -> str:
    """Text of the plan that ran: the parts after the last adaptive change."""
    df._jdf.collectToPython()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=false" not in text.split("== Initial Plan ==")[0]
    return text.split("== Initial Plan ==")[0]


ML = {"rf_predict", "lr_predict", "dt_predict", "gbt_predict", "model_compare", "model_select", "prediction_table", "score_points",
      "lr_metrics", "lr_prediction_table", "lr_score_points", "stored_predictions", "stored_model", "stored_forest", "document_scan"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - ML))
def test_no_cross_join_no_python(spark, name):
    s = summarize(executed_nodes(QUERIES[name](spark, SF_SMALL)))
    assert s["nested_loop"] == 0, s
    geodesic = name in ("nearest_one", "nearest_batch", "nearest_text")
    assert s["python"] == int(geodesic), s


def test_nearest_search_has_no_cross_join(spark):
    parts = {name: summarize(executed_nodes(df)) for name, df in nearest_parts(spark, SF_SMALL).items()}
    assert parts["nearest: candidates"]["python"] == 1
    assert all(s["nested_loop"] == 0 for s in parts.values())
    assert parts["nearest: pairs"]["bhj"] + parts["nearest: pairs"]["smj"] == 1


def test_audit_sees_reuse_and_cross_joins(spark):
    fitted = executed_nodes(trends.trend_fitted(K.base(spark, SF_SMALL)))
    assert summarize(fitted)["scans"] == 2
    one = spark.range(3).crossJoin(spark.range(2))
    assert summarize(executed_nodes(one))["nested_loop"] == 1


def test_clean_parses_each_value_once(spark):
    plan = final_plan(C.clean(fixture.raw_catalog(spark, SF_SMALL)))
    # two layouts tried per value, once each: no re-evaluation in the null filter
    assert len(re.findall(r"gettimestamp\(", plan)) == 2


def test_one_row_subqueries_bound_once(spark):
    base = K.base(spark, SF_SMALL)
    assert summarize(executed_nodes(trends.depth_scaled(base)))["scans"] == 2
    assert summarize(executed_nodes(trends.trend_fitted(base)))["scans"] == 2


def test_yearly_stats_partial_aggregation_before_shuffle(spark):
    plan = final_plan(stats.yearly_stats(fixture.raw_catalog(spark, SF_SMALL)))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_count" in plan and "partial_max" in plan


def test_store_prunes_year_partitions(spark):
    df = trends.year_slice(K.curated(spark, SF_SMALL))
    plan = final_plan(df)
    assert re.search(r"PartitionFilters: \[[^\]]*Year", plan)
