"""Plans of the wide reports: no row is copied per distinct count."""

import __spark_entry__ as entry_points
import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["curation_metrics", "sales_kpis", "geographic_sales", "daily_summary"])
def test_distinct_counts_do_not_expand(spark, name):
    plan = entry_points.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "CartesianProduct" not in plan
