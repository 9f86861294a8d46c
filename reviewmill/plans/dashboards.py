"""Export of the dashboard tables as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewmill.operators.dashboards import (
    business_insights,
    category_days,
    daily_volume,
    data_quality,
)
from reviewmill.session import path_exists, written
from reviewmill.sinks.tables import write_csv
from reviewmill.sources.tables import (
    model_rows,
    read_model_metrics,
    read_scaling,
    read_silver,
)

# Names of the exported tables.
DATA_QUALITY = "dashboard1_data_quality.csv"
DAILY_VOLUME = "dashboard1_daily_volume.csv"
MODEL_PERFORMANCE = "dashboard2_model_performance.csv"
BUSINESS_INSIGHTS = "dashboard3_business_insights.csv"
SCALABILITY = "dashboard4_scalability.csv"


def export_dashboards(
    spark: SparkSession, silver_path: str, metrics_path: str, scaling_path: str, out: str,
    arrived: DataFrame | None = None,
) -> list[str]:
    """Write all tables and return their paths; the scaling table only where there is one.

    Volume and insights come from one roll-up, which is stored and then read for each. The quality
    table counts the reviews as they ``arrived``, before validation set the incomplete ones aside;
    without them it can only count those that were stored.
    """
    silver = read_silver(spark, silver_path)
    days = written(category_days(silver), "category-days")
    tables = {
        DATA_QUALITY: data_quality(silver if arrived is None else arrived),
        DAILY_VOLUME: daily_volume(days),
        MODEL_PERFORMANCE: model_rows(read_model_metrics(spark, metrics_path)),
        BUSINESS_INSIGHTS: business_insights(days),
    }
    if path_exists(spark, scaling_path):
        tables[SCALABILITY] = read_scaling(spark, scaling_path)
    for name, table in tables.items():
        write_csv(table, f"{out}/{name}")
    return [f"{out}/{name}" for name in tables]
