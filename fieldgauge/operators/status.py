"""Grading of readings against the thresholds of their zone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldgauge.config import METRICS, Metric
from fieldgauge.functions import expressions as X
from fieldgauge.operators.enrich import MATCHED


def grade(df: DataFrame, metrics: Sequence[Metric] = METRICS) -> DataFrame:
    """Add a status per metric, the number of abnormal ones, severity and overall status."""
    return (
        df.withColumns({m.status: X.metric_status(m) for m in metrics})
        .withColumn("anomaly_count", X.count_abnormal([m.status for m in metrics]))
        .withColumns(
            {
                "is_anomaly": F.col("anomaly_count") > 0,
                "severity": X.severity(MATCHED, "anomaly_count"),
                "overall_status": X.overall_status(MATCHED, "anomaly_count"),
            }
        )
    )
