"""Wait statistics: the largest non-idle wait types per snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge import fixed_values as fv
from fleetgauge.functions.ranking import top_per
from fleetgauge.functions.shaping import SNAPSHOT, to_metrics
from fleetgauge.params import WaitParams

COUNTERS = [
    ("WaitingTasksCount", "count"), ("WaitTimeMs", "ms"), ("SignalWaitTimeMs", "ms"),
    ("ResourceWaitTimeMs", "ms"), ("MaxWaitTimeMs", "ms"),
]


def waits(raw: DataFrame) -> DataFrame:
    """All waits that are not benign; what the time series stores."""
    return raw.filter(~F.col("wait_type").isin(fv.BENIGN_WAITS) & (F.col("wait_time_ms") > 0)).select(
        *SNAPSHOT,
        F.col("wait_type").alias("WaitType"),
        F.col("waiting_tasks_count").alias("WaitingTasksCount"),
        F.col("wait_time_ms").alias("WaitTimeMs"),
        F.col("signal_wait_time_ms").alias("SignalWaitTimeMs"),
        (F.col("wait_time_ms") - F.col("signal_wait_time_ms")).alias("ResourceWaitTimeMs"),
        F.col("max_wait_time_ms").alias("MaxWaitTimeMs"),
    )


def wait_snapshot(raw: DataFrame, params: WaitParams = WaitParams()) -> DataFrame:
    """The waits of each snapshot with the longest times."""
    return top_per(waits(raw), SNAPSHOT, [F.col("WaitTimeMs").desc()], ["WaitType"], params.max_types)


def wait_metrics(found: DataFrame) -> DataFrame:
    return to_metrics(
        found, COUNTERS, collector=fv.WAIT_STATS, category="WaitStats", object_name="SQLWaitStats",
        metric_type="Cumulative", sub_instance="WaitType",
    )
