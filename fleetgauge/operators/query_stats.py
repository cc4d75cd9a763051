"""Query statistics: top statements by four rankings, deduplicated, enriched and summarised."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge import fixed_values as fv
from fleetgauge.functions import text
from fleetgauge.functions.ranking import newest_per, rank_per, top_per
from fleetgauge.functions.shaping import SNAPSHOT, to_evidence, to_metrics
from fleetgauge.functions.timing import now_or
from fleetgauge.params import QueryStatsParams

# Rankings in report order, each with the measure it ranks by and its summary counter.
RANKINGS = {
    "CPU": ("total_worker_time", "TopCpuQueryCount"),
    "Duration": ("total_elapsed_time", "TopDurationQueryCount"),
    "LogicalReads": ("total_logical_reads", "TopLogicalReadQueryCount"),
    "Executions": ("execution_count", "TopExecutionQueryCount"),
}
# Fixed value: stands for a missing hash when statements are compared.
ZERO_HASH = "0x0000000000000000"
SUMMARY = [*((counter, "count") for _, counter in RANKINGS.values()), ("DistinctQueriesCaptured", "count")]


def candidates(
    stats: DataFrame, categories: tuple[str, ...] = tuple(RANKINGS), as_of: datetime | None = None,
    params: QueryStatsParams = QueryStatsParams(),
) -> DataFrame:
    """The top statements of each snapshot by each ranking, all rankings in one pass."""
    earliest = now_or(as_of) - F.expr(f"INTERVAL '{params.lookback_minutes}' MINUTE")
    recent = stats.filter(
        (F.col("last_execution_time") >= earliest) & (F.col("execution_count") >= params.min_executions)
    )
    ranked = F.inline(F.array(*[
        F.struct(F.lit(c).alias("RankingCategory"), F.col(RANKINGS[c][0]).alias("_measure")) for c in categories
    ]))
    top = top_per(
        recent.select("*", ranked), [*SNAPSHOT, "RankingCategory"], [F.col("_measure").desc()],
        ["plan_handle", "sql_handle"], params.top_n,
    )
    return top.drop("_measure")


def deduplicate(chosen: DataFrame) -> DataFrame:
    """One row per ranking and statement hash pair, the most expensive one."""
    keys = [*SNAPSHOT, "RankingCategory", *(F.coalesce(h, F.lit(ZERO_HASH)) for h in ("query_hash", "query_plan_hash"))]
    order = [F.col(c).desc() for c in ("total_worker_time", "total_elapsed_time", "last_execution_time")]
    order += [F.col("plan_handle").asc(), F.col("sql_handle").asc()]
    return newest_per(chosen.drop("rn"), keys, order).drop("rn")


def _ratio(amount: str, by: str, scale: int = 1) -> Column:
    exact = F.col(amount).cast("decimal(20,0)")
    return F.try_divide(exact, (F.col(by) * scale).cast("decimal(20,0)")).cast("decimal(19,2)")


def enrich(chosen: DataFrame, texts: DataFrame) -> DataFrame:
    """Add the statement text and convert microseconds to milliseconds, totals and averages."""
    per_execution = {
        "LogicalReads": "total_logical_reads", "PhysicalReads": "total_physical_reads", "Writes": "total_logical_writes",
    }
    milli = {"Cpu": "total_worker_time", "Elapsed": "total_elapsed_time"}
    columns = []
    for name, source in milli.items():
        total = (F.col(source).cast("decimal(20,0)") / 1000).cast("decimal(19,2)")
        columns += [total.alias(f"Total{name}Ms"), _ratio(source, "execution_count", 1000).alias(f"Avg{name}Ms")]
    for name, source in per_execution.items():
        columns += [F.col(source).cast("decimal(19,2)").alias(f"Total{name}"),
                    _ratio(source, "execution_count").alias(f"Avg{name}")]
    return chosen.join(texts.select("sql_handle", F.col("sql_text").alias("RawSqlText")), "sql_handle").select(
        *SNAPSHOT, "RankingCategory", F.col("database_name").alias("DatabaseName"),
        F.col("query_hash").alias("QueryHash"), F.col("query_plan_hash").alias("QueryPlanHash"),
        "execution_count", "creation_time", "last_execution_time", *columns, "plan_handle", "RawSqlText",
    )


def without_monitor_statements(enriched: DataFrame, params: QueryStatsParams = QueryStatsParams()) -> DataFrame:
    """Drop the monitoring's own statements, judged on the whole text, and bring the rest on one line."""
    raw = F.col("RawSqlText")
    for pattern in params.monitor.statements:
        enriched = enriched.filter(~raw.like(f"%{pattern}%"))
    return enriched.withColumn("SqlText", text.one_line(raw, params.max_text_length)).drop("RawSqlText")


def query_details(
    stats: DataFrame, texts: DataFrame, as_of: datetime | None = None, params: QueryStatsParams = QueryStatsParams(),
) -> DataFrame:
    """The whole chain from statistics to the kept statements."""
    chosen = deduplicate(candidates(stats, as_of=as_of, params=params))
    return without_monitor_statements(enrich(chosen, texts), params)


def query_summary(kept: DataFrame, roster: DataFrame) -> DataFrame:
    pair = F.concat(F.coalesce("QueryHash", F.lit("")), F.lit(":"), F.coalesce("QueryPlanHash", F.lit("")))
    totals = kept.groupBy(*SNAPSHOT).agg(
        *(F.count_if(F.col("RankingCategory") == c).alias(counter) for c, (_, counter) in RANKINGS.items()),
        F.countDistinct(pair).alias("DistinctQueriesCaptured"),
    )
    return roster.join(totals, SNAPSHOT, "left").fillna(0)


def detail_order(kept: DataFrame) -> DataFrame:
    """Number the kept statements of each snapshot in report order."""
    rank = F.lit(len(RANKINGS) + 1)
    for position, name in reversed(list(enumerate(RANKINGS, 1))):
        rank = F.when(F.col("RankingCategory") == name, position).otherwise(rank)
    order = [rank.asc(), *(F.col(c).desc() for c in ("TotalCpuMs", "TotalElapsedMs", "TotalLogicalReads"))]
    # A snapshot holds at most four times top_n statements here, so the window stays small.
    return rank_per(kept, SNAPSHOT, [*order, F.col("plan_handle").asc()])


def query_metrics(summary: DataFrame) -> DataFrame:
    return to_metrics(
        summary, SUMMARY, collector=fv.QUERY_STATS, category="QueryStats", object_name="QueryStatsSummary",
    )


def query_evidence(kept: DataFrame) -> DataFrame:
    c = F.col
    measures = ["TotalCpuMs", "AvgCpuMs", "TotalElapsedMs", "AvgElapsedMs", "TotalLogicalReads", "AvgLogicalReads",
                "TotalPhysicalReads", "AvgPhysicalReads", "TotalWrites", "AvgWrites"]
    body = text.details([
        ("RankingCategory", c("RankingCategory"), text.UNKNOWN), ("DatabaseName", c("DatabaseName"), text.UNKNOWN),
        ("QueryHash", c("QueryHash")), ("QueryPlanHash", c("QueryPlanHash")),
        ("CreationTime", text.moment_text(c("creation_time"))),
        ("LastExecutionTime", text.moment_text(c("last_execution_time"))),
        ("ExecutionCount", c("execution_count")), *((m, c(m)) for m in measures),
        ("SQL text", c("SqlText"), text.UNAVAILABLE),
    ])
    return to_evidence(
        kept, collector=fv.QUERY_STATS, category="QueryStats", detail_type=F.lit("QueryStatsDetail"),
        severity=F.lit("Info"), body=body, value1=c("AvgCpuMs"), value2=c("AvgElapsedMs"),
        database=text.or_default(c("DatabaseName"), text.UNKNOWN),
    )
