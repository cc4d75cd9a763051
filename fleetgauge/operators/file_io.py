"""Database file I/O: latencies, the busiest files and their severity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge import fixed_values as fv
from fleetgauge.functions import text
from fleetgauge.functions.ranking import top_per
from fleetgauge.functions.shaping import SNAPSHOT, to_evidence, to_metrics
from fleetgauge.params import FileIoParams

CATEGORY = "DatabaseIO"
COUNTERS = [
    ("FileSizeMB", "MB"), ("FileSizeGB", "GB"), ("NumReads", "count"), ("NumWrites", "count"),
    ("TotalIO", "count"), ("BytesRead", "bytes"), ("BytesWritten", "bytes"), ("IoStallReadMs", "ms"),
    ("IoStallWriteMs", "ms"), ("IoStallTotalMs", "ms"), ("AvgReadLatencyMs", "ms"),
    ("AvgWriteLatencyMs", "ms"), ("AvgIoLatencyMs", "ms"),
]
# Databases up to this id belong to the server itself.
LAST_SYSTEM_DATABASE = 4


def _amount(column: Column) -> Column:
    return F.coalesce(column, F.lit(0)).cast("decimal(19,2)")


def _latency(stall: str, operations: str) -> Column:
    average = F.try_divide(F.col(stall), F.col(operations))
    return F.coalesce(average, F.lit(0)).cast("decimal(19,2)")


def file_stats(raw: DataFrame, databases: DataFrame) -> DataFrame:
    """Totals and average latencies of every file of an online user database."""
    user_databases = databases.filter(
        (F.col("database_id") > LAST_SYSTEM_DATABASE) & (F.col("state_desc") == "ONLINE")
        & F.col("source_database_id").isNull()
    ).select(*SNAPSHOT, "database_id", F.col("name").alias("DatabaseName"))
    c = F.col
    amounts = raw.filter(c("database_id") > LAST_SYSTEM_DATABASE).select(
        *SNAPSHOT, "database_id", "file_id",
        F.concat(F.lit("file_id_"), c("file_id").cast("string")).alias("LogicalFileName"),
        # File attributes the source does not report.
        F.lit("(unavailable)").alias("PhysicalName"), F.lit("(unknown)").alias("DriveLetter"),
        F.lit("UNKNOWN").alias("FileType"),
        _amount(F.lit(0)).alias("FileSizeMB"), _amount(F.lit(0)).alias("FileSizeGB"),
        _amount(c("num_of_reads")).alias("NumReads"), _amount(c("num_of_writes")).alias("NumWrites"),
        _amount(F.coalesce("num_of_reads", F.lit(0)) + F.coalesce("num_of_writes", F.lit(0))).alias("TotalIO"),
        _amount(c("num_of_bytes_read")).alias("BytesRead"), _amount(c("num_of_bytes_written")).alias("BytesWritten"),
        _amount(c("io_stall_read_ms")).alias("IoStallReadMs"), _amount(c("io_stall_write_ms")).alias("IoStallWriteMs"),
        _amount(c("io_stall")).alias("IoStallTotalMs"),
    )
    return (
        amounts.join(user_databases, [*SNAPSHOT, "database_id"])
        .withColumn("AvgReadLatencyMs", _latency("IoStallReadMs", "NumReads"))
        .withColumn("AvgWriteLatencyMs", _latency("IoStallWriteMs", "NumWrites"))
        .withColumn("AvgIoLatencyMs", _latency("IoStallTotalMs", "TotalIO"))
    )


def busiest_files(stats: DataFrame, params: FileIoParams = FileIoParams()) -> DataFrame:
    order = [F.col(c).desc() for c in ("TotalIO", "IoStallTotalMs", "AvgIoLatencyMs")]
    return top_per(stats.filter("TotalIO > 0"), SNAPSHOT, order, ["database_id", "file_id"], params.max_files)


def latency_severity(params: FileIoParams = FileIoParams()) -> Column:
    worst = F.greatest("AvgReadLatencyMs", "AvgWriteLatencyMs")
    return (
        F.when(worst >= params.critical_ms, "Critical").when(worst >= params.warning_ms, "Warning").otherwise("Info")
    )


def file_metrics(files: DataFrame) -> DataFrame:
    named = files.withColumn("DatabaseName", text.or_default(F.col("DatabaseName"), text.UNKNOWN))
    return to_metrics(
        named, COUNTERS, collector=fv.DATABASE_IO, category=CATEGORY, object_name="DatabaseFileIO",
        metric_type="Cumulative", database="DatabaseName", sub_instance="LogicalFileName",
    )


def file_evidence(files: DataFrame, params: FileIoParams = FileIoParams()) -> DataFrame:
    defaulted = {c: text.UNKNOWN for c in ("DatabaseName", "LogicalFileName", "PhysicalName", "DriveLetter")}
    shown = [
        "DatabaseName", "LogicalFileName", "PhysicalName", "DriveLetter", "FileType", "FileSizeGB", "TotalIO",
        "AvgReadLatencyMs", "AvgWriteLatencyMs", "AvgIoLatencyMs",
    ]
    body = text.details([(c, F.col(c), defaulted[c]) if c in defaulted else (c, F.col(c)) for c in shown])
    return to_evidence(
        files, collector=fv.DATABASE_IO, category=CATEGORY, detail_type=F.lit("DatabaseFileIODetail"),
        severity=latency_severity(params), body=body, value1=F.col("AvgIoLatencyMs"), value2=F.col("TotalIO"),
        database=text.or_default(F.col("DatabaseName"), text.UNKNOWN),
    )
