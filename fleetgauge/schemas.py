"""Explicit schemas of the core tables, the landing tables and the given test tables.

All times are zone-free (``timestamp_ntz``): the captured systems report local wall-clock values.
"""

from __future__ import annotations


def _schema(text: str) -> str:
    """DDL text on one line, accepted by ``spark.read.schema`` before any session exists."""
    return " ".join(text.split())


_SNAPSHOT = "InstanceId int, CaptureTime timestamp_ntz, "

MONITORED_INSTANCES = _schema("""
    InstanceId int, InstanceName string, EnvironmentName string, IsEnabled boolean, CollectionProfile string,
    ComplianceProfile string, SqlVersion string, Edition string, Notes string,
    CreatedAt timestamp_ntz, ModifiedAt timestamp_ntz""")

COLLECTION_RUN_HISTORY = _schema("""
    CollectionRunId bigint, CollectorName string, InstanceId int, StartedAt timestamp_ntz,
    FinishedAt timestamp_ntz, Status string, RowsCollected int, DurationMs int, ErrorMessage string,
    CreatedAt timestamp_ntz""")

COLLECTION_RUN_EVENT = _schema("""
    CollectionRunId bigint, EventType string, EventTime timestamp_ntz, CollectorName string, InstanceId int,
    Status string, RowsCollected int, ErrorMessage string""")

METRIC_SNAPSHOT = _schema("""
    MetricSnapshotId bigint, InstanceId int, CaptureTime timestamp_ntz, DatabaseName string, ObjectName string,
    CounterName string, InstanceName string, MetricCategory string, MetricValue decimal(28,6),
    MetricType string, Unit string, SourceCollector string, CreatedAt timestamp_ntz, capture_date date""")

METRIC_TEXT_SNAPSHOT = _schema("""
    MetricTextSnapshotId bigint, InstanceId int, CaptureTime timestamp_ntz, DatabaseName string,
    MetricCategory string, DetailType string, Severity string, NumericValue1 decimal(28,6),
    NumericValue2 decimal(28,6), Details string, XmlDetails string, SourceCollector string,
    CreatedAt timestamp_ntz, capture_date date""")

ANOMALY_EVENTS = _schema("""
    AnomalyEventId bigint, InstanceId int, DatabaseName string, MetricCategory string, CounterName string,
    Severity string, CurrentValue decimal(28,6), BaselineValue decimal(28,6), ThresholdValue decimal(28,6),
    ConfidenceScore decimal(5,2), Details string, DetectedAt timestamp_ntz, IsAcknowledged boolean,
    AcknowledgedAt timestamp_ntz, AcknowledgedBy string""")

CORE_TABLES = {
    "monitored_instances": MONITORED_INSTANCES,
    "collection_run_history": COLLECTION_RUN_HISTORY,
    "metric_snapshot": METRIC_SNAPSHOT,
    "metric_text_snapshot": METRIC_TEXT_SNAPSHOT,
    "anomaly_events": ANOMALY_EVENTS,
}

LANDING_TABLES = {
    name: _schema(_SNAPSHOT + columns)
    for name, columns in {
        "raw_counters": "object_name string, counter_name string, instance_name string, cntr_value bigint, cntr_type int",
        "raw_ring_buffer": "ring_buffer_type string, ts bigint, record string",
        "raw_sessions": """session_id bigint, login_name string, host_name string, program_name string,
            database_id int, database_name string, is_user_process boolean""",
        "raw_requests": """session_id bigint, request_id int, blocking_session_id bigint, database_name string, status string,
            command string, wait_type string, wait_time bigint, cpu_time bigint, total_elapsed_time bigint,
            logical_reads bigint, reads bigint, writes bigint, percent_complete double, sql_text string""",
        "raw_waits": """wait_type string, waiting_tasks_count bigint, wait_time_ms bigint,
            signal_wait_time_ms bigint, max_wait_time_ms bigint""",
        "raw_file_io": """database_id int, file_id int, num_of_reads bigint, num_of_writes bigint,
            num_of_bytes_read bigint, num_of_bytes_written bigint, io_stall_read_ms bigint,
            io_stall_write_ms bigint, io_stall bigint""",
        "raw_databases": """database_id int, name string, state_desc string, recovery_model_desc string,
            source_database_id int""",
        "raw_query_stats": """sql_handle bigint, plan_handle bigint, query_hash string, query_plan_hash string,
            database_name string, execution_count bigint, total_worker_time bigint, total_elapsed_time bigint,
            total_logical_reads bigint, total_physical_reads bigint, total_logical_writes bigint,
            creation_time timestamp_ntz, last_execution_time timestamp_ntz""",
        "raw_query_text": "sql_handle bigint, sql_text string",
        "raw_backupset": """database_name string, type string, backup_start_date timestamp_ntz,
            backup_finish_date timestamp_ntz, backup_size bigint, compressed_backup_size bigint,
            media_set_id bigint""",
        "raw_backupmedia": "media_set_id bigint, physical_device_name string",
        "raw_jobs": "job_id bigint, name string, enabled int",
        "raw_job_history": """instance_id bigint, job_id bigint, step_id int, step_name string, run_status int,
            run_date int, run_time int, run_duration int, message string""",
        "raw_job_activity": """job_id bigint, session_id bigint, start_execution_date timestamp_ntz,
            stop_execution_date timestamp_ntz""",
        "raw_agent_sessions": "session_id bigint",
        "raw_alerts": """id bigint, name string, enabled int, message_id int, severity int, database_name string,
            event_description_keyword string, delay_between_responses int, last_occurrence_date int,
            last_occurrence_time int, last_response_date int, last_response_time int, occurrence_count int,
            count_reset_date int, count_reset_time int""",
        "raw_notifications": "alert_id bigint, operator_id bigint, notification_method int",
        "raw_operators": "id bigint, name string",
    }.items()
}

GIVEN_TABLES = {
    name: _schema(columns)
    for name, columns in {
        "region": "r_regionkey int, r_name string",
        "nation": "n_nationkey int, n_name string, n_regionkey int",
        "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
        "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
        "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
        "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
            o_orderdate timestamp_ntz, o_orderpriority string""",
        "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
            l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,
            l_shipdate timestamp_ntz""",
        "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
        "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    }.items()
}
