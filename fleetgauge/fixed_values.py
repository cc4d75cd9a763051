"""Names and lists that are part of the data model: stored values that readers filter on."""

# Collector names as stored in SourceCollector.
PERFORMANCE_COUNTERS = "Collect-PerformanceCounters"
CONNECTIONS = "Collect-Connections"
BLOCKING = "Collect-Blocking"
WAIT_STATS = "Collect-WaitStats"
DATABASE_IO = "Collect-DatabaseIO"
ACTIVE_REQUESTS = "Collect-ActiveRequests"
QUERY_STATS = "Collect-QueryStats"
BACKUPS = "Collect-Backups"
AGENT_JOBS = "Collect-SqlAgentJobs"
AGENT_ALERTS = "Collect-SqlAgentAlerts"

# Compliance profiles.
SIMPLE_PROFILE = "V1_SIMPLE"
FULL_PROFILE = "V2_FULL"

# Run states counted as success, and as failure.
SUCCESS_STATES = ["Success", "Succeeded", "Completed"]
FAILURE_STATES = ["Failed", "Error"]

# Performance counters that are captured.
CAPTURED_COUNTERS = [
    "Batch Requests/sec", "SQL Compilations/sec", "SQL Re-Compilations/sec", "User Connections",
    "Logins/sec", "Logouts/sec", "Lock Waits/sec", "Number of Deadlocks/sec", "Page reads/sec",
    "Page writes/sec", "Lazy Writes/sec", "Checkpoint pages/sec", "Memory Grants Pending",
    "Target Server Memory (KB)", "Total Server Memory (KB)", "Page life expectancy",
]

# Captured counters that are gauges; the others accumulate.
GAUGE_COUNTERS = [
    "User Connections", "Memory Grants Pending", "Target Server Memory (KB)", "Total Server Memory (KB)",
    "Page life expectancy",
]

# Wait types that mean idling and are left out of wait snapshots.
BENIGN_WAITS = [
    "BROKER_EVENTHANDLER", "BROKER_RECEIVE_WAITFOR", "BROKER_TASK_STOP", "BROKER_TO_FLUSH", "BROKER_TRANSMITTER",
    "CHECKPOINT_QUEUE", "CHKPT", "CLR_AUTO_EVENT", "CLR_MANUAL_EVENT", "CLR_SEMAPHORE", "DBMIRROR_DBM_EVENT",
    "DBMIRROR_EVENTS_QUEUE", "DBMIRROR_WORKER_QUEUE", "DIRTY_PAGE_POLL", "DISPATCHER_QUEUE_SEMAPHORE", "EXECSYNC",
    "FSAGENT", "FT_IFTS_SCHEDULER_IDLE_WAIT", "FT_IFTSHC_MUTEX", "HADR_CLUSAPI_CALL",
    "HADR_FILESTREAM_IOMGR_IOCOMPLETION", "HADR_LOGCAPTURE_WAIT", "HADR_NOTIFICATION_DEQUEUE", "HADR_TIMER_TASK",
    "HADR_WORK_QUEUE", "KSOURCE_WAKEUP", "LAZYWRITER_SLEEP", "LOGMGR_QUEUE", "MEMORY_ALLOCATION_EXT",
    "ONDEMAND_TASK_QUEUE", "PARALLEL_REDO_DRAIN_WORKER", "PARALLEL_REDO_LOG_CACHE", "PARALLEL_REDO_TRAN_LIST",
    "PARALLEL_REDO_WORKER_SYNC", "PARALLEL_REDO_WORKER_WAIT_WORK", "PREEMPTIVE_OS_FLUSHFILEBUFFERS",
    "PREEMPTIVE_XE_GETTARGETSTATE", "PWAIT_ALL_COMPONENTS_INITIALIZED", "PWAIT_DIRECTLOGCONSUMER_GETNEXT",
    "QDS_PERSIST_TASK_MAIN_LOOP_SLEEP", "QDS_ASYNC_QUEUE", "QDS_CLEANUP_STALE_QUERIES_TASK_MAIN_LOOP_SLEEP",
    "REQUEST_FOR_DEADLOCK_SEARCH", "RESOURCE_QUEUE", "SERVER_IDLE_CHECK", "SLEEP_BPOOL_FLUSH", "SLEEP_DBSTARTUP",
    "SLEEP_DCOMSTARTUP", "SLEEP_MASTERDBREADY", "SLEEP_MASTERMDREADY", "SLEEP_MASTERUPGRADED", "SLEEP_MSDBSTARTUP",
    "SLEEP_SYSTEMTASK", "SLEEP_TASK", "SLEEP_TEMPDBSTARTUP", "SNI_HTTP_ACCEPT", "SP_SERVER_DIAGNOSTICS_SLEEP",
    "SQLTRACE_BUFFER_FLUSH", "SQLTRACE_INCREMENTAL_FLUSH_SLEEP", "SQLTRACE_WAIT_ENTRIES", "WAIT_FOR_RESULTS",
    "WAITFOR", "WAITFOR_TASKSHUTDOWN", "XE_DISPATCHER_JOIN", "XE_DISPATCHER_WAIT", "XE_TIMER_EVENT",
]

# Wait classes, in the order that decides ties for the dominant class.
# Each class is (name, exact wait types, wait type prefix).
WAIT_CLASSES = [
    ("Locking", [], "LCK_"),
    ("IO", ["PAGEIOLATCH_SH", "PAGEIOLATCH_EX", "PAGEIOLATCH_UP", "IO_COMPLETION", "ASYNC_IO_COMPLETION"], None),
    ("Parallelism", ["CXPACKET", "CXCONSUMER"], None),
    ("Memory", ["RESOURCE_SEMAPHORE", "CMEMTHREAD"], None),
    ("CPU", ["SOS_SCHEDULER_YIELD", "THREADPOOL"], None),
    ("LogIO", [], "WRITELOG"),
]

# Message numbers that make an alert critical.
CRITICAL_MESSAGES = [823, 824, 825, 9001, 17053]

# Programs the monitoring itself runs under, and texts of its own statements.
MONITOR_PROGRAMS = ["dbatools", "PowerShell"]
MONITOR_STATEMENTS = ["MetricSnapshot", "MetricTextSnapshot", "CollectionRunHistory", "sys.dm_exec_query_stats"]
