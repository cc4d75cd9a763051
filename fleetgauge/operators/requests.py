"""Active requests: summary, expensive requests, attribution by four keys and repeated statements.

Statement texts are wide.  Summaries, groupings and choices run on rows without them; the chosen rows fetch theirs, and
the base set is given each statement's text by its signature, so that a text travels once per statement and task at most.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge import fixed_values as fv
from fleetgauge.functions import text
from fleetgauge.functions.ranking import rank_per, top_per
from fleetgauge.functions.shaping import SNAPSHOT, to_evidence, to_metrics
from fleetgauge.params import MonitorIdentity, RequestParams

CATEGORY = "ActiveRequest"
MEASURES = ["wait_time", "blocking_session_id", "cpu_time", "total_elapsed_time", "logical_reads", "reads", "writes",
            "percent_complete"]
SUMMARY = [
    ("ActiveRequestCount", "count"), ("LongRunningRequestCount", "count"), ("HighCpuRequestCount", "count"),
    ("HighLogicalReadRequestCount", "count"), ("HighPhysicalReadRequestCount", "count"),
    ("HighWriteRequestCount", "count"), ("WaitingRequestCount", "count"), ("BlockedRequestCount", "count"),
    ("MaxElapsedSeconds", "sec"), ("TotalCpuMs", "ms"), ("TotalLogicalReads", "count"),
    ("TotalPhysicalReads", "count"), ("TotalWrites", "count"),
]
ATTRIBUTIONS = ("Database", "Host", "Program", "Login")
TOTALS = {
    "TotalCpuMs": "cpu_time", "TotalElapsedMs": "total_elapsed_time", "TotalLogicalReads": "logical_reads",
    "TotalReads": "reads", "TotalWrites": "writes",
}


def foreign_sessions(sessions: DataFrame, monitor: MonitorIdentity = MonitorIdentity()) -> DataFrame:
    """User sessions that are not the monitoring's own."""
    program = F.lower(F.coalesce("program_name", F.lit("")))
    others = [~program.contains(p.lower()) for p in monitor.programs]
    if monitor.login is not None:
        others.append(text.name_key(F.coalesce("login_name", F.lit(""))) != text.name_key(F.lit(monitor.login)))
    return sessions.filter(reduce(and_, others, F.col("is_user_process"))).select(
        *SNAPSHOT, "session_id", F.col("login_name").alias("LoginName"), F.col("host_name").alias("HostName"),
        F.col("program_name").alias("ProgramName"),
    )


def active_requests(
    requests: DataFrame, sessions: DataFrame, params: RequestParams = RequestParams(), *, statements: bool = True,
) -> DataFrame:
    """The base set: requests of foreign user sessions, measures defaulted to zero, signature and statement.

    The signature is that of the whole statement; ``max_text_length`` only cuts what is shown.  Without ``statements`` the
    rows have no SqlText.
    """
    flat = text.one_line(F.col("sql_text"), None)
    narrow = requests.select(
        *SNAPSHOT, "session_id", "request_id", F.col("database_name").alias("DatabaseName"), "status", "command", "wait_type",
        *(F.coalesce(m, F.lit(0)).alias(m) for m in MEASURES),
        F.col("sql_text").isNotNull().alias("HasStatement"), text.signature(flat).alias("QuerySignature"),
    )
    base = narrow.join(foreign_sessions(sessions, params.monitor), [*SNAPSHOT, "session_id"])
    if not statements:
        return base
    whole = requests.select(flat.alias("_whole")).filter(F.col("_whole").isNotNull()).distinct()
    shown = F.col("_whole") if params.max_text_length is None else F.substring("_whole", 1, params.max_text_length)
    texts = whole.select(text.signature(F.col("_whole")).alias("_signed"), shown.alias("SqlText"))
    # Requests without a statement match nothing; their own keys spread them over the tasks.
    key = F.coalesce("QuerySignature", F.concat(F.lit("-"), F.xxhash64("session_id", "request_id").cast("string")))
    return _with_text(base.withColumn("_key", key).join(texts, F.col("_key") == F.col("_signed"), "left").drop("_key", "_signed"))


def _with_text(rows: DataFrame) -> DataFrame:
    """SqlText beside the signature."""
    names = [c for c in rows.columns if c != "SqlText"]
    at = names.index("QuerySignature") + 1
    return rows.select(*names[:at], "SqlText", *names[at:])


def request_summary(base: DataFrame, roster: DataFrame, params: RequestParams = RequestParams()) -> DataFrame:
    """Counts over thresholds and totals; every snapshot of the roster has a row."""
    c = F.col
    totals = base.groupBy(*SNAPSHOT).agg(
        F.count(F.lit(1)).alias("ActiveRequestCount"),
        F.count_if(c("total_elapsed_time") >= params.elapsed_ms).alias("LongRunningRequestCount"),
        F.count_if(c("cpu_time") >= params.cpu_ms).alias("HighCpuRequestCount"),
        F.count_if(c("logical_reads") >= params.logical_reads).alias("HighLogicalReadRequestCount"),
        F.count_if(c("reads") >= params.physical_reads).alias("HighPhysicalReadRequestCount"),
        F.count_if(c("writes") >= params.writes).alias("HighWriteRequestCount"),
        F.count_if((c("wait_time") >= params.wait_ms) | c("wait_type").isNotNull()).alias("WaitingRequestCount"),
        F.count_if(c("blocking_session_id") != 0).alias("BlockedRequestCount"),
        F.max("total_elapsed_time").alias("_elapsed"),
        F.sum("cpu_time").alias("TotalCpuMs"), F.sum("logical_reads").alias("TotalLogicalReads"),
        F.sum("reads").alias("TotalPhysicalReads"), F.sum("writes").alias("TotalWrites"),
    )
    seconds = (c("_elapsed").cast("decimal(18,2)") / 1000).cast("decimal(25,8)")
    filled = roster.join(totals, SNAPSHOT, "left").fillna(0)
    return filled.select(
        *SNAPSHOT, *(seconds.alias(n) if n == "MaxElapsedSeconds" else c(n) for n, _ in SUMMARY),
    )


def is_expensive(params: RequestParams = RequestParams()) -> Column:
    limits = {
        "total_elapsed_time": params.elapsed_ms, "cpu_time": params.cpu_ms, "logical_reads": params.logical_reads,
        "reads": params.physical_reads, "writes": params.writes, "wait_time": params.wait_ms,
    }
    over = [F.col(m) >= limit for m, limit in limits.items()]
    return reduce(or_, over, F.col("blocking_session_id") != 0)


def expensive_requests(
    base: DataFrame, params: RequestParams = RequestParams(), requests: DataFrame | None = None,
) -> DataFrame:
    """The requests over any threshold, the most costly ones of each snapshot first.

    For a base without SqlText, ``requests`` are what the chosen ones' statements are fetched from.
    """
    order = [F.col(c).desc() for c in ("cpu_time", "total_elapsed_time", "logical_reads", "wait_time")]
    costly = base.filter(is_expensive(params)).drop("HasStatement")
    top = top_per(costly, SNAPSHOT, order, ["session_id", "request_id"], params.max_requests)
    if requests is None:
        return top
    # At most max_requests rows a snapshot are sent to the texts, instead of all texts to them.
    key, whole = [*SNAPSHOT, "session_id"], text.one_line(F.col("sql_text"), None)
    texts = requests.select(*key, F.col("request_id").alias("_request"), "sql_text")
    found = F.broadcast(top).join(texts, key).filter(F.col("request_id").eqNullSafe(F.col("_request"))).withColumns({
        "_same": text.signature(whole).eqNullSafe(F.col("QuerySignature")),
        "SqlText": text.one_line(F.col("sql_text"), params.max_text_length),
    })
    # Keys may repeat: each chosen request, told by its rank, takes the statement its signature is of.
    own = rank_per(found, [*SNAPSHOT, "rn"], [F.col("_same").desc()], "_n").filter("_n = 1")
    return _with_text(own.select(*top.columns, "SqlText"))


def request_attribution(
    base: DataFrame, kinds: tuple[str, ...] = ATTRIBUTIONS, params: RequestParams = RequestParams(),
) -> DataFrame:
    """Totals by database, host, program and login, from one pre-aggregated pass.  Spellings of a name that differ in case or
    blanks at the end are one group, shown by the first of them."""
    sources = {"Database": "DatabaseName", "Host": "HostName", "Program": "ProgramName", "Login": "LoginName"}
    combinations = base.groupBy(*SNAPSHOT, *sources.values(), "wait_type").agg(
        F.count(F.lit(1)).alias("_requests"),
        F.count_if(F.col("blocking_session_id") != 0).alias("_blocked"),
        *(F.sum(column).alias(column) for column in TOTALS.values()),
    )
    shown = {k: F.when(F.rtrim(sources[k]) != "", F.col(sources[k])).otherwise(text.UNKNOWN) for k in kinds}
    labels = F.inline(F.array(*[
        F.struct(F.lit(f"ActiveRequestBy{k}").alias("DetailType"), text.name_key(name).alias("GroupKey"), name.alias("GroupValue"))
        for k, name in shown.items()
    ]))
    labelled, key = combinations.select("*", labels), [*SNAPSHOT, "DetailType", "GroupKey"]
    groups = labelled.groupBy(*key).agg(
        F.sum("_requests").alias("ActiveRequestCount"),
        *(F.sum(column).alias(name) for name, column in TOTALS.items()),
        F.sum("_blocked").alias("BlockedRequestCount"),
    )
    order = [F.col(c).desc() for c in ("TotalCpuMs", "TotalElapsedMs", "TotalLogicalReads")]
    top = top_per(groups, [*SNAPSHOT, "DetailType"], order, ["GroupKey"], params.max_attribution_rows)
    # Text maxima need a sort, so only the chosen groups get samples.
    samples = labelled.join(top.select(*key), key, "left_semi").groupBy(*key).agg(
        F.min("GroupValue").alias("GroupValue"), F.max("wait_type").alias("SampleWaitType"),
        F.max("DatabaseName").alias("SampleDatabaseName"),
        F.max("HostName").alias("SampleHostName"),
        F.max("ProgramName").alias("SampleProgramName"),
    )
    return top.join(samples, key).drop("GroupKey")


def repeated_requests(base: DataFrame, requests: DataFrame, params: RequestParams = RequestParams()) -> DataFrame:
    """Statements that more than one request of a snapshot runs, the most frequent first."""
    # Asking the flag, not the signature, keeps the hash from being computed a second time for the filter.
    groups = (
        base.filter("HasStatement")
        .groupBy(*SNAPSHOT, "QuerySignature")
        .agg(
            F.count(F.lit(1)).alias("ActiveRequestCount"),
            *(F.sum(column).alias(name) for name, column in TOTALS.items()),
            F.max("DatabaseName").alias("SampleDatabaseName"), F.max("LoginName").alias("SampleLoginName"),
            F.max("HostName").alias("SampleHostName"), F.max("ProgramName").alias("SampleProgramName"),
            F.min(F.struct("session_id", "request_id")).alias("_first"),
        )
        .filter("ActiveRequestCount > 1")
    )
    order = [F.col(c).desc() for c in ("ActiveRequestCount", "TotalCpuMs", "TotalElapsedMs")]
    top = top_per(groups, SNAPSHOT, order, ["QuerySignature"], params.max_repeated_rows)
    # The statement of one request of each chosen group; session and request identify it.
    key = [*SNAPSHOT, "session_id", "request_id"]
    sampled = top.select("*", "_first.*").drop("_first")
    shown = text.one_line(F.col("sql_text"), params.max_text_length).alias("SampleSqlText")
    texts = requests.filter(F.col("sql_text").isNotNull()).select(*key, shown)
    # At most max_repeated_rows a snapshot are sent to the texts, instead of all texts to them.
    return F.broadcast(sampled).join(texts, key).drop("session_id", "request_id")


def request_metrics(summary: DataFrame) -> DataFrame:
    return to_metrics(
        summary, SUMMARY, collector=fv.ACTIVE_REQUESTS, category=CATEGORY, object_name="ActiveRequestSummary",
    )


def expensive_evidence(expensive: DataFrame) -> DataFrame:
    c = F.col
    body = text.details([
        ("DetailType", F.lit("ActiveRequestDetail")), ("SessionId", c("session_id")),
        ("DatabaseName", c("DatabaseName"), text.UNKNOWN), ("LoginName", c("LoginName"), text.UNKNOWN),
        ("HostName", c("HostName"), text.UNKNOWN), ("ProgramName", c("ProgramName"), text.UNKNOWN),
        ("Status", c("status"), text.UNKNOWN), ("Command", c("command"), text.UNKNOWN),
        ("WaitType", c("wait_type"), text.NONE),
        ("WaitSeconds", text.plain_number(c("wait_time").cast("decimal(20,3)") / 1000, 3)),
        ("BlockingSessionId", c("blocking_session_id")), ("CpuTimeMs", c("cpu_time")),
        ("ElapsedTimeMs", c("total_elapsed_time")), ("LogicalReads", c("logical_reads")), ("Reads", c("reads")),
        ("Writes", c("writes")), ("PercentComplete", text.plain_number(c("percent_complete"), 6)),
        ("QuerySignature", c("QuerySignature"), text.NONE), ("SQL text", c("SqlText"), text.UNAVAILABLE),
    ])
    return to_evidence(
        expensive, collector=fv.ACTIVE_REQUESTS, category=CATEGORY, detail_type=F.lit("ActiveRequestDetail"),
        severity=F.lit("Warning"), body=body, value1=c("total_elapsed_time").cast("decimal(25,6)") / 1000,
        value2=c("cpu_time"), database=text.or_default(c("DatabaseName"), text.UNKNOWN),
    )


def attribution_evidence(attribution: DataFrame) -> DataFrame:
    plain = ["DetailType", "GroupValue", "ActiveRequestCount", *TOTALS, "BlockedRequestCount"]
    samples = {"SampleWaitType": text.NONE, "SampleDatabaseName": text.UNKNOWN, "SampleHostName": text.UNKNOWN,
               "SampleProgramName": text.UNKNOWN}
    groups = attribution.withColumn("GroupValue", text.or_default(F.col("GroupValue"), text.UNKNOWN))
    body = text.details([*((p, F.col(p)) for p in plain), *((s, F.col(s), d) for s, d in samples.items())])
    return to_evidence(
        groups, collector=fv.ACTIVE_REQUESTS, category=CATEGORY, detail_type=F.col("DetailType"),
        severity=F.lit("Info"), body=body, value1=F.col("TotalCpuMs"), value2=F.col("TotalElapsedMs"),
    )


def repeated_evidence(repeated: DataFrame) -> DataFrame:
    samples = ["SampleDatabaseName", "SampleLoginName", "SampleHostName", "SampleProgramName"]
    body = text.details([
        ("DetailType", F.lit("RepeatedActiveQuery")), ("QuerySignature", F.col("QuerySignature"), text.NONE),
        ("ActiveRequestCount", F.col("ActiveRequestCount")), *((t, F.col(t)) for t in TOTALS),
        *((s, F.col(s), text.UNKNOWN) for s in samples), ("SQL text", F.col("SampleSqlText"), text.UNAVAILABLE),
    ])
    return to_evidence(
        repeated, collector=fv.ACTIVE_REQUESTS, category=CATEGORY, detail_type=F.lit("RepeatedActiveQuery"),
        severity=F.lit("Warning"), body=body, value1=F.col("TotalCpuMs"), value2=F.col("ActiveRequestCount"),
        database=text.or_default(F.col("SampleDatabaseName"), text.UNKNOWN),
    )
