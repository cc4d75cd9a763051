"""The inventory of monitored instances: scans, registration, state changes and listing.

The inventory is never joined with a broadcast hint: Spark broadcasts it while it is under
``spark.sql.autoBroadcastJoinThreshold`` and shuffles it beyond that.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetgauge import fixed_values as fv
from fleetgauge.functions.text import name_key
from fleetgauge.functions.timing import ntz
from fleetgauge.sources import tables
from fleetgauge.sources.versions import Snapshot

_TABLE = "MonitoredInstances"
_REGISTERED = ["EnvironmentName", "CollectionProfile", "ComplianceProfile", "SqlVersion", "Edition", "Notes"]
_COLUMNS = ["InstanceId", "InstanceName", "EnvironmentName", "IsEnabled", "CollectionProfile", "ComplianceProfile",
            "SqlVersion", "Edition", "Notes", "CreatedAt", "ModifiedAt"]


def enabled_instances(instances: DataFrame) -> DataFrame:
    return instances.filter("IsEnabled").select("InstanceId", "InstanceName").orderBy("InstanceName")


def enabled_profiles(instances: DataFrame) -> DataFrame:
    """Enabled instances with their compliance profile, the simple one where none is set."""
    profile = F.col("ComplianceProfile")
    effective = F.when(F.trim(profile) != "", profile).otherwise(fv.SIMPLE_PROFILE)
    return (
        instances.filter("IsEnabled")
        .select("InstanceId", "InstanceName", effective.alias("ComplianceProfile"))
        .orderBy("InstanceName")
    )


def capture_roster(instances: DataFrame, captured_at: datetime) -> DataFrame:
    """The snapshots of one collection cycle: every enabled instance at the cycle's capture time."""
    return instances.filter("IsEnabled").select("InstanceId", ntz(captured_at).alias("CaptureTime"))


def with_default_column(df: DataFrame, name: str, default: str) -> DataFrame:
    """Read data written before a column existed: add it with its default, and fill gaps with the default."""
    present = F.col(name) if name in df.columns else F.lit(None).cast("string")
    return df.withColumn(name, F.coalesce(present, F.lit(default)))


def list_instances(instances: DataFrame, status: str = "All") -> DataFrame:
    conditions = {"All": F.lit(True), "Enabled": F.col("IsEnabled"), "Disabled": ~F.col("IsEnabled")}
    return instances.filter(conditions[status]).select(*_COLUMNS).orderBy("EnvironmentName", "InstanceName")


def _named_once(rows: DataFrame) -> DataFrame:
    """The rows with what their name is compared by in ``_name``; a name that occurs twice is an error."""
    keyed = rows.withColumn("_name", name_key(F.col("InstanceName")))
    count = F.count(F.lit(1)).over(Window.partitionBy("_name"))
    repeated = F.raise_error(F.concat(F.lit("name occurs more than once: "), F.col("_name")))
    return keyed.withColumn("_name", F.when(count > 1, repeated).otherwise(F.col("_name")))


def register(instances: DataFrame, registrations: DataFrame, now: datetime) -> DataFrame:
    """The new inventory after an upsert by name; a name that ``registrations`` hold twice is an error.

    A known instance takes the registered values, is enabled and stamped, and keeps its id and
    creation time.  A new one gets the next ids.
    """
    checked = _check_profiles(_named_once(registrations))
    updates = checked.drop("InstanceName").withColumnsRenamed({c: f"_{c}" for c in _REGISTERED}).withColumn(
        "_registered", F.lit(True))
    found = F.col("_registered").isNotNull()
    known = instances.withColumn("_name", name_key(F.col("InstanceName"))).join(updates, "_name", "left").select(
        "InstanceId", "InstanceName",
        *(F.when(found, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in _REGISTERED),
        (found | F.col("IsEnabled")).alias("IsEnabled"),
        "CreatedAt", F.when(found, ntz(now)).otherwise(F.col("ModifiedAt")).alias("ModifiedAt"),
    )
    return known.select(*_COLUMNS).unionByName(_new_instances(instances, checked, now, ntz(now)))


def seed(instances: DataFrame, seeds: DataFrame, now: datetime) -> DataFrame:
    """The inventory with the seeds that were absent; known instances stay as they are."""
    added = _new_instances(instances, _check_profiles(_named_once(seeds)), now, F.lit(None).cast("timestamp_ntz"))
    return instances.select(*_COLUMNS).unionByName(added)


def _check_profiles(registrations: DataFrame) -> DataFrame:
    profile = F.col("ComplianceProfile")
    allowed = profile.isin(fv.SIMPLE_PROFILE, fv.FULL_PROFILE)
    problem = F.raise_error(F.concat(F.lit("not a compliance profile: "), F.coalesce(profile, F.lit("NULL"))))
    return registrations.withColumn("ComplianceProfile", F.when(allowed, profile).otherwise(problem))


def _new_instances(instances: DataFrame, registrations: DataFrame, now: datetime, modified: Column) -> DataFrame:
    """Absent names, numbered after the highest id without moving all of them to one task.

    Names are spread over 256 buckets by hash; a bucket starts where the ones before it end.
    """
    known = instances.select(name_key(F.col("InstanceName")).alias("_name"))
    absent = registrations.join(known, "_name", "left_anti").withColumn(
        "_bucket", F.substring(F.md5("InstanceName"), 1, 2)
    )
    highest = instances.agg(F.lit("").alias("_bucket"), F.coalesce(F.max("InstanceId"), F.lit(0)).alias("_n"))
    sizes = absent.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")).unionByName(highest)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # 256 buckets and the row with the highest id: small enough for one task and for a broadcast.
    starts = sizes.withColumn("_start", F.sum("_n").over(before)).filter("_bucket <> ''").drop("_n")
    position = F.row_number().over(Window.partitionBy("_bucket").orderBy("InstanceName"))
    return absent.join(F.broadcast(starts), "_bucket").select(
        (F.col("_start") + position).cast("int").alias("InstanceId"), "InstanceName", "EnvironmentName",
        F.lit(True).alias("IsEnabled"), "CollectionProfile", "ComplianceProfile", "SqlVersion", "Edition", "Notes",
        ntz(now).alias("CreatedAt"), modified.alias("ModifiedAt"),
    )


def unknown_names(instances: DataFrame, changes: DataFrame) -> DataFrame:
    known = instances.select(name_key(F.col("InstanceName")).alias("_name"))
    return changes.withColumn("_name", name_key(F.col("InstanceName"))).join(known, "_name", "left_anti").select("InstanceName")


def set_state(instances: DataFrame, changes: DataFrame, now: datetime) -> DataFrame:
    """The inventory after enabling and disabling; a name that is not registered, or given twice, is an error."""
    changed, reason, notes = F.col("State").isNotNull(), F.col("Reason"), F.col("Notes")
    appended = (
        F.when(F.coalesce(reason, F.lit("")) == "", notes)
        .when(F.coalesce(notes, F.lit("")) == "", reason)
        .otherwise(F.concat(notes, F.lit(" | "), reason))
    )
    unknown = F.raise_error(F.concat(F.lit("instance is not registered: "), F.col("_name")))
    known = instances.withColumn("_name", name_key(F.col("InstanceName")))
    return (
        known.join(_named_once(changes).select("_name", "State", "Reason"), "_name", "full")
        .withColumns({
            "InstanceId": F.when(F.col("InstanceId").isNull(), unknown).otherwise(F.col("InstanceId")),
            "IsEnabled": F.when(changed, F.col("State") == "Enable").otherwise(F.col("IsEnabled")),
            "ModifiedAt": F.when(changed, ntz(now)).otherwise(F.col("ModifiedAt")),
            "Notes": F.when(changed, appended).otherwise(notes),
        })
        .select(*_COLUMNS)
    )


# --- The stored inventory ------------------------------------------------------------------------


def stored_instances(spark: SparkSession, path: str) -> DataFrame:
    return tables.read_table(spark, path, _TABLE)


def store_registration(spark: SparkSession, path: str, registrations: DataFrame, now: datetime) -> Snapshot:
    """Register in the stored inventory.  The new version is computed from the newest one and published only if that still
    is the newest; otherwise it is computed again, so of two writers neither loses a name or numbers one twice."""
    return _store(spark, path, lambda instances: register(instances, registrations, now))


def store_seeds(spark: SparkSession, path: str, seeds: DataFrame, now: datetime) -> Snapshot:
    return _store(spark, path, lambda instances: seed(instances, seeds, now))


def store_state(spark: SparkSession, path: str, changes: DataFrame, now: datetime) -> Snapshot:
    """Enable and disable in the stored inventory; an unknown name is an error and nothing is stored."""
    return _store(spark, path, lambda instances: set_state(instances, changes, now))


def _store(spark: SparkSession, path: str, change: Callable[[DataFrame], DataFrame]) -> Snapshot:
    schema = tables.schema_of(_TABLE)
    return tables.open_table(spark, path, _TABLE).replace_all(lambda base: change(base.read(schema)))
