"""What the operators share: shared scratch space, stored intermediate tables, input columns, batches."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Words are runs of anything but the six ASCII blanks; ``bytes.split()`` splits at the same six.
WORD = r"[^\x20\x09-\x0D]+"
# Arrow batches are cut by size as well as by rows, so that very long texts do not pile up in a worker.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


_OWN: dict[str, str] = {}  # application -> folder of a local session that names none


def shared_folder(spark: SparkSession) -> str:
    """The folder ``spark.checkpoint.dir`` names; a session of one local process without one gets its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    master, application = spark.sparkContext.master, spark.sparkContext.applicationId
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if application not in _OWN:
        _OWN[application] = tempfile.mkdtemp(prefix="llm-")
    return _OWN[application]


# What modules remember in a worker process, and how it is forgotten.
FORGET: dict[str, Callable[[], None]] = {}
_CLAIMED = [""]


def claim_worker(owner: str) -> None:
    """Worker processes serve one stage after another.  When a stage of another module begins, what the others remember
    is freed and given back to the system, so that memories do not add up along a pipeline."""
    if _CLAIMED[0] == owner:
        return
    for name, forget in FORGET.items():
        if name != owner:
            forget()
    if _CLAIMED[0]:
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)
    _CLAIMED[0] = owner


class Scratch:
    """Tables of one run below the shared folder.  A stored table cuts lineage: a lost executor rereads files
    instead of repeating the work behind them.  ``drop`` removes them once the result has been written."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.path = spark, f"{shared_folder(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
        spark.conf.set(BATCH_BYTES, "16m")

    def store(self, df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
        path = f"{self.path}/{name}"
        df.write.option("compression", codec).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string): a null text counts as empty; further columns cannot clash with the operator's."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only, as ``bytes.lower()`` does."""
    return F.translate(text, UPPER, LOWER)


def id_crc(doc_id: Column) -> Column:
    """crc32 of the id as text; callers take it modulo the number of folds."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def batches(schema: pa.Schema, rows: Iterator[tuple], limit: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Rows as batches of a bounded number."""
    out: list[tuple] = []
    for row in rows:
        out.append(row)
        if len(out) >= limit:
            yield batch(schema, out)
            out = []
    if out:
        yield batch(schema, out)


def columns(record: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    """The rows of a batch as tuples of Python values."""
    return zip(*(record.column(n).to_pylist() for n in names), strict=True)
