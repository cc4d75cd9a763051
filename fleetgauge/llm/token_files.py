"""Token ids in binary files: blocks of ids, transposed into bit or byte planes, each plane compressed with zstandard.

The container is a folder of Parquet files written by Spark's committer, so a lost executor or a second attempt leaves
no half file, on any store.  ``blocks`` has one row per block of ``block_ids`` ids (the last of a part may be shorter):
the compressed planes, and which documents stand in it with how many ids.  ``index`` has a row per block without
its planes: the part, the place of its first id in the whole stream, the number of ids and stored bytes, and the range of
document ids, so a reader finds the blocks of a position or document without opening others.

Documents are dealt by range of their id and sorted, so part by part the stream is in ascending id order, and no
token crosses the network: texts are encoded where their ids are written.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetgauge.llm.common import Scratch, batches, columns, table, texts
from fleetgauge.llm.tokens import encoder

_BLOCK = pa.schema([
    ("part", pa.int32()), ("block", pa.int64()), ("first", pa.int64()), ("n_ids", pa.int32()), ("continues", pa.bool_()),
    ("closes", pa.bool_()), ("ordinal", pa.int64()), ("docs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32())),
    ("stored", pa.int64()), ("planes", pa.list_(pa.binary())),
])
_BLOCK_DDL = ("part int, block long, first long, n_ids int, continues boolean, closes boolean, ordinal long, "
              "docs array<long>, counts array<int>, stored long, planes array<binary>")
_SEGMENT = pa.schema([("part", pa.int32()), ("ordinal", pa.int64()), ("doc_id", pa.int64()), ("block", pa.int64()),
                      ("first", pa.int64()), ("length", pa.int64()), ("crc", pa.int64()), ("ids", pa.binary())])


def to_planes(ids: np.ndarray, unit: str) -> list[bytes]:
    """32 bit planes or 4 byte planes of a block, lowest first, each compressed."""
    as_bytes = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if unit == "bit":
        planes = np.packbits(np.unpackbits(as_bytes, axis=1, bitorder="little").T, axis=1)
    else:
        planes = np.ascontiguousarray(as_bytes.T)
    compressor = zstandard.ZstdCompressor(level=3)
    return [compressor.compress(plane.tobytes()) for plane in planes]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    raw = [np.frombuffer(zstandard.ZstdDecompressor().decompress(plane), np.uint8) for plane in planes]
    if len(raw) == 32:
        bits = np.stack([np.unpackbits(plane, count=n) for plane in raw], axis=1)
        as_bytes = np.packbits(bits, axis=1, bitorder="little")
    else:
        as_bytes = np.stack(raw, axis=1)
    return np.ascontiguousarray(as_bytes).view("<u4").reshape(-1)


def _encode(path: str, byte_level: bool, end_id: int, block_ids: int, unit: str):
    size, end = 4 * block_ids, np.uint32(end_id).astype("<u4").tobytes()

    def rows(records: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        part, block, ordinal, held = TaskContext.get().partitionId(), 0, 0, bytearray()
        docs, counts, continues, first_ordinal = [], [], False, 0

        def close(upto: int, closes: bool):
            nonlocal block
            planes = to_planes(np.frombuffer(bytes(held[:upto]), "<u4"), unit)
            row = (part, block, block * block_ids, upto // 4, continues, closes, first_ordinal, docs, counts,
                   sum(map(len, planes)), planes)
            block += 1
            del held[:upto]
            return row

        for record in records:
            doc_ids = record.column("doc_id").to_pylist()
            for doc_id, ids in zip(doc_ids, encoder(path, byte_level).encode(record.column("text").to_pylist()), strict=True):
                ids += end
                at = 0
                while at < len(ids):
                    if not docs:
                        first_ordinal, continues = ordinal, at > 0
                    step = min(len(ids) - at, size - len(held))
                    held += ids[at:at + step]
                    at += step
                    docs.append(doc_id)
                    counts.append(step // 4)
                    if len(held) == size:
                        yield close(size, at == len(ids))
                        docs, counts = [], []
                ordinal += 1
        if held:
            yield close(len(held), True)

    return lambda records: batches(_BLOCK, rows(records), 32)


def write_tokens(docs: DataFrame, scratch: Scratch, tokenizer_path: str, *, byte_level: bool = True, end_id: int = 0,
                 id_col: str = "doc_id", text_col: str = "text", block_ids: int = 65_536, unit: str = "byte") -> None:
    """Encode whole texts, end each with ``end_id`` and store ``blocks`` and ``index`` in ascending id order.

    Null and empty texts have the end id alone.  Rows without id come first, rows repeated with one id stand side by
    side in the order of their texts.  No rows give empty files.
    """
    ordered = texts(docs, id_col, text_col).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    blocks = scratch.store(ordered.mapInArrow(_encode(tokenizer_path, byte_level, end_id, block_ids, unit), _BLOCK_DDL),
                           "blocks", codec="none")
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("size"))
    # One row per part, of which there are no more than shuffle partitions.
    bases = parts.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("base"))
    index = blocks.join(bases, "part").select(
        "part", "block", (F.col("base") + F.col("first")).alias("first"), "n_ids", "stored",
        F.array_min("docs").alias("first_doc"), F.array_max("docs").alias("last_doc"))
    scratch.store(index, "index")


def _decode(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        names = ("part", "block", "first", "n_ids", "continues", "closes", "ordinal", "docs", "counts", "planes")
        for record in records:
            for part, block, first, n, continues, closes, ordinal, docs, counts, planes in columns(record, *names):
                data, at = from_planes(planes, n).tobytes(), 0
                for i, (doc_id, count) in enumerate(zip(docs, counts, strict=True)):
                    ids = data[4 * at:4 * (at + count)]
                    whole = not (i == 0 and continues) and (closes or i < len(docs) - 1)
                    yield (part, ordinal + i, doc_id, block, first + at, count, zlib.crc32(ids) if whole else None,
                           None if whole else ids)
                    at += count

    return batches(_SEGMENT, rows(), 5_000)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """From the files: doc_id, start (ids before it), n_tokens, ids_crc32 per document.

    Only documents that cross a block border are put together by a shuffle, each from its own blocks.
    """
    blocks = spark.read.schema(_BLOCK_DDL).parquet(f"{path}/blocks")
    index = spark.read.schema("part int, block long, first long, n_ids int, stored long, first_doc long, last_doc long") \
        .parquet(f"{path}/index")
    bases = index.filter("block = 0").select("part", F.col("first").alias("base"))
    segments = blocks.mapInArrow(_decode, "part int, ordinal long, doc_id long, block long, first long, length long, "
                                          "crc long, ids binary")
    # An aggregate of whole documents only passes them on; the partial ones meet by (part, ordinal).
    whole = segments.filter("crc IS NOT NULL").select("part", "doc_id", "first", F.col("length").alias("n_tokens"),
                                                      F.col("crc").alias("ids_crc32"))
    pieces = F.array_sort(F.collect_list(F.struct("block", "ids")))
    joined = F.aggregate(pieces, F.lit(b"").cast("binary"), lambda held, x: F.concat(held, x["ids"]))
    crossing = segments.filter("crc IS NULL").groupBy("part", "ordinal").agg(
        F.min("doc_id").alias("doc_id"), F.min("first").alias("first"), F.sum("length").alias("n_tokens"),
        F.crc32(joined).alias("ids_crc32")).drop("ordinal")
    return whole.unionByName(crossing).join(bases, "part").select(
        "doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    scratch = Scratch(spark, "token-files")
    write_tokens(table(spark, sf_dir, "documents"), scratch, public_tokenizers.path("byte_bpe_50k.json"))
    return read_documents(spark, scratch.path)
