"""Best-fit packing by large-item matching.

Texts are encoded once and cut into pieces of at most ``capacity`` ids; only narrow piece rows are kept.  Pieces of one
length are interchangeable, so the packing is decided on the counts per length, of which there are ``capacity`` whatever
the corpus's size:

* Pieces above a third of the capacity: at most two of them share a sequence.  From the longest down, each is matched
  with the longest that still fits beside it.
* Shorter ones, from the longest down, go where the remaining gap is tightest (best fit), then into new sequences.

The outcome is a list of runs (length, first rank, sequence, offset): pieces of that length with ranks in the run take
equal places in consecutive sequences.  A piece's rank among those of its length comes from a window per
(length, slice), so a length that most pieces have does not meet in one task, plus the counts of earlier slices.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetgauge.llm.common import Scratch, batches, table, texts
from fleetgauge.llm.tokens import encoder

_PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64())])
_PLACED = pa.schema([*_PIECE, ("sequence_id", pa.int64()), ("offset", pa.int64())])
SLICES = 256


def _cut(path: str, byte_level: bool, end_id: int, capacity: int):
    end = np.uint32(end_id).astype("<u4").tobytes()

    def rows(records: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for record in records:
            found = encoder(path, byte_level).encode(record.column("text").to_pylist())
            for doc_id, ids in zip(record.column("doc_id").to_pylist(), found, strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    yield doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)

    return lambda records: batches(_PIECE, rows(records))


def match_and_fit(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Runs (length, first rank, first sequence, per sequence, offset) and the number of sequences."""
    left, runs, made = dict(counts), [], 0
    taken = dict.fromkeys(counts, 0)
    groups: dict[int, list[tuple[int, int]]] = {}  # remaining gap -> (first sequence, how many)

    def place(length: int, first: int, many: int, each: int, offset: int) -> None:
        runs.append((length, taken[length], first, each, offset))
        taken[length] += many * each
        left[length] -= many * each

    def gap(size: int, first: int, many: int) -> None:
        if size and many:
            groups.setdefault(size, []).append((first, many))

    large = sorted(x for x in counts if 3 * x > capacity)
    for length in reversed(large):
        while left[length]:
            at = bisect.bisect_right(large, min(length, capacity - length)) - 1
            while at >= 0 and left[large[at]] < (2 if large[at] == length else 1):
                at -= 1
            mate = large[at] if at >= 0 else None
            many = left[length] if mate is None else left[length] // 2 if mate == length else min(left[length], left[mate])
            first, made = made, made + many
            if mate == length:
                place(length, first, many, 2, 0)
            else:
                place(length, first, many, 1, 0)
                if mate is not None:
                    place(mate, first, many, 1, length)
            gap(capacity - length - (mate or 0), first, many)
    for length in sorted((x for x in counts if 3 * x <= capacity), reverse=True):
        for size in sorted(x for x in groups if x >= length):
            if not left[length]:
                break
            open_, fit = groups.pop(size), size // length
            while open_ and left[length]:
                first, many = open_.pop()
                full = min(many, left[length] // fit)
                if full:
                    place(length, first, full, fit, capacity - size)
                    gap(size - fit * length, first, full)
                rest = left[length] if full < many else 0
                if rest:  # fewer than ``fit`` are left: one more sequence takes them
                    place(length, first + full, 1, rest, capacity - size)
                    gap(size - rest * length, first + full, 1)
                    full += 1
                if full < many:
                    open_.append((first + full, many - full))
            if open_:
                groups.setdefault(size, []).extend(open_)
        fit = capacity // length
        full, rest = divmod(left[length], fit)
        for many, each in ((full, fit), (1, rest)):
            if many and each:
                place(length, made, many, each, 0)
                gap(capacity - each * length, made, many)
                made += many
    return runs, made


def _place(bases: dict[tuple[int, int], int], runs: list[tuple[int, int, int, int, int]]):
    by_length: dict[int, list] = {}
    for length, *run in sorted(runs):
        by_length.setdefault(length, []).append(run)
    tables = {length: np.array(rows, np.int64) for length, rows in by_length.items()}

    def rows(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in records:
            length = record.column("length").to_numpy()
            rank = record.column("rank").to_numpy() + np.array(
                [bases[key] for key in zip(length.tolist(), record.column("slice").to_pylist(), strict=True)], np.int64)
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for size in np.unique(length):
                at = np.flatnonzero(length == size)
                run = tables[int(size)]
                hit = run[np.searchsorted(run[:, 0], rank[at], "right") - 1]
                inside = rank[at] - hit[:, 0]
                sequence[at] = hit[:, 1] + inside // hit[:, 2]
                offset[at] = hit[:, 3] + inside % hit[:, 2] * size
            yield pa.RecordBatch.from_arrays([*(record.column(f.name) for f in _PIECE), pa.array(sequence), pa.array(offset)],
                                             schema=_PLACED)

    return rows


def pack(docs: DataFrame, tokenizer_path: str, *, byte_level: bool = False, end_id: int = 0, capacity: int = 2048,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one piece with the end id alone.  Repeated rows are pieces of their own; equal ranks are
    ordered by id, piece and content, so a rerun packs alike.  No rows give no rows.  The driver sees at most
    ``capacity`` x 256 counts, however many documents there are.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "packing")
    pieces = scratch.store(
        texts(docs, id_col, text_col).mapInArrow(
            _cut(tokenizer_path, byte_level, end_id, capacity),
            "doc_id long, piece int, start long, length long, ids_crc32 long"), "pieces")
    pieces = pieces.withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SLICES)).cast("int"))
    counted = pieces.groupBy("length", "slice").count().collect()
    bases, counts = {}, {}
    for length, part, n in sorted(tuple(x) for x in counted):
        bases[length, part] = counts.get(length, 0)
        counts[length] = counts.get(length, 0) + n
    runs, _ = match_and_fit(counts, capacity)
    order = Window.partitionBy("length", "slice").orderBy("doc_id", "piece", "ids_crc32")
    ranked = pieces.withColumn("rank", (F.row_number().over(order) - 1).cast("long"))
    return ranked.mapInArrow(_place(bases, runs), "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                                  "sequence_id long, offset long")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
