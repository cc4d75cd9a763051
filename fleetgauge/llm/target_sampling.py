"""Target-distribution importance resampling: array-scored weights, drawn by parallel sorting by regular sampling.

1. Every task counts hashed features in one array of ``buckets`` numbers; the sums over all documents and over the target
   texts give an array of gains, and a document's weight is the floored mean of its features' gains.  Noise from a hash
   of the id makes the order of weights a draw without replacement.
2. Tasks sort what they scored into runs of at most ``RUN`` rows, stored with every ``STRIDE``-th key as regular samples.
   A bounded, regular part of the samples gives splitters: fine ones where the draw ends, coarse ones behind.
3. Every task counts its runs' rows per segment.  Prefix sums of these counts give the rank each segment starts at, so only
   segments that start within the draw are exchanged; a segment's pieces, sorted already, are merged in one task and
   its rows numbered on from its start.

A key is (score, id, features, run, place in the run), so no two are equal: however often a row is repeated, its copies
spread over segments.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.llm.common import LOWER, UPPER, Scratch, batches, columns, table, texts

RUN, STRIDE = 100_000, 64
# Samples the driver sees, segments within the draw and behind it, and rows a segment of the draw should have.
SAMPLES, FINE, COARSE, SEGMENT = 131_072, 4096, 64, 8192
# Bytes that are no part of a word become blanks, A-Z become a-z; bytes from 0x80 on are parts of letters.
_WORDS = bytes.maketrans(bytes(c for c in range(128) if not chr(c).isalnum()) + UPPER.encode(),
                         b" " * sum(not chr(c).isalnum() for c in range(128)) + LOWER.encode())
# Big-endian and unsigned, so the bytes of the first six fields sort as the rows do; the weight is carried along.
_ROW = np.dtype([("score", ">u8"), ("no_id", "u1"), ("id", ">u8"), ("features", ">u8"), ("run", ">u4"), ("at", ">u4"), ("weight", ">i8")])
_KEY = np.dtype({"names": ["key", "weight"], "formats": ["S33", ">i8"], "offsets": [0, 33], "itemsize": _ROW.itemsize})
_FLIP, _TOP = np.uint64(1 << 63), np.uint64((1 << 63) - 1)

_COUNT = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])
_RUN = pa.schema([("drawable", pa.bool_()), ("n", pa.int64()), ("rows", pa.binary()), ("samples", pa.binary())])
_SEGMENT = pa.schema([("segment", pa.int32()), ("run", pa.int64()), ("rows", pa.binary())])
_RESULT = pa.schema([("doc_id", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64()), ("score", pa.int64()),
                     ("rank", pa.int64())])
_RESULT_DDL = "doc_id long, n_features long, weight long, score long, rank long"


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


class _Buckets(dict):
    """Feature -> bucket, remembered."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        bucket = self[feature] = zlib.crc32(feature) % self.buckets
        return bucket


def _features(found: list[bytes], longest: int, known: _Buckets) -> np.ndarray:
    """The buckets of all runs of 1 to ``longest`` words."""
    out = list(map(known.__getitem__, found))
    for size in range(2, longest + 1):
        out += [zlib.crc32(b" ".join(found[i:i + size])) % known.buckets for i in range(len(found) - size + 1)]
    return np.array(out, np.int64)


def _count(longest: int, buckets: int):
    def rows(records: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        total, known = np.zeros(buckets, np.int64), _Buckets(buckets)
        for record in records:
            for (text,) in columns(record, "text"):
                total += np.bincount(_features(words(text), longest, known), minlength=buckets)
        yield from ((int(b), int(total[b])) for b in np.flatnonzero(total))

    return lambda records: batches(_COUNT, rows(records))


def bucket_counts(rows: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """How many features fall into each bucket; at most ``buckets`` rows visit the driver."""
    out = np.zeros(buckets, np.int64)
    for row in rows.select("text").mapInArrow(_count(longest, buckets), "bucket int, n long").groupBy("bucket").agg(
            F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    buckets, of_corpus, of_target = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((float(t) + 1) * (of_corpus + buckets) / ((float(s) + 1) * (of_target + buckets))))
                     for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def noise(seed: int, doc_id: int | None) -> int:
    drawn = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((drawn + 0.5) / 4294967296)))


def _packed(rows: list[tuple], run: int, first: int) -> np.ndarray:
    """Rows (score, id, features, weight) as records; ``first`` is the place of the first one in its task."""
    score, doc_id, features, weight = zip(*rows, strict=True)
    out = np.empty(len(rows), _ROW)
    out["score"] = _TOP - np.array(score, np.int64).view(np.uint64)
    out["no_id"] = [x is None for x in doc_id]
    out["id"] = np.array([x or 0 for x in doc_id], np.int64).view(np.uint64) ^ _FLIP
    out["features"], out["weight"], out["run"], out["at"] = features, weight, run, np.arange(first, first + len(rows))
    return out


def _unpacked(rows: np.ndarray, ranks: np.ndarray) -> pa.RecordBatch:
    """Records as result rows; a rank of 0 is none."""
    native = [rows[c].astype(rows[c].dtype.newbyteorder("=")) for c in ("id", "features", "weight", "score")]
    doc_id, features, weight, score = native[0] ^ _FLIP, native[1], native[2], _TOP - native[3]
    return pa.RecordBatch.from_arrays([
        pa.array(doc_id.view(np.int64), mask=rows["no_id"] == 1), pa.array(features.view(np.int64)), pa.array(weight),
        pa.array(score.view(np.int64)), pa.array(ranks, mask=ranks == 0)], schema=_RESULT)


def _ordered(rows: np.ndarray) -> np.ndarray:
    return rows[np.argsort(rows.view(_KEY)["key"], kind="stable")]


def _score(gain: np.ndarray, longest: int, least_words: int, seed: int, run_rows: int, stride: int):
    """Sorted runs of the rows that can be drawn, and unsorted rows of the others."""
    def rows(records: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        run, done, known, held = TaskContext.get().partitionId(), 0, _Buckets(len(gain)), {True: [], False: []}

        def close(drawable: bool) -> tuple:
            nonlocal done
            packed = _packed(held[drawable], run, done)
            done += len(packed)
            held[drawable] = []
            if drawable:
                packed = _ordered(packed)
            return drawable, len(packed), packed.tobytes(), packed[stride // 2::stride].tobytes() if drawable else b""

        for record in records:
            for doc_id, text in columns(record, "doc_id", "text"):
                found = words(text)
                features = _features(found, longest, known)
                weight = int(gain[features].sum()) // len(features) if len(features) else 0
                drawable = len(found) >= least_words
                held[drawable].append((weight + noise(seed, doc_id), doc_id, len(features), weight))
                if len(held[drawable]) == run_rows:
                    yield close(drawable)
        for drawable, rest in held.items():
            if rest:
                yield close(drawable)

    return lambda records: batches(_RUN, rows(records), 4)


def _thinned(every: int):
    def rows(records: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for record in records:
            for (samples,) in columns(record, "samples"):
                found = np.frombuffer(samples, _ROW)[every // 2::every]
                if len(found):
                    yield (found.tobytes(),)

    return lambda records: batches(pa.schema([("samples", pa.binary())]), rows(records), 64)


def _splitters(runs: DataFrame, n: int, draw: int, stride: int, segment_rows: int) -> np.ndarray:
    """Ascending keys between segments: fine ones for the rows to be drawn, coarse ones behind."""
    every = max(1, -(-n // (stride * SAMPLES)))
    found = [r["samples"] for r in runs.select("samples").mapInArrow(_thinned(every), "samples binary").collect()]
    keys = np.sort(np.frombuffer(b"".join(found), _ROW).view(_KEY)["key"])
    stands_for = stride * every
    within = min(len(keys), draw // stands_for + draw // (20 * stands_for) + 1)
    step = max(1, segment_rows // stands_for, -(-within // FINE))
    return np.concatenate([keys[:within:step], keys[within::max(1, -(-(len(keys) - within) // COARSE))]])


def _cut(records: Iterator[pa.RecordBatch], splitters: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each run with the places its segments start and end at."""
    for record in records:
        for (rows,) in columns(record, "rows"):
            run = np.frombuffer(rows, _ROW)
            yield run, np.concatenate([[0], np.searchsorted(run.view(_KEY)["key"], splitters, side="left"), [len(run)]])


def _sizes(splitters: np.ndarray):
    def rows(records: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        total = np.zeros(len(splitters) + 1, np.int64)
        for _, ends in _cut(records, splitters):
            total += np.diff(ends)
        yield from ((int(s), int(total[s])) for s in np.flatnonzero(total))

    return lambda records: batches(_COUNT, rows(records))


def _exchange(splitters: np.ndarray, segments: int):
    """The pieces of the first segments."""
    def rows(records: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for run, ends in _cut(records, splitters):
            for s in np.flatnonzero(np.diff(ends[:segments + 1])):
                piece = run[ends[s]:ends[s + 1]]
                yield int(s), int(piece[0]["run"]), piece.tobytes()

    return lambda records: batches(_SEGMENT, rows(records), 500)


def _behind(splitters: np.ndarray, segments: int):
    def rows(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run, ends in _cut(records, splitters):
            rest = run[ends[segments]:]
            if len(rest):
                yield _unpacked(rest, np.zeros(len(rest), np.int64))

    return rows


def _merge(starts: np.ndarray, draw: int):
    def rows(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = (row for record in records for row in columns(record, "segment", "rows"))
        for segment, group in groupby(pieces, key=lambda row: row[0]):
            merged = _ordered(np.frombuffer(b"".join(rows for _, rows in group), _ROW))
            ranks = starts[segment] + 1 + np.arange(len(merged))
            yield _unpacked(merged, np.where(ranks <= draw, ranks, 0))

    return rows


def resample(docs: DataFrame, target: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", longest: int = 1,
             buckets: int = 10_000, percent: int = 10, least_words: int = 20, seed: int = 2024, run_rows: int = RUN,
             stride: int = STRIDE, segment_rows: int = SEGMENT) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank (1, 2, ... in the order drawn, null if not drawn).

    Null, empty and wordless texts have no features, weight 0 and are never drawn, unless ``least_words`` is 0.  Texts of
    any length are read whole, one at a time.  Documents of equal score are drawn by ascending id, rows without id last
    (their noise is that of an empty id), rows repeated with one id by their number of features and then in no
    particular order: each row has its own rank.  Without documents there are no rows, without target texts all gains
    count as for an empty target.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "target-sampling")
    rows = texts(docs, id_col, text_col).withColumn("text", F.col("text").cast("binary"))
    aim = target.select(F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    gain = gains(bucket_counts(rows, longest, buckets), bucket_counts(aim, longest, buckets))
    runs = scratch.store(rows.mapInArrow(_score(gain, longest, least_words, seed, run_rows, stride),
                                         "drawable boolean, n long, rows binary, samples binary"), "runs")
    sorted_runs = runs.filter("drawable")
    n = sorted_runs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    draw = n * percent // 100
    splitters = _splitters(sorted_runs, n, draw, stride, segment_rows)
    sizes = np.zeros(len(splitters) + 1, np.int64)
    for row in sorted_runs.select("rows").mapInArrow(_sizes(splitters), "bucket int, n long").groupBy("bucket").agg(
            F.sum("n").alias("n")).collect():  # a row per segment
        sizes[row["bucket"]] = row["n"]
    starts = np.cumsum(sizes) - sizes
    segments = int((starts < draw).sum()) if draw else 0
    pieces = sorted_runs.select("rows").mapInArrow(_exchange(splitters, segments), "segment int, run long, rows binary")
    drawn = pieces.repartition("segment").sortWithinPartitions("segment", "run").mapInArrow(_merge(starts, draw), _RESULT_DDL)
    behind = sorted_runs.select("rows").mapInArrow(_behind(splitters, segments), _RESULT_DDL)
    others = runs.filter("NOT drawable").select("rows").mapInArrow(_behind(splitters[:0], 0), _RESULT_DDL)
    return drawn.unionByName(behind).unionByName(others)


def op12_target_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""WITH crc_table AS (
  SELECT list(list_reduce(list_prepend(b, [0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[]),
           lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
  FROM range(256) r(b)),
doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
aim_words AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
hashed AS MATERIALIZED (
  SELECT word, (xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, len(hex(word)) // 2),
             lambda i: ('0x' || substr(hex(word), 2 * i + 1, 2))::BIGINT)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000)::INT AS bucket
  FROM (SELECT DISTINCT unnest(w) AS word FROM (SELECT w FROM doc_words UNION ALL SELECT w FROM aim_words)), crc_table),
doc_features AS MATERIALIZED (
  SELECT doc_id, bucket, n FROM (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(w) AS word FROM doc_words) GROUP BY ALL)
  JOIN hashed USING (word)),
corpus AS (SELECT bucket, sum(n)::DOUBLE AS s FROM doc_features GROUP BY 1),
aim AS (SELECT bucket, count(*)::DOUBLE AS t FROM (SELECT unnest(w) AS word FROM aim_words) JOIN hashed USING (word) GROUP BY 1),
gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1) * ((SELECT coalesce(sum(s), 0) FROM corpus) + 10000)
           / ((coalesce(s, 0) + 1) * ((SELECT coalesce(sum(t), 0) FROM aim) + 10000))))::BIGINT AS g
  FROM corpus FULL JOIN aim USING (bucket)),
summed AS (SELECT doc_id, sum(n * g)::BIGINT AS g, sum(n)::BIGINT AS n FROM doc_features JOIN gain USING (bucket) GROUP BY 1),
weighed AS (
  SELECT doc_id, len(w)::BIGINT AS n_features, coalesce((g - (g % n + n) % n) // n, 0)::BIGINT AS weight
  FROM doc_words LEFT JOIN summed USING (doc_id)),
scored AS (
  SELECT *, weight + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
           / 4294967296::DOUBLE)))::BIGINT AS score FROM weighed),
placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, if(place <= n * 10 // 100, place, NULL)::BIGINT AS rank
FROM scored LEFT JOIN placed USING (doc_id)"""
