"""Vector code compression: integer k-means per part of the vectors, over Hilbert-sorted flat blocks.

1. Components become integers, vectors are cut into equal parts.  The parts of each position are sorted along a Hilbert
   curve and cut into flat blocks of some hundred, stored once with their box (least and greatest value per component)
   and their sums.
2. In each round a block compares its box with the codebook: an entry whose least distance to the box is above another
   entry's greatest distance cannot be nearest to any part in it.  The entries left are the block's shortlist.  If it has
   one entry, the block gives its stored sums; otherwise a small kernel of exact 64-bit integers compares its parts with the
   shortlist.  A task gives one row per entry, so nothing but sums is shuffled and the driver sees ``parts * entries`` rows.
3. The last pass assigns every part and brings the parts of a vector together again.

Equal parts have equal places on the curve; row numbers complete the order, so many copies of a vector fill many blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.llm.common import Scratch, batches, columns, table
from fleetgauge.llm.spread import spread_lookup

# Rows of a block: small enough for tight boxes, large enough for one numpy call.
BLOCK = 128
_PLACED = pa.schema([("part", pa.int32()), ("place", pa.int64()), ("row", pa.int64()), ("at", pa.binary())])
_BLOCK = pa.schema([("part", pa.int32()), ("low", pa.binary()), ("high", pa.binary()), ("total", pa.binary()),
                    ("rows", pa.binary()), ("points", pa.binary())])
_BLOCK_DDL = "part int, low binary, high binary, total binary, rows binary, points binary"
_SUM = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])
_ASSIGNED = pa.schema([("row", pa.int64()), ("part", pa.int32()), ("entry", pa.int32()), ("distance", pa.int64())])
_IDS = pa.schema([("id", pa.int64())])


def hilbert_place(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place of each row of cells (unsigned, ``bits`` bits each) on the Hilbert curve through all of them."""
    axes, width = cells.astype(np.int64).T.copy(), cells.shape[1]
    for bit in range(bits - 1, 0, -1):
        below = (1 << bit) - 1
        for i in range(width):
            on = (axes[i] >> bit) & 1 == 1
            swapped = np.where(on, 0, (axes[0] ^ axes[i]) & below)
            axes[0] ^= np.where(on, below, swapped)
            axes[i] ^= swapped
    for i in range(1, width):
        axes[i] ^= axes[i - 1]
    turn = np.zeros(len(cells), np.int64)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((axes[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    place = np.zeros(len(cells), np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in axes ^ turn:
            place = place << 1 | (axis >> bit) & 1
    return place


def shortlist(low: np.ndarray, high: np.ndarray, book: np.ndarray) -> np.ndarray:
    """The entries, ascending, that can be nearest to a point of the box."""
    below, above = low - book, book - high
    least = (np.maximum(np.maximum(below, above), 0) ** 2).sum(1)
    most = (np.maximum(book - low, high - book) ** 2).sum(1)
    return np.flatnonzero(least <= most.min())


def nearest(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per point the first of the nearest entries and its squared distance, exact in 64 bits."""
    away = ((points[:, None, :] - book[None, :, :]) ** 2).sum(2)
    entry = away.argmin(1)
    return entry, away[np.arange(len(points)), entry]


def _place(parts: int, width: int, low: int, high: int):
    used = min(width, 62)
    bits = max(1, 62 // max(used, 1))

    def rows(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in records:
            n = record.num_rows
            if not n:
                continue
            whole = record.column("ints").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, parts, width)
            for part in range(parts):
                points = whole[:, part]
                cells = (points[:, :used] - low) * ((1 << bits) - 1) // max(high - low, 1)
                place = hilbert_place(cells, bits) if used else np.zeros(n, np.int64)
                at = np.ascontiguousarray(points, "<i4").tobytes()
                size = 4 * width
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, part, np.int32)), pa.array(place), record.column("row"),
                    pa.array([at[i * size:(i + 1) * size] for i in range(n)], pa.binary())], schema=_PLACED)

    return rows


def _build(width: int):
    """Flat blocks of rows that come sorted by part and place."""
    def block(part: int, rows: list[int], points: list[bytes]) -> tuple:
        values = np.frombuffer(b"".join(points), "<i4").astype("<i8").reshape(len(rows), width)
        return (part, values.min(0).tobytes(), values.max(0).tobytes(), values.sum(0).tobytes(),
                np.array(rows, "<i8").tobytes(), values.astype("<i4").tobytes())

    def rows(records: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        at, held, points = None, [], []
        for record in records:
            for part, row, point in columns(record, "part", "row", "at"):
                if held and (part != at or len(held) == BLOCK):
                    yield block(at, held, points)
                    held, points = [], []
                at = part
                held.append(row)
                points.append(point)
        if held:
            yield block(at, held, points)

    return lambda records: batches(_BLOCK, rows(records), 1_000)


def _blocks(records: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple]:
    for record in records:
        for part, low, high, total, rows, points in columns(record, *_BLOCK.names):
            row = np.frombuffer(rows, "<i8")
            yield (part, *(np.frombuffer(x, "<i8") for x in (low, high, total)), row,
                   np.frombuffer(points, "<i4").astype(np.int64).reshape(len(row), width))


def _totals(books: np.ndarray):
    """Per task, the number and the sums of the parts nearest to each entry."""
    parts, entries, width = books.shape

    def rows(records: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for part, low, high, total, row, points in _blocks(records, width):
            few = shortlist(low, high, books[part])
            if len(few) == 1:
                counts[part, few[0]] += len(row)
                sums[part, few[0]] += total
            else:
                entry = few[nearest(points, books[part][few])[0]]
                counts[part] += np.bincount(entry, minlength=entries)
                np.add.at(sums[part], entry, points)
        for part, entry in zip(*np.nonzero(counts), strict=True):
            yield int(part), int(entry), int(counts[part, entry]), sums[part, entry].tolist()

    return lambda records: batches(_SUM, rows(records))


def _assign(books: np.ndarray):
    def rows(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, low, high, _, row, points in _blocks(records, books.shape[2]):
            few = shortlist(low, high, books[part])
            entry, distance = nearest(points, books[part][few])
            yield pa.RecordBatch.from_arrays([
                pa.array(row), pa.array(np.full(len(row), part, np.int32)), pa.array(few[entry].astype(np.int32)),
                pa.array(distance)], schema=_ASSIGNED)

    return rows


def _smallest(count: int):
    """The smallest ids of a task."""
    def rows(records: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        found = np.empty(0, np.int64)
        for record in records:
            ids = record.column("id").drop_null().to_numpy(zero_copy_only=False)
            found = np.unique(np.concatenate([found, ids]))[:count]
        yield from ((int(x),) for x in found)

    return lambda records: batches(_IDS, rows(records))


def _first_book(vectors: DataFrame, parts: int, entries: int, width: int) -> np.ndarray:
    """(parts, entries, width): the vectors of the smallest ids; of a repeated id the smallest vector."""
    ids = vectors.select("id").mapInArrow(_smallest(entries), "id long").distinct().orderBy("id").limit(entries)
    chosen = [r["id"] for r in ids.collect()]
    first = vectors.filter(F.col("id").isin(chosen)).groupBy("id").agg(F.min("ints").alias("ints")).orderBy("id").collect()
    whole = np.array([r["ints"] for r in first], np.int64)
    return whole.reshape(len(first), parts, width).transpose(1, 0, 2)


def _next_book(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    width, out = books.shape[2], books.copy()
    given = blocks.mapInArrow(_totals(books), "part int, entry int, n long, sums array<long>")
    sums = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)]
    for row in given.groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums).collect():  # parts * entries rows
        out[row["part"], row["entry"]] = [row[f"s{i}"] // row["n"] for i in range(width)]
    return out


def compress(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> DataFrame:
    """One row per vector that is not null and has no null, infinite or NaN component: vec_id, label, code, error,
    label_error, codebooks_sha256.

    A nearest entry that is tied with others is the one with the lowest index.  Rows repeated with one id are coded each;
    the first codebook takes the smallest vector of a repeated id and none of rows without id.  With fewer ids than
    entries the codebooks are smaller; without any id codes and errors are null.  Rows without label are one label.
    Vectors without components have entry 0 throughout.  No rows give no rows.  All vectors must have one length, which
    ``parts`` divides, and components whose distances fit 64 bits (about 32,000 at 64 components): anything else is an error.
    """
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession, "vector-codes")
    named = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"),
                           F.col(vector_col).cast("array<double>").alias("vector"))
    # A null component makes the comparison null, which is not true; NaN counts as greater than infinity.
    finite = F.forall("vector", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    kept = named.filter(F.col("vector").isNotNull() & finite)
    width = kept.agg(F.max(F.size("vector")), F.min(F.size("vector"))).first()
    kind = dict(named.dtypes)["label"]
    if width[0] is None:
        return spark.createDataFrame([], f"vec_id long, label {kind}, code string, error long, label_error long, codebooks_sha256 string")
    if width[0] != width[1] or width[0] % parts:
        raise ValueError(f"vectors of {width[1]} to {width[0]} components cannot be cut into {parts} equal parts")
    # Differences are at most twice this, and the squares of all of them add up to less than 2 ** 62.
    most = min(isqrt(2**62 // max(width[0], 1)) // 2, 2**31 - 1)

    def whole(x):
        large = F.raise_error(F.lit(f"a component is beyond {most / scale}")).cast("int")
        return F.when(F.abs(x) * scale < most, F.floor(x * scale).cast("int")).otherwise(large)

    vectors = scratch.store(kept.select(F.monotonically_increasing_id().alias("row"), "id", "label",
                                        F.transform("vector", whole).alias("ints")), "vectors")
    n_rows, low, high = vectors.agg(F.count("*"), F.min(F.array_min("ints")), F.max(F.array_max("ints"))).first()
    books = _first_book(vectors, parts, entries, width[0] // parts)
    if not books.shape[1]:
        return vectors.select(F.col("id").alias("vec_id"), "label", F.lit(None).cast("string").alias("code"),
                              *(F.lit(None).cast("long").alias(c) for c in ("error", "label_error")),
                              F.lit(hashlib.sha256(b"").hexdigest()).alias("codebooks_sha256"))

    placed = vectors.select("row", "ints").mapInArrow(
        _place(parts, width[0] // parts, low or 0, high or 0), "part int, place long, row long, at binary")
    blocks = scratch.store(placed.repartitionByRange("part", "place", "row").sortWithinPartitions("part", "place", "row").mapInArrow(
        _build(width[0] // parts), _BLOCK_DDL), "blocks")
    for _ in range(rounds):
        books = _next_book(blocks, books)

    assigned = blocks.mapInArrow(_assign(books), "row long, part int, entry int, distance long")
    labels = vectors.select("row", F.lit(-1).alias("part"), F.lit(None).cast("int").alias("entry"),
                            F.lit(0).cast("long").alias("distance"), "id", "label")
    # One shuffle brings the parts of a vector, its id and its label together.
    coded = labels.unionByName(assigned, allowMissingColumns=True).groupBy("row").agg(
        F.max("id").alias("vec_id"), F.max("label").alias("label"), F.sum("distance").alias("error"),
        *(F.max(F.when(F.col("part") == i, F.col("entry"))).alias(f"e{i}") for i in range(parts)))
    code = F.concat(*(F.lpad(F.lower(F.hex(f"e{i}")), 2, "0") for i in range(parts)))
    coded = scratch.store(coded.select("vec_id", "label", code.alias("code"), "error"), "coded")
    of_label = coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("size"))
    text = ",".join(map(str, books.reshape(-1).tolist()))
    return spread_lookup(coded, of_label, "label", "size", n_rows).withColumn(
        "codebooks_sha256", F.lit(hashlib.sha256(text.encode()).hexdigest()))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(table(spark, sf_dir, "embeddings")).drop("label")


def _oracle(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    steps = [f"""kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS MATERIALIZED (
  SELECT vec_id, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS x FROM kept, range({parts}) t(p)),
c0 AS MATERIALIZED (
  SELECT p, dense_rank() OVER (ORDER BY vec_id) - 1 AS e, x FROM cut
  WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {entries}))"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT vec_id, p, any_value(x) AS x, min(struct_pack(d := d, e := e)) AS best FROM (
    SELECT q.vec_id, p, q.x, c.e, list_sum(list_transform(range(1, len(q.x) + 1), lambda i: (q.x[i] - c.x[i]) * (q.x[i] - c.x[i]))) AS d
    FROM cut q JOIN c{i} c USING (p)) GROUP BY vec_id, p)""")
        if i < rounds:
            steps.append(f"""m{i} AS (
  SELECT p, e, list(m ORDER BY i) AS x FROM (
    SELECT p, e, i, ((s - (s % n + n) % n) // n)::BIGINT AS m FROM (
      SELECT p, best.e AS e, i, sum(x[i])::HUGEINT AS s, count(*)::HUGEINT AS n
      FROM (SELECT p, best, x, unnest(range(1, len(x) + 1)) AS i FROM a{i}) GROUP BY ALL)) GROUP BY p, e),
c{i + 1} AS MATERIALIZED (SELECT p, c.e, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m USING (p, e))""")
    return "WITH " + ",\n".join(steps) + f""",
book AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS h FROM c{rounds}),
coded AS (
  SELECT vec_id, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM a{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM coded JOIN kept USING (vec_id), book"""


ORACLE = _oracle()
