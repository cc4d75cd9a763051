"""SimHash near-deduplication with a Gray-order hierarchical index.

Two fingerprints of 64 bits that differ in at most ``distance`` bits agree on two of ``distance + 2`` blocks of bits.  The
upper nodes of the index are these shared patterns: a node is a mask (two blocks) and the pattern its fingerprints share
under it, and every distinct fingerprint is posted under each of its nodes.  Nodes are dealt to tasks.  Below a
node, fingerprints are sorted by their rank in Gray order, so that neighbours differ in few bits, and every few
neighbours are factored into a node of the next level: the bits they all share, as mask and pattern.  A search goes
down from the top and adds up the differences to the bits that each level newly fixes; a node whose sum is above the
distance is left with all that is below it.  What is left at the bottom are the links.

A node above ``NODE`` fingerprints is not searched but divided: among the bits it leaves open, two of its
fingerprints again agree on two of ``distance + 2`` blocks, which with its own mask make the nodes below it.  Of fingerprints
with few open bits there are at most ``NODE``, so this ends after three levels at most.  Nodes that hold a
1,024th of all postings are divided before anything is dealt.  A task gives a spanning tree of each linked group, not its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.llm.common import Scratch, batches, columns, table, texts
from fleetgauge.llm.components import components
from fleetgauge.llm.spread import HOT_PART, spread_lookup

# Fingerprints under a node that is searched, children of a node, pairs of query and node looked at in one step.
NODE, FAN, STEP = 4096, 8, 1 << 18
_ALL = (1 << 64) - 1
_CODE = pa.schema([("doc_id", pa.int64()), ("code", pa.int64())])
_POSTED = pa.schema([("mask", pa.int64()), ("pattern", pa.int64()), ("code", pa.int64()), ("rep", pa.int64())])
_FOUND = pa.schema([*_POSTED, ("a", pa.int64()), ("b", pa.int64())])
_POSTED_DDL = "mask long, pattern long, code long, rep long"


def fingerprint(text: bytes, width: int, seed: int) -> int:
    """Bits set in over half of the hashes of the shingles, repeats included; no words give 0."""
    words = text.lower().split()
    if not words:
        return 0
    size = min(width, len(words))
    joined, hashed = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    n, bits = len(words) - size + 1, np.zeros(64, np.int64)
    for at in range(0, n, 16_384):
        upto = min(n, at + 16_384)
        found = np.array([hashed(joined[a:b], seed) for a, b in zip(
            starts[at:upto].tolist(), (ends[at + size - 1:upto + size - 1] - 1).tolist(), strict=True)], "<u8")
        bits += np.unpackbits(found.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * bits > n, bitorder="little").view("<u8")[0])


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the Gray sequence, in which neighbours differ in one bit."""
    out = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(shift)
    return out


def below(mask: int, distance: int) -> list[int]:
    """The masks under a mask: two of ``distance + 2`` blocks of the bits it leaves open, and itself."""
    open_bits = [bit for bit in range(64) if not mask >> bit & 1]
    blocks = [sum(1 << bit for bit in part.tolist()) for part in np.array_split(open_bits, distance + 2)]
    return [mask | a | b for a, b in combinations(blocks, 2)]


class GrayIndex:
    """The index over the fingerprints of several nodes; ``node`` numbers each row's node, rows of a node stand together."""

    def __init__(self, node: np.ndarray, codes: np.ndarray):
        self.order = np.lexsort((gray_rank(codes), node))
        self.codes, self.node = codes[self.order], node[self.order]
        mask, pattern, owner = np.full(len(codes), _ALL, np.uint64), self.codes, self.node
        first, end = np.arange(len(codes)), np.arange(1, len(codes) + 1)
        self.levels = [(mask, pattern, first, end)]  # per node: mask, pattern, first child, end of its rows
        while len(owner) > len(np.unique(owner)):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            place = np.arange(len(owner)) - np.repeat(starts, np.diff(np.r_[starts, len(owner)]))
            child = np.flatnonzero(place % FAN == 0)
            both, any_ = np.bitwise_and.reduceat(pattern, child), np.bitwise_or.reduceat(pattern, child)
            mask = np.bitwise_and.reduceat(mask, child) & ~(both ^ any_)
            pattern, owner, end = both & mask, owner[child], np.r_[end[np.r_[child[1:] - 1, len(place) - 1]]]
            self.levels.append((mask, pattern, child, end))
        # The top node of each row.
        self.top = np.searchsorted(owner, self.node)

    def pairs(self, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows (i, j), i < j in index order, of one node whose codes differ in at most ``distance`` bits."""
        per_row = np.bincount(self.top)[self.top]
        upto = np.cumsum(per_row)
        for part in np.split(np.arange(len(self.codes)), np.searchsorted(upto, np.arange(STEP, upto[-1], STEP))):
            if len(part):
                yield self._search(part, distance)

    def _search(self, query: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        at, fixed = self.top[query], np.zeros(len(query), np.uint64)
        apart = np.zeros(len(query), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            mask, pattern, first, end = self.levels[level]
            apart = apart + np.bitwise_count((self.codes[query] ^ pattern[at]) & mask[at] & ~fixed)
            near = (apart <= distance) & (end[at] - 1 > query)
            query, at, apart, fixed = query[near], at[near], apart[near], mask[at[near]]
            if level:
                width = len(self.levels[level - 1][0])
                counts = np.r_[first[1:], width][at] - first[at]
                at = np.repeat(first[at] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
                query, apart, fixed = (np.repeat(x, counts) for x in (query, apart, fixed))
        return query, at

    def links(self, distance: int) -> list[tuple[int, int]]:
        """A spanning tree of each linked group, as given rows."""
        root, out = np.arange(len(self.codes)), []
        for i, j in self.pairs(distance):
            known = np.unique(np.stack([root[i], root[j]], axis=1)[root[i] != root[j]], axis=0)
            for a, b in known.tolist():
                while root[a] != a:
                    a = int(root[a])
                while root[b] != b:
                    b = int(root[b])
                if a != b:
                    root[max(a, b)] = min(a, b)
                    out.append((int(self.order[a]), int(self.order[b])))
            while len(known) and (root[root] != root).any():
                root = root[root]
        return out


def _divided(mask: np.ndarray, codes: np.ndarray, reps: np.ndarray, distance: int) -> Iterator[pa.RecordBatch]:
    """Postings under the nodes below."""
    for own in np.unique(mask):
        here = mask == own
        for inner in below(int(own) & _ALL, distance):
            inner_mask = np.uint64(inner)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(here.sum(), inner_mask).view(np.int64)), pa.array((codes[here] & inner_mask).view(np.int64)),
                pa.array(codes[here].view(np.int64)), pa.array(reps[here])], schema=_POSTED)


def _arrays(record: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    mask, pattern, codes, reps = (record.column(c).to_numpy(zero_copy_only=False) for c in _POSTED.names)
    return mask, pattern, codes.view(np.uint64), reps


def _divide(distance: int):
    def rows(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in records:
            mask, _, codes, reps = _arrays(record)
            yield from _divided(mask, codes, reps, distance)

    return rows


def _search(distance: int, most: int):
    """Links of the nodes, which come sorted; nodes above ``most`` come back as postings under the nodes below."""
    def found(record: pa.RecordBatch) -> pa.RecordBatch:
        empty = pa.nulls(record.num_rows, pa.int64())
        return pa.RecordBatch.from_arrays([*record.columns, empty, empty], schema=_FOUND)

    def linked(nodes: np.ndarray, codes: np.ndarray, reps: np.ndarray) -> pa.RecordBatch:
        pairs = np.array(GrayIndex(nodes, codes).links(distance), np.int64).reshape(-1, 2)
        empty = pa.nulls(len(pairs), pa.int64())
        return pa.RecordBatch.from_arrays([empty] * 4 + [pa.array(reps[pairs[:, 0]]), pa.array(reps[pairs[:, 1]])], schema=_FOUND)

    def rows(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, large = None, None
        for record in records:
            if not record.num_rows:
                continue
            now = _arrays(record)
            if held is not None:
                now = tuple(np.concatenate(x) for x in zip(held, now, strict=True))
            mask, pattern = now[:2]
            starts = np.flatnonzero(np.r_[True, (mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])])
            yield from work(now, starts[:-1], starts[1:], large)
            last = tuple(x[starts[-1]:] for x in now)
            # A node that has turned out too large is handed on as it comes.
            key = (last[0][0], last[1][0])
            if len(last[0]) > most or key == large:
                large, held = key, None
                yield from map(found, _divided(last[0], *last[2:], distance))
            else:
                large, held = None, last
        if held is not None:
            yield from work(held, np.array([0]), np.array([len(held[0])]), large)

    def work(now: tuple, starts: np.ndarray, ends: np.ndarray, large) -> Iterator[pa.RecordBatch]:
        mask, pattern, codes, reps = now
        sizes = ends - starts
        whole = sizes > most
        if large is not None and len(starts):
            whole |= (mask[starts] == large[0]) & (pattern[starts] == large[1])
        for a, b in zip(starts[whole].tolist(), ends[whole].tolist(), strict=True):
            yield from map(found, _divided(mask[a:b], codes[a:b], reps[a:b], distance))
        small = ~whole & (sizes > 1)
        starts, sizes = starts[small], sizes[small]
        for pack in np.split(np.arange(len(starts)), np.flatnonzero(np.diff(np.cumsum(sizes) // most)) + 1):
            if len(pack):
                n = sizes[pack]
                at = np.repeat(starts[pack] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                yield linked(np.repeat(np.arange(len(pack)), n), codes[at], reps[at])

    return rows


def _post(codes: DataFrame, distance: int) -> DataFrame:
    masks = F.array(*(F.lit(int(np.uint64(m).view(np.int64))) for m in below(0, distance)))
    posted = codes.select("code", "rep", F.explode(masks).alias("mask"))
    return posted.select("mask", F.col("code").bitwiseAND(F.col("mask")).alias("pattern"), "code", "rep")


def _divide_hot(posted: DataFrame, n_codes: int, distance: int, most: int) -> DataFrame:
    """Postings whose nodes hold a 1,024th of all or more, and more than ``most``, are divided.  Which nodes may is seen from
    counts per hash, combined in the map tasks; there are at most 1,024 such hashes and such nodes."""
    least = max(most, len(below(0, distance)) * n_codes // HOT_PART) + 1
    hashed = posted.withColumn("hashed", F.pmod(F.xxhash64("mask", "pattern"), F.lit(1 << 16)))
    likely = hashed.groupBy("hashed").agg(F.count("*").alias("n")).filter(F.col("n") >= least).select("hashed")
    hot = hashed.join(F.broadcast(likely), "hashed", "left_semi").groupBy("mask", "pattern").agg(
        F.count("*").alias("n")).filter(F.col("n") >= least).select("mask", "pattern")
    if hot.isEmpty():
        return posted
    cool = posted.join(F.broadcast(hot), ["mask", "pattern"], "left_anti")
    divided = posted.join(F.broadcast(hot), ["mask", "pattern"], "left_semi").mapInArrow(_divide(distance), _POSTED_DDL)
    return cool.select(*_POSTED.names).unionByName(divided)


def close_codes(codes: DataFrame, scratch: Scratch, distance: int, n_codes: int, most: int) -> DataFrame:
    """Links (a, b) between the ``rep`` of distinct codes, from which all codes within the distance can be reached."""
    posted, links, level = _divide_hot(_post(codes, distance), n_codes, distance, most), None, 0
    while True:
        found = scratch.store(posted.repartition("mask", "pattern").sortWithinPartitions("mask", "pattern").mapInArrow(
            _search(distance, most), _POSTED_DDL + ", a long, b long"), f"found-{level}")
        here = found.filter("a IS NOT NULL").select("a", "b")
        links = here if links is None else links.unionByName(here)
        posted, level = found.filter("mask IS NOT NULL").select(*_POSTED.names), level + 1
        if posted.isEmpty():
            return links


def _fingerprints(width: int, seed: int):
    def rows(records: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for record in records:
            for doc_id, text in columns(record, "doc_id", "text"):
                yield doc_id, int(np.uint64(fingerprint(text, width, seed)).view(np.int64))

    return lambda records: batches(_CODE, rows(records))


def near_by_simhash(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 3, distance: int = 2,
                    seed: int = 42, most: int = NODE) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    Null, empty and blank texts have the fingerprint of zeros, which is linked like any other; a text of fewer words than
    ``width`` is one shingle.  Texts of any length are read whole, in steps of some thousand shingles.  Rows with equal
    fingerprints are one class, so repeated rows and copies cost nothing more.  Rows without id have a fingerprint and no
    component and link nothing.  No rows give no rows.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = texts(docs, id_col, text_col).withColumn("text", F.col("text").cast("binary"))
    signed = scratch.store(rows.mapInArrow(_fingerprints(width, seed), "doc_id long, code long"), "signed")
    classes = scratch.store(signed.groupBy("code").agg(F.min("doc_id").alias("rep"), F.count("*").alias("size")), "classes")
    named = classes.filter("rep IS NOT NULL").select("code", "rep")
    links = close_codes(named, scratch, distance, named.count(), most)
    found = components(links, scratch, "linked")
    of_code = scratch.store(classes.join(found, F.col("rep") == F.col("node"), "left").select(
        "code", F.coalesce("component", "rep").alias("component_id"), "size"), "components")
    placed = spread_lookup(signed, of_code, "code", "size", signed.count())
    return placed.select("doc_id", F.lpad(F.lower(F.hex("code")), 16, "0").alias("fingerprint"),
                         F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_by_simhash(table(spark, sf_dir, "documents"))
