"""Exact deduplication by Patricia-trie owners.

1. Every map task inserts the byte strings of its rows into a compressed radix trie.  A terminal node holds the rows
   with that text, so a text leaves the task once, however often it occurs there.  When the labels exceed
   ``combine_bytes``, the heaviest subtree is spilled: its terminals leave early and may appear again later.
2. What left is dealt by length and content hash.  Each owner partition inserts it in byte order into a trie whose
   terminals hold the staying row and the group's size.  In that order all subtrees left of the current path are
   complete, so they are written out and freed: memory holds one path, whatever the partition's size.
3. The groups go back to the rows, of which a map task has one per text, so a hot group never meets in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.llm.common import Scratch, ascii_lower, batches, claim_worker, columns, table, texts


class Node:
    __slots__ = ("label", "children", "value")

    def __init__(self, label: bytes):
        self.label, self.children, self.value = label, {}, None


def _shared(label: bytes, key: bytes, at: int) -> int:
    """Length of the common prefix of a label and the key from a position on."""
    low, high = 0, min(len(label), len(key) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if key.startswith(label[:mid], at):
            low = mid
        else:
            high = mid - 1
    return low


class PatriciaTrie:
    """A compressed radix trie over byte strings; terminals carry any value."""

    def __init__(self):
        self.root, self.bytes = Node(b""), 0

    def terminal(self, key: bytes) -> Node:
        """The key's node, made where missing."""
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = Node(key[at:])
                self.bytes += len(child.label)
                return child
            size = len(child.label)
            if not key.startswith(child.label, at):
                size = _shared(child.label, key, at)
                fork = node.children[key[at]] = Node(child.label[:size])
                child.label = child.label[size:]
                fork.children[child.label[0]] = child
                child = fork
            node, at = child, at + size
        return node

    def _take(self, node: Node, prefix: bytes) -> Iterator[tuple[bytes, object]]:
        """All terminals below a detached node, smallest key first."""
        stack = [(node, prefix)]
        while stack:
            node, prefix = stack.pop()
            self.bytes -= len(node.label)
            key = prefix + node.label
            if node.value is not None:
                yield key, node.value
            stack += [(node.children[b], key) for b in sorted(node.children, reverse=True)]

    def take_all(self) -> Iterator[tuple[bytes, object]]:
        root, self.root = self.root, Node(b"")
        return self._take(root, b"")

    def take_heaviest(self) -> Iterator[tuple[bytes, object]]:
        """Spill the subtree of the root's child with the longest labels in total."""
        weights = {}
        for first, child in self.root.children.items():
            weight, stack = 0, [child]
            while stack:
                node = stack.pop()
                weight += len(node.label)
                stack += node.children.values()
            weights[first] = weight
        return self._take(self.root.children.pop(max(weights, key=weights.get)), b"")

    def take_before(self, key: bytes) -> Iterator[tuple[bytes, object]]:
        """Everything left of the key's path; complete when keys come in byte order."""
        node, at = self.root, 0
        while True:
            if at < len(key) and node.value is not None:
                value, node.value = node.value, None
                yield key[:at], value
            ahead = key[at] if at < len(key) else 256
            for first in sorted(b for b in node.children if b < ahead):
                yield from self._take(node.children.pop(first), key[:at])
            node = node.children.get(ahead)
            if node is None or not key.startswith(node.label, at):
                return
            at += len(node.label)


_COMBINED = pa.schema([("rep", pa.int64()), ("length", pa.int64()), ("sha256", pa.string()), ("text", pa.binary()),
                       ("ids", pa.list_(pa.int64()))])
_GROUPS = pa.schema([("length", pa.int64()), ("sha256", pa.string()), ("keep_id", pa.int64()), ("keep_rep", pa.int64()),
                     ("group_size", pa.int64())])


def _combine(limit: int):
    def rows(records: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        claim_worker("exact_dedup")
        trie, rep = PatriciaTrie(), TaskContext.get().partitionId() << 40

        def left(terminals):
            nonlocal rep
            for key, ids in terminals:
                rep += 1
                yield rep, len(key), hashlib.sha256(key).hexdigest(), key, ids

        for record in records:
            for doc_id, text in columns(record, "doc_id", "text"):
                node = trie.terminal(text)
                if node.value is None:
                    node.value = [doc_id]
                else:
                    node.value.append(doc_id)
                while trie.bytes > limit:
                    yield from left(trie.take_heaviest())
        yield from left(trie.take_all())

    return lambda records: batches(_COMBINED, rows(records), 500)


def _own(keep: str):
    def rows(records: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        claim_worker("exact_dedup")
        trie = PatriciaTrie()

        def left(terminals):
            for key, (sha, top, rep, size) in terminals:
                yield len(key), sha, None if top is None else top, rep, size

        def better(a: tuple, b: tuple) -> tuple:
            """A row without id stays only if no row has one."""
            if a[0] is None or b[0] is None:
                return a if b[0] is None else b
            return (max if keep == "largest" else min)(a, b)

        for record in records:
            for text, sha, top, rep, n in columns(record, "text", "sha256", "top", "rep", "n"):
                node = trie.terminal(text)
                if node.value is None:
                    yield from left(trie.take_before(text))
                    node = trie.terminal(text)
                    node.value = (sha, top, rep, n)
                else:
                    before = node.value
                    node.value = (sha, *better(before[1:3], (top, rep)), before[3] + n)
        yield from left(trie.take_all())

    return lambda records: batches(_GROUPS, rows(records))


def exact_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", fold_case: bool = True,
                 keep: str = "smallest", combine_bytes: int = 64 << 20) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are (after lower-casing A-Z with ``fold_case``).  ``keep`` names the id that
    stays, "smallest" or "largest".  Null texts count as empty and so form one group with empty ones.  Of rows repeated
    with the same id and text exactly one stays.  Null ids lose to others.  No rows give no rows.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "exact-dedup")
    rows = texts(docs, id_col, text_col)
    rows = rows.withColumn("text", (ascii_lower(F.col("text")) if fold_case else F.col("text")).cast("binary"))
    combined = scratch.store(
        rows.mapInArrow(_combine(combine_bytes),
                        "rep long, length long, sha256 string, text binary, ids array<long>"), "combined")
    top = F.array_max("ids") if keep == "largest" else F.array_min("ids")
    groups = (
        combined.select("rep", "length", "sha256", "text", top.alias("top"), F.size("ids").cast("long").alias("n"))
        .repartition("length", "sha256").sortWithinPartitions("text")
        .mapInArrow(_own(keep), "length long, sha256 string, keep_id long, keep_rep long, group_size long")
    )
    first = F.array_position("ids", F.col("keep_id")) - 1
    return (
        combined.select("rep", "length", "sha256", "ids").join(groups, ["length", "sha256"])
        .withColumn("first", F.when(F.col("rep") == F.col("keep_rep"), F.when(F.col("keep_id").isNull(), 0).otherwise(first)))
        .select("sha256", "keep_id", "group_size", "first", F.posexplode("ids").alias("at", "doc_id"))
        .select("doc_id", "keep_id", "group_size",
                F.coalesce(F.col("at") == F.col("first"), F.lit(False)).alias("kept"),
                F.col("sha256").alias("text_sha256"))
    )


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"), keep="largest")


ORACLE = """
WITH t AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
    FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM t
"""
