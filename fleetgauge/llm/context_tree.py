"""Language-model scoring by context-tree weighting.

A text is its words, lower-cased, joined by single spaces and closed by a line feed.  Each byte is eight binary decisions,
and for every decision (a prefix of bits within the byte) there is a tree of contexts: none, the last byte, ... the last
``DEPTH`` bytes.  A node's Krichevsky-Trofimov estimate comes from the zeros and ones the training texts have there; the
weighted probability of a node is half its own estimate plus half the product of its children's.  A decision's
probability is the mixture along the path, each node weighted by the share its own estimate has in its weighted
probability; a context no training text has passes its parent's estimate on.  Minus the sum of the binary logarithms is
the code length.

How it is spread:

* One pass counts the (DEPTH + 1)-grams of bytes and the words of each task's texts and sends every distinct one once.
* The nodes of depth 2 and more are computed where the grams of one two-byte context meet; only depths 0 and 1, at most
  257 x 255 nodes whatever the corpus, are merged and sent to all.  The outcome is one probability per gram that occurs.
* Scoring reads the texts once more.  The most frequent grams and words, at most ``max_grams`` and ``max_words``, are sent
  to all tasks; the occurrences of others leave the task with the row's number, meet their values in a join, and are
  added to the row.  So every gram and word counts, and no shuffle carries a text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.llm.common import Scratch, batch, columns, id_crc, table

DEPTH = 5
_PAD = b"\n" * DEPTH
_CHUNK = 250_000  # bytes whose grams are sorted at once
_HELD = 1_000_000  # grams a task holds before it sends them
_TREE = 60_000  # grams whose trees are computed at once, beyond which whole two-byte contexts are not put together
_COUNTED = pa.schema([("word", pa.binary()), ("gram", pa.int64()), ("n_train", pa.int64()), ("n_all", pa.int64())])
_SCORED = pa.schema([
    ("row", pa.int64()), ("whole", pa.bool_()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_bytes", pa.int64()), ("known", pa.int64()), ("word_logs", pa.float64()),
    ("gram_logs", pa.float64()), ("words", pa.list_(pa.binary())), ("times", pa.list_(pa.int32())),
    ("grams", pa.list_(pa.int64()))])


def stream(words: list[bytes]) -> bytes:
    return b" ".join(words) + b"\n"


def pieces(text: bytes, size: int = _CHUNK) -> list[bytes]:
    """A stream in pieces of at most ``size`` bytes, each after the ``DEPTH`` bytes before it."""
    padded = _PAD + text
    return [padded[at:at + size + DEPTH] for at in range(0, len(text), size)]


def grams(padded: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The (DEPTH + 1)-gram that ends at each byte of the pieces but their first ``DEPTH``, and where each piece's begin."""
    joined = np.frombuffer(b"".join(padded), np.uint8).astype(np.int64)
    sizes = np.fromiter(map(len, padded), np.int64, len(padded)) - DEPTH
    found = np.zeros(len(joined) - DEPTH, np.int64)
    for i in range(DEPTH + 1):
        found <<= 8
        found |= joined[i:len(joined) - DEPTH + i]
    # The grams that end within the first bytes of the next piece belong to none.
    ends = np.cumsum(sizes + DEPTH) - DEPTH
    keep = np.ones(len(found), bool)
    for end in ends[:-1]:
        keep[end:end + DEPTH] = False
    return found[keep], np.cumsum(sizes) - sizes


def _chunks(rows: Iterable[tuple], size: int = _CHUNK) -> Iterator[list[tuple]]:
    """Rows (..., piece) in groups of about as many bytes."""
    held, out = 0, []
    for row in rows:
        out.append(row)
        held += len(row[-1])
        if held >= size:
            yield out
            held, out = 0, []
    if out:
        yield out


def _firsts(ordered: np.ndarray) -> np.ndarray:
    """Which of the ordered keys differ from the one before."""
    out = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=out[1:])
    return out


def _run(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each occurs."""
    ordered = np.sort(keys)
    at = np.flatnonzero(_firsts(ordered))
    return ordered[at], np.diff(at, append=len(ordered))


def _merged(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Runs as one; a stable sort merges what is in order already."""
    keys, n = (np.concatenate([run[i] for run in runs]) for i in (0, 1))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = np.flatnonzero(_firsts(keys))
    return keys[at], np.add.reduceat(n[order], at)


def _count(limit: int, size: int):
    """Distinct words and grams of a task with their counts, sent when ``limit`` words or ``_HELD`` grams are held.

    Grams are held as twice their number, plus one if a training text has them.
    """
    def out(words: list[Counter], runs: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        other, train = words
        only = list(other.keys() - train.keys())
        names = [*train, *only]
        trained = np.zeros(len(names), np.int64)
        trained[:len(train)] = np.fromiter(train.values(), np.int64, len(train))
        total = trained + np.fromiter(map(other.get, names, repeat(0)), np.int64, len(names))
        for at in range(0, len(names), 50_000):
            some = slice(at, at + 50_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[some], pa.binary()), pa.nulls(len(names[some]), pa.int64()), pa.array(trained[some]), pa.array(total[some])],
                schema=_COUNTED)
        if runs:
            keys, n = _merged(runs)
            found = keys >> 1
            at = np.flatnonzero(_firsts(found))
            found, total, trained = found[at], np.add.reduceat(n, at), np.add.reduceat(n * (keys & 1), at)
            for at in range(0, len(found), 50_000):
                some = slice(at, at + 50_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(found[some]), pa.binary()), pa.array(found[some]), pa.array(trained[some]), pa.array(total[some])],
                    schema=_COUNTED)

    def work(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, runs = [Counter(), Counter()], []

        def cut() -> Iterator[tuple[int, bytes]]:
            for record in records:
                for fold, text in columns(record, "train", "text"):
                    tokens = text.lower().split()
                    words[fold].update(tokens)
                    yield from ((fold, piece) for piece in pieces(stream(tokens), size))

        full = False
        for some in _chunks(cut(), size):
            found, starts = grams([piece for _, piece in some])
            folds = np.repeat(np.array([fold for fold, _ in some], np.int64), np.diff(starts, append=len(found)))
            runs.append(_run(found << 1 | folds))
            if sum(len(keys) for keys, _ in runs) > _HELD + _HELD // 2:
                runs = [_merged(runs)]
                full = len(runs[0][0]) > _HELD
            if full or len(words[0]) + len(words[1]) > limit:
                yield from out(words, runs)
                runs, full = [], False
                words[0].clear()
                words[1].clear()
        yield from out(words, runs)

    return work


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """By Stirling's series six steps up."""
    y = x + 6
    steps = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5)
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - np.log(steps)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural logarithm of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return (_log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0)
            - 1.1447298858494002)  # the logarithm of pi


class Nodes:
    """The nodes of one depth for some grams: counts, estimate and weight; ``at`` is each (gram, bit)'s node."""

    def __init__(self, found: np.ndarray, n: np.ndarray, depth: int, below: Nodes | None):
        self.depth, self.below = depth, below
        context = (found >> 8) & ((1 << 8 * depth) - 1)
        byte = found & 255
        bits = np.arange(8)
        prefix = (byte[:, None] | 256) >> (8 - bits)
        one = (byte[:, None] >> (7 - bits)) & 1
        self.keys, at = np.unique((context[:, None] << 8) | prefix, return_inverse=True)
        self.at = at.reshape(-1, 8)
        times = np.repeat(n, 8).astype(float)
        self.ones = np.bincount(self.at.ravel(), times * one.ravel(), len(self.keys))
        self.zeros = np.bincount(self.at.ravel(), times, len(self.keys)) - self.ones
        own = log_kt(self.zeros, self.ones)
        if below is None:
            self.weighted, self.weight = own, np.ones(len(own))
        else:
            up = np.searchsorted(self.keys, ((below.keys >> 8) & ((1 << 8 * depth) - 1)) << 8 | below.keys & 255)
            self.weighted, self.weight = mixed(own, np.bincount(up, below.weighted, len(self.keys)))

    def chance(self, bit: np.ndarray, deeper: np.ndarray | None) -> np.ndarray:
        """Probability of each gram's bits, given that of the deeper nodes."""
        zeros, ones = self.zeros[self.at], self.ones[self.at]
        own = (np.where(bit, ones, zeros) + 0.5) / (zeros + ones + 1)
        if deeper is None:
            return own
        known = (self.below.zeros + self.below.ones)[self.below.at] > 0
        weight = self.weight[self.at]
        return np.where(known, weight * own + (1 - weight) * deeper, own)


def mixed(own: np.ndarray, children: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logarithm of half a node's own probability plus half its children's, and the own half's share."""
    weighted = np.logaddexp(own, children) - np.log(2)
    return weighted, np.exp(own - np.log(2) - weighted)


def _trees(found: np.ndarray, n: np.ndarray) -> list[Nodes]:
    """Depths DEPTH down to 2."""
    out: list[Nodes] = []
    for depth in range(DEPTH, 1, -1):
        out.append(Nodes(found, n, depth, out[-1] if out else None))
    return out


def _read(records: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows that come sorted by their two-byte context, in groups of whole contexts."""
    held = [np.empty(0, np.int64)] * 3
    for record in records:
        held = [np.concatenate([h, record.column(c).to_numpy()]) for h, c in zip(held, ("gram", "n_train", "n_all"), strict=True)]
        if len(held[0]) >= _TREE:
            context = held[0] >> 8 & 65535
            last = int(np.searchsorted(context, context[-1]))
            if last:
                yield tuple(h[:last] for h in held)
                held = [h[last:] for h in held]
    if len(held[0]):
        yield tuple(held)


_UPPER = pa.schema([("key", pa.int64()), ("zeros", pa.float64()), ("ones", pa.float64()), ("children", pa.float64())])
_VALUED = pa.schema([("gram", pa.int64()), ("n_all", pa.int64()), ("log10", pa.float64())])


def _upper(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the depth-2 nodes of a partition add to the nodes of depth 1."""
    for found, n, _ in _read(records):
        nodes = _trees(found, n)[-1]
        keys, at = np.unique(((nodes.keys >> 8) & 255) << 8 | nodes.keys & 255, return_inverse=True)
        sums = [np.bincount(at, x, len(keys)) for x in (nodes.zeros, nodes.ones, nodes.weighted)]
        yield pa.RecordBatch.from_arrays([pa.array(keys), *map(pa.array, sums)], schema=_UPPER)


class Top:
    """Depths 0 and 1: dense arrays over (last byte, prefix) and (prefix)."""

    def __init__(self, rows: pa.Table):
        """From (key, zeros, ones, children) per node of depth 1."""
        key, *sums = (rows.column(i).to_numpy() for i in range(4))
        zeros, ones, children = (np.zeros(65536) for _ in sums)
        for held, found in zip((zeros, ones, children), sums, strict=True):
            held[key] = found
        weighted, self.weight1 = mixed(log_kt(zeros, ones), children)
        self.one1, self.total1 = (ones + 0.5) / (zeros + ones + 1), zeros + ones
        zeros, ones, weighted = (x.reshape(256, 256).sum(0) for x in (zeros, ones, weighted))
        _, self.weight0 = mixed(log_kt(zeros, ones), weighted)
        self.one0 = (ones + 0.5) / (zeros + ones + 1)

    def chance(self, found: np.ndarray, bit: np.ndarray, nodes: Nodes, deeper: np.ndarray) -> np.ndarray:
        prefix = ((found & 255)[:, None] | 256) >> (8 - np.arange(8))
        at = ((found >> 8) & 255)[:, None] << 8 | prefix
        own = np.where(bit, self.one1[at], 1 - self.one1[at])
        known = (nodes.zeros + nodes.ones)[nodes.at] > 0
        deeper = np.where(known, self.weight1[at] * own + (1 - self.weight1[at]) * deeper, own)
        own = np.where(bit, self.one0[prefix], 1 - self.one0[prefix])
        return np.where(self.total1[at] > 0, self.weight0[prefix] * own + (1 - self.weight0[prefix]) * deeper, own)


def _value(top: Top):
    def work(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found, n, all_ in _read(records):
            trees, chance = _trees(found, n), None
            bit = ((found & 255)[:, None] >> (7 - np.arange(8))) & 1 == 1
            for nodes in trees:
                chance = nodes.chance(bit, chance)
            logs = np.log10(top.chance(found, bit, trees[-1], chance)).sum(1)
            for at in range(0, len(found), 50_000):
                some = slice(at, at + 50_000)
                yield pa.RecordBatch.from_arrays([pa.array(found[some]), pa.array(all_[some]), pa.array(logs[some])], schema=_VALUED)

    return work


def _frequent(counted: DataFrame, limit: int) -> DataFrame:
    """The rows with the largest counts, at most ``limit``: all from a threshold on, found from counts per size class."""
    size = F.floor(F.log2(F.col("n_all")) * 16)
    classes = sorted(((row["size"], row["count"]) for row in counted.groupBy(size.alias("size")).count().collect()), reverse=True)
    least, held = None, 0
    for value, n in classes:
        held += n
        if held > limit:
            break
        least = value
    return counted.filter(size >= least) if least is not None else counted.limit(0)


def looked_up(found: np.ndarray, keys: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each gram's value among the ordered keys, 0 if it is none of them, and which are."""
    if not len(keys):
        return np.zeros(len(found)), np.zeros(len(found), bool)
    order = np.argsort(found)
    ordered = found[order]
    at = np.flatnonzero(_firsts(ordered))
    distinct = ordered[at]
    near = np.searchsorted(keys, distinct)
    near[near == len(keys)] = 0
    value = np.empty(len(found))
    value[order] = np.repeat(np.where(keys[near] == distinct, logs[near], np.nan).astype(float), np.diff(at, append=len(found)))
    known = ~np.isnan(value)
    return np.where(known, value, 0.0), known


def _score(shared: Broadcast, size: int):
    def work(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        names, counts, keys, logs = shared.value
        words = {word: i for i, word in enumerate(names.to_pylist())}
        # The last entry is what a word that is not among them, at -1, adds.
        word_log, trained = np.append(np.log10(counts + 1), 0.0), np.append(counts > 0, False)

        def cut() -> Iterator[tuple]:
            """A tuple per piece; the last piece of a text carries what is known of the text."""
            nonlocal row
            for record in records:
                for doc_id, text in columns(record, "doc_id", "text"):
                    tokens = text.lower().split()
                    at = np.fromiter(map(words.get, tokens, repeat(-1)), np.int64, len(tokens))
                    known, total = int(np.count_nonzero(trained[at])), float(word_log[at].sum())
                    absent = at < 0
                    rare = Counter(compress(tokens, absent.tolist())) if absent.any() else {}
                    row += 1
                    whole = stream(tokens)
                    parts = pieces(whole, size)
                    for piece in parts[:-1]:
                        yield row, False, doc_id, 0, 0, 0, 0.0, [], [], piece
                    yield row, True, doc_id, len(tokens) + 1, len(whole), known, total, list(rare), list(rare.values()), parts[-1]

        sum_before = 0.0  # of the earlier pieces of the text that is being read
        for some in _chunks(cut(), size):
            found, starts = grams([x[-1] for x in some])
            value, hit = looked_up(found, keys, logs)
            sums = np.add.reduceat(value, starts)
            missing = np.flatnonzero(~hit)
            owner = np.searchsorted(starts, missing, "right") - 1
            cuts = np.searchsorted(owner, np.arange(len(some) + 1))
            rest, out = found[missing], []
            for i, (*told, rare, times, _) in enumerate(some):
                here = rest[cuts[i]:cuts[i + 1]].tolist()
                sum_before += float(sums[i])
                out.append((*told, sum_before if told[1] else 0.0, rare, times, here))
                if told[1]:
                    sum_before = 0.0
            yield batch(_SCORED, out)

    return work


def score(docs: DataFrame, train: Column | None = None, *, id_col: str = "doc_id", text_col: str = "text",
          max_words: int = 200_000, max_grams: int = 2_000_000, task_words: int = 200_000,
          piece_bytes: int = _CHUNK) -> DataFrame:
    """One row per input row: doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    ``train``: which rows the model and the word counts learn from, all by default; null counts as false.  A token is a
    word or the end of a text.  Null and empty texts are an end alone.  Repeated rows are scored each.  If nothing is
    learned from, every bit has probability one half and ``base_score`` is 0.  No rows give no rows.  Long texts are read in
    pieces that overlap by ``DEPTH`` bytes, so no more than a piece is sorted at once.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "context-tree")
    fold = F.lit(True) if train is None else F.coalesce(train, F.lit(False))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), fold.cast("int").alias("train"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    counted = scratch.store(rows.select("text", "train").mapInArrow(
        _count(task_words, piece_bytes), "word binary, gram long, n_train long, n_all long"), "counted")
    sums = [F.sum("n_train").alias("n_train"), F.sum("n_all").alias("n_all")]
    words = scratch.store(counted.filter("word IS NOT NULL").groupBy("word").agg(*sums), "words")
    found = scratch.store(counted.filter("gram IS NOT NULL").groupBy("gram").agg(*sums), "grams")

    # All grams of a two-byte context in one partition; how many there are follows from the bytes, not from the corpus.
    placed = found.withColumn("context", F.shiftright("gram", 8).bitwiseAND(F.lit(65535))).repartition("context") \
        .sortWithinPartitions("context").select("gram", "n_train", "n_all")
    upper = placed.mapInArrow(_upper, "key long, zeros double, ones double, children double").groupBy("key").agg(
        *[F.sum(c).alias(c) for c in ("zeros", "ones", "children")])
    top = Top(upper.toArrow())  # at most 65,280 rows
    valued = scratch.store(placed.mapInArrow(_value(top), "gram long, n_all long, log10 double"), "valued")

    totals = words.agg(F.sum("n_train"), F.count(F.when(F.col("n_train") > 0, 1))).first()
    ends = rows.agg(F.sum("train")).first()[0] or 0
    n, v = (totals[0] or 0) + ends, totals[1] + (ends > 0)
    end_log = float(np.log10(ends + 1))
    top_words = _frequent(words, max_words).select("word", "n_train").toArrow().combine_chunks()
    top_grams = _frequent(valued, max_grams).select("gram", F.col("log10").cast("float")).toArrow()
    keys, logs = (top_grams.column(i).to_numpy() for i in (0, 1))
    order = np.argsort(keys)
    shared = spark.sparkContext.broadcast((  # at most max_words words and max_grams numbers
        top_words.column(0).combine_chunks(), top_words.column(1).to_numpy(), keys[order], logs[order]))
    del top_words, top_grams, keys, logs, order
    scored = scratch.store(rows.select("doc_id", "text").mapInArrow(
        _score(shared, piece_bytes),
        "row long, whole boolean, doc_id long, n_tokens long, n_bytes long, known long, word_logs double, gram_logs double, words array<binary>, "
        "times array<int>, grams array<long>"), "scored")

    pairs = scored.select("row", F.explode(F.arrays_zip("words", "times")).alias("x")).select("row", "x.words", "x.times")
    more = pairs.join(words, pairs["words"] == words["word"]).select(
        "row", (F.col("times") * F.log10(F.col("n_train") + 1)).alias("word_log"),
        F.when(F.col("n_train") > 0, F.col("times")).otherwise(0).alias("n_more"), F.lit(0.0).alias("gram_log"))
    rest = scored.select("row", F.explode("grams").alias("gram")).join(valued, "gram").select(
        "row", F.lit(0.0).alias("word_log"), F.lit(0).alias("n_more"), F.col("log10").alias("gram_log"))
    added = more.unionByName(rest).groupBy("row").agg(
        F.sum("word_log").alias("word_log"), F.sum("n_more").alias("n_more"), F.sum("gram_log").alias("gram_log"))
    whole = scored.filter("whole").drop("words", "times", "grams").join(added, "row", "left").fillna(0, ["n_more"]).fillna(
        0.0, ["word_log", "gram_log"])
    base = F.col("word_logs") + F.col("word_log") + F.lit(end_log) - F.col("n_tokens") * F.log10(F.lit(float(n + v + 1)))
    log10 = F.col("gram_logs") + F.col("gram_log")
    return whole.select("doc_id", "n_tokens", (F.col("known") + F.col("n_more") + F.lit(int(ends > 0))).alias("n_known"),
                        F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"),
                        log10.alias("score"), (log10 * float(-np.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"))


def op7_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.pmod(id_crc(F.col("doc_id")), F.lit(7)) == 2, F.lit(False))
    scored = score(table(spark, sf_dir, "documents"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score",
                         "bits_per_byte")
