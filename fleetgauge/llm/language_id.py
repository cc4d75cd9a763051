"""Language identification by word-first backoff.

Known words are scored by their log frequency in each language.  A word that no training text has falls back to its
character n-grams, the longest known ones first: at each place the longest known n-gram is taken and the scan goes on
behind it.  Words and n-grams are counted per language by Spark, over a sample of the labelled texts that is bounded per
language (``docs_per_language``, ``chars_per_language``).  The model holds every language, word and n-gram of the sample:
one entry for each language a name was seen in, in three flat arrays, names as 64-bit hashes; n-grams, which are fewer,
also by name.  Every text is scored whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.llm.common import batches, claim_worker, columns, id_crc, table, texts

UNDETERMINED = "und"
_WORD = re.compile(r"[^\W\d_]+")
LONGEST = 5
_OUT = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


def words(text: str) -> list[str]:
    """Runs of letters, lower-cased.  Number signs such as one half or Roman numerals are no letters."""
    out = []
    for found in _WORD.findall(text.lower()):
        if found.isalpha():
            out.append(found)
        else:
            out += "".join(c if c.isalpha() else " " for c in found).split()
    return out


def name_hash(name: str) -> int:
    """XXH64 with seed 42, unsigned; Spark's ``xxhash64`` of a string gives the same bits."""
    return xxhash.xxh64_intdigest(name.encode("utf-8", "surrogatepass"), 42)


class Counts:
    """How often names occur per language: names by hash in ascending order, of each the languages it was seen in."""

    def __init__(self, hashes: np.ndarray, places: np.ndarray, times: np.ndarray, languages: int):
        order = np.lexsort((places, hashes))
        hashes, self.places, times = hashes[order], places[order].astype(np.int32), times[order].astype(float)
        self.names, first = np.unique(hashes, return_index=True)
        self.starts = np.append(first, len(hashes)).astype(np.int64)
        self.totals = np.log(np.bincount(self.places, times, languages) + 1)
        # One more observation per language, spread as all languages together are.  A name's share of it stands in every
        # language's logarithm, so it is left out, and languages that lack the name gain nothing.
        shares = np.add.reduceat(times, first) / times.sum() if len(first) else np.zeros(0)
        self.gains = np.log1p(times / np.repeat(shares, np.diff(self.starts))).astype(np.float32)

    @classmethod
    def of(cls, found: dict[str, list[int]], languages: int) -> Counts:
        """From names with their counts per language."""
        entries = [(name_hash(name), i, n) for name, row in found.items() for i, n in enumerate(row) if n]
        hashes, places, times = zip(*entries, strict=True) if entries else ((), (), ())
        return cls(np.array(hashes, np.uint64), np.array(places, np.int32), np.array(times, float), languages)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The names' places, -1 where unknown."""
        if not len(self.names):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.names, hashes), len(self.names) - 1)
        return np.where(self.names[at] == hashes, at, -1)

    def score(self, at: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Log score per language of known names, each so many times."""
        first, n = self.starts[at], self.starts[at + 1] - self.starts[at]
        entries = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        gained = np.bincount(self.places[entries], self.gains[entries] * np.repeat(times, n), len(self.totals))
        return gained - times.sum() * self.totals


class Model:
    """Word and n-gram counts per language, n-grams' places by name, and the n-grams of unknown words lately met."""

    def __init__(self, languages: list[str], found: Counts, grams: Counts, names: dict[str, int]):
        self.languages, self.found, self.grams, self.names = languages, found, grams, names
        self.seen: dict[str, list[int]] = {}

    def backoff(self, word: str) -> list[int]:
        """The places of the n-grams an unknown word falls back to; remembered, as words repeat."""
        taken = self.seen.get(word)
        if taken is None:
            if len(self.seen) > 30_000:
                self.seen.clear()
            marked, taken, at = f"<{word}>", [], 0
            while at < len(marked):
                for size in range(min(LONGEST, len(marked) - at), 0, -1):
                    place = self.names.get(marked[at:at + size])
                    if place is not None:
                        taken.append(place)
                        break
                at += size
            self.seen[word] = taken
        return taken

    def predict(self, text: str) -> tuple[str, float]:
        counted = Counter(words(text))
        if not counted or not self.languages:
            return UNDETERMINED, 0.0
        names, times = list(counted), np.fromiter(counted.values(), float, len(counted))
        at = self.found.find(np.fromiter(map(name_hash, names), np.uint64, len(names)))
        known = at >= 0
        total = self.found.score(at[known], times[known])
        if not known.all():
            unknown = np.flatnonzero(~known)
            for lot in range(0, len(unknown), 1_000):  # so that what a long text adds stays bounded
                part = unknown[lot:lot + 1_000]
                grams = [self.backoff(names[i]) for i in part]
                total += self.grams.score(np.array([x for taken in grams for x in taken], np.int64),
                                          np.repeat(times[part], [len(taken) for taken in grams]))
        best = int(total.argmax())  # ties go to the first language in code-point order
        return self.languages[best], float(1 / np.exp(np.clip(total - total[best], -700, 0)).sum())


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          docs_per_language: int = 2_000, chars_per_language: int = 20_000_000, max_entries: int = 20_000_000) -> Model:
    """Fit on rows with a language.  A language's sample are the rows with the smallest hashes of their id, about
    ``docs_per_language`` of them and ``chars_per_language`` characters, whichever is less.  Nothing of the sample is
    left out: words or n-grams that fill more than ``max_entries`` entries (one per name and language) are an error."""
    labelled = docs.filter(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.pmod(F.xxhash64(F.lit(3), F.col(id_col).cast("long")), F.lit(1 << 30)).alias("draw"))
    sizes = {row["lang"]: row for row in labelled.groupBy("lang").agg(
        F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], Counts.of({}, 0), Counts.of({}, 0), {})
    limits = F.create_map(*[x for lang, row in sizes.items() for x in (F.lit(lang), F.lit(math.ceil((1 << 30) * min(
        1.0, docs_per_language / row["n"], chars_per_language / max(1, row["chars"])))))])
    place = F.create_map(*[x for i, lang in enumerate(languages) for x in (F.lit(lang), F.lit(i))])
    sample = labelled.filter(F.col("draw") < F.get(F.array(F.try_element_at(limits, F.col("lang"))), F.lit(0)))
    found = sample.select("lang", F.explode(F.regexp_extract_all(
        F.lower("text"), F.lit(r"[\p{L}]+"), F.lit(0))).alias("word")).groupBy("lang", "word").count()
    found = found.withColumnRenamed("count", "n")
    marked = F.concat(F.lit("<"), "word", F.lit(">"))
    pieces = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(LONGEST)), lambda size: F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(marked) - size + 1)),
        lambda at: F.substr(marked, at, size))))
    grams = found.select("lang", "n", F.explode(F.array_distinct(pieces)).alias("gram")).groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))

    def entries(frame: DataFrame, key: str, *more: str) -> tuple[Counts, pa.Table]:
        got = frame.select(F.xxhash64(key).alias("name"), F.try_element_at(place, F.col("lang")).alias("place"), "n", *more).limit(
            max_entries + 1).toArrow()
        if got.num_rows > max_entries:
            raise ValueError(f"more than {max_entries} {key} entries; lower docs_per_language or chars_per_language")
        return Counts(got["name"].to_numpy().view(np.uint64), got["place"].to_numpy(), got["n"].to_numpy(), len(languages)), got

    counted, got = entries(grams, "gram", "gram")
    places = counted.find(got["name"].to_numpy().view(np.uint64)).tolist()
    return Model(languages, entries(found, "word")[0], counted, dict(zip(got["gram"].to_pylist(), places, strict=True)))


def identify(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, text_hash (Spark's ``xxhash64`` of the text), lang_pred, score (the winner's share
    of the likelihood).

    Texts that are null, empty or without letters, and all texts under a model without languages, are ``und`` with
    score 0.  Very long texts are scored whole, their unknown words in lots.  Repeated rows are scored each.  No rows
    give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by max_entries

    def rows(records: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        claim_worker("language_id")
        for record in records:
            for doc_id, text, hashed in columns(record, "doc_id", "text", "text_hash"):
                yield doc_id, hashed, *shared.value.predict(text)

    return texts(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        lambda records: batches(_OUT, rows(records)), "doc_id long, text_hash long, lang_pred string, score double")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(id_crc(F.col("doc_id")), F.lit(3)) == 1
    model = train(docs.filter(~F.coalesce(held_out, F.lit(False))))
    return identify(docs, model).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")
