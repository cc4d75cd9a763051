"""Toxicity by noisy-channel deobfuscation.

A suspicious token (digits or signs among letters, a letter three times or more, letters set apart by spaces or dots) is
a lattice: each sign may be a letter it stands for, or nothing; a repeated letter may be one; a gap may be a word
border or nothing.  Signs at a token's edges are part of the lattice if they may be letters; tokens of such signs alone are
restored if every sign can be a letter of a known word.  Viterbi decoding with a beam finds the restoration that is likeliest under a character language model
and the channel's costs.  Other tokens are their own only path.  The restored words are then scored.

Both models are fitted on all labelled texts: the language model is counted by Spark and keeps ``max_grams`` n-grams; the
``max_words`` words that tell the classes apart best become the features of a sparse logistic regression, which Spark fits
where the rows are.  Every text is scored whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.llm.common import Scratch, batches, columns, id_crc, table, texts

ORDER = 5
BORDER = " "
# What a sign may stand for; fixed values of common substitutions.
SIGNS = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
         "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¢": "c", "#": "h", "%": "", "&": "", "^": "a"}
GAPS = set(" \t.-_*~'`,;:/\\·•")
STANDS, DROPS, REPEATS, BREAKS = -1.0, -0.7, -0.2, -0.7  # the channel's log costs
BEAM = 12
_EDGE = ".,;:!?\"'()[]{}<>*&%#^~`|/\\-_=+…«»“”‘’¿¡"
_PLAIN = "".join(c for c in _EDGE if not SIGNS.get(c))  # signs at the edges that stand for no letter
_RUN = re.compile(r"([^\w\s])\1\1+")
_TRIPLE = re.compile(r"(.)\1\1")
_SPACED = re.compile(r"(?<![^\W_])(?:[^\W_@$!|][ .\-_*]{1,2}|[@$!|][ .\-_*]{1,2}){2,}[^\W_](?![^\W_])")
_OUT = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


class CharacterModel:
    """Log probabilities of letters after up to ``ORDER - 1`` others, backing off to shorter contexts."""

    def __init__(self, counts: dict[str, int]):
        self.logs = {}
        totals: dict[str, int] = {}
        for gram, n in counts.items():
            totals[gram[:-1]] = totals.get(gram[:-1], 0) + n
        for gram, n in counts.items():
            self.logs[gram] = math.log(n / totals[gram[:-1]])
        self.floor = math.log(1e-4)

    def log(self, context: str, letter: str) -> float:
        back = 0.0
        for at in range(len(context) + 1):
            found = self.logs.get(context[at:] + letter)
            if found is not None:
                return back + found
            back -= 1.2
        return back + self.floor

    def knows(self, word: str) -> bool:
        """Whether all its n-grams were counted; a word of up to three letters is one of them."""
        marked = f"{BORDER}{word}{BORDER}"
        return all(marked[i:i + ORDER] in self.logs for i in range(max(1, len(marked) - ORDER + 1)))

    def decode(self, noisy: str, *, drops: bool = True, repeats: bool = True) -> str:
        """The likeliest restoration of a token or a run of spaced letters; words are set apart by single spaces.  Signs
        may be dropped, or merged with the same sign before, as asked for."""
        beam: dict[tuple[str, str], tuple[float, str]] = {(BORDER, ""): (0.0, "")}
        # A state is the last letters of the output and the last sign read, which tells repetitions.
        for sign in noisy:
            following: dict[tuple[str, str], tuple[float, str]] = {}
            for (tail, last), (score, out) in beam.items():
                options: list[tuple[str, float]] = []
                if sign.isalpha():
                    options.append((sign, 0.0))
                options += [(letter, STANDS) for letter in SIGNS.get(sign, "")]
                if sign == last and repeats:
                    options.append(("", REPEATS))
                if sign in GAPS:
                    options += [("", DROPS), (BORDER, BREAKS)]
                elif not sign.isalpha() and drops:
                    options.append(("", DROPS * (1 if sign in SIGNS else 2)))
                for letter, cost in options:
                    if letter == BORDER and tail.endswith(BORDER):
                        letter = ""
                    total = score + cost + (self.log(tail, letter) if letter else 0.0)
                    key = ((tail + letter)[-(ORDER - 1):] if letter else tail, sign)
                    if key not in following or following[key][0] < total:
                        following[key] = (total, out + letter)
            beam = dict(sorted(following.items(), key=lambda x: -x[1][0])[:BEAM])
        best = max(((score + self.log(tail, BORDER), out) for (tail, _), (score, out) in beam.items()), default=(0.0, ""))
        return best[1].strip()


class Restorer(dict):
    """token -> the words it restores to; remembered, as tokens repeat."""

    def __init__(self, model: CharacterModel):
        super().__init__()
        self.model = model

    def __missing__(self, token: str) -> tuple[str, ...]:
        if len(self) > 300_000:
            self.clear()
        # A run of three or more equal signs is decoration, not a letter.
        core = _RUN.sub("", token.strip(_PLAIN)).strip(_PLAIN)
        if core.isalpha() and not _TRIPLE.search(core):
            found = (core,)
        elif any(c.isalpha() for c in core):
            found = tuple(w for w in self.model.decode(core).split(BORDER) if w)
        elif len(core) > 1 and all(SIGNS.get(c) for c in core):
            # Dropping them all would always be likelier; one letter to a sign goes before merged ones.
            tries = (self.model.decode(core, drops=False, repeats=merged) for merged in (False, True))
            found = next(((w,) for w in tries if len(w) > 1 and self.model.knows(w)), ())
        else:
            found = ()
        self[token] = found
        return found

    def words(self, text: str) -> set[str]:
        """The distinct words of the restored text."""
        text = text.lower()
        out: set[str] = set()
        for token in set(text.split()):
            out.update(self[token])
        for run in _SPACED.finditer(text):
            out.update(w for w in self.model.decode(run[0]).split(BORDER) if w)
        return out


class Scorer:
    """Probability of a toxic text from its restored words; picklable, restorer made per worker."""

    def __init__(self, counts: dict[str, int], weights: dict[str, float], bias: float):
        self.counts, self.weights, self.bias, self.restorer = counts, weights, bias, None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "restorer": None}

    def score(self, text: str) -> float:
        if self.restorer is None:
            self.restorer = Restorer(CharacterModel(self.counts))
        total = self.bias + sum(self.weights.get(w, 0.0) for w in self.restorer.words(text))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))


def fit(bags: DataFrame, words: list[str], penalty: float) -> tuple[dict[str, float], float]:
    """Weights of the words and the bias: Spark's logistic regression of ``toxic`` with an absolute penalty."""
    bagged = CountVectorizerModel.from_vocabulary(words, inputCol="words", outputCol="features").transform(bags)
    model = LogisticRegression(labelCol="toxic", regParam=penalty, elasticNetParam=1.0, standardization=False).fit(bagged)
    return dict(zip(words, model.coefficients.toArray().tolist(), strict=True)), float(model.intercept)


def constant(share: float) -> Scorer:
    """Without texts of both classes every text has the share of the toxic ones as its score."""
    return Scorer({}, {}, math.log((share + 1e-3) / (1 - share + 1e-3)))


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          max_grams: int = 200_000, max_words: int = 1_000) -> Scorer:
    """Fit both models on all labelled rows; equal texts of a class count once, so copies do not vouch for each other.

    Rows without label are left out.  Without labels of both classes every text has the share of toxic labels (one half
    without any) as its score.  The labelled texts and their bags of words are stored for the passes over them.
    """
    known = labels.filter(F.col(label_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("label_id"), (F.col(label_col) > 0).cast("int").alias("toxic"))
    classes = {row["toxic"] for row in known.select("toxic").distinct().collect()}
    if len(classes) < 2:
        return constant(0.5 if not classes else float(1 in classes))
    scratch = Scratch(docs.sparkSession, "toxicity")
    try:
        hashed = texts(docs, id_col, text_col).withColumn("hash", F.sha2("text", 256))
        # One row stands for the equal texts of a class; found on narrow rows, so that texts are shuffled once, at every size.
        first = hashed.select("doc_id", "hash").join(known.hint("merge"), F.col("doc_id") == F.col("label_id")).groupBy(
            "hash", "toxic").agg(F.min("doc_id").alias("doc_id"))
        labelled = hashed.join(first.hint("merge"), ["doc_id", "hash"]).dropDuplicates(["doc_id", "hash", "toxic"]).select("text", "toxic")
        return _fitted(scratch, scratch.store(labelled, "texts"), max_grams, max_words)
    finally:
        scratch.drop()


def _fitted(scratch: Scratch, labelled: DataFrame, max_grams: int, max_words: int) -> Scorer:
    sizes = {row["toxic"]: row["count"] for row in labelled.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return constant(0.5 if not sizes else float(1 in sizes))
    words = labelled.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}]+"), F.lit(0))).alias("word"))
    words = words.groupBy("word").count()
    marked = F.concat(F.lit(BORDER), "word", F.lit(BORDER))
    grams = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(ORDER)), lambda size: F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(marked) - size + 1)), lambda at: F.substr(marked, at, size))))
    found = words.select("count", F.explode(grams).alias("gram")).groupBy("gram").agg(F.sum("count").alias("n"))
    found = found.orderBy(F.desc("n"), "gram").limit(max_grams).select("gram", "n").toArrow()
    scorer = Scorer(dict(zip(found.column(0).to_pylist(), found.column(1).to_pylist(), strict=True)), {}, 0.0)
    shared = labelled.sparkSession.sparkContext.broadcast(scorer)

    schema = pa.schema([("toxic", pa.int32()), ("words", pa.list_(pa.string()))])

    def restored(records: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        restorer = Restorer(CharacterModel(shared.value.counts))
        for record in records:
            for text, toxic in columns(record, "text", "toxic"):
                yield toxic, sorted(restorer.words(text))

    bags = scratch.store(labelled.mapInArrow(lambda records: batches(schema, restored(records), 500), "toxic int, words array<string>"), "bags")
    seen = bags.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(
        F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")).filter("t + c >= 5")
    # Log odds with half a text added, in standard errors.
    odds = (F.log((F.col("t") + 0.5) / (sizes[1] + 1.0)) - F.log((F.col("c") + 0.5) / (sizes[0] + 1.0))) / F.sqrt(
        1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    best = seen.orderBy(F.desc(F.abs(odds)), "word").limit(max_words).select("word").toPandas()["word"].tolist()
    # First which words speak for toxicity, then how much they do, without the shrinking that chose them.
    speaks = [w for w, weight in fit(bags, best, 2e-4)[0].items() if weight > 0] if best else []
    if not speaks:
        return Scorer(scorer.counts, {}, math.log(sizes[1] / sizes[0]))
    return Scorer(scorer.counts, *fit(bags, speaks, 1e-5))


def rate(docs: DataFrame, scorer: Scorer, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, score.  Null and empty texts have the score of a text without known words.
    Repeated rows are scored each.  No rows give no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)  # bounded by max_grams and max_words

    def rows(records: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for record in records:
            for doc_id, text in columns(record, "doc_id", "text"):
                yield doc_id, shared.value.score(text)

    return texts(docs, id_col, text_col).mapInArrow(lambda records: batches(_OUT, rows(records)), "doc_id long, score double")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.pmod(id_crc(F.col("doc_id")), F.lit(5)) == 0, F.lit(False))
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scorer = train(docs, labels.filter(~held_out))
    return rate(docs, scorer).select("doc_id", held_out.alias("held_out"), "score",
                                     (F.col("score") >= 0.5).cast("int").alias("predicted"))
