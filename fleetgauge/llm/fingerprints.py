"""Document fingerprints: a Merkle tree over sections and paragraphs, in DataFrame operations only.

A section ends after a blank line, a paragraph after a line feed, so the parts joined give the text back exactly.  A
paragraph's hash is that of its text, a section's that of its paragraphs' hashes in order, the root that of its
sections' hashes: equal texts have equal roots, and where two trees differ, the differing branches lead to the edit.
For the likeness of texts that share no whole paragraph, a paragraph also has the short hashes of its spans: every run of
four units in it, each beginning one unit later, or all of its units if it has fewer.  A unit is a word with the blanks
behind it; of a word above ``LONG`` characters each character is a unit.  An edit so changes the few spans it touches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetgauge.llm.common import Scratch, table, texts

LONG, SPAN = 16, 4
_UNIT = rf"(?<!\S)\S{{1,{LONG}}}+(?!\S)\s*+|\S\s*+|\s++"


def tree(text: Column) -> Column:
    """array (sections) of arrays (paragraphs) of struct(hash, spans)."""
    def spans(units: Column) -> Column:
        found = F.transform(F.sequence(F.lit(0), F.greatest(F.size(units) - SPAN, F.lit(0))), lambda i: F.xxhash64(
            *[F.get(units, i + n) for n in range(SPAN)]))
        return F.slice(found, F.lit(1), F.size(units))  # none where there are no units

    def paragraph(p: Column) -> Column:
        units = F.transform(F.regexp_extract_all(p, F.lit(_UNIT), F.lit(0)), lambda u: F.xxhash64(u))
        # An array of one array, so that the units are computed once.
        return F.struct(F.sha2(p, 256).alias("hash"), F.get(F.transform(F.array(units), spans), F.lit(0)).alias("spans"))

    return F.transform(F.split(text, r"(?<=\n\n)"), lambda s: F.transform(F.split(s, r"(?<=\n)"), paragraph))


def sections(parts: Column) -> Column:
    return F.transform(parts, lambda s: F.sha2(F.concat_ws("", F.transform(s, lambda p: p["hash"])), 256))


def root(parts: Column) -> Column:
    return F.sha2(F.concat_ws("", sections(parts)), 256)


def likeness(a: Column, b: Column) -> Column:
    """1 for equal roots, else twice the shared spans over the spans of both, each distinct span counted once."""
    spans = [F.array_distinct(F.flatten(F.flatten(F.transform(t, lambda s: F.transform(s, lambda p: p["spans"]))))) for t in (a, b)]
    shared = F.size(F.array_intersect(*spans))
    return F.when(root(a) == root(b), 1.0).otherwise(
        F.coalesce(F.try_divide(2.0 * shared, F.size(spans[0]) + F.size(spans[1])), F.lit(0.0)))


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_chars, fingerprint (the root), section_hashes.

    Null texts count as empty.  Repeated rows and rows without id have their rows.  A text, however long, is hashed whole
    within its row.  No rows give no rows.
    """
    rows = texts(docs, id_col, text_col).withColumn("tree", tree(F.col("text")))
    return rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), root(F.col("tree")).alias("fingerprint"),
                       sections(F.col("tree")).alias("section_hashes"))


def first_difference(a: Column, b: Column) -> tuple[Column, Column]:
    """Where two trees part, from the top down: the section, and the paragraph in it, counted from 0; null if equal."""
    def place(x: Column, y: Column) -> Column:
        return F.array_position(F.transform(F.arrays_zip(x.alias("x"), y.alias("y")),
                                            lambda z: ~z["x"].eqNullSafe(z["y"])), True) - 1

    section = place(sections(a), sections(b))
    section = F.when(section >= 0, section)
    hashes = [F.transform(F.coalesce(F.get(t, section.cast("int")), F.slice(F.get(t, F.lit(0)), 1, 0)), lambda p: p["hash"])
              for t in (a, b)]
    paragraph = place(*hashes)
    return section, F.when(section.isNotNull() & (paragraph >= 0), paragraph)


def _bucket(doc_id: Column, bounds: list[int]) -> Column:
    """How many bounds are not above the id, by binary search."""
    known = F.array(*[F.lit(x).cast("long") for x in bounds])
    steps = F.array(*[F.lit(1 << n) for n in reversed(range(len(bounds).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.coalesce(F.get(known, at + step - 1) <= doc_id, F.lit(False)), at + step).otherwise(at))


def with_next_text(rows: DataFrame) -> DataFrame:
    """(doc_id, text) -> with ``next_text``: that of the next row by descending id, after the last the first one's.

    Ids are dealt into ranges of about equal counts; a range's rows are ordered in one task, and a copy of each
    range's first row is sent along with the range above it, so texts are shuffled once.
    """
    spark, scratch = rows.sparkSession, Scratch(rows.sparkSession, "fingerprints")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = rows.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5], 10_000)).first()[0]
    bounds = sorted(set(found or []))
    bucket = _bucket(F.col("doc_id"), bounds) if bounds else F.lit(0)
    tops = rows.groupBy(bucket.alias("bucket")).agg(F.max("doc_id").alias("top"))
    above = F.lead("bucket").over(Window.orderBy("bucket"))
    lowest = F.min("bucket").over(Window.partitionBy())
    tops = scratch.store(tops.select("top", F.coalesce(above, lowest).alias("above")), "tops")
    places = F.array(F.struct(bucket.alias("bucket"), F.lit(False).alias("copy")),
                     F.struct(F.col("above").alias("bucket"), F.lit(True).alias("copy")))
    order = Window.partitionBy("bucket").orderBy("copy", F.col("doc_id").desc_nulls_last(), "text")
    # At most one row per range, so the ranges' first rows are broadcast.
    both = rows.join(F.broadcast(tops), F.col("doc_id") == F.col("top"), "left").select(
        "doc_id", "text", F.explode(F.slice(places, F.lit(1), F.when(F.col("top").isNull(), 1).otherwise(2))).alias("at")).select(
        "doc_id", "text", "at.*")
    return both.withColumn("next_text", F.lead("text").over(order)).filter("NOT copy").select(
        "doc_id", "text", F.coalesce("next_text", F.lit("")).alias("next_text"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null texts count as empty.  Rows repeated with one id follow one another by text; rows without id come last.  A
    single row is its own next one.  No rows give no rows."""
    rows = with_next_text(texts(table(spark, sf_dir, "documents")))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substr("text", F.lit(1), n - half), F.substr("next_text", F.lit(1), half)))
    trees = rows.select("doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                        *[tree(F.col(c)).alias(f"{c}_tree") for c in ("text", "edited", "next_text")])
    own, edited, after = (F.col(f"{c}_tree") for c in ("text", "edited", "next_text"))
    section, paragraph = first_difference(own, edited)
    return trees.select(
        "doc_id", "n_chars", "edited_sha256", root(own).alias("fingerprint"), root(edited).alias("edited_fingerprint"),
        likeness(own, edited).alias("near_edited"), likeness(own, after).alias("near_next"),
        section.alias("changed_section"), paragraph.alias("changed_paragraph"))
