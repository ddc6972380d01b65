"""License notices in documents, by diagonal voting over word pairs.

Words are runs of a-z, 0-9 and characters beyond ASCII, A-Z in lower case. Each
notice is a template: a label and its words. All rolling pairs of words of all
documents are joined, by a 64-bit hash, with the templates' pairs. A match votes for
a diagonal: its place in the document less its place in the template.

A base phrase stands wherever one diagonal has all its votes. Longer notices may have
words put in, left out or changed: diagonals of a template that differ by at most
``DRIFT`` and whose votes lie at most ``GAP`` words apart merge into one span, which
counts if it holds at least ``COVER`` of the template's pairs.

Everything is DataFrame work. The templates are constants of a checked size and are
broadcast; document pairs are not shuffled, only what matched, beside one row for each
document that carries it through.

Cases: a null text is empty; texts of fewer than two words match nothing; equal rows
are scanned once and each returned; rows of one id with different texts are apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: First sentences of common notices, in words as scanned, and their labels.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under the apache license version 2 0": "apache-2.0",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "licensed under the gnu lesser general public license": "lgpl",
    "subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4.0",
}

SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
KELVIN = "K"  # the one character beyond ASCII whose lower case is an ASCII letter
DRIFT, GAP, COVER = 2, 4, 0.8
MOST_PAIRS = 10_000
CARRIER = 0  # the pair hash of the row that carries a document through


def words_of(text: Column) -> Column:
    """The words of a text, A-Z in lower case."""
    lower = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit(KELVIN), F.lit("κ")))
    return F.array_remove(F.split(lower, SEPARATORS), "")


def _pairs(words: Column) -> Column:
    rest = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, F.lit(1), rest), F.slice(words, F.lit(2), rest), lambda a, b: F.xxhash64(a, b))


def _templates(spark: SparkSession) -> DataFrame:
    """(pair, template, at, n_pairs, label, base): the pairs of all templates, and the carrier's."""
    rows = [(k, text, label, text in BASE) for k, (text, label) in enumerate([*BASE.items(), *NOTICES.items()])]
    if sum(len(text.split()) for _, text, *_ in rows) > MOST_PAIRS:
        raise ValueError("too many template words to broadcast")
    found = spark.createDataFrame(rows, "template int, text string, label string, base boolean")
    found = found.withColumn("pairs", _pairs(F.split("text", " ")))
    found = found.select("template", "label", "base", F.size("pairs").alias("n_pairs"), F.posexplode("pairs").alias("at", "pair"))
    carrier = spark.createDataFrame([(-1, None, False, 0, 0, CARRIER)], found.schema)
    return found.unionAll(carrier)


def _matches(docs: DataFrame) -> DataFrame:
    """A row for each matched pair of each distinct document, and one for the document."""
    document = [F.col("doc_id"), F.xxhash64("text").alias("digest"), F.col("text")]
    words = docs.select(*document).select("doc_id", "digest", words_of(F.col("text")).alias("words"))
    carried = F.concat(F.array(F.lit(CARRIER).cast("long")), _pairs(F.col("words")))
    places = words.select("doc_id", "digest", F.size("words").alias("n_words"), F.posexplode(carried).alias("place", "pair"))
    templates = F.broadcast(_templates(docs.sparkSession))
    # A document's words could hash to the carrier's value; only its place 0 carries.
    hits = places.join(templates, "pair").where((F.col("place") == 0) == (F.col("template") < 0))
    key = ["doc_id", "digest", "n_words", "template", "label", "base", "n_pairs", "at", "place"]
    return hits.groupBy(*key).agg(F.count("*").alias("copies")).withColumn("place", F.col("place") - 1)


def scan_licenses(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of each row.

    ``labels`` holds the base labels and those of longer notices; ``score`` is the largest
    share of a template's pairs in one span, 1 for a base phrase, 0 if nothing counts.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    document = ["doc_id", "digest", "n_words"]
    found = _matches(texts).withColumn("diagonal", F.col("place") - F.col("at"))

    # Spans: neighbouring diagonals of a template whose votes follow one another.
    along = Window.partitionBy(*document, "template").orderBy("place", "at")
    apart = (F.col("place") - F.lag("place").over(along) > GAP) | (F.abs(F.col("diagonal") - F.lag("diagonal").over(along)) > DRIFT)
    starts = found.withColumn("begins", F.coalesce(apart, F.lit(True)).cast("int"))
    spans = starts.withColumn("span", F.when(F.col("base"), F.col("diagonal")).otherwise(F.sum("begins").over(along)))

    by_span = [*document, "template", "label", "base", "n_pairs", "span"]
    judged = spans.groupBy(*by_span).agg(
        F.countDistinct("at").alias("votes"), F.min("diagonal").alias("first"), F.max("copies").alias("copies")
    )
    cover = F.col("votes") / F.col("n_pairs")
    # A base phrase needs all its votes on one diagonal; the carrier stays in any case.
    kept = judged.where((F.col("template") < 0) | F.when(F.col("base"), F.col("votes") == F.col("n_pairs")).otherwise(cover >= COVER))
    base = F.col("base")

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(labels)), ",")

    result = kept.groupBy(*document).agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("first"))).cast("long").alias("last_word"),
        joined(F.when(base, F.col("label"))).alias("base_labels"),
        joined(F.col("label")).alias("labels"),
        F.coalesce(F.max(F.when(F.col("template") >= 0, cover)), F.lit(0.0)).alias("score"),
        F.max("copies").alias("copies"),
    )
    each = result.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    columns = ["n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    return each.select("doc_id", F.col("n_words").cast("long").alias("n_words"), *columns)
