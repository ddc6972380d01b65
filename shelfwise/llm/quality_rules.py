"""Quality rules over documents, as a short-circuit cascade.

A document is kept if no rule rejects it. Rules are asked in an order that is estimated on
a sample: each rule is run over the sample alone, which gives its cost (seconds) and its
selectivity (the share of documents that it rejects); rules with more rejections a second
come first. The cascade is one conditional expression, so a rule is only worked out for
documents that no earlier rule rejects. The order decides what is worked out, never what is
kept: whatever the sample and the clock say, the verdicts are the same.

Everything is DataFrame expressions on a document's own row: no shuffle and no Python.
Repeated windows are looked for by 64-bit hashes of eight words, chained from hashes of
words; the chance that two different windows of a text of 20,000 words share one is 1 in
10^11.

The sample: about ``SAMPLE`` documents, chosen by the hash of their ids. Thresholds are fixed
values from published rule sets, loosened where short or accented texts would suffer.

Cases: a null text has no words and, like any text of fewer than 20 words, is not kept;
repeated rows and ids, and rows without an id, are judged row by row; ``keep_documents``
returns the columns of its input whatever their names. An empty table, or a sample without
documents, leaves rules in the order in which they are given. Memory is about a hundred bytes
a word of the longest text.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.columns import ids_and_texts
from shelfwise.llm.staging import discard, staged

SAMPLE = 2_000
WINDOW = 8
SPACES = "\\x20\\x09-\\x0D"
SYMBOLS = "[#*$%&|<>]"

Measures = dict[str, Column]


@dataclass(frozen=True)
class Rule:
    """What a rule is called, and whether it rejects a document of these measures."""

    name: str
    rejects: Callable[[Measures], Column]


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, f"[{SPACES}]+"), "")


def _chained(hashes: Column, apart: int) -> Column:
    """Hashes of two neighbouring stretches of ``apart`` words, from those of each."""
    rest = F.greatest(F.size(hashes) - apart, F.lit(0))
    return F.zip_with(F.slice(hashes, F.lit(1), rest), F.slice(hashes, F.lit(1 + apart), rest), lambda a, b: F.xxhash64(a, b))


def _windows(words: Column) -> Column:
    """A hash of every window of eight words."""
    ones = F.transform(words, lambda word: F.xxhash64(word))
    return let(ones, lambda one: let(_chained(one, 1), lambda two: let(_chained(two, 2), lambda four: _chained(four, 4))))


def _covered(windows: Column) -> Column:
    """How many words lie in windows that are found twice or more."""
    numbered = F.zip_with(windows, F.sequence(F.lit(0), F.size(windows) - 1), lambda h, i: F.struct(h.alias("h"), i.alias("i")))

    def equal(places: Column, k: Column, x: Column) -> Column:
        return F.coalesce(F.get(places, k).getField("h") == x.getField("h"), F.lit(False))

    def again(places: Column) -> Column:
        return F.filter(places, lambda x, k: equal(places, k - 1, x) | equal(places, k + 1, x))

    def spread(starts: Column) -> Column:
        gaps = F.zip_with(starts, F.slice(starts, F.lit(2), F.size(starts)), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(gaps, F.lit(0), lambda x, y: x + y)

    found = let(F.sort_array(numbered), lambda places: F.transform(again(places), lambda x: x.getField("i")))
    return let(F.sort_array(found), spread)


def _repeat_words(words: Column) -> Column:
    return let(_windows(words), lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(_covered(w)))


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(f"[^{SPACES}]")))


def measures_of(text: Column, words: Column) -> Measures:
    """All measures of a text without nulls and its words, worked out where they are used."""
    return {
        "text": text,
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        "n_lines": F.size(_lines(text)).cast("long"),
        "n_dup_lines": let(_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": _repeat_words(words).cast("long"),
        "n_capitals": F.regexp_count(text, F.lit("[A-Z]")),
        "n_small": F.regexp_count(text, F.lit("[a-z]")),
        "n_exclamations": F.regexp_count(text, F.lit("!")),
        "n_without_letters": F.regexp_count(text, F.lit(f"(?<![^{SPACES}])[^A-Za-z\\x80-\\x{{10FFFF}}{SPACES}]++(?![^{SPACES}])")),
        "n_cut_lines": F.size(F.filter(_lines(text), lambda line: F.rlike(line, F.lit(f"(?:\\.\\.\\.|…)[{SPACES}]*\\z")))),
    }


#: What the base rules read, and every document is measured by.
BASE_MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

#: Base rules.
BASE_RULES = [
    Rule("few words", lambda m: m["n_words"] < 20),
    Rule("repeated words", lambda m: 100 * m["n_repeat_words"] > 30 * m["n_words"]),
]

#: Rules on top of them.
MORE_RULES = [
    Rule("symbols", lambda m: 10 * m["n_symbols"] > m["n_words"]),
    Rule("word length", lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 25 * m["n_words"])),
    Rule("repeated lines", lambda m: 10 * m["n_dup_lines"] > 4 * m["n_lines"]),
    Rule("capitals", lambda m: 10 * m["n_capitals"] > 3 * (m["n_capitals"] + m["n_small"])),
    Rule("exclamations", lambda m: 10 * m["n_exclamations"] > m["n_words"]),
    Rule("words without letters", lambda m: 10 * m["n_without_letters"] > 2 * m["n_words"]),
    Rule("cut lines", lambda m: 10 * m["n_cut_lines"] > 3 * m["n_lines"]),
]

RULES = [*BASE_RULES, *MORE_RULES]


def first_rejection(rules: Iterable[Rule], measures: Measures) -> Column:
    """The name of the first rule that rejects, or null; later rules are not worked out."""
    chain = F
    for rule in rules:
        chain = chain.when(rule.rejects(measures), F.lit(rule.name))
    return F.lit(None).cast("string") if chain is F else chain


def _text(docs: DataFrame, text_column: str) -> Column:
    return F.coalesce(docs[f"`{text_column}`"].cast("string"), F.lit(""))


def _sampled(docs: DataFrame, size: int) -> DataFrame:
    """About ``size`` texts of ``docs``, by the hash of their ids; all, if there are fewer."""
    every = max(1, docs.count() // size)
    return docs.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(every)) == 0).select("text")


def estimated(docs: DataFrame, rules: list[Rule] = RULES, size: int = SAMPLE) -> list[tuple[Rule, float, float]]:
    """(rule, seconds, share rejected) on a sample of ``docs`` (doc_id, text), best first.

    ``docs`` is read once for the sample, which is staged; each rule is run over it by itself.
    """
    sample = staged(_sampled(docs, size).repartition(4), "sample")
    text = F.coalesce("text", F.lit(""))

    def rejected(rule: Rule) -> tuple[int, int]:
        fails = let(words_of(text), lambda words: rule.rejects(measures_of(text, words)))
        return tuple(sample.agg(F.count_if(fails), F.count("*")).first())

    found = []
    for place, rule in enumerate(rules):
        rejected(rule)  # compiles what the next run is timed without
        started = time.perf_counter()
        gone, all_ = rejected(rule)
        found.append((rule, time.perf_counter() - started, gone / max(all_, 1), place, all_))
    discard(sample)
    if not all(x[4] for x in found):
        return [x[:3] for x in found]
    return [x[:3] for x in sorted(found, key=lambda x: (-x[2] / x[1], x[1], x[3]))]


def ordered_rules(docs: DataFrame, rules: list[Rule] = RULES, size: int = SAMPLE) -> list[Rule]:
    return [rule for rule, *_ in estimated(docs, rules, size)]


def rule_report(docs: DataFrame, rules: list[Rule] = RULES, size: int = SAMPLE) -> DataFrame:
    """(rule, seconds, rejected, place): what the sample says of each rule."""
    rows = [(rule.name, seconds, share, k) for k, (rule, seconds, share) in enumerate(estimated(ids_and_texts(docs), rules, size), 1)]
    return docs.sparkSession.createDataFrame(rows, "rule string, seconds double, rejected double, place int")


def keep_documents(docs: DataFrame, rules: list[Rule] = RULES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that no rule rejects, rules in their estimated order."""
    order = ordered_rules(ids_and_texts(docs, id_column, text_column), rules)
    text = _text(docs, text_column)
    return docs.where(let(words_of(text), lambda words: first_rejection(order, measures_of(text, words))).isNull())


def judged_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, the base measures, base_failed and kept of each row.

    The base measures are worked out for every document; what other rules read, only where
    no earlier rule rejects.
    """
    pairs = ids_and_texts(docs, id_column, text_column)
    order = ordered_rules(pairs)
    cut = pairs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("words", words_of(F.col("text")))
    all_ = measures_of(F.col("text"), F.col("words"))
    measured = cut.select("*", *[all_[name].alias(name) for name in BASE_MEASURES])
    known = all_ | {name: F.col(name) for name in BASE_MEASURES}
    failed = BASE_RULES[0].rejects(known) | BASE_RULES[1].rejects(known)
    return measured.select("doc_id", *BASE_MEASURES, failed.alias("base_failed"), first_rejection(order, known).isNull().alias("kept"))
