"""Which rows' keys are not in a stored table: a Bloom filter in front of an exact anti-join.

The filter is blocked: a key has one 64-bit word and a few bits in it, so it is built by one
``bit_or`` a word and asked by one lookup a row. It never misses a stored key. Rows whose bits are
not all set are new for certain and skip the join; only the rest are shuffled and compared with the
stored keys. The number of words follows the stored keys up to ``MOST_WORDS``, which bounds
what is broadcast (16 bytes a word); beyond it more rows take the exact way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS_A_WORD, BITS_A_KEY = 6, 4
MOST_WORDS = 1 << 21


def _word(keys: Sequence[str], words: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(words))


def _mask(keys: Sequence[str]) -> Column:
    """The bits of a key: six bits of a second hash name each."""
    drawn = F.xxhash64(*keys, F.lit("bits"))
    mask = F.lit(0).cast("long")
    for k in range(BITS_A_KEY):
        place = F.shiftright(drawn, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return mask


def words_for(keys: int) -> int:
    words = 1
    while words * KEYS_A_WORD < keys and words < MOST_WORDS:
        words *= 2
    return words


def key_filter(stored: DataFrame, keys: Sequence[str], words: int) -> DataFrame:
    """(word, bits): the filter of the keys of ``stored``."""
    return stored.groupBy(_word(keys, words).alias("word")).agg(F.bit_or(_mask(keys)).alias("bits"))


def marked(rows: DataFrame, stored: DataFrame, keys: Sequence[str], n_stored: int) -> DataFrame:
    """``rows`` with ``maybe_stored``: false only where no stored row has the key."""
    words = words_for(n_stored)
    bits = F.broadcast(key_filter(stored, keys, words))  # MOST_WORDS bounds it
    asked = rows.withColumn("word", _word(keys, words)).join(bits, "word", "left")
    held = F.coalesce(F.col("bits").bitwiseAND(_mask(keys)) == _mask(keys), F.lit(False))
    return asked.withColumn("maybe_stored", held).drop("word", "bits")


def unseen(rows: DataFrame, stored: DataFrame, keys: Sequence[str], n_stored: int) -> DataFrame:
    """The rows whose key no row of ``stored`` has; keys are compared as equal, nulls with nulls."""
    asked = marked(rows, stored, keys, n_stored)
    known = stored.select(*[F.col(k).alias(f"stored_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"stored_{k}")) for k in keys]
    checked = asked.where("maybe_stored").join(known, same, "left_anti")
    return asked.where("not maybe_stored").unionByName(checked).drop("maybe_stored")
