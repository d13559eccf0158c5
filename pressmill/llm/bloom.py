"""Once-seen and twice-seen Bloom filters as tables, made with built-in functions only.

A key (a 64-bit hash) owns ``PROBES`` bits of one 64-bit word. Counting bits over all keys gives two filters: bits seen
at least once and bits seen at least twice. A key whose bits were all seen twice may be repeated; one with a bit seen
once is certainly unique. The filter has a fixed bound of words (``MAX_WORDS``, 8 bytes each), so it can be broadcast at
any corpus size; when a corpus is too large for it, more keys are suspected and results stay exact.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROBES = 3
BITS_PER_KEY = 16
#: few, because packing looks every slot up in a small map
WORDS_PER_ROW = 32
#: 2^22 words are 32 MB: the proven size of the broadcast
MAX_WORDS = 1 << 22


def filter_words(keys: int, max_words: int = MAX_WORDS) -> int:
    """Words for so many keys: a power of two from one row's words up to the bound."""
    words = WORDS_PER_ROW
    while words * 64 < keys * BITS_PER_KEY and words < max_words:
        words *= 2
    return words


def _word(key: Column, words: int) -> Column:
    return F.shiftrightunsigned(key, 20).bitwiseAND(words - 1)


def _bit(key: Column, probe: int) -> Column:
    return F.shiftrightunsigned(key, 6 * probe).bitwiseAND(63).cast("int")


def _mask(key: Column) -> Column:
    mask = F.lit(0).cast("long")
    for probe in range(PROBES):
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), _bit(key, probe)))
    return mask


def build(keys: DataFrame, key: str, words: int) -> DataFrame:
    """Rows (filter_row, once, twice): arrays of ``WORDS_PER_ROW`` words of the two filters.

    Each count is combined before the shuffle, so a key with a third of all rows moves one number per task."""
    bits = keys.select(_word(F.col(key), words).alias("word"), F.explode(F.array_distinct(F.array(
        *[_bit(F.col(key), p) for p in range(PROBES)]))).alias("bit"))
    seen = bits.groupBy("word", "bit").agg(F.count(F.lit(1)).alias("n"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))
    by_word = seen.groupBy("word").agg(F.bit_or(one).alias("once"), F.bit_or(F.when(F.col("n") > 1, one).otherwise(0)).alias("twice"))
    slot = F.col("word").bitwiseAND(WORDS_PER_ROW - 1).cast("int")

    def packed(name: str) -> Column:
        held = F.map_from_entries(F.collect_list(F.struct(slot, F.col(name))))
        return F.transform(F.sequence(F.lit(0), F.lit(WORDS_PER_ROW - 1)), lambda i: F.coalesce(held[i], F.lit(0).cast("long"))).alias(name)

    rows = by_word.groupBy(F.call_function("shiftright", F.col("word"), F.lit(WORDS_PER_ROW.bit_length() - 1)).alias("filter_row"))
    return rows.agg(packed("once"), packed("twice"))


def suspected(rows: DataFrame, key: str, filters: DataFrame, words: int, flag: str = "suspected", seen: str = "twice") -> DataFrame:
    """``rows`` with a flag: whether all bits of the key were seen twice (or ``once``). The filter is broadcast; rows don't move."""
    word, mask = _word(F.col(key), words), _mask(F.col(key))
    row = F.call_function("shiftright", word, F.lit(WORDS_PER_ROW.bit_length() - 1))
    held = F.get(seen, word.bitwiseAND(WORDS_PER_ROW - 1).cast("int"))
    return rows.join(F.broadcast(filters.select("filter_row", seen)), row == F.col("filter_row"), "left").withColumn(
        flag, F.coalesce(held.bitwiseAND(mask) == mask, F.lit(False))).drop("filter_row", seen)
