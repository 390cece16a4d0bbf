"""A Bloom filter as a table of bounded size, built and applied with built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits for each key, and the most bytes of a filter, which is broadcast. A fuller filter lets more through.
BITS_PER_KEY, MAX_BYTES = 16, 64 << 20
#: Words of 64 bits in one row of the table.
ROW_WORDS = 512
_BITS = 4
_GROUP, _PLACE, _MASK, _WORDS = "_group", "_place", "_mask", "_words"


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words))


def _mask(key: Column) -> Column:
    """A word with up to four bits set, taken from a second hash."""
    hashed, mask = F.xxhash64(F.lit(1), key), F.lit(0).cast("bigint")
    for i in range(_BITS):
        bit = F.pmod(F.shiftrightunsigned(hashed, 6 * i), F.lit(64)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit))
    return mask


def filter_words(keys: int, max_bytes: int = MAX_BYTES) -> int:
    """Words of a filter for so many keys: whole rows, within the bound."""
    wanted = -(-keys * BITS_PER_KEY // 64)
    return min(max(-(-wanted // ROW_WORDS), 1), max(max_bytes // (8 * ROW_WORDS), 1)) * ROW_WORDS


def key_filter(keys: DataFrame, key: str, words: int) -> DataFrame:
    """The filter of the keys as rows of ``ROW_WORDS`` words; partial filters merge on the way to the rows."""
    place = _word(F.col(key), words)
    single = keys.select(place.alias(_PLACE), _mask(F.col(key)).alias(_MASK))
    merged = single.groupBy(_PLACE).agg(F.bit_or(_MASK).alias(_MASK))
    listed = F.map_from_entries(F.collect_list(F.struct((F.col(_PLACE) % ROW_WORDS).cast("int"), _MASK)))
    rows = merged.groupBy(F.floor(F.col(_PLACE) / ROW_WORDS).alias(_GROUP)).agg(listed.alias("listed"))
    words_of = F.transform(F.sequence(F.lit(0), F.lit(ROW_WORDS - 1)), lambda i: F.coalesce(F.element_at("listed", i), F.lit(0)))
    return rows.select(_GROUP, words_of.alias(_WORDS))


def possible_members(df: DataFrame, key: str, table: DataFrame, words: int) -> DataFrame:
    """Rows whose key may be in the filter ``table``: all that are, and few others."""
    place = _word(F.col(key), words)
    placed = df.withColumns({_PLACE: place, _GROUP: F.floor(place / ROW_WORDS), _MASK: _mask(F.col(key))})
    # At most MAX_BYTES of words.
    joined = placed.join(F.broadcast(table), _GROUP)
    word = F.get(F.col(_WORDS), (F.col(_PLACE) % ROW_WORDS).cast("int"))
    return joined.where(word.bitwiseAND(F.col(_MASK)) == F.col(_MASK)).select(*df.columns)
