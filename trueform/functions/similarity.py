"""Token-sort similarity (E4) as native expressions.

score(a, b) = round_half_even(100 * 2*LCS(a', b') / (len a' + len b')), where
x' lower-cases x, drops non-ASCII characters, turns every other non-word
character into a space, splits on whitespace, sorts the tokens and joins them
with one space. An empty side scores 0.

The LCS is bit-parallel: the positions of each character of one string are bits of
words of 62 bits, and one step a character of the other string updates all words by
and, or and an addition with carry. A step costs as many word operations as the key of
an option has words (nearly always one), so texts of thousands of characters are
compared in full. It only ever runs on *distinct* candidate values times the options
of one field, never on raw rows.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column
from pyspark.sql import functions as F

#: bits held by one word: a word, its masked copy and a carry add up below 2^63
WORD_BITS = 62


def token_sort_key(c: Column) -> Column:
    ascii_only = F.regexp_replace(c, r"[^\x00-\x7F]", "")
    spaced = F.lower(F.regexp_replace(ascii_only, r"[^A-Za-z0-9_]", " "))
    tokens = F.filter(F.split(F.btrim(spaced), r"\s+"), lambda t: t != F.lit(""))
    return F.array_join(F.array_sort(tokens), " ")


def option_key(option: str) -> str:
    """:func:`token_sort_key` of an option of the spec, while planning."""
    ascii_only = re.sub(r"[^\x00-\x7F]", "", option)
    return " ".join(sorted(re.sub(r"[^A-Za-z0-9_]", " ", ascii_only).lower().split()))


def _words(length: int) -> list[int]:
    return [(1 << min(WORD_BITS, length - start)) - 1 for start in range(0, length, WORD_BITS)]


def option_sql(position: int, option: str) -> str:
    """An option as a literal struct: its position, text, key length, character counts and bit masks."""
    key = option_key(option)
    masks = {ch: [0] * len(_words(len(key))) for ch in key}
    for i, ch in enumerate(key):
        masks[ch][i // WORD_BITS] |= 1 << (i % WORD_BITS)
    longs = lambda words: f"array({', '.join(f'{w}L' for w in words)})" if words else "CAST(array() AS array<bigint>)"
    bag = ", ".join(f"named_struct('ch', '{ch}', 'n', {n})" for ch, n in Counter(key).items())
    mask = ", ".join(f"'{ch}', {longs(words)}" for ch, words in masks.items())
    quoted = option.replace("\\", "\\\\").replace("'", "\\'")
    return (f"named_struct('pos', {position}, 'option', '{quoted}', 'len', {len(key)}, "
            f"'bag', CAST(array({bag}) AS array<struct<ch:string,n:int>>), "
            f"'masks', CAST(map({mask}) AS map<string,array<bigint>>), 'full', {longs(_words(len(key)))})")


def _characters(c: Column) -> Column:
    return F.split(c, "")


def _masks(b: Column) -> tuple[Column, Column]:
    """Bit masks of each character of a non-empty string, and the words with all its bits set."""
    words = F.sequence(F.lit(0), F.floor((F.length(b) - 1) / F.lit(WORD_BITS)).cast("int"))
    bit = lambda n: F.call_function("shiftleft", F.lit(1).cast("bigint"), n)
    word = lambda ch, w: F.aggregate(
        F.sequence(F.lit(0), F.lit(WORD_BITS - 1)), F.lit(0).cast("bigint"),
        lambda acc, j: F.when(F.substring(b, w * WORD_BITS + j + 1, 1) == ch, acc.bitwiseOR(bit(j))).otherwise(acc))
    masks = F.map_from_entries(F.transform(
        F.array_distinct(_characters(b)), lambda ch: F.struct(ch, F.transform(words, lambda w: word(ch, w)))))
    full = F.transform(words, lambda w: bit(F.least(F.lit(WORD_BITS), F.length(b) - w * WORD_BITS)) - 1)
    return masks, full


def _common(characters: Column, masks: Column, full: Column, length: Column) -> Column:
    """LCS length of a list of characters and the string of ``length`` behind ``masks``."""
    hits = F.filter(F.transform(characters, lambda ch: F.try_element_at(masks, ch)), lambda m: m.isNotNull())

    def word(v, m, whole, carry):
        total = v + v.bitwiseAND(m) + carry
        return total, total.bitwiseAND(whole).bitwiseOR(v.bitwiseAND(F.bitwise_not(m)))

    def all_words(words, m):
        def one(acc, w):
            total, new = word(words[w], m[w], full[w], acc["carry"])
            return F.struct(F.shiftright(total, WORD_BITS).alias("carry"), F.concat(acc["words"], F.array(new)).alias("words"))
        start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("words"))
        return F.aggregate(F.sequence(F.lit(0), F.size(full) - 1), start, one)["words"]

    step = lambda words, m: F.when(
        F.size(full) == 1, F.array(word(words[0], m[0], full[0], F.lit(0).cast("bigint"))[1])).otherwise(all_words(words, m))
    left = F.aggregate(hits, full, step)
    return length - F.aggregate(left, F.lit(0), lambda acc, v: acc + F.bit_count(v))


def _bag(text: Column, counts: Column) -> Column:
    """Characters that a text shares with a bag of counted ones: the LCS is at most this long."""
    occurrences = lambda ch: F.length(text) - F.length(F.replace(text, ch, F.lit("")))
    return F.aggregate(counts, F.lit(0), lambda acc, x: acc + F.least(x["n"], occurrences(x["ch"])))


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two strings (0 if either is empty)."""
    # the masks are bound once, not built again at every step
    bound = F.transform(F.array(F.struct(*[c.alias(n) for c, n in zip(_masks(b), ("masks", "full"))])),
                        lambda x: _common(_characters(a), x["masks"], x["full"], F.length(b)))[0]
    return F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0)).otherwise(bound)


def _percent(common: Column, total: Column) -> Column:
    return F.bround(F.lit(100.0) * ((F.lit(2.0) * common) / total), 0).cast("int")


def ratio_score(a_key: Column, b_key: Column) -> Column:
    """0-100 similarity of two already normalised keys (half-even rounding)."""
    total = F.length(a_key) + F.length(b_key)
    return F.when(total == 0, F.lit(0)).otherwise(_percent(lcs_length(a_key, b_key), total))


def option_score(key: Column, option: Column, floor: int | None = None) -> Column:
    """:func:`ratio_score` of a key and an option from :func:`option_sql`.

    With ``floor``, a pair whose character counts alone keep it at or below ``floor``
    scores 0 and is not aligned; scores above ``floor`` are exact.
    """
    total = F.length(key) + option["len"]
    score = F.when((F.length(key) == 0) | (option["len"] == 0), F.lit(0))
    if floor is not None:
        score = score.when(_percent(_bag(key, option["bag"]), total) <= floor, F.lit(0))
    return score.otherwise(_percent(_common(_characters(key), option["masks"], option["full"], option["len"]), total))


def token_sort_score(a: Column, b: Column) -> Column:
    return ratio_score(token_sort_key(a), token_sort_key(b))
