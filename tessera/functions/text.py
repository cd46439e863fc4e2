"""Normalisation of names and addresses, and candidate street phrases, as native expressions."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import ADMIN_WORDS, CITY_ALIASES, CITY_WORDS, MAX_TOKENS, NAMELESS_ROADS, PREFIX_TOKENS, PROVINCE_WORDS, TERMINATORS

SPACES = r"(?U)[\s\x1c-\x1f]+"


def _bare(c: str) -> str:
    return "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))


@lru_cache(1)
def _letters() -> tuple[str, str]:
    """Characters of the basic plane that NFKD without marks makes one other character, then those it makes none."""
    pairs = [(chr(c), _bare(chr(c))) for c in range(0x80, 0x10000) if not 0xD800 <= c < 0xE000]
    one = [(a, b) for a, b in pairs if len(b) == 1 and a != b]
    return "".join(a for a, _ in one) + "".join(a for a, b in pairs if not b), "".join(b for _, b in one)


@F.pandas_udf(T.StringType())
def _nfkd(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else _bare(x))


def strip_marks(c: Column, exact: bool = False) -> Column:
    """NFKD without combining marks. The native form covers every character that becomes at most one; ``exact`` adds ligatures, fractions and Hangul by an Arrow UDF."""
    return _nfkd(c) if exact else F.translate(c, *_letters())


def collapse_spaces(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, SPACES, " "))


def normalize_text(c: Column, exact: bool = False) -> Column:
    """Upper case without marks; punctuation becomes space, & becomes AND; null becomes ''."""
    s = F.upper(strip_marks(F.coalesce(c.cast("string"), F.lit("")), exact))
    return collapse_spaces(F.regexp_replace(F.replace(s, F.lit("&"), F.lit(" AND ")), r"[/,;:()\-.']", " "))


def join_spaced_letters(c: Column) -> Column:
    """'D K I' becomes 'DKI'; anything with a longer word stays."""
    return F.when(c.rlike(r"^\S(?: \S)+$"), F.replace(c, F.lit(" "), F.lit(""))).otherwise(c)


def compact_text(c: Column) -> Column:
    return F.replace(c, F.lit(" "), F.lit(""))


def _drop_words(c: Column, words: list[str]) -> Column:
    longest_first = sorted(words, key=len, reverse=True)
    return collapse_spaces(F.regexp_replace(c, rf"\b(?:{'|'.join(longest_first)})\b", " "))


def normalize_province(c: Column) -> Column:
    return _drop_words(join_spaced_letters(normalize_text(c)), PROVINCE_WORDS)


def normalize_admin(c: Column) -> Column:
    return _drop_words(join_spaced_letters(normalize_text(c)), ADMIN_WORDS)


def normalize_city(c: Column) -> Column:
    s = _drop_words(normalize_admin(c), CITY_WORDS)
    return F.when(s.isin(*CITY_ALIASES), F.lit("KEPULAUAN SERIBU")).otherwise(s)


def admin_kind(c: Column) -> Column:
    s = normalize_text(c)
    return F.when(s.rlike(r"\bKOTA\b"), "city").when(s.rlike(r"\b(?:KABUPATEN|KAB)\b"), "regency").otherwise("unknown")


def admin_level(c: Column) -> Column:
    """The first run of digits as an integer, or null."""
    return F.regexp_extract(c.cast("string"), r"\d+", 0).try_cast("int")


def drop_road_prefix(c: Column) -> Column:
    """Without all leading prefix words, and without one RAYA after those."""
    return F.regexp_replace(c, rf"^(?:(?:{'|'.join(PREFIX_TOKENS)})(?: |$))+(?:RAYA(?: |$))?", "")


def normalize_road(c: Column) -> Column:
    s = collapse_spaces(drop_road_prefix(normalize_text(c)))
    return F.when(s.isin(*NAMELESS_ROADS), "").otherwise(s)


def words(c: Column) -> Column:
    """Words of a normalised text, none of an empty one."""
    return F.filter(F.split(c, " "), lambda w: w != "")


def index_tokens(c: Column) -> Column:
    """Words of a normalised text that are worth an index: no prefix, no terminator, three letters or a number."""
    return F.filter(words(c), lambda w: ~w.isin(*PREFIX_TOKENS, *TERMINATORS) & ((F.length(w) >= 3) | w.rlike(r"^\d+$")))


def aliases(c: Column) -> Column:
    return F.array_distinct(F.filter(F.array(normalize_text(c), normalize_admin(c)), lambda x: x != ""))


def context_phrases(*columns: Column) -> Column:
    return F.array_distinct(F.flatten(F.array(*(aliases(c) for c in columns))))


def candidate_phrases(c: Column, split_before_normalize: bool = False) -> Column:
    """Street phrases of an address, the longest first, as array<struct<rank, phrase>>.

    Each segment gives up to three variants (whole, without its prefix word,
    without RAYA after it), each cut at its first terminator, and all prefixes
    of at most eight words of each. Segments end at '|' only, because
    normalisation has removed commas and line ends before; with
    ``split_before_normalize`` they end at those too.
    """
    if split_before_normalize:
        segments = F.transform(F.split(F.coalesce(c, F.lit("")), r"[,\n;|]+"), normalize_text)
    else:
        segments = F.transform(F.split(normalize_text(c), r"\|+"), collapse_spaces)
    token_lists = F.filter(F.transform(segments, words), lambda t: F.size(t) > 0)

    def from_word(t: Column, n: int) -> Column:
        return F.slice(t, n + 1, F.greatest(F.size(t) - n, F.lit(0)))

    def variants(t: Column) -> Column:
        prefixed, second_raya = F.element_at(t, 1).isin(*PREFIX_TOKENS), F.try_element_at(t, F.lit(2)) == "RAYA"
        none = F.filter(t, lambda w: F.lit(False))
        return F.array(t, F.when(prefixed, from_word(t, 1)).when(F.element_at(t, 1) == "RAYA", from_word(t, 1)).otherwise(none), F.when(prefixed & second_raya, from_word(t, 2)).otherwise(none))

    def cut(t: Column) -> Column:
        stop = F.array_position(F.transform(t, lambda w: w.isin(*TERMINATORS)), True)
        return F.slice(t, 1, F.least(F.when(stop > 0, stop.cast("int") - 1).otherwise(F.size(t)), F.lit(MAX_TOKENS)))

    def prefixes(t: Column) -> Column:
        return F.transform(F.filter(F.sequence(F.size(t), F.lit(0), F.lit(-1)), lambda n: n > 0), lambda n: F.array_join(F.slice(t, 1, n), " "))

    phrases = F.array_distinct(F.flatten(F.transform(F.flatten(F.transform(token_lists, variants)), lambda t: prefixes(cut(t)))))
    keyed = F.transform(phrases, lambda p, i: F.struct((-F.size(F.split(p, " "))).alias("n"), i.alias("i"), p.alias("phrase")))
    return F.transform(F.array_sort(keyed), lambda s, i: F.struct((i + 1).alias("rank"), s["phrase"].alias("phrase")))
