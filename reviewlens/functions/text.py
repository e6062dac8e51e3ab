"""Text columns: cleaning, expansion, sentences, tokens.

Functions that use a costly argument more than once take it as a column the caller has already projected, so it is
computed once per row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewlens import config as cfg
from reviewlens.functions.coerce import WHITE, strip

_W = r"(?U:[\s\x1c-\x1f])"  # the same characters as WHITE, in the form that runs fastest
SPACE = rf"{_W}+"
LEAKED_TAIL = rf"^{_W}+[A-Z][^.!?]{{10,120}}[^.!?{WHITE}]$"
BOUNDARY = rf"(?<=[.!?]){_W}+(?=[A-Z])"
WORD = r"[\p{L}\p{N}_]{2,}"


def collapse(c: Column) -> Column:
    """Literal ``\\n`` and ``\\r`` escapes and runs of white space become one space."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"\\r\\n|\\n|\\r", " "), SPACE, " "))


def null_tokens(c: Column) -> Column:
    return F.when(~c.isin(*cfg.NULL_TOKENS), c)


def clean(c: Column) -> Column:
    """Collapsed text; null tokens become null."""
    return null_tokens(collapse(c))


def _after_last_stop(c: Column) -> Column:
    return F.substring_index(c, ".", -1)


def has_title_leak(c: Column) -> Column:
    """Whether what follows the last full stop looks like a title: capital first, some length, no end mark."""
    c = strip(c)
    return F.contains(c, F.lit(".")) & F.rlike(_after_last_stop(c), F.lit(LEAKED_TAIL))


def strip_title(c: Column) -> Column:
    """Drop a title that leaked onto the end of the text after its last full stop."""
    s = strip(c)
    return F.when(has_title_leak(c), F.substring(s, F.lit(1), F.length(s) - F.length(_after_last_stop(s)))).otherwise(s)


def _abbreviation(pattern: str) -> str:
    return rf"(?iU)\b{pattern}\b"


ANY_ABBREVIATION = r"(?iU)\b(?:" + "|".join(p for p, _ in cfg.ABBREVIATIONS) + r")\b"


def expand_abbreviations(c: Column) -> Column:
    """All replacements in order; one combined test spares the rows that need none of them."""
    expanded = reduce(lambda acc, pr: F.regexp_replace(acc, _abbreviation(pr[0]), pr[1]), cfg.ABBREVIATIONS, c)
    return F.when(F.rlike(c, F.lit(ANY_ABBREVIATION)), expanded).otherwise(c)


def min_chars(c: Column, n: int = cfg.MIN_CHARS) -> Column:
    return F.when(F.length(c) >= n, c)


def aspect_term(label: Column) -> Column:
    c = F.regexp_replace(F.lower(label), r"[&,/\\|]+", " ")
    return F.coalesce(strip(F.regexp_replace(c, SPACE, " ")), F.lit("general"))


def nonblank(c: Column) -> Column:
    return c.isNotNull() & (strip(c) != "")


def long_pieces(stripped: Column, min_len: int) -> Column:
    """The sentences of a stripped text that have at least ``min_len`` characters."""
    pieces = F.transform(F.split(stripped, BOUNDARY), lambda s: strip(s))
    return F.filter(pieces, lambda s: F.length(s) >= F.lit(min_len))


def pieces_or_whole(pieces: Column, stripped: Column, min_len: int) -> Column:
    """The pieces; if there are none, the whole text when it is long enough."""
    whole = F.when(F.length(stripped) >= min_len, F.array(stripped)).otherwise(F.array().cast("array<string>"))
    return F.when(F.size(pieces) > 0, pieces).otherwise(whole)


def words(c: Column) -> Column:
    """Lower-case runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(c), F.lit(WORD), F.lit(0))


def content_words(c: Column, stop: list[str]) -> Column:
    return F.filter(words(c), lambda w: ~w.isin(*stop))


def with_phrases(kept: Column) -> Column:
    """The words and the two-word phrases they form."""
    most = F.greatest(F.size(kept) - 1, F.lit(0))
    pairs = F.zip_with(
        F.slice(kept, F.lit(1), most), F.slice(kept, F.lit(2), most), lambda a, b: F.concat(a, F.lit(" "), b)
    )
    return F.concat(kept, pairs)


def keyword_list(keywords: Column) -> Column:
    return F.transform(F.split(keywords, ","), lambda k: F.trim(k))


def keyword_overlap(sentence: Column, keywords: Column) -> Column:
    """Share of keywords found in the sentence as substrings; null when there are no keywords."""
    kws = F.filter(F.transform(F.split(F.lower(keywords), ","), lambda k: strip(k)), lambda k: k != "")
    hits = F.filter(kws, lambda k: F.contains(F.lower(sentence), k))
    return F.when(F.size(kws) > 0, F.size(hits) / F.size(kws).cast("double"))


def label_of(keywords: Column) -> Column:
    """First three keywords joined with `` | ``; the two sentinels pass through."""
    joined = F.array_join(F.slice(keyword_list(keywords), 1, 3), " | ")
    return F.when(
        keywords.isNull() | keywords.isin("", cfg.OUTLIER_KEYWORDS, cfg.UNLABELLED), keywords
    ).otherwise(joined)


def names_only_products(keywords: Column, stop: list[str] = cfg.PRODUCT_STOP, mode: str = "substring") -> Column:
    """True when each of the top three keywords contains a product stop term.

    ``substring`` matches inside words too; ``token`` asks for whole words.
    """
    top = F.slice(F.transform(F.split(F.lower(keywords), ","), lambda k: F.trim(k)), 1, 3)
    phrases = F.array(*[F.lit(s) for s in stop])
    if mode == "substring":
        return F.forall(top, lambda t: F.exists(phrases, lambda p: F.contains(t, p)))
    pad = lambda x: F.concat(F.lit(" "), x, F.lit(" "))
    return F.forall(top, lambda t: F.exists(phrases, lambda p: F.contains(pad(t), pad(p))))


def json_payload(c: Column) -> Column:
    """VARIANT held by a free-text response: as is, else in a fenced block, else in an <output> body."""
    fenced = F.regexp_extract(c, r"```(?:json)?\s*([\s\S]+?)\s*```", 1)
    tagged = F.regexp_extract(c, r"<output>([\s\S]+?)</output>", 1)
    return F.coalesce(
        F.try_parse_json(F.trim(c)), F.try_parse_json(F.nullif(fenced, F.lit(""))), F.try_parse_json(strip(tagged))
    )


def reasoning(c: Column) -> Column:
    return F.nullif(strip(F.regexp_extract(c, r"<reasoning>([\s\S]+?)</reasoning>", 1)), F.lit(""))
