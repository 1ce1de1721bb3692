"""Column expressions for post text: all JVM-side (regex + higher-order functions).

Whitespace follows Python's ``str`` notion (``\\s`` on Unicode text also
matches the separators U+001C..U+001F, NBSP, U+2000.. etc.), so Java regexes
run in ``(?U)`` mode with the four separators added explicitly.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from chirpscope import constants as C

# Python-style whitespace / non-whitespace classes for Java regex
WS = r"[\s\x1c-\x1f]"
NON_WS = r"[^\s\x1c-\x1f]"
U = "(?U)"
# sentence break marker: a private-use character; texts are ASCII when it is used
_MARK = "\ue000"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_or_empty(c) -> Column:
    """Null text counts as the empty string (FN9)."""
    return F.coalesce(_col(c).cast("string"), F.lit(""))


# --- extraction (FN1, FN2, FN3, SRT9) ---------------------------------------

def extract_mentions(c) -> Column:
    """All ``@handle`` captures, case kept, at most 15 characters each (FN1)."""
    return F.regexp_extract_all(text_or_empty(c), F.lit(C.MENTION_PATTERN), 1)


def extract_hashtags(c) -> Column:
    """All ``#tag`` captures, lower-cased, ASCII word characters only (FN2)."""
    return F.transform(
        F.regexp_extract_all(text_or_empty(c), F.lit(C.HASHTAG_PATTERN), 1),
        lambda t: F.lower(t))


def distinct_sorted(arr) -> Column:
    """Distinct values of an array, sorted (FN3 + SRT9)."""
    return F.array_sort(F.array_distinct(_col(arr)))


def array_pairs(arr) -> Column:
    """All pairs (a, b) with a before b of an array, as ``array<struct<u, v>>`` (FN20).

    Used on *sorted distinct* arrays so every pair satisfies ``u < v``.  The
    caller bounds the array size (see ``operators.pairs``): the result has
    k(k-1)/2 elements.
    """
    a = _col(arr)
    return F.flatten(F.transform(
        a, lambda x, i: F.transform(
            F.slice(a, i + 2, F.greatest(F.size(a), F.lit(1))),
            lambda y: F.struct(x.alias("u"), y.alias("v")))))


# --- prefixes and CASEs (PRJ6, FN12, FN13) ------------------------------------

def user_key(c) -> Column:
    return F.concat(F.lit(C.USER_ID_PREFIX), _col(c).cast("string"))


def handle_key(c) -> Column:
    return F.concat(F.lit(C.HANDLE_PREFIX), _col(c))


def tag_key(c) -> Column:
    return F.concat(F.lit(C.TAG_PREFIX), _col(c))


def node_type(c) -> Column:
    """Prefix CASE: ``@`` user, ``user:`` user_id, ``#`` hashtag, else other (FN12)."""
    s = _col(c).cast("string")
    return (F.when(s.startswith(C.HANDLE_PREFIX), F.lit(C.NODE_TYPE_USER))
            .when(s.startswith(C.USER_ID_PREFIX), F.lit(C.NODE_TYPE_USER_ID))
            .when(s.startswith(C.TAG_PREFIX), F.lit(C.NODE_TYPE_HASHTAG))
            .otherwise(F.lit(C.NODE_TYPE_OTHER)))


def polarity_class(c, threshold: float = C.POLARITY_THRESHOLD) -> Column:
    """Strict thresholds: > t positive, < -t negative, else (incl. null/NaN) neutral (FN13)."""
    p = _col(c)
    # Spark orders NaN above every number: test it first so NaN stays neutral
    return (F.when(F.isnan(p), F.lit(C.NEUTRAL))
            .when(p > F.lit(threshold), F.lit(C.POSITIVE))
            .when(p < F.lit(-threshold), F.lit(C.NEGATIVE))
            .otherwise(F.lit(C.NEUTRAL)))


# --- cleaning (FN4, FN5, FN6, SET5, FLT9, FN7, FN10) ---------------------------

def squeeze_ws(c) -> Column:
    """Runs of whitespace → one space, then strip."""
    return F.trim(F.regexp_replace(_col(c), U + WS + "+", " "))


def clean_text(c) -> Column:
    """Drop links, ``#tags``, ``@handles`` (each up to the next whitespace), squeeze, strip (FN4)."""
    t = text_or_empty(c)
    t = F.regexp_replace(t, U + "http" + NON_WS + "+", "")
    t = F.regexp_replace(t, U + "#" + NON_WS + "+", "")
    t = F.regexp_replace(t, U + "@" + NON_WS + "+", "")
    return squeeze_ws(t)


def summary_ascii(c) -> Column:
    """Summary clean-up, first half: links and tags out, non-ASCII runs → space, squeeze (FN5)."""
    t = text_or_empty(c)
    t = F.regexp_replace(t, U + "http" + NON_WS + "+", "")
    t = F.regexp_replace(t, U + "#" + NON_WS + "+", "")
    t = F.regexp_replace(t, r"[^\x00-\x7F]+", " ")
    return squeeze_ws(t)


def split_sentences(c) -> Column:
    """Split after ``.``, ``!`` or ``?`` followed by whitespace; drop blank pieces (FN6, FLT9)."""
    marked = F.regexp_replace(_col(c), r"([.!?])" + WS + "+", "$1" + _MARK)
    parts = F.split(marked, _MARK)
    return F.filter(F.transform(parts, lambda s: F.trim(s)), lambda s: s != F.lit(""))


def distinct_ci(arr) -> Column:
    """Keep the first of each case-insensitive duplicate, order kept (SET5): sort by
    (lower-cased, place), keep the first of each run, sort back — n log n in the elements."""
    sorted_ = F.array_sort(F.transform(_col(arr), lambda s, i: F.struct(F.lower(s).alias("l"), i.alias("i"), s.alias("s"))))

    def firsts(z):
        # z is bound once by the outer lambda; element_at is 1-based, so k is the one before
        return F.filter(z, lambda x, k: (k == 0) | (F.element_at(z, F.greatest(k, F.lit(1)))["l"] != x["l"]))

    kept = F.element_at(F.transform(F.array(sorted_), firsts), 1)
    return F.transform(F.array_sort(F.transform(kept, lambda x: F.struct(x["i"].alias("i"), x["s"].alias("s")))), lambda x: x["s"])


def clean_summary(c) -> Column:
    """Full summary clean-up: FN5 → FN6 → SET5 → join with spaces (FN7)."""
    return F.trim(F.array_join(distinct_ci(split_sentences(summary_ascii(c))), " "))


# --- predicates (FLT6, FN11, SRC8) ------------------------------------------------

def contains_any(c, keywords: Iterable[str]) -> Column:
    """Case-insensitive *substring* match of any keyword (FLT6)."""
    low = F.lower(text_or_empty(c))
    cond = F.lit(False)
    for k in keywords:
        cond = cond | low.contains(k.lower())
    return cond


def has_word(c, word: str) -> Column:
    """Case-insensitive whole-word match; a word character is a letter, digit or ``_``."""
    import re
    w = re.escape(word.lower())
    pat = r"(^|[^\p{L}\p{N}_])" + w + r"([^\p{L}\p{N}_]|$)"
    return F.lower(text_or_empty(c)).rlike(pat)


def truncate_chars(c, n: int = C.MODEL_MAX_CHARS) -> Column:
    """First ``n`` code points (FN8)."""
    return F.substring(text_or_empty(c), 1, n)
