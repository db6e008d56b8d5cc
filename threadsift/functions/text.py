"""Scalar text functions as Column -> Column builders.

Everything here compiles to Spark SQL built-ins, so it stays inside
whole-stage codegen. Regular expressions are Java patterns; ``(?U)`` makes
``\\w``, ``\\s`` and ``\\d`` Unicode-aware, matching the Python cleaners they
replace.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadsift.functions.cols import as_col

# --- fixed values -----------------------------------------------------------
# Characters the issue extractor replaces by a blank: newline, round and
# square brackets, hash, star, back-tick and double quote.
MARKUP_PUNCT_PATTERN = r"[\n()\[\]#*`\"]"
# Patterns of the cleaners ((?U): Unicode classes, (?d): only a newline ends a line).
NOT_LETTER_PATTERN = r"[^\p{L}]"
TAG_PATTERN = r"(?d)<.*?>"
FENCED_CODE_PATTERN = r"```[\s\S]*?```"
INLINE_CODE_PATTERN = r"`[^`]*`"
URL_PATTERN = r"(?U)http[s]?://\S+"
WHITESPACE_PATTERN = r"(?U)\s+"
NUMERIC_ENTITY_PATTERN = r"(?U)&#\d+;"
# What the Q&A cleaner blanks: all but letters, numbers of any kind, underscore,
# whitespace and the listed marks.
NOT_WORD_PUNCT_PATTERN = r"(?U)[^\p{L}\p{N}_\s.,!?-]"
# Words the word tokenizer splits in two (prefix, suffix); after punctuation
# removal these are the only splits it makes besides whitespace.
FUSED_WORDS = (
    ("can", "not"),
    ("gim", "me"),
    ("gon", "na"),
    ("got", "ta"),
    ("lem", "me"),
    ("wan", "na"),
)
# Era buckets for year-based periods: (first year, last year, label); years
# outside every bucket fall into the last label.
ERA_BUCKETS = (
    (2007, 2010, "2007-2010"),
    (2011, 2015, "2011-2015"),
    (2016, 2020, "2016-2020"),
    (2021, 2024, "2021-2024"),
)
# --------------------------------------------------------------------------


# The steps of the Q&A cleaner after unescaping, as (pattern, replacement).
QA_STEPS = ((TAG_PATTERN, ""), (FENCED_CODE_PATTERN, ""), (INLINE_CODE_PATTERN, ""), (URL_PATTERN, ""),
            (NOT_WORD_PUNCT_PATTERN, " "), (WHITESPACE_PATTERN, " "))


def json_path(c, path: str) -> Column:
    """decoded JSON path value (strings unquoted, escapes resolved)."""
    return F.get_json_object(as_col(c), path)


def replace_markup_punct(c) -> Column:
    """markup punctuation and newlines become blanks."""
    return F.regexp_replace(as_col(c), MARKUP_PUNCT_PATTERN, " ")


def collapse_whitespace(c) -> Column:
    """runs of two or more whitespace characters become one blank."""
    return F.regexp_replace(as_col(c), r"\s{2,}", " ")


def trim_whitespace(c) -> Column:
    """Trim Unicode whitespace at both ends (Spark's ``trim`` only strips blanks)."""
    return F.regexp_replace(as_col(c), r"(?U)^\s+|\s+$", "")


def lower_trim(c) -> Column:
    """F5."""
    return F.lower(trim_whitespace(c))


def token_count(c, sep: str = " ") -> Column:
    """number of pieces when splitting on a literal separator."""
    return F.size(F.split(as_col(c), _quote_regex(sep)))


def letters_only(c) -> Column:
    """every character that is not a Unicode letter becomes a blank."""
    return F.regexp_replace(as_col(c), NOT_LETTER_PATTERN, " ")


def truncate(c, n: int) -> Column:
    """first ``n`` characters."""
    return F.substring(as_col(c), 1, n)


def parse_long(c) -> Column:
    """integer id, null when not a number."""
    return as_col(c).try_cast("bigint")


def strip_tags(c) -> Column:
    """non-greedy tag removal; ``(?d)`` keeps ``.`` from crossing newlines only."""
    return F.regexp_replace(as_col(c), TAG_PATTERN, "")


def drop_fenced_code(c) -> Column:
    """F14."""
    return F.regexp_replace(as_col(c), FENCED_CODE_PATTERN, "")


def drop_inline_code(c) -> Column:
    """F15."""
    return F.regexp_replace(as_col(c), INLINE_CODE_PATTERN, "")


def drop_urls(c) -> Column:
    """F16."""
    return F.regexp_replace(as_col(c), URL_PATTERN, "")


def keep_word_punct(c) -> Column:
    """everything but word characters, whitespace and ``.,!?-`` becomes a blank."""
    return F.regexp_replace(as_col(c), NOT_WORD_PUNCT_PATTERN, " ")


def normalise_whitespace_lower(c) -> Column:
    """whitespace runs to one blank, lower case, trimmed."""
    return F.lower(F.trim(F.regexp_replace(as_col(c), WHITESPACE_PATTERN, " ")))


def clean_tags(c) -> Column:
    """``<a><b-c>`` -> ``a b-c``; missing -> empty string."""
    from threadsift.functions.predicates import is_missing

    col = as_col(c)
    spaced = F.regexp_replace(F.replace(col, F.lit("<"), F.lit("")), ">", " ")
    joined = F.trim(F.regexp_replace(trim_whitespace(spaced), WHITESPACE_PATTERN, " "))
    return F.when(is_missing(col), F.lit("")).otherwise(joined)


def strip_numeric_entities(c) -> Column:
    """drop ``&#NN;`` entities, collapse whitespace; empty -> null."""
    col = F.regexp_replace(as_col(c), NUMERIC_ENTITY_PATTERN, "")
    col = F.trim(F.regexp_replace(trim_whitespace(col), WHITESPACE_PATTERN, " "))
    return F.when(col == "", F.lit(None)).otherwise(col)


# Python's strptime accepts one-digit fields, so the pattern uses one letter.
# The text is read as UTC (an explicit offset is appended), so neither the
# session zone nor its daylight-saving gaps change the result.
_LOOSE_DATETIME = "y-M-d H:m:s XXX"


def parse_loose_datetime(c) -> Column:
    """Instant of ``Y-m-d H:M:S`` text (four-digit year, other fields of one or two) read as UTC, else null."""
    text = F.when(as_col(c).rlike(r"^[0-9]{4}-"), as_col(c))
    return F.try_to_timestamp(F.concat(text, F.lit(" +00:00")), F.lit(_LOOSE_DATETIME))


def is_valid_datetime(c) -> Column:
    """F21."""
    return parse_loose_datetime(c).isNotNull()


def to_iso_datetime(c) -> Column:
    """ISO ``yyyy-MM-ddTHH:mm:ss`` text, null when the input is not a datetime."""
    text = micros_to_text(F.unix_micros(parse_loose_datetime(c)))
    return F.replace(text, F.lit(" "), F.lit("T"))


def is_all_digits(c) -> Column:
    """non-empty and only digits."""
    return F.coalesce(as_col(c).rlike(r"(?U)^\d+$"), F.lit(False))


def is_int(c) -> Column:
    """text is an integer (of any size), else null or false.

    Follows Python's ``int(text)``: surrounding whitespace, an optional sign,
    digits of any script with single underscores between them.
    """
    return trim_whitespace(c).rlike(r"(?U)^[+-]?\d+(_\d+)*$")


# Decimal digits of every script and their values, by rule.
_DIGITS = [chr(i) for i in range(0x80, 0x110000) if unicodedata.category(chr(i)) == "Nd"]
_DIGIT_VALUES = "".join(str(unicodedata.decimal(d)) for d in _DIGITS)


def try_int(c, kind: str = "bigint") -> Column:
    """integer value of text (see ``is_int``), null if it is none or beyond ``kind``."""
    plain = F.replace(trim_whitespace(c), F.lit("_"), F.lit(""))
    plain = F.when(plain.rlike("[^0-9+-]"), F.translate(plain, "".join(_DIGITS), _DIGIT_VALUES)).otherwise(plain)
    return F.when(is_int(c), plain.try_cast(kind))


_DAY_US = 86_400_000_000


def micros_to_text(c) -> Column:
    """epoch microseconds -> ``yyyy-MM-dd HH:mm:ss`` in UTC.

    Pure date/integer arithmetic: the session time zone (and its daylight
    saving gaps) cannot shift the result, unlike ``date_format``.
    """
    us = as_col(c)
    day = F.floor(us / _DAY_US)
    sod = F.floor((us - day * _DAY_US) / 1_000_000).cast("long")
    date = F.date_add(F.lit("1970-01-01").cast("date"), day.cast("int"))
    text = F.format_string("%s %02d:%02d:%02d", date.cast("string"),
                           F.floor(sod / 3600), F.floor(sod / 60) % 60, sod % 60)
    return F.when(us.isNotNull(), text)


def ntz_to_micros(c) -> Column:
    """Epoch microseconds of a ``timestamp_ntz`` read as UTC wall-clock time (zone-free fields)."""
    ts = as_col(c)
    seconds = F.date_part(F.lit("SECOND"), ts)
    return (F.unix_date(ts.cast("date")).cast("long") * _DAY_US
            + F.hour(ts).cast("long") * 3_600_000_000 + F.minute(ts).cast("long") * 60_000_000
            + (seconds * 1_000_000).cast("long"))


def _java_trim(col: Column) -> Column:
    # Java's String.trim strips every character up to U+0020.
    return F.regexp_replace(col, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def strip_slashes(c) -> Column:
    """Leading and trailing slashes removed after trimming."""
    return F.regexp_replace(_java_trim(as_col(c)), r"^/+|/+$", "")


def slug_to_text(c) -> Column:
    """``/unanswered/How-to-x/`` -> ``how to x``."""
    col = F.regexp_replace(strip_slashes(c), r"^unanswered/", "")
    return F.lower(F.regexp_replace(col, r"-|\t", " "))


def first_path_segment(c) -> Column:
    """first ``/``-separated segment after stripping outer slashes."""
    return F.split_part(strip_slashes(c), F.lit("/"), F.lit(1))


def date_prefix(c) -> Column:
    """F30 + parse: the first ten characters as a date (one-digit fields allowed)."""
    return F.try_to_date(F.substring(as_col(c), 1, 10), "y-M-d")


def quarter_label(date_col) -> Column:
    """``YYYY-Qn`` from a date column."""
    d = as_col(date_col)
    return F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string"))


def era_label(date_col, buckets=ERA_BUCKETS) -> Column:
    """era bucket of the year; years outside all buckets get the last label."""
    year = F.year(as_col(date_col))
    expr = None
    for lo, hi, label in buckets:
        cond = (year >= lo) & (year <= hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    out = expr.otherwise(buckets[-1][2])
    return F.when(as_col(date_col).isNull(), F.lit(None)).otherwise(out)


def lower_alnum(c, unicode_space: bool = True) -> Column:
    """lower case, then delete everything but ``a-z``, ``0-9`` and whitespace."""
    pattern = r"(?U)[^a-z0-9\s]" if unicode_space else r"[^a-z0-9\s]"
    return F.regexp_replace(F.lower(as_col(c)), pattern, "")


def split_fused_words(c, fused=FUSED_WORDS) -> Column:
    """Split the fused words the word tokenizer separates (``cannot`` -> ``can not``)."""
    alternatives = "|".join(f"{a}(?={b}\\b)" for a, b in fused)
    return F.regexp_replace(as_col(c), rf"\b({alternatives})", "$1 ")


def tokenize_words(c, split_fused: bool = True) -> Column:
    """F32: array of whitespace-separated tokens, empty tokens removed."""
    col = as_col(c)
    if split_fused:
        col = split_fused_words(col)
    # array_remove (not a lambda filter): same result, and plans that use the
    # token stream twice canonicalise equal, so their exchanges are reused
    return F.array_remove(F.split(col, r"(?U)\s+"), "")


def hot_word_tokens(c, split_fused: bool = True) -> Column:
    """F31 + F32: the token array the hot-word counter works on."""
    return tokenize_words(lower_alnum(c), split_fused=split_fused)


def lower_or_null(c) -> Column:
    """lower-cased category, empty -> null."""
    return F.lower(F.nullif(as_col(c), F.lit("")))


def length_or_zero(c) -> Column:
    """F38."""
    return F.coalesce(F.length(as_col(c)), F.lit(0))


def join_present(*cols, sep: str = " ") -> Column:
    """Join the non-null parts with a separator."""
    return F.concat_ws(sep, *[as_col(c) for c in cols])


def _quote_regex(s: str) -> str:
    import re

    return re.escape(s)
