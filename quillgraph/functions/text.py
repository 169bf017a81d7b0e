"""Text functions as Column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .udf import arrow_udf

# Words that never count as tokens of a topic.
STOPWORDS = (
    "the and for with from that this your you are how what into about when why can a an to of in on is it as or be by not "
    "trading trade trader traders stock stocks course courses"
).split()
TOKEN_LENGTH = 4


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(x: Column, digits: int) -> Column:
    """Rounding by floor(x * 10^d + 0.5), the same double arithmetic in any engine."""
    scale = float(10**digits)
    return F.floor(x * scale + 0.5).cast("double") / scale


def tokens(c: Column | str) -> Column:
    """Lower-case ASCII words of four or more characters that are no stopwords, with repeats."""
    words = F.transform(F.regexp_extract_all(_col(c), F.lit("[A-Za-z0-9]+"), F.lit(0)), F.lower)
    return F.filter(words, lambda w: (F.length(w) >= TOKEN_LENGTH) & ~w.isin(STOPWORDS))


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two arrays as sets; 0 where both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))


def fact_tokens(c: Column | str) -> Column:
    """Distinct words of a fact: lower case, everything but letters, numbers and white space deleted."""
    bare = F.regexp_replace(F.lower(_col(c)), r"[^\p{L}\p{N}\s]", "")
    return F.array_distinct(F.filter(F.split(bare, r"(?U)\s+"), lambda w: w != ""))


def collapse_space(c: Column | str) -> Column:
    """Runs of Unicode white space become one blank; ends are trimmed."""
    return F.trim(F.regexp_replace(_col(c), r"(?U)\s+", " "))


def slugify_topic(c: Column | str) -> Column:
    slug = F.regexp_replace(F.lower(F.trim(_col(c))), "[^a-z0-9]+", "-")
    slug = F.regexp_replace(slug, "^-+|-+$", "")
    return F.coalesce(F.nullif(slug, F.lit("")), F.lit("topic"))


@arrow_udf("string")
def _fold(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for series in texts:
        yield series.map(lambda t: None if t is None else "".join(c for c in unicodedata.normalize("NFKD", t) if not 0x300 <= ord(c) <= 0x36F))


def slugify(c: Column | str) -> Column:
    """Slug with accents folded (there is no built-in normalisation, hence the Arrow UDF); null and empty give ''."""
    folded = _fold(F.lower(F.coalesce(_col(c), F.lit(""))))
    return F.regexp_replace(F.regexp_replace(folded, "[^a-z0-9]+", "-"), "^-+|-+$", "")


def words(c: Column | str) -> Column:
    return F.filter(F.split(F.coalesce(_col(c), F.lit("")), r"(?U)\s+"), lambda w: w != "")


def count_body_words(c: Column | str) -> Column:
    """Words without the marks of section headings."""
    return F.size(words(F.regexp_replace(F.coalesce(_col(c), F.lit("")), r"(?m)^##\s+", "")))


def headings(c: Column | str) -> Column:
    """Texts of the '## ' lines."""
    return F.transform(F.regexp_extract_all(F.coalesce(_col(c), F.lit("")), F.lit(r"(?m)^##\s+(\S.*)$"), F.lit(1)), lambda h: F.trim(h))


def quoted(c: Column) -> Column:
    """A string as a literal part of a Java pattern."""
    return F.concat(F.lit(r"\Q"), F.replace(c, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def heading_mentions(heading: Column, name: Column) -> Column:
    """Whether a heading holds the name between non-alphanumerics, plural and possessive allowed, in any case."""
    pattern = F.concat(F.lit("(?i)(?<![a-z0-9])"), quoted(name), F.lit("('s|s)?(?![a-z0-9])"))
    return F.regexp_like(heading, pattern)


def truncate_words(c: Column | str, n: int) -> Column:
    w = words(c)
    return F.when(F.size(w) <= n, F.array_join(w, " ")).otherwise(F.concat(F.array_join(F.slice(w, 1, n), " "), F.lit("…")))


def truncate_chars(c: Column | str, n: int) -> Column:
    text = F.trim(F.coalesce(_col(c), F.lit("")))
    return F.when(F.length(text) <= n, text).otherwise(F.concat(F.substring(text, 1, n), F.lit("…")))


def month_year(c: Column | str) -> Column:
    return F.date_format(_col(c).cast("date"), "MMMM yyyy")


def month_year_zh(c: Column | str) -> Column:
    day = _col(c).cast("date")
    return F.concat(F.year(day).cast("string"), F.lit("年"), F.month(day).cast("string"), F.lit("月"))


def reading_minutes(english: Column | str, chinese: Column | str | None = None) -> Column:
    """Minutes to read: words / 200, or without English text characters / 300; at least 1."""
    n = F.size(words(english))
    by_words = F.greatest(F.lit(1), F.floor(n / 200 + 0.5).cast("int"))
    if chinese is None:
        return by_words
    chars = F.length(F.regexp_replace(F.coalesce(_col(chinese), F.lit("")), r"(?U)\s+", ""))
    return F.when(n > 0, by_words).otherwise(F.greatest(F.lit(1), F.floor(chars / 300 + 0.5).cast("int")))


def reading_time_text(minutes: Column) -> Column:
    return F.concat(minutes.cast("string"), F.lit(" min read"))


def reading_time_text_zh(c: Column | str) -> Column:
    digits = F.regexp_replace(F.coalesce(_col(c), F.lit("")), "[^0-9]", "")
    return F.concat(F.lit("阅读时间："), F.coalesce(F.nullif(digits, F.lit("")), F.lit("5")), F.lit("分钟"))


def derive_category(c: Column | str) -> Column:
    """Last non-empty part of a section path 'A > B', else 'Trading Strategy'."""
    parts = F.filter(F.transform(F.split(F.coalesce(_col(c), F.lit("")), ">"), lambda p: F.trim(p)), lambda p: p != "")
    return F.when(F.size(parts) > 0, F.element_at(parts, -1)).otherwise(F.lit("Trading Strategy"))


def clean_headline(c: Column | str) -> Column:
    """Headline without the site's suffix and without what follows the last slash; blank becomes null."""
    bare = F.trim(F.regexp_replace(_col(c), r"\s*\|\s*e南洋\s*$", ""))
    cut = F.when(F.instr(bare, "/") > 0, F.regexp_extract(bare, r"(?s)^(.*)/[^/]*$", 1)).otherwise(bare)
    return F.nullif(F.trim(cut), F.lit(""))


def parse_keywords(c: Column | str) -> Column:
    """String elements of a JSON array; [] for null or malformed text."""
    parsed = F.from_json(_col(c), "array<string>")
    return F.coalesce(F.filter(parsed, lambda k: k.isNotNull()), F.array().cast("array<string>"))
