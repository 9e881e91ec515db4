"""Text column functions. Everything is built in but NFKC and entity decoding."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from gleaner import config as C


def missing(c: Column) -> Column:
    """Null where the value is null, empty or the 'unknown' sentinel."""
    return F.when(~c.isin("", "unknown"), c)


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


@F.pandas_udf(StringType())
def unescape_nfkc(texts: pd.Series) -> pd.Series:
    """HTML entities decoded, tags to spaces, compatibility characters composed."""
    import html
    import re
    import unicodedata

    tag = re.compile(r"<[^>]+>")
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", tag.sub(" ", html.unescape(t))))


def tidy(text: Column) -> Column:
    """Dashes and quotes to ASCII, possessives dropped, white space collapsed."""
    for pattern, by in (
        (r"[‐-―−­]", "-"), (r"[‘’]", "'"), (r"[“”]", '"'), (r"'s\b", ""), (r"\s+", " "),
    ):
        text = F.regexp_replace(text, pattern, by)
    return F.trim(text)


def strip_tags(html: Column) -> Column:
    """Tags to spaces, white space collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(html, r"<[^>]+>", " "), r"\s+", " "))


def html_to_text(html: Column) -> Column:
    """As ``strip_tags`` after scripts and styles are dropped with their content."""
    return strip_tags(F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</\1>", " "))


def preprocess_native(text: Column) -> Column:
    """Preprocessing without entity decoding and NFKC; no Python."""
    return tidy(F.regexp_replace(F.coalesce(text, F.lit("")), r"<[^>]+>", " "))


def preprocess(text: Column) -> Column:
    """Full preprocessing, entities before tags."""
    return tidy(unescape_nfkc(F.coalesce(text, F.lit(""))))


def has_term(text: Column, term: str) -> Column:
    """Whether the literal term stands at word boundaries, in any case."""
    return text.rlike(rf"(?iu)\b\Q{term}\E\b")


def dedup_key(term: Column) -> Column:
    return F.regexp_replace(F.lower(term), "[^a-z0-9]", "")


def normalize_company(c: Column) -> Column:
    """Lower case without commas and dots, each legal suffix dropped once in order."""
    c = F.regexp_replace(F.lower(F.trim(F.coalesce(c, F.lit("")))), "[,.]", "")
    for s in C.COMPANY_SUFFIXES:
        c = F.trim(F.regexp_replace(c, f" {s}$", ""))
    return c


def normalize_title(t: Column) -> Column:
    t = F.lower(F.trim(F.coalesce(t, F.lit(""))))
    for pattern, by in C.TITLE_ABBREVIATIONS:
        t = F.regexp_replace(t, pattern, by)
    return F.trim(F.regexp_replace(F.regexp_replace(t, "[,.]", ""), r"\s+", " "))


def normalize_consulting(c: Column) -> Column:
    """Punctuation to spaces, then all trailing corporate suffixes."""
    c = F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.trim(F.coalesce(c, F.lit("")))), "[,.&]", " "), r"\s+", " "))
    return F.regexp_replace(c, "( (" + "|".join(s for s in C.CONSULTING_SUFFIXES if "&" not in s) + "))+$", "")


def city(location: Column) -> Column:
    return F.lower(F.trim(F.substring_index(F.coalesce(location, F.lit("")), ",", 1)))


def snippet(text: Column, length: int = 300) -> Column:
    return F.substring(text, 1, length)


def salary_range(low: Column, high: Column) -> Column:
    """'$120K-$180K', '$120K+', 'Up to $180K' or null; zero counts as missing, halves go to even."""
    def fmt(v: Column) -> Column:
        return F.concat(F.lit("$"), F.bround(v / 1000, 0).cast("long").cast("string"), F.lit("K"))

    low, high = F.nullif(low, F.lit(0.0)), F.nullif(high, F.lit(0.0))
    return (
        F.when(low.isNotNull() & high.isNotNull(), F.concat(fmt(low), F.lit("-"), fmt(high)))
        .when(low.isNotNull(), F.concat(fmt(low), F.lit("+")))
        .when(high.isNotNull(), F.concat(F.lit("Up to "), fmt(high)))
    )


def _salary_values(texts: Column) -> Column:
    """Amounts of an array of numbers as text, null where they are no plausible salary.

    Each step binds its values, and what is empty isn't cast: a cast that fails costs an exception.
    """
    amounts = F.transform(texts, lambda s: F.nullif(F.translate(s, ",", ""), F.lit("")).try_cast("double"))
    amounts = F.transform(amounts, lambda v: F.when(v < 1000, v * 1000).otherwise(v))
    return F.transform(amounts, lambda v: F.when(v.between(10_000, 1_000_000), v))


def extract_salary(text: Column) -> Column:
    """struct<min, max> from the first pattern whose first match has two plausible amounts."""
    def both(amounts: Column) -> Column:
        plausible = F.forall(amounts, lambda v: v.isNotNull())
        return F.when(plausible, F.struct(F.array_min(amounts).alias("min"), F.array_max(amounts).alias("max")))

    tries = []
    for p in C.SALARY_PATTERNS:
        amounts = _salary_values(F.array(F.regexp_extract(text, p, 1), F.regexp_extract(text, p, 2)))
        tries.append(F.transform(F.array(amounts), both)[0])  # matched once, however often the amounts are used
    return F.coalesce(*tries)


def sweep_amounts(text: Column, number: str = r"\d[\d,]*") -> Column:
    """struct<min, max> of all plausible amounts in free text; one alone is the minimum."""
    found = F.filter(_salary_values(F.regexp_extract_all(text, F.lit(f"({number})"), F.lit(1))), lambda v: v.isNotNull())
    return F.struct(F.array_min(found).alias("min"), F.when(F.size(found) > 1, F.array_max(found)).alias("max"))


def remote_status(text: Column) -> Column:
    """hybrid over remote over onsite, else null."""
    return (
        F.when(text.rlike(f"(?iu){C.HYBRID_WORDS}"), "hybrid").when(text.rlike(f"(?iu){C.REMOTE_WORDS}"), "remote")
        .when(text.rlike(f"(?iu){C.ONSITE_WORDS}"), "onsite")
    )


def extract_location(text: Column) -> Column:
    labelled = F.regexp_extract(text, r"\blocation[:\s]+([A-Z][A-Za-z.\s]*?,\s*[A-Z]{2})\b", 1)
    plain = F.regexp_extract(text, rf"\b([A-Z][A-Za-z.]+(?:\s+[A-Z][A-Za-z.]+)*,\s*(?:{C.STATES}))\b", 1)
    return F.coalesce(
        F.when(text.rlike(r"(?iu)\bmultiple\s+locations\b"), "Multiple Locations"),
        blank_to_null(F.trim(labelled)), blank_to_null(F.trim(plain)),
    )


def redact(message: Column, limit: int = 500) -> Column:
    """Credentials in a message replaced, then cut to ``limit`` characters."""
    pattern = r"(?i)(bearer|api[_-]?key|token|authorization|secret|password)(\s*[:=]?\s*)[A-Za-z0-9._\-]{6,}"
    return F.substring(F.regexp_replace(message, pattern, "$1$2<redacted>"), 1, limit)


def split_title(text: Column, separators: tuple[str, ...] = C.TITLE_SEPARATORS) -> Column:
    """struct<title, company> at the first separator by priority that occurs; null without one."""
    tries = []
    for s in separators:
        at = F.instr(text, s)
        tries.append(F.when(at > 0, F.struct(
            F.trim(F.substring(text, F.lit(1), at - 1)).alias("title"), F.trim(F.substring(text, at + len(s), F.length(text))).alias("company"))))
    return F.coalesce(*tries)


def last_segment(text: Column, separators: tuple[str, ...] = C.RSS_SEPARATORS) -> Column:
    """What follows the last of the first separator that occurs; null without one."""
    return F.coalesce(*[F.when(F.instr(text, s) > 0, F.trim(F.substring_index(text, s, -1))) for s in separators])


def html_escape(text: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def prompt(title: Column, company: Column, description: Column, limit: int = 2000) -> Column:
    """A classification prompt; double quotes become single ones, the description is cut."""
    clean = lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit("'"))
    return F.format_string('Title: "%s"\nCompany: "%s"\nDescription: "%s"', clean(title), clean(company), F.substring(clean(description), 1, limit))


def hash_id(text: Column, length: int = 16) -> Column:
    return F.substring(F.sha2(text.cast("binary"), 256), 1, length)


def whole_json(text: Column) -> Column:
    """The variant of a text that is one JSON value as a whole, else null.

    The parser takes the first value and leaves what follows it. What is one element of a list as
    well as the value of a key has nothing after it: none but itself ends both.
    """
    whole = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))).isNotNull() & F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}"))).isNotNull()
    return F.when(whole, F.try_parse_json(text))


def capped_json(json: Column, limit: int = 50_000) -> Column:
    """The JSON text, or a marker with size and a preview where it has more than ``limit`` bytes.

    The preview is an object of the first five keys with 100 characters of each value as text, cut
    to 400 in all; what isn't an object has none.
    """
    quoted = lambda v: F.regexp_extract(F.to_json(F.array(v)), r"(?s)^\[(.*)\]$", 1)
    fields = F.slice(F.map_entries(F.from_json(json, "map<string,string>")), 1, 5)
    shown = F.transform(fields, lambda e: F.concat(quoted(e["key"]), F.lit(": "), quoted(F.coalesce(F.substring(e["value"], 1, 100), F.lit("null")))))
    preview = F.when(F.size(fields) > 0, F.substring(F.concat(F.lit("{"), F.array_join(shown, ", "), F.lit("}")), 1, 400)).otherwise("")
    marker = F.to_json(F.struct(F.lit(True).alias("_truncated"), F.octet_length(json).alias("_original_bytes"), preview.alias("_preview")))
    return F.when(F.octet_length(json) > limit, marker).otherwise(json)
