"""Small expressions: ids, names, authors, titles, shares, colours, weeks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexiscope.functions.cleaning import squeeze_space


def safe_id(paper_id: Column, title: Column | None = None) -> Column:
    """What follows the last slash of an id; without an id, the first 60 characters of the title."""
    own = F.element_at(F.split(paper_id, "/"), -1)
    return own if title is None else F.coalesce(F.nullif(own, F.lit("")), F.substring(title, 1, 60))


def normal_id(paper_id: Column) -> Column:
    return F.regexp_replace(paper_id, "^https://", "http://")


def short_authors(authors: Column, limit: int = 72) -> Column:
    """All names if they fit, else three and "et al."; none: "Unknown authors"."""
    whole = F.array_join(authors, ", ")
    some = F.concat(F.array_join(F.slice(authors, 1, 3), ", "), F.lit(" et al."))
    return F.when(F.coalesce(F.size(authors), F.lit(0)) <= 0, F.lit("Unknown authors")).when(F.length(whole) <= limit, whole).otherwise(some)


def section_title(title: Column) -> Column:
    """Spaces squeezed, ". " between a number or an appendix letter and a capital that touches it; blank: "Untitled section"."""
    t = squeeze_space(F.coalesce(title, F.lit("")))
    t = F.regexp_replace(t, r"^(Appendix\s+[A-Z])([A-Z][a-z])", "$1. $2")
    t = F.regexp_replace(t, r"^(\d+(?:\.\d+)*)\.?([A-Z])", "$1. $2")
    return F.when(t == "", F.lit("Untitled section")).otherwise(t)


def hash31(name: Column) -> Column:
    """h = 31 h + code of each character, modulo 2 to the 32."""
    return F.aggregate(F.split(name, ""), F.lit(0).cast("long"), lambda h, c: F.pmod(h * 31 + F.when(c == "", F.lit(0)).otherwise(F.ascii(c)), F.lit(4294967296)))


def hash_class(name: Column, classes: int = 6) -> Column:
    return F.pmod(hash31(name), F.lit(classes)).cast("int")


def percent(part: Column, total: Column) -> Column:
    """With one decimal; "0.0%" where the total is 0."""
    share = F.when(total == 0, F.lit(0.0)).otherwise(F.round(100.0 * part / total, 1))
    return F.format_string("%.1f%%", share)


def count_with_share(part: Column, total: Column) -> Column:
    share = F.when(total == 0, F.lit(0)).otherwise(F.round(100.0 * part / total)).cast("int")
    return F.format_string("%d (%d%%)", part, share)


def duration(seconds: Column) -> Column:
    whole = F.floor(seconds)
    return F.when(seconds < 60, F.format_string("%.1fs", seconds)).otherwise(F.format_string("%dm %02ds", F.floor(whole / 60), F.pmod(whole, F.lit(60))))


def conflict_message(acronym: Column, language: Column) -> Column:
    return F.format_string("Acronym %s is also the language name %s; mentions may have been removed", acronym, language)


def needs_review(language: Column, flagged: Column, reason: Column) -> Column:
    """Flagged, or listed with a reason, or a name of exactly two ASCII letters."""
    return F.coalesce(flagged, F.lit(False)) | reason.isNotNull() | F.regexp_like(language, F.lit("^[A-Za-z]{2}\\z"))


def review_reason(language: Column, explicit: Column, listed: Column) -> Column:
    two = F.when(F.regexp_like(language, F.lit("^[A-Za-z]{2}\\z")), F.lit("Two-letter names are often something else"))
    return F.coalesce(explicit, listed, two)


def coverage_badge(sources: Column) -> Column:
    """None where HTML was read; else what was."""
    return F.when(F.array_contains(sources, "html"), F.lit(None).cast("string")).when(F.array_contains(sources, "pdf"), F.lit("PDF & Abstract")).otherwise(F.lit("Abstract only"))


def entry_of(entry: Column) -> Column:
    """A language entry as a variant: JSON as it is, any other text as a string."""
    e = F.trim(entry)
    return F.coalesce(F.try_parse_json(e), e.cast("variant"))


def _as(entry: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(entry_of(entry), path, kind)


def _kind(entry: Column) -> Column:
    return F.schema_of_variant(entry_of(entry))


def entry_language(entry: Column) -> Column:
    """The name in a language entry: a string, a [name, class] pair, or an object with language or name."""
    return F.when(F.startswith(_kind(entry), F.lit("OBJECT")), F.coalesce(_as(entry, "$.language", "string"), _as(entry, "$.name", "string"))).when(
        F.startswith(_kind(entry), F.lit("ARRAY")), _as(entry, "$[0]", "string")
    ).otherwise(_as(entry, "$", "string"))


def entry_class(entry: Column) -> Column:
    """The class in a pair or an object, if it is a number there."""
    at = lambda path: F.when(F.regexp_like(F.coalesce(F.schema_of_variant(F.try_variant_get(entry_of(entry), path, "variant")), F.lit("")), F.lit("^(BIGINT|DECIMAL|DOUBLE)")), _as(entry, path, "int"))
    return F.coalesce(at("$.class"), at("$[1]"))


def entry_sources(entry: Column) -> Column:
    """The sources that an object lists; none for the other forms."""
    return F.coalesce(_as(entry, "$.sources", "array<string>"), F.array().cast("array<string>"))


#: The label that is broken over two lines.
LONG_LABEL = ("Papers with", "language mentions")


def slice_lines(label: Column, value: Column, share: Column | None = None) -> Column:
    """A slice's label with its value (and share, as text) as lines."""
    tail = F.format_string(" (%d)", value) if share is None else F.concat(F.format_string(" (%d)", value), F.coalesce(F.concat(F.lit(" ("), share, F.lit(")")), F.lit("")))
    first, last = LONG_LABEL
    return F.when(label == f"{first} {last}", F.array(F.lit(first), F.concat(F.lit(last), tail))).otherwise(F.array(F.concat(label, tail)))


def name_order(name: Column) -> Column:
    """Sorts names as a reader expects it: by letters, then accents, then case (root collation), not by code points."""
    return F.collate(name, "UNICODE")


def category_tokens(query: Column) -> Column:
    """Categories of a query "cat:x OR cat:y", distinct and sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(query, F.lit(r"cat:([A-Za-z0-9.\-]+)"), F.lit(1))))


def set_spec(category: Column) -> Column:
    """cs.CL -> cs:cs:CL; a category without a dot twice."""
    head = F.split(category, "\\.")[0]
    return F.concat_ws(":", head, F.replace(category, F.lit("."), F.lit(":")))


def week_start(ts: Column) -> Column:
    """The Monday of a day, which a Monday is itself."""
    return F.date_trunc("week", ts).cast("date")


def week_slug(start: Column, days: int = 7) -> Column:
    return F.concat(F.date_format(start, "yyyyMMdd"), F.lit("_to_"), F.date_format(F.date_add(start, days), "yyyyMMdd"))


def slug_start(slug: Column) -> Column:
    return F.to_date(F.nullif(F.regexp_extract(slug, r"(\d{8})_to_(\d{8})", 1), F.lit("")), "yyyyMMdd")


def slug_end(slug: Column) -> Column:
    return F.to_date(F.nullif(F.regexp_extract(slug, r"(\d{8})_to_(\d{8})", 2), F.lit("")), "yyyyMMdd")


def oai_date(text: Column) -> Column:
    """A timestamp in either of two forms, else null."""
    return F.coalesce(F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ssX")), F.try_to_timestamp(text, F.lit("yyyy-MM-dd")))


PERIODS = {"week": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}


def period_key(start: Column, granularity: str) -> Column:
    """The week, month or year that a week belongs to by its start."""
    return F.date_format(start, PERIODS[granularity])


def in_window(ts: Column, end: Column, days: int) -> Column:
    """Half-open: end - days <= ts < end; null is out."""
    return F.coalesce((ts >= end - F.make_dt_interval(F.lit(days))) & (ts < end), F.lit(False))


def month_guard(paper_id: Column, start: Column, end: Column) -> Column:
    """Whether the year and month in an id such as 2401.01234 lie in a window's months; ids without them pass."""
    yymm = F.regexp_extract(paper_id, r"(?:^|/)(\d{4})\.\d{4,5}", 1)
    month = F.try_to_timestamp(F.concat(F.lit("20"), F.nullif(yymm, F.lit("")), F.lit("01")), F.lit("yyyyMMdd")).cast("date")
    return F.coalesce((month >= F.trunc(start, "month")) & (month <= F.trunc(end, "month")), F.lit(True))


def transient_error(message: Column) -> Column:
    return F.regexp_like(message, F.lit(r"HTTP (?:429|502|503|504)"))
