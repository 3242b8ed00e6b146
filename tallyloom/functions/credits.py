"""Film credits in their informal text form, as one struct column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.text import between, bind

# The pattern of a bracketed year with its optional number, the
# mark of an unknown year, and the marks and names of the kinds of title.
YEAR = r"\([12][890]\d{2}\/?[IVX]*\)"
UNKNOWN_YEAR = "(????"
SERIES_KIND = "TV_SERIES"
MINI_SERIES_MARK, MINI_SERIES_KIND = "(mini", "TV_MINI_SERIES"
DETAIL_KINDS = (("(TV)", "TV_MOVIE"), ("(V)", "VIDEO_MOVIE"), ("(VG)", "VIDEO_GAME"))
FILM_KIND = "THEATRICAL_MOVIE"


def parse_credit(text: Column) -> Column:
    """Struct (name, year, number, kind, episode, billing, role).

    Null when the text has no year mark. The year is null when it is unknown;
    the last bracketed year counts, since a name may hold one of its own.
    """
    return bind(F.trim(text), _with_mark)


def _with_mark(text: Column) -> Column:
    """The text cut at its year mark."""
    pattern = rf"(?s)^(.*)({YEAR})(.*)$"
    fallback = r"(?s)^(.*?)(\(\?\?\?\?[^)]*\))(.*)$"
    known = F.regexp_like(text, F.lit(pattern))

    def cut(group: int) -> Column:
        return F.when(known, F.regexp_extract(text, pattern, group)).otherwise(
            F.regexp_extract(text, fallback, group))

    parts = F.struct(
        text.alias("text"), known.alias("known"),
        F.rtrim(cut(1)).alias("title"), cut(2).alias("mark"), cut(3).alias("details"),
    )
    return bind(parts, _fields)


def _fields(cut: Column) -> Column:
    text, title, mark, details = cut["text"], cut["title"], cut["mark"], cut["details"]
    on_tv = F.startswith(text, F.lit('"'))
    kind = F.when(on_tv & F.contains(text, F.lit(MINI_SERIES_MARK)), MINI_SERIES_KIND).when(on_tv, SERIES_KIND)
    for token, name in DETAIL_KINDS:
        kind = kind.when(F.contains(details, F.lit(token)), name)
    unquoted = F.substring(title, F.lit(2), F.greatest(F.length(title) - 2, F.lit(0)))
    number = F.regexp_extract(mark, r"^\(.{4}/?([^)]*)\)$", 1)
    return F.when(
        mark != "",
        F.struct(
            F.when(on_tv, unquoted).otherwise(title).alias("name"),
            F.when(cut["known"], F.substring(mark, 2, 4).try_cast("int")).alias("year"),
            F.when(number != "", number).alias("number"),
            kind.otherwise(FILM_KIND).alias("kind"),
            F.when(on_tv, between(details, "{", "}")).alias("episode"),
            between(details, "<", ">").try_cast("int").alias("billing"),
            between(details, "[", "]").alias("role"),
        ),
    )


def format_credit(credit: Column) -> Column:
    """A readable line; absent parts are left out, an unknown year shows as -1."""

    def part(field: str, opening: str, closing: str) -> Column:
        value = credit[field].cast("string")
        return F.when(value.isNotNull(), F.concat(F.lit(opening), value, F.lit(closing)))

    return F.concat_ws(
        "",
        credit["name"],
        F.lit("\t("), F.coalesce(credit["year"], F.lit(-1)).cast("string"), F.lit(")\t:"),
        credit["kind"], F.lit(":"),
        part("number", "#", "#"),
        part("episode", "\t{", "}"),
        part("billing", "\t<", ">"),
        part("role", "\t[", "]"),
    )
