"""Dates and scores on columns. Totals are counted in whole hundredths, so they round alike everywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def as_of_ts(as_of: str) -> Column:
    return F.lit(as_of).cast("timestamp")


def age_hours(dt: Column, as_of: str) -> Column:
    """Whole hours before as_of; null stays null."""
    return F.floor((F.unix_micros(as_of_ts(as_of)) - F.unix_micros(dt.cast("timestamp"))) / F.lit(3_600_000_000)).cast("long")


# Named zones of mail dates, in hours; other names are taken as UTC.
ZONES = {"EST": -5, "EDT": -4, "CST": -6, "CDT": -5, "MST": -7, "MDT": -6, "PST": -8, "PDT": -7, "AST": -4, "ADT": -3}
_MAIL = r"(?i)^(\d{1,2})[ -]([a-z]{3})[a-z]*[ -](\d{2,4}) (\d{1,2}):(\d{2})(?::(\d{2}))?(?: ?(?:([+-])(\d{2})(\d{2})|([a-z]+)))?$"


MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]


def _bound(value: Column, f) -> Column:
    """f(value), where value is evaluated once however often f reads it."""
    return F.transform(F.array(value), f)[0]


def _mail_dt(c: Column) -> Column:
    """RFC 822: with or without day name, seconds and zone; two-digit years are 1969 to 2068.

    One match splits a date into its parts; what is none has one part.
    """
    s = F.regexp_replace(F.trim(F.regexp_replace(c, r"\([^()]*\)", " ")), r"\s+", " ")
    s = F.regexp_replace(F.regexp_replace(s, r"^[A-Za-z]+\.?,? ?(?=\d)", ""), " ?, ?", " ")
    parts = F.split(F.regexp_replace(s, _MAIL, "\n".join(f"${i}" for i in range(1, 11))), "\n")
    return _bound(parts, lambda g: F.when(F.size(g) == 10, _of_parts(g)))


def _of_parts(g: Column) -> Column:
    year = g[2].try_cast("int")
    year = F.when(year < 69, year + 2000).when(year < 100, year + 1900).when(year >= 1000, year)
    month = F.nullif(F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(g[1])), F.lit(0)).cast("int")
    second = F.when(g[5] == "", 0).otherwise(g[5].try_cast("int"))
    local = F.try_make_timestamp(year, month, g[0].try_cast("int"), g[3].try_cast("int"), g[4].try_cast("int"), F.when(second < 60, second).cast("decimal(16,6)"))
    named = F.coalesce(F.create_map(*[x for name, hours in ZONES.items() for x in (F.lit(name), F.lit(hours * 60))])[F.upper(g[9])], F.lit(0))
    east = F.coalesce(g[7].try_cast("int") * 60 + g[8].try_cast("int"), F.lit(0))
    minutes = F.when(g[6] == "-", -east).when(g[6] == "+", east).otherwise(named)
    return local - F.make_interval(mins=minutes.cast("int"))


def _iso_dt(c: Column) -> Column:
    """ISO 8601, also without dashes and colons."""
    s = F.regexp_replace(c, r"^(\d{4})(\d{2})(\d{2})(?=$|[T ])", "$1-$2-$3")
    s = F.regexp_replace(s, r"^(.{10}[T ]\d{2})(\d{2})(?:(\d{2}))?(?=$|[.+\-Z])", "$1:$2:$3")
    s = F.regexp_replace(F.regexp_replace(s, ":(?=$|[.+\\-Z])", ":00"), r"^(.{10}[T ].*[+-]\d{2})(\d{2})$", "$1:$2")
    return s.try_cast("timestamp")


def parse_dt(c: Column) -> Column:
    """RFC 822 or ISO 8601; without a zone UTC; else null."""
    return _bound(F.trim(c), lambda s: F.coalesce(_mail_dt(s), _iso_dt(s)))


def pub_display(dt: Column, as_of: str) -> Column:
    t, now = F.from_utc_timestamp(dt, "Asia/Shanghai"), F.from_utc_timestamp(as_of_ts(as_of), "Asia/Shanghai")
    days = F.datediff(now, t)
    clock = F.date_format(t, "HH:mm")
    return (
        F.when(dt.isNull(), "")
        .when(days == 0, clock)
        .when(days == 1, F.concat(F.lit("昨天 "), clock))
        .when(F.year(t) == F.year(now), F.concat(F.month(t).cast("string"), F.lit("月"), F.dayofmonth(t).cast("string"), F.lit("日 "), clock))
        .otherwise(F.date_format(t, "yyyy-MM-dd HH:mm"))
    )


def pub_iso(dt: Column) -> Column:
    return F.coalesce(F.concat(F.date_format(F.from_utc_timestamp(dt, "Asia/Shanghai"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+08:00")), F.lit(""))


def clamp_score(rel: Column, info: Column, fresh: Column) -> Column:
    """struct(rel, info, fresh) of 0..10; null if any is no whole number."""
    parts = {k: F.greatest(F.lit(0), F.least(F.lit(10), c.try_cast("int"))) for k, c in (("rel", rel), ("info", info), ("fresh", fresh))}
    whole = rel.try_cast("int").isNotNull() & info.try_cast("int").isNotNull() & fresh.try_cast("int").isNotNull()
    return F.when(whole, F.struct(*[c.alias(k) for k, c in parts.items()]))


def weighted_total(score: Column, lane: Column) -> Column:
    """.45 rel + .30 info + .25 fresh, half a point for new models, 10 at most, one decimal (half up)."""
    h = 45 * score["rel"] + 30 * score["info"] + 25 * score["fresh"] + F.when(lane == "model", 50).otherwise(0)
    return F.when(h.isNotNull(), F.least(F.lit(100), F.floor((h + 5) / 10)) / F.lit(10.0))  # least() skips nulls


def fallback_total(lane: Column, age: Column, has_also: Column) -> Column:
    base = F.lit(54)
    for name, tenths in C.FALLBACK_TENTHS.items():
        base = F.when(lane == name, tenths).otherwise(base)
    fresh = F.when(age.between(0, 12), 12).when(age.between(0, 36), 6).otherwise(0)
    return F.least(F.lit(95), base + fresh + F.when(has_also, 5).otherwise(0)) / F.lit(10.0)


def boosted(total: Column, hit: Column) -> tuple[Column, Column]:
    """(total, whether it was raised)."""
    raised = hit & (total >= C.FLOOR_KEYWORD)
    return F.when(raised, F.least(F.lit(10.0), total + C.KEYWORD_BONUS)).otherwise(total), raised


def half_even_percent(n: Column, percent: int) -> Column:
    """round(n * percent / 100), halves to even, in whole numbers."""
    x = n * percent
    q, r = F.floor(x / 100).cast("long"), F.pmod(x, F.lit(100))
    return q + F.when((r > 50) | ((r == 50) & (F.pmod(q, F.lit(2)) == 1)), 1).otherwise(0)


def case_decay(score: Column, seen: Column, as_of_date: str) -> Column:
    days = F.greatest(F.coalesce(F.datediff(F.lit(as_of_date).cast("date"), seen), F.lit(0)), F.lit(0))
    return score * F.pow(F.lit(0.5), days / F.lit(C.HALF_LIFE_DAYS))
