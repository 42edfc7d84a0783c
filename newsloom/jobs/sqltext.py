"""SQL text (DuckDB) of the chain from items to a brief, for the oracle."""

from __future__ import annotations

from .. import config as C
from ..sources.items import ITEMS_SQL


def _case(column: str, values: dict, default) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items()) + f" ELSE {default} END"


def pattern(words) -> str:
    out = []
    for w in words:
        out.append("".join(ch if ch.isalnum() or ch.isspace() or ch == "_" else "\\" + ch for ch in w))
    return "|".join(out)


def norm(x: str) -> str:
    return f"lower(regexp_replace(coalesce({x}, ''), '[^\\p{{L}}\\p{{N}}_]+', '', 'g'))"


def cjk(x: str) -> str:
    return f"regexp_matches(coalesce({x}, ''), '[\\x{{4e00}}-\\x{{9fff}}]')"


def tokens(x: str) -> str:
    words = f"list_filter(string_split(regexp_replace(lower(coalesce({x}, '')), '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g'), ' '), lambda w: w <> '')"
    grams = f"list_transform({words}, lambda w: CASE WHEN regexp_full_match(w, '[\\x{{4e00}}-\\x{{9fff}}]+') AND length(w) > 2 THEN list_transform(range(1, length(w)), lambda i: substr(w, i, 2)) ELSE [w] END)"
    return f"list_distinct(flatten({grams}))"


def half_even(n: str, percent: int) -> str:
    return f"(({n} * {percent}) // 100 + CASE WHEN ({n} * {percent}) % 100 > 50 OR (({n} * {percent}) % 100 = 50 AND (({n} * {percent}) // 100) % 2 = 1) THEN 1 ELSE 0 END)"


RANK = _case("lane", {x: i for i, x in enumerate(C.LANES)}, 99)
HOURS = _case("lane", C.LANE_HOURS, C.DEFAULT_HOURS)
AGE = f"CAST(floor((epoch_us(TIMESTAMP '{C.AS_OF}') - epoch_us(dt)) / 3600000000.0) AS BIGINT)"
AGE_SORT = "CASE WHEN age_h IS NULL OR age_h < 0 THEN 9999 ELSE age_h END"
HIT = f"regexp_matches(lower(concat_ws(' ', title, title_cn)), '{pattern(C.TOP_KEYWORDS)}')"

DEDUP = f"""
dedup AS (
  SELECT * FROM (SELECT *, {norm('title')} AS key FROM items) WHERE key <> ''
  QUALIFY row_number() OVER (PARTITION BY run_date, source_id, key ORDER BY pos) = 1
)"""
def windowed(take: int = C.TAKE) -> str:
    return f"""
marked AS (SELECT *, dt IS NULL OR dt >= TIMESTAMP '{C.AS_OF}' - to_hours(CAST({HOURS} AS INT)) AS inw, {AGE} AS age_h FROM dedup),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY run_date, source_id, inw ORDER BY dt DESC NULLS LAST, pos) AS rn,
         count(*) FILTER (inw) OVER (PARTITION BY run_date, source_id) AS nin FROM marked
),
windowed AS (SELECT *, NOT inw AS stale FROM ranked WHERE (inw AND rn <= {take}) OR (NOT inw AND rn <= {C.MIN_TAKE} - least(nin, {take}, {C.MIN_TAKE})))"""


WINDOWED = windowed()
FOLDED = f"""
placed AS (SELECT *, row_number() OVER (PARTITION BY run_date, key ORDER BY {RANK}, {AGE_SORT}, pos) AS frn FROM windowed),
others AS (SELECT run_date, key, list(block ORDER BY frn) FILTER (frn > 1) AS also FROM placed GROUP BY run_date, key),
folded AS (SELECT p.*, coalesce(o.also, []) AS also_in FROM placed p JOIN others o USING (run_date, key) WHERE frn = 1)"""
SCORED = f"""
based AS (
  SELECT *, CASE WHEN scored THEN least(100, (45 * rel + 30 * info + 25 * fresh + CASE WHEN lane = 'model' THEN 50 ELSE 0 END + 5) // 10) / 10.0::DOUBLE
    ELSE least(95, {_case('lane', C.FALLBACK_TENTHS, 54)} + CASE WHEN age_h BETWEEN 0 AND 12 THEN 12 WHEN age_h BETWEEN 0 AND 36 THEN 6 ELSE 0 END
         + CASE WHEN len(also_in) > 0 THEN 5 ELSE 0 END) / 10.0::DOUBLE END AS base, {HIT} AS hit FROM folded
),
totals AS (
  SELECT *, CASE WHEN hit AND base >= {C.FLOOR_KEYWORD} THEN least(10.0::DOUBLE, base + 1.0::DOUBLE) ELSE base END AS total, hit AND base >= {C.FLOOR_KEYWORD} AS kw_boost, NOT scored AS fallback FROM based
)"""
LEVELED = f"""
dayrank AS (SELECT *, row_number() OVER (PARTITION BY run_date ORDER BY total DESC, pos) AS drn, count(*) OVER (PARTITION BY run_date) AS n FROM totals),
leveled AS (
  SELECT *, CASE WHEN drn <= least({C.TOP_MAX}, greatest({C.TOP_MIN}, {half_even('n', C.TOP_PERCENT)})) AND total >= {C.FLOOR_TOP} THEN 'top'
    WHEN drn <= least({C.TOP_MAX}, greatest({C.TOP_MIN}, {half_even('n', C.TOP_PERCENT)})) + {half_even('n', C.WATCH_PERCENT)} AND total >= {C.FLOOR_WATCH} THEN 'watch'
    ELSE 'normal' END AS level FROM dayrank
)"""
ORDERED = f"""
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY run_date ORDER BY CASE level WHEN 'top' THEN 0 WHEN 'watch' THEN 1 ELSE 2 END, total DESC, {AGE_SORT}, pos) AS ord FROM leveled
)"""


def chain(to: str, rest: str, take: int = C.TAKE) -> str:
    """WITH the chain up to the CTE `to`, then the rest (more CTEs may follow after a comma)."""
    names = ["items", "dedup", "windowed", "folded", "totals", "leveled", "ordered"]
    return "WITH " + ",".join([ITEMS_SQL, DEDUP, windowed(take), FOLDED, SCORED, LEVELED, ORDERED][: names.index(to) + 1]) + rest


def brief_chain(to: str, rest: str) -> str:
    """The chain under the limit of the queries over a whole brief."""
    return chain(to, rest, C.BRIEF_TAKE)


def chain_pinned(day: str, rest: str) -> str:
    """The chain to `ordered`, in which titles of `day` are pinned to their wording before it, ahead of the scores; then the rest."""
    pins = f"""
    pins AS (SELECT substr(md5({norm('title')}), 1, 10) AS id, arg_max(title_cn, run_date || lpad(CAST(pos AS VARCHAR), 12, '0')) AS pinned FROM items WHERE run_date < '{day}' AND coalesce(title_cn, '') <> '' GROUP BY 1),
    folded AS (SELECT f.* REPLACE (CASE WHEN run_date = '{day}' AND coalesce(title_cn, '') <> '' THEN coalesce(pinned, title_cn) ELSE title_cn END AS title_cn), run_date = '{day}' AND coalesce(title_cn, '') <> '' AND coalesce(pinned <> title_cn, false) AS was_pinned
      FROM folded0 f LEFT JOIN pins ON pins.id = substr(md5({norm('f.title')}), 1, 10))"""
    parts = [ITEMS_SQL, DEDUP, WINDOWED, FOLDED.replace("folded AS (", "folded0 AS ("), pins, SCORED, LEVELED, ORDERED]
    return "WITH " + ",".join(parts) + rest
