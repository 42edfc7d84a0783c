"""A day's run in its order: selection, fold, pinned titles, scores, levels, order, repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import handover
from . import history as H
from . import select as L


def day_brief(items: DataFrame, day: str, before: DataFrame | None = None) -> DataFrame:
    """The day's ordered brief. Titles are pinned to their wording in `before` (older items; none: as they are) ahead of the scores, since a keyword in them raises an item."""
    today = items.filter(F.col("run_date") == F.lit(day).cast("date"))
    folded = L.cross_source_fold(L.window_with_floor(L.in_source_dedup(today)))
    if before is not None:
        folded = H.pinned(folded, H.title_pins(before, day))
    scored = handover(L.score_items(folded), "scored")
    return L.brief_order(L.assign_levels(scored))


def daily_run(items: DataFrame, day: str) -> DataFrame:
    """The day's brief with is_repeat against the brief of the newest day before, of which only titles are read. A day without items gives no rows."""
    older = items.filter(F.col("run_date") < F.lit(day).cast("date"))
    last = older.agg(F.max("run_date")).first()[0]
    brief = handover(day_brief(items, day, older), "brief")
    names = ["run_date", "pos", "title", "title_cn", "title_en"]
    both = brief.select(*names)
    if last is not None:
        both = both.unionByName(handover(day_brief(items, str(last)).select(*names), "brief"))
    return brief.join(H.cross_day_repeat(both), ["run_date", "pos"])
