"""Parsers of landed feed bodies: each takes bodies (any key columns and `body`) and returns a row per entry.

Result: the key columns, ord (place in the body), title, desc, url, dt. All narrow: a
body is parsed where it lies. Limits per body (`take`) are the feeds' own. Bodies that
don't parse, and null or empty ones, give no rows. `PARSERS` is the registry by name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import LANE_HOURS
from ..functions import text as X
from ..functions.residue import strip_tags
from ..functions.scalars import age_hours, as_of_ts, parse_dt
from . import xmlfeeds

# The curated feed's name and address, where an entry has none.
CURATED = ("AIHOT", "https://aihot.news/")
# Where listed names live. The display strings of the parsers below are fixed values too.
PAPERS, HUB, APPS, ROUTER = "https://huggingface.co/papers/", "https://huggingface.co/", "https://huggingface.co/spaces/", "https://openrouter.ai/"

_PAPER = "title:string, summary:string, abstract:string, url:string"
_ENTRY = f"struct<{_PAPER}, id:string, description:string, publishedAt:string, published_at:string, date:string, createdAt:string, paper:struct<{_PAPER}>>"
_LISTED = "models array<struct<id:string, display_name:string, org:string, listed_at_iso:string, arena_score:string, arena_rank:string, open_weights:boolean, context_length:double, price_in:string, price_out:string>>"
_CATALOGUE = "data array<struct<id:string, name:string, context_length:double, pricing:struct<prompt:string, completion:string>, architecture:struct<input_modalities:array<string>>, description:string>>"
_REPOS = "array<struct<modelId:string, id:string, createdAt:string, likes:long, downloads:long, tags:array<string>>>"
_SPACES = "array<struct<id:string, sdk:string, likes:long, createdAt:string, lastModified:string>>"
_CURATED = "items array<struct<title:string, originalTitle:string, summary:string, source:struct<name:string>, links:struct<original:string>, reason:string, category:string, attribution:struct<name:string, url:string>, publishedAt:string, discoveredAt:string, score:int, selected:boolean>>"


def filled(*columns: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def _entries(bodies: DataFrame, rows: Column) -> DataFrame:
    keys = [c for c in bodies.columns if c != "body"]
    return bodies.select(*keys, F.posexplode(rows).alias("ord", "e")).filter("e is not null")


def _items(entries: DataFrame, title: Column, desc: Column, url: Column, dt: Column) -> DataFrame:
    keys = [c for c in entries.columns if c != "e"]
    return entries.select(*keys, F.coalesce(title, F.lit("")).alias("title"), F.coalesce(desc, F.lit("")).alias("desc"), F.coalesce(url, F.lit("")).alias("url"), dt.alias("dt"))


def _first(items: DataFrame, take: int, *order: Column) -> DataFrame:
    """The first `take` of each body (its key columns); Spark cuts before the shuffle (group limit)."""
    keys = [c for c in items.columns if c not in ("ord", "title", "desc", "url", "dt")]
    w = W.partitionBy(*keys).orderBy(*order, "ord")
    return items.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= take).drop("_rn")


def _commas(c: Column) -> Column:
    return F.format_number(c.cast("long"), 0)


def _feed(bodies: DataFrame, form: str | None) -> DataFrame:
    rows = xmlfeeds.entries(bodies).filter(F.col("ord").isNotNull() if form is None else F.col("form") == form)
    keys = [c for c in bodies.columns if c != "body"]
    return rows.select(*keys, "ord", strip_tags(F.col("title")).alias("title"), strip_tags(F.col("desc")).alias("desc"), "url", parse_dt(F.nullif(F.col("stamp"), F.lit(""))).alias("dt"))


def parse_feed(bodies: DataFrame) -> DataFrame:
    """RSS items of a body; if it has none, its Atom entries."""
    return _feed(bodies, None)


def parse_rss(bodies: DataFrame) -> DataFrame:
    """Items at any depth, in order; bodies without items give no rows."""
    return _feed(bodies, "rss")


def parse_atom(bodies: DataFrame) -> DataFrame:
    """Atom entries at any depth, in order; a body with items is no Atom feed."""
    return _feed(bodies, "atom")


def parse_json_items(bodies: DataFrame) -> DataFrame:
    """A root array, or the first list under items, models, data, papers."""
    listed = F.from_json("body", ", ".join(f"{k} array<{_ENTRY}>" for k in ("items", "models", "data", "papers")))
    root = F.when(F.ltrim("body").startswith("["), F.from_json("body", f"array<{_ENTRY}>"))
    rows = _entries(bodies, F.coalesce(root, *[listed[k] for k in ("items", "models", "data", "papers")]))
    e = F.col("e")
    url = filled(e["paper"]["url"], e["url"], e["id"])
    desc = filled(e["paper"]["summary"], e["paper"]["abstract"], F.when(e["paper"].isNull(), filled(e["summary"], e["abstract"])), e["description"])
    return _items(
        rows,
        strip_tags(filled(e["paper"]["title"], e["title"], e["id"])),
        strip_tags(desc),
        F.when(url.startswith("http"), url).otherwise(F.concat(F.lit(PAPERS), url)),
        parse_dt(filled(e["publishedAt"], e["published_at"], e["date"], e["createdAt"])),
    )


def parse_model_listing(bodies: DataFrame, as_of: str, recent_days: int = 3, take: int = 12) -> DataFrame:
    """Models listed of late (or without a date), newest first."""
    e = F.col("e")
    dt = parse_dt(F.trim("e.listed_at_iso"))
    rows = _entries(bodies, F.from_json("body", _LISTED)["models"]).filter(dt.isNull() | (dt >= as_of_ts(as_of) - F.make_interval(days=F.lit(recent_days))))
    name = filled(e["display_name"], e["id"])
    rank = F.when(e["arena_rank"].isNotNull(), F.concat(F.lit("（LMArena 第 "), e["arena_rank"], F.lit("）"))).otherwise("")
    facts = [
        F.concat(F.coalesce(filled(e["org"]), F.lit("未知厂商")), F.lit(" 出品")),
        F.concat(F.substring(filled(F.trim(e["listed_at_iso"])), 1, 10), F.lit(" 上架")),
        F.when(e["arena_score"].cast("double") != 0, F.concat(F.lit("LMArena Elo "), e["arena_score"], rank)),
        F.when(e["open_weights"], "开源权重").otherwise("闭源"),
        F.when(e["context_length"] > 0, F.concat(F.lit("上下文 "), _commas(e["context_length"]), F.lit(" tokens"))),
        F.concat(F.lit("定价 $"), e["price_in"], F.lit("/$"), F.coalesce(e["price_out"], F.lit("None")), F.lit(" 每百万 tokens")),
    ]
    items = _items(rows.filter(name.isNotNull()), F.concat(F.lit("新模型上架："), name), F.concat_ws("；", *facts), F.concat(F.lit(ROUTER), e["id"]), dt)
    return _first(items, take, F.desc_nulls_last("dt"))


def parse_stealth_models(bodies: DataFrame, stealth: bool = True, take: int = 10) -> DataFrame:
    """Catalogue in feed order; anonymous models are told by their id alone."""
    e = F.col("e")
    mid = F.trim("e.id")
    rows = _entries(bodies, F.from_json("body", _CATALOGUE)["data"]).filter(mid != "")
    rows = rows.filter(F.lower(mid).startswith("stealth/")) if stealth else rows
    facts = [
        F.when(e["context_length"] > 0, F.concat(F.lit("上下文 "), _commas(e["context_length"]), F.lit(" tokens"))),
        F.concat(F.lit("输入 $"), filled(e["pricing"]["prompt"]), F.lit(" / 输出 $"), e["pricing"]["completion"], F.lit(" 每百万 tokens")),
        F.when(F.size(e["architecture"]["input_modalities"]) > 0, F.concat(F.lit("输入模态 "), F.array_join(e["architecture"]["input_modalities"], "/"))),
        F.substring(F.regexp_replace(filled(e["description"]), r"\s+", " "), 1, 260),
    ]
    title = F.concat(F.lit("匿名公测模型：" if stealth else "模型上架："), F.coalesce(filled(F.trim(e["name"])), mid))
    return _first(_items(rows, title, F.concat_ws("；", *facts), F.concat(F.lit(ROUTER), mid), F.lit(None).cast("timestamp")), take)


def parse_new_models(bodies: DataFrame, exclude_tags: list[str] = (), min_likes: int = 2, take: int = 8) -> DataFrame:
    """Repositories with likes enough and no tag of the excluded ones, in feed order."""
    e = F.col("e")
    no = F.array(*[F.lit(t.lower()) for t in exclude_tags]).cast("array<string>")
    tags = F.transform(F.coalesce(e["tags"], F.array().cast("array<string>")), F.lower)
    mid = F.trim(filled(e["modelId"], e["id"]))
    rows = _entries(bodies, F.from_json("body", _REPOS)).filter((mid != "") & (F.coalesce(e["likes"], F.lit(0)) >= min_likes) & ~F.coalesce(F.arrays_overlap(tags, no), F.lit(False)))
    facts = [
        F.concat(F.lit("创建于 "), F.substring(filled(e["createdAt"]), 1, 10)),
        F.concat(F.lit("下载 "), _commas(e["downloads"])),
        F.concat(F.lit("点赞 "), e["likes"].cast("string")),
        F.when(F.size(tags) > 0, F.concat(F.lit("标签 "), F.array_join(F.slice(tags, 1, 6), ", "))),
    ]
    return _first(_items(rows, F.concat(F.lit("HF 新模型："), mid), F.concat_ws("；", *facts), F.concat(F.lit(HUB), mid), parse_dt(e["createdAt"])), take)


def parse_spaces(bodies: DataFrame, take: int = 6) -> DataFrame:
    e = F.col("e")
    sid = F.trim("e.id")
    facts = [
        F.concat(F.lit("技术栈 "), filled(e["sdk"])),
        F.concat(F.lit("点赞 "), e["likes"].cast("string")),
        F.concat(F.lit("创建于 "), F.substring(filled(e["createdAt"]), 1, 10)),
        F.concat(F.lit("最近更新 "), F.substring(filled(e["lastModified"]), 1, 10)),
    ]
    rows = _entries(bodies, F.from_json("body", _SPACES)).filter(sid != "")
    return _first(_items(rows, F.concat(F.lit("Spaces 应用："), sid), F.concat_ws("；", *facts), F.concat(F.lit(APPS), sid), parse_dt(e["lastModified"])), take)


def parse_curated(bodies: DataFrame, as_of: str, window_hours: int = LANE_HOURS["hot"]) -> DataFrame:
    """Selected entries with a title and an original link; more columns: title_en, block, age_h (-1 unknown), score, reason, category, attribution, stale.

    Entries older than `window_hours` stay and are marked stale.
    """
    e = F.col("e")
    rows = _entries(bodies, F.from_json("body", _CURATED)["items"]).filter(e["selected"] & (F.trim(e["title"]) != "") & (F.trim(e["links"]["original"]) != ""))
    dt = parse_dt(filled(e["publishedAt"], e["discoveredAt"]))
    keys = [c for c in rows.columns if c != "e"]
    return rows.select(
        *keys,
        F.substring(F.trim(e["title"]), 1, 150).alias("title"),
        F.substring(F.coalesce(F.trim(e["originalTitle"]), F.lit("")), 1, 150).alias("title_en"),
        F.substring(F.regexp_replace(F.trim(F.coalesce(e["summary"], F.lit(""))), r"\s+", " "), 1, 1200).alias("desc"),
        F.trim(e["links"]["original"]).alias("url"),
        dt.alias("dt"),
        F.coalesce(age_hours(dt, as_of), F.lit(-1)).alias("age_h"),
        X.source_label(e["source"]["name"]).alias("block"),
        e["score"].alias("score"),
        F.trim(F.coalesce(e["reason"], F.lit(""))).alias("reason"),
        F.coalesce(e["category"], F.lit("")).alias("category"),
        F.coalesce(e["attribution"], F.struct(F.lit(CURATED[0]).alias("name"), F.lit(CURATED[1]).alias("url"))).alias("attribution"),
        F.coalesce(age_hours(dt, as_of) > window_hours, F.lit(False)).alias("stale"),
    )


def candidate_paths(sources: DataFrame, pool: list[str]) -> DataFrame:
    """source_id, path_rank, url: own urls, then pool x route, as the source's mode (direct, rsshub, auto) says."""
    none = F.array().cast("array<string>")
    own = F.when(F.col("mode") != "rsshub", F.coalesce("urls", none)).otherwise(none)
    routed = F.when((F.col("mode") != "direct") & F.col("route").isNotNull(), F.array(*[F.concat(F.lit(h.rstrip("/")), F.col("route")) for h in pool])).otherwise(none)
    return sources.select("source_id", F.posexplode(F.concat(own, routed)).alias("path_rank", "url"))


def latest_snapshot(attempts: DataFrame) -> DataFrame:
    """Per source the newest pull that brought a body; a pull that says "not modified" leaves the one before."""
    return attempts.filter((F.col("status") == 200) & (F.col("body") != "")).groupBy("source_id").agg(F.max_by(F.struct("body", "fetched_at"), "fetched_at").alias("s")).select("source_id", "s.*")


PARSERS = {
    "feed": parse_feed, "rss": parse_rss, "atom": parse_atom, "json": parse_json_items, "listing": parse_model_listing, "catalogue": parse_stealth_models,
    "models": parse_new_models, "spaces": parse_spaces, "curated": parse_curated,
}
