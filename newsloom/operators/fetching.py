"""From landed bodies to the items of each source: every path's body is parsed once, the first good path is taken.

A path fails if its request failed, its body doesn't parse, or it has no entries (special
parsers may find nothing); it is passed over if the median length of its texts is below the
source's `desc_min`. Paths after the chosen one are not looked at, so they say nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.residue import strip_tags
from ..functions.scalars import parse_dt
from ..sources import feeds, xmlfeeds
from .report import desc_median

KEYS = ["source_id", "path_rank"]
PARSED = ["source_id", "path_rank", "ord", "title", "desc", "url", "dt", "error"]


def parsed(bodies: DataFrame, **special) -> DataFrame:
    """source_id, path_rank, ord, title, desc, url, dt, error: a row per entry; one row with an error, and no ord, for a body that doesn't parse.

    bodies: source_id, path_rank, kind (json, a name in `special`, else a feed), status, body. Only bodies of status 200 are read.
    """
    good = bodies.filter("status = 200")
    one = lambda kind: good.filter(F.col("kind") == kind).select(*KEYS, "body")
    none = F.lit(None).cast("string")
    xml = xmlfeeds.entries(good.filter(~F.col("kind").isin(["json", *special])).select(*KEYS, "body"))
    told = F.when(F.col("error").isNotNull(), "ParseError")
    out = xml.filter("ord is not null or error is not null").select(*KEYS, "ord", strip_tags(F.col("title")).alias("title"), strip_tags(F.col("desc")).alias("desc"), "url", parse_dt(F.nullif(F.col("stamp"), F.lit(""))).alias("dt"), told.alias("error"))
    for kind, parser in {"json": feeds.parse_json_items, **special}.items():
        out = out.unionByName(parser(one(kind)).select(*PARSED[:-1], none.alias("error")))
        bad = one(kind).filter(F.try_parse_json("body").isNull())
        out = out.unionByName(bad.select(*KEYS, *[F.lit(None).cast(t).alias(c) for c, t in out.dtypes if c not in (*KEYS, "error")], F.lit("JSONDecodeError").alias("error")))
    return out.select(*PARSED)


def attempts(bodies: DataFrame, rows: DataFrame, special: tuple[str, ...] = ()) -> DataFrame:
    """source_id, path_rank, host, special, ok, n, desc_median, newest, error of each path. rows: what parsed() gave of the bodies."""
    sums = rows.groupBy(*KEYS).agg(F.count("ord").alias("n"), F.max("dt").alias("newest"), F.max("error").alias("failed"))
    median = desc_median(rows.filter("ord is not null"), KEYS, "desc")
    all_paths = bodies.select(*KEYS, "host", F.col("kind").isin(list(special)).alias("special"), "status")
    x = all_paths.join(sums, KEYS, "left").join(median, KEYS, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    error = F.when(F.col("status").isNull(), "URLError").when(F.col("status") != 200, F.concat(F.lit("HTTPError"), F.col("status").cast("string")))
    error = F.coalesce(error, F.col("failed"), F.when((F.col("n") == 0) & ~F.col("special"), "RuntimeError"))
    return x.select(*KEYS, "host", "special", error.isNull().alias("ok"), "n", F.coalesce("desc_median", F.lit(0)).cast("long").alias("desc_median"), "newest", error.alias("error"))


def told(desc_min: Column) -> Column:
    """What a path says of itself."""
    fine = F.concat(F.lit("OK("), F.col("n").cast("string"), F.lit("条/desc"), F.col("desc_median").cast("string"), F.lit(")"))
    short = F.concat(F.lit("desc中位"), F.col("desc_median").cast("string"), F.lit("<"), desc_min.cast("string"), F.lit("跳过"))
    return F.concat("host", F.lit(":"), F.when(~F.col("ok"), F.col("error")).when(F.col("desc_median") < desc_min, short).otherwise(fine))


def choose(attempted: DataFrame, sources: DataFrame) -> DataFrame:
    """source_id, ok, via, path_rank, n, diag of each source: the first good path and what the paths up to it said. sources: source_id, desc_min (null or 0: no gate)."""
    gate = F.coalesce("desc_min", F.lit(0))
    x = attempted.join(sources.select("source_id", "desc_min"), "source_id", "left").withColumn("good", F.col("ok") & ((gate == 0) | (F.col("desc_median") >= gate)))
    x = x.withColumn("said", told(gate))
    first = F.min_by(F.struct("path_rank", "host", "n"), F.when(F.col("good"), F.col("path_rank")))
    s = x.groupBy("source_id").agg(first.alias("first"), F.array_sort(F.collect_list(F.struct("path_rank", "said"))).alias("all"))
    upto = F.filter("all", lambda p: F.col("first").isNull() | (p["path_rank"] <= F.col("first.path_rank")))
    return s.select("source_id", F.col("first").isNotNull().alias("ok"), F.col("first.host").alias("via"), F.col("first.path_rank").alias("path_rank"), F.coalesce("first.n", F.lit(0)).alias("n"), F.transform(upto, lambda p: p["said"]).alias("diag"))


def chosen_items(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """The entries of each source's chosen path."""
    return rows.filter("ord is not null").drop("error").join(chosen.filter("ok").select(*KEYS, "via"), KEYS)
