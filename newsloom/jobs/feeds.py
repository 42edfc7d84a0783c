"""Queries of parsers, responses, residue cleaning, sinks and streams, with their SQL.

Bodies, responses and diagnostics are derived from the driver's tables by Spark.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import config as C
from ..functions import text as X
from ..functions.residue import clean_web_junk as cleaned
from ..operators import curated as U
from ..operators import fetching as G
from ..operators import report as R
from ..operators import responses as M
from ..operators import select as L
from ..session import handover, shared_dir
from ..sources import feeds as B
from ..sources import reports as V
from ..sources import settings as N
from ..sources import sinks as K
from ..sources.items import items, table
from ..streaming import jobs as T
from . import sqltext as Q
from .registering import register

QUERIES, ORACLES = {}, {}
query = register(QUERIES, ORACLES)

# XML bodies: one per source and day, titles reduced to letters, digits and blanks
_PLAIN_TITLE = "trim(regexp_replace(coalesce({}, ''), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
_STAMP = "strftime(dt, '%Y-%m-%d %H:%M:%S')"


def _stories(spark, d):
    title = F.trim(F.regexp_replace(F.coalesce("title", F.lit("")), r"[^\p{L}\p{N}]+", " "))
    return items(spark, d, desc=False).select("run_date", "source_id", "pos", title.alias("title"), "url", "dt").withColumn("page", F.floor(F.col("pos") / PAGE))


PAGE = 3000  # ids a body may span, so that bodies don't grow with the table


def _bodies(rows, entry, head, tail):
    """Entries of a source, day and page in order of pos, as one body."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", entry.alias("x")))), lambda e: e["x"]), "")
    return rows.groupBy("run_date", "source_id", "page").agg(text.alias("body")).withColumn("body", F.concat(head, "body", tail))


def _element(name, value):
    return F.concat(F.lit(f"<{name}>"), F.coalesce(value, F.lit("")), F.lit(f"</{name}>"))


# Bodies of three shapes, by page and source: usual prefixes; other prefixes; other prefixes with the channels one level deeper.


def _by_shape(*values):
    shape, out = F.pmod(F.col("page") + F.ascii(F.right("source_id", F.lit(1))), F.lit(3)), F.lit(values[0])
    for i, v in enumerate(values[1:], 1):
        out = F.when(shape == i, v).otherwise(out)
    return out


def _prefixed(name, prefix, value):
    tag = F.concat(prefix, F.lit(name))
    return F.concat(F.lit("<"), tag, F.lit(">"), F.coalesce(value, F.lit("")), F.lit("</"), tag, F.lit(">"))


@query(Q.chain("items", f" SELECT run_date, source_id, {_PLAIN_TITLE.format('title')} AS title, CASE WHEN pos % 5 <> 1 THEN replace(url, '&', '') ELSE 'https://guid.example.com/' || pos END AS url, CASE WHEN pos % 2 = 0 THEN 'full ' || pos ELSE 'short ' || pos END AS \"desc\", {_STAMP} AS dt FROM items"))
def parse_rss(spark, d):
    p = F.col("pos").cast("string")
    stamp = F.concat(F.date_format("dt", "E, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    entry = F.concat(
        F.lit("<item>"),
        _element("title", F.concat(F.lit("&lt;b&gt;"), "title", F.lit("&lt;/b&gt;"))),
        F.when(F.col("pos") % 5 != 1, _element("link", F.col("url"))).otherwise(F.concat(F.lit("<link></link><guid isPermaLink=\"false\">https://guid.example.com/"), p, F.lit("</guid>"))),
        _element("description", F.concat(F.lit("short "), p)),
        F.when(F.col("pos") % 2 == 0, _prefixed("encoded", _by_shape("content:", "c:", "x:"), F.concat(F.lit("full "), p))).otherwise(""),
        F.when(F.col("pos") % 3 == 0, _prefixed("date", _by_shape("dc:", "d:", "y:"), stamp)).otherwise(_element("pubDate", stamp)),
        F.lit("</item>"),
    )
    names = [f'<rss xmlns:{c}="http://purl.org/rss/1.0/modules/content/" xmlns:{n}="http://purl.org/dc/elements/1.1/">' for c, n in (("content", "dc"), ("c", "d"), ("x", "y"))]
    head = _by_shape(f"{names[0]}<channel>", f"{names[1]}<channel>", f"{names[2]}<all><channel><title>no item</title></channel><channel>")
    return B.parse_rss(_bodies(_stories(spark, d), entry, head, _by_shape("</channel></rss>", "</channel></rss>", "</channel></all></rss>"))).drop("ord", "page")


@query(Q.chain("items", f" SELECT run_date, source_id, {_PLAIN_TITLE.format('title')} AS title, CASE WHEN pos % 4 = 0 THEN 'https://self.example.com/' || pos ELSE url END AS url, 'text ' || pos AS \"desc\", {_STAMP} AS dt FROM items"))
def parse_atom(spark, d):
    p = F.col("pos").cast("string")
    pre = _by_shape("", "a:", "atom:")
    me = F.concat(F.lit("<"), pre, F.lit('link rel="self" href=" https://self.example.com/'), p, F.lit('"/>'))
    link = F.concat(F.lit("<"), pre, F.lit("link"), F.when(F.col("pos") % 2 == 0, ' rel="alternate"').otherwise(""), F.lit(' href="'), "url", F.lit('"/>'))
    stamp = F.date_format("dt", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    entry = F.concat(
        *[F.lit("<"), pre, F.lit("entry>")],
        _prefixed("title", pre, F.col("title")),
        F.when(F.col("pos") % 4 == 0, me).otherwise(F.concat(me, link)),
        F.when(F.col("pos") % 3 == 0, _prefixed("content", pre, F.concat(F.lit("text "), p))).otherwise(_prefixed("summary", pre, F.concat(F.lit("text "), p))),
        F.when(F.col("pos") % 2 == 0, _prefixed("published", pre, stamp)).otherwise(_prefixed("updated", pre, stamp)),
        *[F.lit("</"), pre, F.lit("entry>")],
    )
    head = _by_shape('<feed xmlns="http://www.w3.org/2005/Atom">', '<a:feed xmlns:a="http://www.w3.org/2005/Atom">', '<all xmlns:atom="http://www.w3.org/2005/Atom"><atom:feed>')
    return B.parse_atom(_bodies(_stories(spark, d), entry, head, _by_shape("</feed>", "</a:feed>", "</atom:feed></all>"))).drop("ord", "page")


@query(Q.chain("items", f" SELECT run_date, source_id, {_PLAIN_TITLE.format('title')} AS title, CASE WHEN pos % 3 = 0 THEN '{B.PAPERS}' || pos ELSE url END AS url, 'about ' || pos AS \"desc\", {_STAMP} AS dt FROM items WHERE {_PLAIN_TITLE.format('title')} <> ''"))
def parse_json_items(spark, d):
    return _parsed_json(spark, d)


def _parsed_json(spark, d):
    p = F.col("pos").cast("string")
    about = F.concat(F.lit("about "), p)
    none = F.lit(None).cast("string")
    paper = F.when(F.col("pos") % 2 == 0, F.struct("title", about.alias("summary")))
    flat = F.col("pos") % 2 == 1
    stamp = F.date_format("dt", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    row = F.struct(
        "pos", F.when(flat, F.col("title")).alias("title"), F.when(flat, about).alias("description"), paper.alias("paper"),
        F.when(F.col("pos") % 3 == 0, none).otherwise(F.col("url")).alias("url"), p.alias("id"),
        F.when(F.col("pos") % 4 == 0, stamp).alias("publishedAt"), F.when(F.col("pos") % 4 != 0, stamp).alias("createdAt"),
    )
    rows = _stories(spark, d).filter("title <> ''").groupBy("run_date", "source_id", "page").agg(F.array_sort(F.collect_list(row)).alias("papers"))
    body = F.when(F.size("papers") % 2 == 0, F.to_json("papers")).otherwise(F.to_json(F.struct("papers")))
    return B.parse_json_items(rows.select("run_date", "source_id", "page", body.alias("body"))).drop("ord", "page")


def _listed(rows, entry, key, root=None):
    """Bodies by `key` and page: entries in order of the struct's first field."""
    rows = rows.groupBy(key, "page").agg(F.array_sort(F.collect_list(entry)).alias("x"))
    return rows.select(key, "page", F.to_json(F.struct(F.col("x").alias(root)) if root else F.col("x")).alias("body"))


_FIRST = f"QUALIFY row_number() OVER (PARTITION BY p_size, p_partkey // {PAGE} ORDER BY {{}}p_partkey) <= {{}}"


def _parts(spark, d):
    return table(spark, d, "part").withColumn("page", F.floor(F.col("p_partkey") / PAGE))


@query(
    f"""WITH m AS (SELECT *, CASE WHEN p_partkey % 7 <> 0 THEN TIMESTAMP '{C.AS_OF}' - to_days(CAST(p_partkey % 5 AS INT)) END AS dt FROM part)
    SELECT p_size, '新模型上架：' || CASE WHEN p_partkey % 11 = 0 THEN 'm/' || p_partkey ELSE p_name END AS title,
      concat_ws('；', p_brand || ' 出品', strftime(dt, '%Y-%m-%d') || ' 上架', CASE WHEN p_partkey % 2 = 0 THEN 'LMArena Elo ' || (1000 + p_partkey % 500) || CASE WHEN p_partkey % 4 = 0 THEN '（LMArena 第 ' || p_partkey || '）' ELSE '' END END,
        CASE WHEN p_partkey % 3 = 0 THEN '开源权重' ELSE '闭源' END, '上下文 ' || format('{{:,}}', p_size * 1000) || ' tokens', '定价 $' || (p_partkey % 9) || '/$' || (p_partkey % 8) || ' 每百万 tokens') AS "desc",
      '{B.ROUTER}m/' || p_partkey AS url, strftime(dt, '%Y-%m-%d %H:%M:%S') AS dt
    FROM m WHERE dt IS NULL OR dt >= TIMESTAMP '{C.AS_OF}' - INTERVAL 3 DAY {_FIRST.format('m.dt DESC NULLS LAST, ', 12)}"""
)
def parse_model_listing(spark, d):
    p = F.col("p_partkey")
    stamp = F.date_format(F.lit(C.AS_OF).cast("timestamp") - F.make_interval(days=(p % 5).cast("int")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    entry = F.struct(
        p, F.concat(F.lit("m/"), p.cast("string")).alias("id"), F.when(p % 11 != 0, F.col("p_name")).alias("display_name"), F.col("p_brand").alias("org"), F.when(p % 7 != 0, stamp).alias("listed_at_iso"),
        F.when(p % 2 == 0, 1000 + p % 500).alias("arena_score"), F.when(p % 4 == 0, p).alias("arena_rank"), (p % 3 == 0).alias("open_weights"), (F.col("p_size") * 1000).alias("context_length"), (p % 9).alias("price_in"), (p % 8).alias("price_out"),
    )
    return B.parse_model_listing(_listed(_parts(spark, d), entry, "p_size", "models"), C.AS_OF).drop("ord", "page")


@query(
    f"""SELECT p_size, '匿名公测模型：' || p_name AS title, concat_ws('；', '上下文 ' || format('{{:,}}', p_size * 1000) || ' tokens', CASE WHEN p_partkey % 4 <> 0 THEN '输入 $' || (p_partkey % 9) || ' / 输出 $' || (p_partkey % 8) || ' 每百万 tokens' END, '输入模态 text/' || lower(p_brand), p_type) AS "desc",
      '{B.ROUTER}' || CASE WHEN p_partkey % 2 = 0 THEN 'stealth/' ELSE 'Stealth/' END || p_partkey AS url, CAST(NULL AS VARCHAR) AS dt FROM part WHERE p_partkey % 3 <> 0 {_FIRST.format('', 10)}"""
)
def parse_stealth_models(spark, d):
    p = F.col("p_partkey")
    name = F.when(p % 3 == 0, "alpha/").when(p % 2 == 0, "stealth/").otherwise("Stealth/")
    entry = F.struct(
        p, F.concat(name, p.cast("string")).alias("id"), F.col("p_name").alias("name"), (F.col("p_size") * 1000).alias("context_length"), F.when(p % 4 != 0, F.struct((p % 9).alias("prompt"), (p % 8).alias("completion"))).alias("pricing"),
        F.struct(F.array(F.lit("text"), F.lower("p_brand")).alias("input_modalities")).alias("architecture"), F.regexp_replace("p_type", " ", "  ").alias("description"),
    )
    return B.parse_stealth_models(_listed(_parts(spark, d), entry, "p_size", "data")).drop("ord", "page")


@query(
    f"""SELECT p_size, 'HF 新模型：m/' || p_partkey AS title, concat_ws('；', '创建于 2024-01-30', '下载 ' || format('{{:,}}', p_partkey * 1000), '点赞 ' || (p_partkey % 13), '标签 ' || lower(p_brand) || ', ' || lower(p_type)) AS "desc",
      '{B.HUB}m/' || p_partkey AS url, '2024-01-30 08:00:00' AS dt FROM part WHERE p_partkey % 13 >= 2 AND lower(p_brand) <> 'brand#11' {_FIRST.format('', 8)}"""
)
def parse_new_models(spark, d):
    p = F.col("p_partkey")
    entry = F.struct(p, F.concat(F.lit("m/"), p.cast("string")).alias("modelId"), F.lit("2024-01-30T08:00:00.000Z").alias("createdAt"), (p % 13).alias("likes"), (p * 1000).alias("downloads"), F.array("p_brand", "p_type").alias("tags"))
    return B.parse_new_models(_listed(_parts(spark, d), entry, "p_size"), ["BRAND#11"]).drop("ord", "page")


@query(
    f"""SELECT p_size, 'Spaces 应用：s/' || p_partkey AS title, concat_ws('；', CASE WHEN p_partkey % 2 = 0 THEN '技术栈 gradio' END, '点赞 ' || (p_partkey % 13), '最近更新 2024-01-31') AS "desc",
      '{B.APPS}s/' || p_partkey AS url, '2024-01-31 09:00:00' AS dt FROM part {_FIRST.format('', 6)}"""
)
def parse_spaces(spark, d):
    p = F.col("p_partkey")
    entry = F.struct(p, F.concat(F.lit("s/"), p.cast("string")).alias("id"), F.when(p % 2 == 0, "gradio").otherwise("").alias("sdk"), (p % 13).alias("likes"), F.lit("2024-01-31T09:00:00.000Z").alias("lastModified"))
    return B.parse_spaces(_listed(_parts(spark, d), entry, "p_size")).drop("ord", "page")


_CHOSEN = f"pos % 3 <> 0 AND pos % 7 <> 0 AND {_PLAIN_TITLE.format('title')} <> ''"
_CURATED = f"""SELECT run_date, substr({_PLAIN_TITLE.format('title')}, 1, 150) AS title, substr('EN ' || {_PLAIN_TITLE.format('title')}, 1, 150) AS title_en, 'a b ' || pos AS "desc",
  url, {_STAMP} AS dt, coalesce({Q.AGE}, -1) AS age_h, upper(source_id) AS block, CAST(pos % 100 AS INT) AS score, CASE WHEN pos % 2 = 0 THEN 'why ' || pos ELSE '' END AS reason,
  CASE WHEN pos % 5 = 0 THEN 'other' ELSE '{B.CURATED[0]}' END AS attribution, coalesce({Q.AGE} > {C.LANE_HOURS['hot']}, false) AS stale FROM items WHERE {_CHOSEN}"""


def _curated(spark, d):
    p = F.col("pos")
    stamp = F.date_format("dt", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    entry = F.struct(
        "pos", "title", F.concat(F.lit("EN "), "title").alias("originalTitle"), F.concat(F.lit("a \n b  "), p.cast("string")).alias("summary"), F.struct(F.concat(F.upper("source_id"), F.lit("（RSS）")).alias("name")).alias("source"),
        F.struct(F.when(p % 7 != 0, F.col("url")).alias("original")).alias("links"), F.when(p % 2 == 0, stamp).alias("publishedAt"), stamp.alias("discoveredAt"), (p % 100).alias("score"), (p % 3 != 0).alias("selected"),
        F.when(p % 2 == 0, F.concat(F.lit(" why "), p.cast("string"))).alias("reason"), F.when(p % 5 == 0, F.struct(F.lit("other").alias("name"))).alias("attribution"),
    )
    return B.parse_curated(_listed(_stories(spark, d), entry, "run_date", "items"), C.AS_OF).drop("ord", "page")


@query(Q.chain("items", f" SELECT * EXCLUDE (stale) FROM ({_CURATED})"))
def parse_curated(spark, d):
    return _curated(spark, d).withColumn("attribution", F.col("attribution.name")).drop("stale", "category")


@query(Q.chain("items", f" SELECT url, age_h, stale FROM ({_CURATED})"))
def curated_stale(spark, d):
    """Curated rows beyond the window are marked, not dropped."""
    return _curated(spark, d).select("url", "age_h", "stale")


@query(
    Q.chain(
        "items",
        f""" SELECT run_date, {_PLAIN_TITLE.format('title')} AS title, source_id, CAST(NULL AS INT) AS score FROM items WHERE {_PLAIN_TITLE.format('title')} <> ''
        UNION ALL SELECT run_date, title, NULL, score FROM ({_CURATED})""",
    )
)
def union_sources(spark, d):
    """Parsed rows and curated ones in one table; what a part lacks is null."""
    parsed = _parsed_json(spark, d)
    return U.union_sources(parsed, _curated(spark, d)).select("run_date", "title", "source_id", "score")


_LANE = f"CASE WHEN s_suppkey % 9 = 8 THEN 'other' ELSE {C.LANES}[CAST(s_suppkey % 9 AS INT) + 1] END"
_ENABLED = "s_suppkey % 4 <> 0"


def _settings(spark, d):
    """Configuration files with the suppliers as sources, a thousand a file, written and read."""
    k = F.col("s_suppkey")
    lane = F.when(k % 9 == 8, "other").otherwise(F.get(F.array(*[F.lit(x) for x in C.LANES]), (k % 9).cast("int")))
    name = k.cast("string")
    source = F.struct(
        name.alias("id"), lane.alias("lane"), F.upper("s_name").alias("block"), (k % 4 != 0).alias("enabled"), F.lit("auto").alias("mode"), F.concat(F.lit("/r/"), name).alias("route"),
        F.array(F.concat(F.lit("https://a.example.com/"), name)).alias("urls"), F.when(k % 5 != 0, k % 5 - 1).alias("take"),
    )
    rows = table(spark, d, "supplier").groupBy(F.floor(k / 1000).alias("file")).agg(F.collect_list(source).alias("sources"))
    lanes = F.array(*[F.struct(F.lit(x).alias("id"), F.upper(F.lit(x)).alias("name")) for x in C.LANES])
    path = f"{shared_dir(spark)}/settings-{uuid.uuid4().hex}"
    rows.select("file", F.to_json(F.struct(lanes.alias("lanes"), "sources")).alias("value")).repartition("file").write.partitionBy("file").text(path)
    return N.read_settings(spark, path)


@query(f"WITH s AS (SELECT s_suppkey, {_LANE} AS lane FROM supplier) SELECT CAST(s_suppkey AS VARCHAR) AS source_id, lane, {Q.RANK} AS lane_rank FROM s")
def dim_sources(spark, d):
    return _settings(spark, d)[1].select("source_id", "lane", "lane_rank")


@query(f"WITH s AS (SELECT *, {_LANE} AS lane FROM supplier) SELECT CAST(s_suppkey AS VARCHAR) AS source_id, upper(s_name) AS block FROM s WHERE {_ENABLED} AND s_suppkey % 5 <> 1 AND lane = 'apps'")
def enabled_sources(spark, d):
    """Sources of one lane that are on and take something."""
    return N.enabled_sources(_settings(spark, d)[1], "apps").select("source_id", "block")


@query(
    """WITH s AS (SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'direct' WHEN 1 THEN 'rsshub' ELSE 'auto' END AS mode FROM supplier),
    p AS (SELECT s_suppkey, 0 AS k, 'https://a.example.com/' || s_suppkey AS url FROM s WHERE mode <> 'rsshub'
      UNION ALL SELECT s_suppkey, k, h || '/r/' || s_suppkey FROM s, (VALUES (1, 'https://hub1.example.com'), (2, 'https://hub2.example.com')) t(k, h) WHERE mode <> 'direct')
    SELECT s_suppkey AS source_id, CAST(row_number() OVER (PARTITION BY s_suppkey ORDER BY k) - 1 AS INT) AS path_rank, url FROM p"""
)
def candidate_paths(spark, d):
    k = F.col("s_suppkey").cast("string")
    mode = F.element_at(F.array(F.lit("direct"), F.lit("rsshub"), F.lit("auto")), (F.col("s_suppkey") % 3 + 1).cast("int"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("source_id"), mode.alias("mode"), F.array(F.concat(F.lit("https://a.example.com/"), k)).alias("urls"), F.concat(F.lit("/r/"), k).alias("route"))
    return B.candidate_paths(s, ["https://hub1.example.com/", "https://hub2.example.com"])


@query("SELECT user_id AS source_id, arg_max(props, event_id) AS body FROM events WHERE event_type <> 'error' AND props <> '' GROUP BY user_id")
def curated_snapshot(spark, d):
    pulls = table(spark, d, "events").select(F.col("user_id").alias("source_id"), F.when(F.col("event_type") == "error", 304).otherwise(200).alias("status"), F.col("props").alias("body"), F.col("event_id").alias("fetched_at"))
    return B.latest_snapshot(pulls).select("source_id", "body")


# responses: batch = conversation, i = turn; every third is cut off in its last row, every third is fenced

_SENT = """sent AS (SELECT conv_id AS batch_id, CAST(turn AS INT) AS i, turn % 2 = 0 AS translate, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY conv_id % 5 = 4 AND turn <> 0, turn DESC, coalesce(text, '') DESC) AS back FROM conversations)"""
_GOT = _SENT + """, got AS (SELECT batch_id, i, translate, text, CASE WHEN i % 3 <> 1 THEN '译文 ' || i END AS title, CASE WHEN i % 4 <> 3 AND batch_id % 7 <> 6 THEN 'why ' || i END AS reason FROM sent WHERE (batch_id % 3 <> 1 OR back > 1) AND (batch_id % 5 <> 4 OR i = 0)),
acc AS (SELECT batch_id, count(*) AS rows, count(*) FILTER (translate AND title IS NOT NULL) AS titles, count(reason) AS reasons FROM got GROUP BY 1),
need AS (SELECT batch_id, count(*) AS n, count(*) FILTER (translate) AS need FROM sent GROUP BY 1),
verdict AS (SELECT batch_id, rows, titles, reasons, rows >= greatest(1, n // 2) AND (need = 0 OR titles >= greatest(1, need * 3 // 10)) AS accepted, reasons < greatest(1, n * 3 // 10) AS low_yield FROM acc JOIN need USING (batch_id))"""


def _sent(spark, d):
    return table(spark, d, "conversations").select(F.col("conv_id").alias("batch_id"), F.col("turn").cast("int").alias("i"), (F.col("turn") % 2 == 0).alias("translate"), F.coalesce("text", F.lit("")).alias("text"))


def _responses(spark, d):
    i = F.col("i")
    row = F.struct(
        "i", "text", F.when(i % 3 != 1, F.concat(F.lit("译文 "), i.cast("string"))).otherwise("").alias("title"), F.when((i % 4 != 3) & (F.col("batch_id") % 7 != 6), F.concat(F.lit("why "), i.cast("string"))).alias("reason"),
        F.when(i % 2 == 0, "agent").alias("kind"), (i + 5).alias("rel"), F.lit(3).alias("info"), F.when(i % 5 == 4, "x").otherwise("7").alias("fresh"),
    )
    answered = _sent(spark, d).filter("batch_id % 5 <> 4 or i = 0")  # every fifth batch brings its first row alone
    x = answered.groupBy("batch_id").agg(F.to_json(F.array_sort(F.collect_list(row))).alias("t"))
    cut = F.when(F.col("batch_id") % 3 == 1, F.expr("left(t, length(t) - 6)")).when(F.col("batch_id") % 3 == 2, F.concat(F.lit("```json\n"), "t", F.lit("\n```"))).otherwise(F.col("t"))
    return x.select("batch_id", F.lit(0).alias("model_rank"), cut.alias("text"))


@query(f"WITH {_GOT} SELECT batch_id, i, title, reason, CASE WHEN i % 2 = 0 THEN 'agent' END AS apptype, CASE WHEN i % 5 <> 4 THEN least(10, i + 5) END AS rel FROM got")
def lenient_json_array(spark, d):
    return M.response_rows(_responses(spark, d)).select("batch_id", "i", "title", "reason", "apptype", F.col("score.rel").alias("rel"))


@query(f"WITH {_GOT} SELECT * FROM verdict")
def response_acceptance(spark, d):
    return M.acceptance(M.response_rows(_responses(spark, d)), _sent(spark, d)).drop("model_rank")


@query(f"WITH {_GOT}, told AS (SELECT batch_id, i, max(title) AS title, max(reason) AS reason FROM got JOIN verdict USING (batch_id) WHERE accepted GROUP BY 1, 2) SELECT s.batch_id, s.i, md5(s.text) AS text, CASE WHEN s.translate THEN t.title END AS title_cn, t.reason FROM sent s LEFT JOIN told t USING (batch_id, i)")
def response_join_back(spark, d):
    sent, rows = _sent(spark, d), M.response_rows(_responses(spark, d))
    return M.join_back(sent, rows, M.acceptance(rows, sent)).select("batch_id", "i", F.md5(F.col("text").cast("binary")).alias("text"), "title_cn", "reason")


# Two models answer batches of five texts: the first translates every second batch, but for texts of every third place; of the rest it says the text itself, or too little.
_BODIES = """WITH s AS (SELECT doc_id // 5 AS batch_id, CAST(doc_id % 5 AS INT) AS i, text FROM documents),
t AS (SELECT batch_id, i, 0 AS model_rank, '译文 ' || rpad(CAST(batch_id * 5 + i AS VARCHAR), 70, '文') AS desc_zh FROM s WHERE batch_id % 2 = 0 AND i % 3 <> 2
  UNION ALL SELECT batch_id, i, 1, '再译 ' || rpad(CAST(batch_id * 5 + i AS VARCHAR), 60, '文') FROM s WHERE batch_id % 7 <> 3)"""


def _body_responses(spark, d):
    sent = table(spark, d, "documents").select(F.floor(F.col("doc_id") / 5).alias("batch_id"), (F.col("doc_id") % 5).cast("int").alias("i"), "text")
    at = (F.col("batch_id") * 5 + F.col("i")).cast("string")
    first = F.when((F.col("batch_id") % 2 == 0) & (F.col("i") % 3 != 2), F.concat(F.lit("译文 "), F.rpad(at, 70, "文"))).when(F.col("batch_id") % 2 == 0, "译文太短").otherwise(F.rpad(F.lit("English only "), 80, "x"))
    second = F.when(F.col("batch_id") % 7 != 3, F.concat(F.lit(" 再译 "), F.rpad(at, 60, "文"), F.lit("\n"))).otherwise("")
    answers = [sent.groupBy("batch_id").agg(F.to_json(F.collect_list(F.struct("i", zh.alias("zh")))).alias("text")).withColumn("model_rank", F.lit(k)) for k, zh in enumerate((first, second))]
    return sent, answers[0].unionByName(answers[1])


@query(_BODIES + " SELECT b.batch_id, m.model_rank, count(t.i) AS translated, count(t.i) > 0 AS accepted FROM (SELECT DISTINCT batch_id FROM s) b CROSS JOIN (VALUES (0), (1)) m(model_rank) LEFT JOIN t ON t.batch_id = b.batch_id AND t.model_rank = m.model_rank GROUP BY 1, 2")
def body_acceptance(spark, d):
    sent, answers = _body_responses(spark, d)
    return M.body_acceptance(answers, M.body_rows(answers, sent))


@query(_BODIES + ", f AS (SELECT batch_id, min(model_rank) AS r FROM t GROUP BY 1) SELECT s.batch_id, s.i, t.desc_zh FROM s LEFT JOIN f USING (batch_id) LEFT JOIN t ON t.batch_id = s.batch_id AND t.i = s.i AND t.model_rank = f.r")
def body_join_back(spark, d):
    """Translated bodies: the first model's if any of its rows counts, else the second's."""
    sent, answers = _body_responses(spark, d)
    return M.join_bodies(sent.select("batch_id", "i"), M.body_rows(answers, sent))


@query("SELECT event_id, event_type AS host, CASE event_id % 3 WHEN 0 THEN 'ok' WHEN 1 THEN 'short' ELSE 'error' END AS outcome, CASE WHEN event_id % 3 = 0 THEN CAST(event_id % 50 AS INT) END AS n, CASE WHEN event_id % 3 < 2 THEN CAST(user_id AS INT) END AS desc_median, CASE WHEN event_id % 3 = 2 THEN 429 END AS code FROM events")
def diag_parse(spark, d):
    e, m = F.col("event_id"), F.col("user_id").cast("string")
    line = F.when(e % 3 == 0, F.concat(F.lit("OK("), (e % 50).cast("string"), F.lit("条/desc"), m, F.lit(")"))).when(e % 3 == 1, F.concat(F.lit("desc中位"), m, F.lit("<300跳过"))).otherwise("HTTPError 429")
    return table(spark, d, "events").select("event_id", M.parse_diag(F.concat("event_type", F.lit(":"), line)).alias("x")).select("event_id", "x.*")


@query()
def clean_web_junk(spark, d):
    """Whole texts behind a piece of residue: SQL has no rounds, the tests have known answers."""
    head = F.element_at(F.array(F.lit("Loading… Share "), F.lit(':last-child]:mb-0"> '), F.lit("| "), F.lit("")), (F.col("doc_id") % 4 + 1).cast("int"))
    return table(spark, d, "documents").select("doc_id", F.md5(cleaned(F.concat(head, F.coalesce("text", F.lit("")))).cast("binary")).alias("cleaned"))


# Three paths a source: the first one is down, not well-formed, empty or too short, by the source's number; the second is of another kind; the third is good.
_GATES = f"""WITH items AS (SELECT source, doc_id AS pos, CAST(regexp_extract(source, '(\\d+)', 1) AS INT) AS no FROM documents),
s AS (SELECT source AS source_id, any_value(no) AS no, count(*) AS n FROM items GROUP BY source),
p AS (SELECT source_id, no, n, r, CASE r WHEN 0 THEN 'a.example.com' WHEN 1 THEN 'b.example.com' ELSE 'c.example.com' END AS host,
  CASE WHEN r = 0 THEN CASE no % 5 WHEN 0 THEN 'HTTPError503' WHEN 1 THEN 'ParseError' WHEN 2 THEN 'RuntimeError' END WHEN r = 1 AND no % 4 = 0 THEN 'JSONDecodeError' WHEN r = 2 AND no % 6 = 0 THEN 'URLError' END AS error,
  CASE r WHEN 0 THEN 6 WHEN 1 THEN 60 ELSE 90 END AS dm, CASE WHEN no % 2 = 1 THEN 60 + no % 4 * 10 ELSE 0 END AS gate FROM s, range(3) t(r)),
told AS (SELECT *, error IS NULL AND (gate = 0 OR dm >= gate) AS good, host || ':' || CASE WHEN error IS NOT NULL THEN error WHEN dm < gate THEN 'desc中位' || dm || '<' || gate || '跳过' ELSE 'OK(' || n || '条/desc' || dm || ')' END AS said FROM p),
f AS (SELECT source_id, min(r) FILTER (good) AS r FROM told GROUP BY source_id)"""


def _landed_paths(spark, d):
    """Bodies of each source's three paths, from its documents; sources (source_id, desc_min)."""
    docs = table(spark, d, "documents")
    no = F.regexp_extract("source", r"(\d+)", 1).cast("int")
    p = F.col("doc_id").cast("string")
    text = lambda n: F.rpad(F.concat(F.lit("t"), p), n, "x")
    entry = lambda n: F.concat(F.lit("<item><title>t"), p, F.lit("</title><description>"), text(n), F.lit("</description><link>http://x/"), p, F.lit("</link></item>"))
    paper = F.struct(F.concat(F.lit("t"), p).alias("title"), text(60).alias("description"), F.concat(F.lit("http://x/"), p).alias("url"))
    joined = lambda x: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", x.alias("x")))), lambda e: e["x"]), "")
    s = docs.groupBy(F.col("source").alias("source_id"), no.alias("no")).agg(joined(entry(6)).alias("a"), F.to_json(F.struct(F.collect_list(paper).alias("items"))).alias("b"), joined(entry(90)).alias("c"))
    k = F.col("no")
    rss = lambda c: F.concat(F.lit("<rss><channel>"), c, F.lit("</channel></rss>"))
    first = F.when(k % 5 == 1, F.concat(F.lit("<rss>"), "a")).when(k % 5 == 2, "<html></html>").otherwise(rss(F.col("a")))
    paths = F.array(
        F.struct(F.lit("a.example.com").alias("host"), F.lit("rss").alias("kind"), F.when(k % 5 == 0, 503).otherwise(200).alias("status"), first.alias("body")),
        F.struct(F.lit("b.example.com").alias("host"), F.lit("json").alias("kind"), F.lit(200).alias("status"), F.when(k % 4 == 0, F.concat(F.lit("{"), "b")).otherwise(F.col("b")).alias("body")),
        F.struct(F.lit("c.example.com").alias("host"), F.lit("rss").alias("kind"), F.when(k % 6 != 0, 200).alias("status"), F.when(k % 6 != 0, rss(F.col("c"))).alias("body")),
    )
    bodies = handover(s.select("source_id", F.posexplode(paths).alias("path_rank", "p")).select("source_id", "path_rank", "p.*"), "landed")
    return bodies, s.select("source_id", F.when(k % 2 == 1, 60 + k % 4 * 10).alias("desc_min"))


def _fetched(spark, d):
    bodies, sources = _landed_paths(spark, d)
    rows = handover(G.parsed(bodies), "parsed")
    return rows, G.choose(G.attempts(bodies, rows), sources)


@query(_GATES + " SELECT t.source_id, any_value(f.r) IS NOT NULL AS ok, any_value(host) FILTER (t.r = f.r) AS via, CAST(coalesce(any_value(n) FILTER (t.r = f.r), 0) AS BIGINT) AS n, string_agg(said, '; ' ORDER BY t.r) FILTER (f.r IS NULL OR t.r <= f.r) AS diag FROM told t JOIN f USING (source_id) GROUP BY t.source_id")
def source_paths(spark, d):
    """Each source's chosen path, from parsed bodies and its own gate, with what the paths said."""
    return _fetched(spark, d)[1].select("source_id", "ok", "via", F.col("n").cast("long").alias("n"), F.array_join("diag", "; ").alias("diag"))


@query(_GATES + " SELECT source AS source_id, host AS via, count(*) AS n, CAST(sum(dm) AS BIGINT) AS chars, count(DISTINCT 'http://x/' || pos) AS urls FROM items JOIN told ON told.source_id = source JOIN f ON f.source_id = source AND f.r = told.r GROUP BY ALL")
def fetched_items(spark, d):
    """The entries that came by the chosen paths."""
    rows, chosen = _fetched(spark, d)
    return G.chosen_items(rows, chosen).groupBy("source_id", "via").agg(F.count(F.lit(1)).alias("n"), F.sum(F.char_length("desc")).alias("chars"), F.count_distinct("url").alias("urls"))


# sinks


@query(Q.brief_chain("ordered", " SELECT run_date, pos, ord, level FROM ordered WHERE run_date = (SELECT max(run_date) FROM ordered)"))
def brief_write(spark, d):
    """Days are written, some of them again, and the newest is read back."""
    path = f"{shared_dir(spark)}/brief-{uuid.uuid4().hex}"
    brief = L.brief(items(spark, d, desc=False), C.BRIEF_TAKE).select("run_date", "pos", "ord", "level")
    K.write_brief(brief, path)
    K.write_brief(brief.filter(F.dayofmonth("run_date") % 2 == 1), path)
    return K.latest_brief(spark, path).select("run_date", "pos", "ord", "level")


_FUNNEL = f"""{Q.WINDOWED}, fun AS (
  SELECT r.run_date, r.source_id, r.raw, coalesce(x.deduped, 0) AS deduped, coalesce(x.in_window, 0) AS in_window, coalesce(w.taken, 0) AS taken, coalesce(w.stale, 0) AS stale
  FROM (SELECT run_date, source_id, count(*) AS raw FROM items GROUP BY 1, 2) r
  LEFT JOIN (SELECT run_date, source_id, count(*) AS deduped, count(*) FILTER (inw) AS in_window FROM marked GROUP BY 1, 2) x ON x.run_date = r.run_date AND x.source_id = r.source_id
  LEFT JOIN (SELECT run_date, source_id, count(*) AS taken, count(*) FILTER (stale) AS stale FROM windowed GROUP BY 1, 2) w ON w.run_date = r.run_date AND w.source_id = r.source_id
)"""


def _reports(spark, d):
    """Nested JSON of all days, written and read back."""
    funnel = handover(R.source_funnel(items(spark, d, desc=False)))
    few = funnel.filter("taken < 4").select("run_date", "source_id", F.concat(F.lit("taken "), F.col("taken").cast("string")).alias("reason"))
    counts = funnel.groupBy("run_date").agg(F.sum("taken").alias("total"), F.sum("stale").alias("stale"))
    path = f"{shared_dir(spark)}/reports-{uuid.uuid4().hex}"
    K.run_report(funnel, few, counts).write.json(path)
    return K.read_reports(spark, path)


@query(
    Q.chain(
        "dedup",
        f""", {_FUNNEL} SELECT run_date, CAST(sum(taken) AS BIGINT) AS total, CAST(sum(stale) AS BIGINT) AS stale, count(*) AS sources, count(*) FILTER (taken < 4) AS degraded,
        string_agg(source_id || ' ' || raw || ' ' || taken, '; ' ORDER BY source_id) AS told FROM fun GROUP BY run_date""",
    )
)
def run_report_write(spark, d):
    told = F.transform("sources", lambda x: F.concat_ws(" ", x["source_id"], x["raw"].cast("string"), x["taken"].cast("string")))
    x = _reports(spark, d)
    return x.select("run_date", "counts.total", "counts.stale", F.size("sources").cast("long").alias("sources"), F.size("degraded").cast("long").alias("degraded"), F.array_join(told, "; ").alias("told"))


@query(Q.chain("dedup", f", {_FUNNEL} SELECT run_date, source_id, raw, in_window, taken, CASE WHEN taken < 4 THEN 'taken ' || taken END AS reason FROM fun"))
def reports_read(spark, d):
    """Stored reports, a row per run and source."""
    return K.report_sources(_reports(spark, d)).select("run_date", "source_id", "raw", "in_window", "taken", "reason")


# Reports of the days: those of even days in the older shape. Sources with an odd number met a short path first, those that took nothing an error.
_RUNS = f"""{Q.WINDOWED}, fun AS (SELECT i.run_date, i.source_id, count(*) AS raw, (SELECT count(*) FROM windowed w WHERE w.run_date = i.run_date AND w.source_id = i.source_id) AS n FROM items i GROUP BY ALL),
src AS (SELECT *, CAST(right(run_date, 2) AS INT) % 2 = 0 AS old, CAST(regexp_extract(source_id, '(\\d+)', 1) AS INT) AS no FROM fun)"""
_SAID = "[CASE WHEN no % 2 = 1 THEN 'a' || no || ':desc中位' || no || '<300跳过' END, 'b' || no || ':' || CASE WHEN n > 3 THEN 'OK(' || raw || '条/desc' || (300 + no) || ')' ELSE 'HTTPError429' END]"


def _day_reports(spark, d):
    """Reports of all days, written in two shapes and read by one scan."""
    funnel = handover(R.source_funnel(items(spark, d, desc=False)))
    no, fine = F.regexp_extract("source_id", r"(\d+)", 1), F.col("taken") > 3
    short = F.when(no.cast("int") % 2 == 1, F.concat(F.lit("a"), no, F.lit(":desc中位"), no, F.lit("<300跳过")))
    last = F.concat(F.lit("b"), no, F.lit(":"), F.when(fine, F.concat(F.lit("OK("), F.col("raw").cast("string"), F.lit("条/desc"), (no.cast("int") + 300).cast("string"), F.lit(")"))).otherwise("HTTPError429"))
    sources = funnel.select("run_date", F.col("source_id").alias("id"), fine.alias("ok"), F.when(fine, F.concat(F.lit("b"), no)).alias("via"), F.when(fine, F.col("taken")).otherwise(0).alias("n"), F.when(fine, F.col("raw")).alias("raw"), F.array_compact(F.array(short, last)).alias("diag"), "taken")
    degraded = sources.filter("not ok").select("run_date", "id", F.lit("apps").alias("lane"), F.substring(F.array_join("diag", "; "), 1, 200).alias("reason"))
    total = funnel.groupBy("run_date").agg(F.sum("taken").alias("total"), F.sum("stale").alias("repeat"), *[(F.sum("taken") % k).alias(x) for k, x in ((5, "top"), (7, "watch"), (9, "normal"))])
    old = F.dayofmonth("run_date") % 2 == 0
    now = V.day_reports(total, sources, degraded).filter(~old)
    then = F.to_json(F.struct(F.struct("total").alias("counts"), "sources"))
    before = sources.filter(old).groupBy("run_date").agg(F.collect_list(F.struct(F.col("id").alias("source_id"), "taken")).alias("sources")).join(total.select("run_date", "total"), "run_date").select("run_date", then.alias("report"))
    path = f"{shared_dir(spark)}/reports-{uuid.uuid4().hex}"
    V.write_day_reports(now.unionByName(before).repartition("run_date"), path)
    return V.read_reports(spark, path)


@query(
    Q.chain(
        "dedup",
        f""", {_RUNS}, t AS (SELECT run_date, any_value(old) AS old, CAST(sum(n) AS BIGINT) AS total, CAST(sum((SELECT count(*) FROM windowed w WHERE w.run_date = src.run_date AND w.source_id = src.source_id AND stale)) AS BIGINT) AS stale FROM src GROUP BY run_date)
        SELECT run_date, false AS bad, CASE WHEN NOT old THEN run_date || ' 00:00' END AS generated_at, total, CASE WHEN NOT old THEN stale END AS repeat, CASE WHEN NOT old THEN total % 5 END AS top, CASE WHEN NOT old THEN total % 7 END AS watch, CASE WHEN NOT old THEN total % 9 END AS normal FROM t WHERE total > 0""",
    )
)
def report_counts(spark, d):
    """Counts of all stored reports, old and new."""
    return V.report_counts(_day_reports(spark, d))


@query(
    Q.chain(
        "dedup",
        f""", {_RUNS} SELECT run_date, source_id, CASE WHEN old THEN n > 0 ELSE n > 3 END AS ok, CASE WHEN NOT old AND n > 3 THEN 'b' || no END AS via, CAST(CASE WHEN old OR n > 3 THEN n ELSE 0 END AS BIGINT) AS n, CASE WHEN NOT old AND n > 3 THEN raw END AS raw,
        CASE WHEN NOT old AND n <= 3 THEN 'apps' END AS lane, CASE WHEN NOT old AND n <= 3 THEN array_to_string(list_filter({_SAID}, lambda x: x IS NOT NULL), '; ') END AS reason FROM src""",
    )
)
def report_source_rows(spark, d):
    """A row per source of all stored reports, with why it was degraded."""
    return V.report_sources(_day_reports(spark, d)).drop("diag")


@query(
    Q.chain(
        "dedup",
        f""", {_RUNS}, l AS (SELECT run_date, source_id, no, n, raw, unnest(CASE WHEN no % 2 = 1 THEN [0, 1] ELSE [1] END) AS k FROM src WHERE NOT old)
        SELECT run_date, source_id, CAST(CASE WHEN no % 2 = 1 THEN k ELSE 0 END AS INT) AS path_rank, CASE WHEN k = 0 THEN 'a' ELSE 'b' END || no AS host, CASE WHEN k = 0 THEN 'short' WHEN n > 3 THEN 'ok' ELSE 'error' END AS outcome,
        CASE WHEN k = 1 AND n > 3 THEN CAST(raw AS INT) END AS n, CASE WHEN k = 0 THEN no WHEN n > 3 THEN 300 + no END AS desc_median, CASE WHEN k = 1 AND n <= 3 THEN 429 END AS code FROM l""",
    )
)
def report_paths(spark, d):
    """What all paths of all runs said, from the diag lines of the stored reports."""
    return V.report_paths(_day_reports(spark, d))


@query(
    Q.chain(
        "items",
        """, l AS (SELECT nullif(CASE WHEN pos % 5 = 4 THEN '' ELSE split_part(url, '?', 1) END, '') AS url, title, pos FROM items)
        SELECT url, arg_max(title, pos) AS title, max(pos) AS pos FROM l WHERE url IS NOT NULL GROUP BY url""",
    )
)
def cases_read(spark, d):
    """A library stored as JSON lines, some without a url, some urls twice."""
    url = F.when(F.col("pos") % 5 == 4, "").otherwise(F.split("url", r"\?").getItem(0))
    path = f"{shared_dir(spark)}/cases-{uuid.uuid4().hex}"
    items(spark, d, desc=False).select(url.alias("url"), F.coalesce("title", F.lit("")).alias("title"), "pos").write.json(path)
    return K.read_cases(spark.read.schema("url string, title string, pos long").json(path))


@query(
    Q.chain(
        "items",
        """, l AS (SELECT url, CASE WHEN max(pos) % 4 = 0 THEN '' ELSE 'type ' || (max(pos) % 3) END AS type FROM items WHERE lane = 'apps' GROUP BY url)
        SELECT count(*) AS n, array_to_string(list_sort(list_distinct(list(nullif(type, '')))), '|') AS types FROM l""",
    )
)
def cases_write(spark, d):
    """A snapshot of the library; its size and types are read back."""
    p = F.max("pos")
    kind = F.when(p % 4 == 0, "").otherwise(F.concat(F.lit("type "), (p % 3).cast("string")))
    path = f"{shared_dir(spark)}/cases-{uuid.uuid4().hex}"
    K.write_cases(items(spark, d, desc=False).filter("lane = 'apps'").groupBy("url").agg(kind.alias("type")), path, 0)
    return spark.read.schema("n long, types array<string>").json(f"{path}/about/v=*").select("n", F.array_join("types", "|").alias("types"))


# streams: all that has landed is drained, then the sink is read


def _landed(spark, d, name):
    """A table as a stream of its files; a pattern, since a stream's plain path has to be a folder."""
    return spark.readStream.schema(table(spark, d, name).schema).parquet(f"{d}/{name}.parque[t]")


def _arriving(spark, d):
    x = items(spark, d, desc=False, docs=_landed(spark, d, "documents"))
    return x.select("pos", X.item_id(F.col("title")).alias("id"), "title_cn", F.col("run_date").cast("timestamp").alias("seen_at"))


_ID = f"substr(md5({Q.norm('title')}), 1, 10)"


@query(f"SELECT page_id, title, 'about ' || page_id AS \"desc\", substr(md5({Q.norm('title')}), 1, 10) AS id FROM (SELECT page_id, 'Page ' || page_id AS title FROM pages)")
def stream_ingest(spark, d):
    k = F.col("page_id").cast("string")
    body = F.to_json(F.array(F.struct(F.concat(F.lit("Page "), k).alias("title"), F.concat(F.lit("about "), k).alias("description"), F.col("url"))))
    return T.drained(T.ingest(_landed(spark, d, "pages").select("page_id", body.alias("body")), B.parse_json_items), shared_dir(spark)).select("page_id", "title", "desc", "id")


@query(f"SELECT page_id, title, 'about ' || page_id AS \"desc\", 'http://x/' || page_id AS url, substr(md5({Q.norm('title')}), 1, 10) AS id FROM (SELECT page_id, 'Page ' || page_id AS title FROM pages)")
def stream_ingest_mixed(spark, d):
    """JSON, RSS and Atom bodies in one stream."""
    k = F.col("page_id").cast("string")
    json = F.to_json(F.array(F.struct(F.concat(F.lit("Page "), k).alias("title"), F.concat(F.lit("about "), k).alias("description"), F.concat(F.lit("http://x/"), k).alias("url"))))
    rss = F.concat(F.lit("<rss><channel><item><title>Page "), k, F.lit("</title><link>http://x/"), k, F.lit("</link><description>about "), k, F.lit("</description></item></channel></rss>"))
    atom = F.concat(F.lit('<a:feed xmlns:a="http://www.w3.org/2005/Atom"><a:entry><a:title>Page '), k, F.lit('</a:title><a:link href="http://x/'), k, F.lit('"/><a:summary>about '), k, F.lit("</a:summary></a:entry></a:feed>"))
    kind = F.when(F.col("page_id") % 3 == 0, "json").otherwise("rss")
    landed = _landed(spark, d, "pages").select("page_id", kind.alias("kind"), F.when(F.col("page_id") % 3 == 0, json).when(F.col("page_id") % 3 == 1, rss).otherwise(atom).alias("body"))
    return T.drained(T.ingest_mixed(landed), shared_dir(spark)).select("page_id", "title", "desc", "url", "id")


@query(Q.chain("items", f" SELECT DISTINCT {_ID} AS id FROM items"))
def stream_dedup(spark, d):
    return T.drained(T.dedup(_arriving(spark, d)), shared_dir(spark)).select("id")


@query(Q.chain("items", f" SELECT id, arg_min(title_cn, (run_date, title_cn)) AS pinned FROM (SELECT *, {_ID} AS id FROM items) WHERE coalesce(title_cn, '') <> '' GROUP BY id"))
def stream_title_pin(spark, d):
    return T.latest(T.drained(T.title_pins(_arriving(spark, d)), shared_dir(spark), "update"), "id").select("id", "pinned")


@query("SELECT user_id AS source_id, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS since, count(*) AS attempts, count(*) FILTER (event_type = 'error') AS failed FROM events GROUP BY 1, 2, date_trunc('day', ts) HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR")
def stream_health(spark, d):
    """Windows that were over when the last row came."""
    e = _landed(spark, d, "events").select(F.col("user_id").alias("source_id"), F.col("ts").cast("timestamp").alias("ts"), (F.col("event_type") != "error").alias("ok"))
    return T.drained(T.health(e), shared_dir(spark)).select("source_id", "since", "attempts", "failed")


@query(
    """WITH e AS (SELECT user_id AS source_id, event_type = 'error' AS bad, date_trunc('day', ts) - to_days(CAST(k AS INT)) AS since FROM events, range(0, 7) t(k))
    SELECT source_id, strftime(since, '%Y-%m-%d %H:%M:%S') AS since, count(*) AS attempts, count(*) FILTER (bad) AS failed FROM e
    GROUP BY 1, e.since HAVING e.since + INTERVAL 7 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"""
)
def stream_health_week(spark, d):
    """Seven days, sliding by one."""
    e = _landed(spark, d, "events").select(F.col("user_id").alias("source_id"), F.col("ts").cast("timestamp").alias("ts"), (F.col("event_type") != "error").alias("ok"))
    return T.drained(T.health(e, "7 days", "1 day"), shared_dir(spark)).select("source_id", "since", "attempts", "failed")


@query(Q.chain("items", f" SELECT url, arg_max(title, pos) AS title, '{C.AS_OF_DATE}' AS first_seen FROM items WHERE lane = 'apps' AND coalesce(title, '') <> '' GROUP BY url UNION ALL SELECT url, NULL, '{C.AS_OF_DATE}' FROM items WHERE lane = 'apps' GROUP BY url HAVING max(coalesce(title, '')) = ''"))
def stream_cases_upsert(spark, d):
    """An empty library and what has landed, merged batch by batch; the last version is read."""
    x = items(spark, d, desc=False, docs=_landed(spark, d, "documents")).filter("lane = 'apps'")
    new = x.select("url", "pos", "title", F.lit("").alias("summary"), F.lit("").alias("type"), F.lit(7.0).alias("score"), F.lit(5).alias("rel"))
    library = spark.createDataFrame([], "url string, title string, summary string, type string, score double, rel int, first_seen date, last_seen date")
    path = f"{shared_dir(spark)}/cases-{uuid.uuid4().hex}"
    T.cases_upsert(new, library, path, C.AS_OF_DATE).trigger(availableNow=True).option("checkpointLocation", f"{path}/state").start().awaitTermination()
    versions = spark.read.schema(library.schema.add("v", "long")).option("basePath", path).parquet(f"{path}/v=*")
    last = versions.agg(F.max("v").alias("v"))
    return versions.join(F.broadcast(last), "v").select("url", "title", "first_seen")
