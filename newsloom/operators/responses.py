"""Model responses: lenient parsing, acceptance per batch, yield and the join back to the items."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import text as X
from ..functions.residue import BLANKS

# Names under which the form of an application comes back.
TYPE_KEYS = ["type", "apptype", "app_type", "kind", "形态", "应用形态"]
ROW = "array<struct<i:int, title:string, summary:string, reason:string, topic:string, rel:string, info:string, fresh:string, " + ", ".join(f"`{k}`:string" for k in TYPE_KEYS) + ">>"
MOST_CUTS = 40


def whole_array(text: str | None) -> str | None:
    """A JSON array as it is, or what remains of a truncated one after its last complete row; else null."""
    text = text or ""
    ends = [len(text), *(k + 1 for k in range(len(text) - 1, -1, -1) if text[k] == "}")][: MOST_CUTS + 1]
    for n, end in enumerate(ends):
        tried = text if n == 0 else text[:end].rstrip(", \n\t") + "]"
        try:
            rows = json.loads(tried)
        except ValueError:
            continue
        if isinstance(rows, list) and (rows or n == 0):
            return tried
    return None


def lenient_array(c: Column, rows: str = ROW) -> Column:
    """Rows of a response: code fences go, a truncated array is closed after its last complete row. Null if nothing can be read."""

    def repair(s: pd.Series) -> pd.Series:
        return s.map(whole_array)

    repair.__annotations__ = {"s": pd.Series, "return": pd.Series}
    plain = F.trim(F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), r"(?m)^```(json)?|```$", ""))
    return F.from_json(F.pandas_udf(repair, "string")(plain), rows)


def response_rows(responses: DataFrame) -> DataFrame:
    """batch_id, model_rank and the fields of each row that came back."""
    r = responses.select("batch_id", "model_rank", F.explode(lenient_array(F.col("text"))).alias("r"))
    types = F.coalesce(*[F.nullif(F.trim(F.col(f"r.`{k}`")), F.lit("")) for k in TYPE_KEYS])
    text = lambda name: F.nullif(F.trim(F.col(f"r.{name}")), F.lit(""))
    zero = lambda name: F.coalesce(F.col(f"r.{name}"), F.lit("0"))
    return r.select(
        "batch_id", "model_rank", "r.i", text("title").alias("title"), text("summary").alias("summary"), F.substring(text("reason"), 1, 150).alias("reason"),
        F.substring(text("topic"), 1, 12).alias("topic"), F.substring(types, 1, 14).alias("apptype"), S.clamp_score(zero("rel"), zero("info"), zero("fresh")).alias("score"),
    )


def acceptance(rows: DataFrame, batch: DataFrame) -> DataFrame:
    """Per response: rows, titles, reasons, accepted, low_yield. `batch`: batch_id, i, translate of the rows that were sent.

    Accepted: half the batch came back, and three in ten of the titles to be
    translated (one at least) are Chinese. Sent rows and answers are counted apart
    before they meet, so that no batch is multiplied.
    """
    sent = batch.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("translate").alias("need"))
    good = rows.filter(X.has_cjk(F.col("title"))).join(batch.filter("translate").select("batch_id", "i").distinct(), ["batch_id", "i"], "left_semi")
    titles = good.groupBy("batch_id", "model_rank").agg(F.count(F.lit(1)).alias("titles"))
    got = rows.groupBy("batch_id", "model_rank").agg(F.count(F.lit(1)).alias("rows"), F.count("reason").alias("reasons"))
    one = F.lit(1).cast("long")
    enough = lambda share, of: F.greatest(one, F.floor(F.col(of) * share / 10).cast("long"))
    x = got.join(titles, ["batch_id", "model_rank"], "left").join(sent, "batch_id").withColumn("titles", F.coalesce("titles", F.lit(0)))
    return x.select(
        "batch_id", "model_rank", "rows", "titles", "reasons",
        ((F.col("rows") >= enough(5, "n")) & ((F.col("need") == 0) | (F.col("titles") >= enough(3, "need")))).alias("accepted"),
        (F.col("reasons") < enough(3, "n")).alias("low_yield"),
    )


def join_back(batch: DataFrame, rows: DataFrame, accepted: DataFrame) -> DataFrame:
    """The sent rows with the fields of the first accepted model (by rank); a row answered twice keeps one answer, the greatest title."""
    best = accepted.filter("accepted").groupBy("batch_id").agg(F.min("model_rank").alias("model_rank"))
    told = rows.join(best, ["batch_id", "model_rank"], "left_semi").groupBy("batch_id", "i").agg(F.max(F.struct("title", "summary", "reason", "topic", "apptype", "score")).alias("r"))
    x = batch.join(told, ["batch_id", "i"], "left")
    return x.select(*batch.columns, F.when(F.col("translate") & X.has_cjk(F.col("r.title")), F.col("r.title")).alias("title_cn"), F.col("r.summary").alias("summary"), F.col("r.reason").alias("reason"), F.col("r.topic").alias("topic"), F.col("r.apptype").alias("apptype"), F.col("r.score").alias("score"))


BODY_ROW, BODY_LEAST = "array<struct<i:string, zh:string>>", 60


def body_rows(responses: DataFrame, sent: DataFrame) -> DataFrame:
    """batch_id, model_rank, i, desc_zh: the translations that count: of a row that was sent, Chinese, 60 characters at least. Of a row answered twice the last one counts.

    `sent`: batch_id, i.
    """
    r = responses.select("batch_id", "model_rank", F.posexplode(lenient_array(F.col("text"), BODY_ROW)).alias("at", "r"))
    zh = F.btrim("r.zh", F.lit(BLANKS))
    r = r.select("batch_id", "model_rank", "at", F.col("r.i").try_cast("int").alias("i"), zh.alias("desc_zh")).filter((F.char_length("desc_zh") >= BODY_LEAST) & X.has_cjk(F.col("desc_zh")))
    return r.join(sent.select("batch_id", "i").distinct(), ["batch_id", "i"], "left_semi").groupBy("batch_id", "model_rank", "i").agg(F.max_by("desc_zh", "at").alias("desc_zh"))


def body_acceptance(responses: DataFrame, rows: DataFrame) -> DataFrame:
    """batch_id, model_rank, translated, accepted of each response: one translation that counts makes it good. rows: what body_rows() gave."""
    n = rows.groupBy("batch_id", "model_rank").agg(F.count(F.lit(1)).alias("translated"))
    x = responses.select("batch_id", "model_rank").distinct().join(n, ["batch_id", "model_rank"], "left").withColumn("translated", F.coalesce("translated", F.lit(0)))
    return x.withColumn("accepted", F.col("translated") > 0)


def join_bodies(sent: DataFrame, rows: DataFrame) -> DataFrame:
    """The sent rows with desc_zh of the first model that translated any row of the batch; the others keep what they have."""
    best = rows.groupBy("batch_id").agg(F.min("model_rank").alias("model_rank"))
    told = rows.join(best, ["batch_id", "model_rank"], "left_semi").select("batch_id", "i", "desc_zh")
    return sent.join(told, ["batch_id", "i"], "left")


def parse_diag(c: Column) -> Column:
    """struct(host, outcome, n, desc_median, code) of a run report's line such as h:OK(3条/desc171), h:desc中位17<300跳过, h:Error429."""
    number = lambda p: F.nullif(F.regexp_extract(c, p, 1), F.lit("")).cast("int")
    outcome = F.when(c.contains(":OK("), "ok").when(c.contains("跳过"), "short").otherwise("error")
    return F.struct(
        F.regexp_extract(c, r"^(.*?):(?:OK\(|desc中位|[A-Za-z]*Error)", 1).alias("host"), outcome.alias("outcome"), number(r":OK\((\d+)条").alias("n"),
        F.coalesce(number(r"/desc ?(\d+)\)"), number(r"desc中位(\d+)<")).alias("desc_median"), number(r"Error\D*(\d{3})").alias("code"),
    )
