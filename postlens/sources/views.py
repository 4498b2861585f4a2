"""Base views over the given tables: posts, and posts decorated with forum-style text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from postlens.sources.readers import in_pieces, spread, table

# What is added to each text by id % 12, so that every text operator
# has emojis, links, quotes, contractions and line breaks to work on.
DECORATIONS = {
    0: " To the moon 🚀🚀🚀 🚀 now.",
    1: " Nice, it's good timing. 👱‍♀️",
    2: " Diamond 💎🙌 💎 🙌 hands.",
    3: " She said “sure thing” and ‘that’ wasn’t mine.",
    4: " I'm sure she's here; they've sold, wasn't it? You're late, I'd say.",
    5: " Don't sell ABC, I think. I do not sell! We should not sell. Should hold.",
    6: " See https://example.org/a?b=c&d=1 and http://x.y.",
    7: " Blank &#x200B; here &#x200Bzz end.",
    8: " *YO* *bold* text",
    9: " First\n- second- third\n\n-YO",
    10: " Hmm.... fine.. We got a steep $7🚀 & 30% less ...",
    11: " Wave 👋🏽 👋🏿 🙅🏻 game stop.",
}
URL_PREFIX = "https://forum.example.org/comments/"


def decoration(row_id: Column) -> Column:
    kind = row_id % 12
    out = None
    for number, suffix in DECORATIONS.items():
        out = (F if out is None else out).when(kind == number, F.lit(suffix))
    return out


def titles(spark: SparkSession, folder: str, pieces: bool = False) -> DataFrame:
    """(id, title, body): the first line of a document is its title. ``pieces`` deals them out by id and size."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    docs = in_pieces(docs, "doc_id", "text") if pieces else spread(docs, "doc_id")
    title = F.substring_index("text", "\n", 1)
    body = F.expr("nullif(substr(text, length(substring_index(text, '\n', 1)) + 2), '')")
    return docs.select(F.col("doc_id").alias("id"), title.alias("title"), body.alias("body"))


def texts(spark: SparkSession, folder: str, pieces: bool = False) -> DataFrame:
    """(id, text) with decorations; needs no join."""
    text = F.concat(F.concat_ws(". ", "title", "body"), decoration(F.col("id")))
    return titles(spark, folder, pieces).select("id", text.alias("text"))


def _with_events(df: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """Add timestamp and comms_num from the event that belongs to each post."""
    events = table(spark, folder, "events").select(
        "event_id", F.col("ts").alias("timestamp"), F.floor("value").cast("bigint").alias("comms_num")
    )
    return df.withColumn("event_id", F.col("id") * 5).join(events, "event_id").drop("event_id")


def posts(spark: SparkSession, folder: str) -> DataFrame:
    """The posts table: id, title, body, timestamp, comms_num, url."""
    url = F.concat(F.lit(URL_PREFIX), F.lpad(F.col("id").cast("string"), 6, "0"), F.lit("/x"))
    return _with_events(titles(spark, folder), spark, folder).withColumn("url", url)


def post_activity(spark: SparkSession, folder: str) -> DataFrame:
    """(id, timestamp, comms_num) of all posts, without their texts."""
    ids = table(spark, folder, "documents").select(F.col("doc_id").alias("id"))
    return _with_events(ids, spark, folder)
