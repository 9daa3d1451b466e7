"""The data model's tables, made from the star schema by whole-number rules that SQL can repeat."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import exploded


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each segment: a user is a recording, their events its segments in time order."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    group = F.format_string("reciter-%02d", F.col("user_id") % 15)
    duration = F.col("value") / 3
    silent = (duration > 30) | (F.col("event_type") == "error")
    text = lambda n: F.when(silent, F.lit(None)).when(F.col("event_id") % 17 == 0, "").otherwise(F.repeat(F.lit("w "), n.cast("int")))
    return e.select(
        "event_id",
        group.alias("reciter_slug"),
        F.concat(group, F.lit("/"), F.format_string("%03d", "user_id")).alias("source_id"),
        F.format_string("%03d", "user_id").alias("stem"),
        (F.row_number().over(order) - 1).alias("index"),
        duration.alias("duration_seconds"),
        (F.regexp_extract("props", r"(\d+)", 1).cast("int") / 100).alias("align_distance"),
        text(F.col("event_id") % 7 + 3).alias("asr"),
        F.when(F.col("event_id") % 11 == 0, F.lit(None)).otherwise(text(F.col("event_id") % 5 + 5)).alias("label"),
        (F.col("event_id") % 19 != 0).alias("source_is_complete"),
        (F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id"))) == 1).alias("is_last_of_source"),
    )


def probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each recorded file: a supplier is a group, a part a stem."""
    g = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("q"), F.sum("l_extendedprice").alias("p"))
    key = F.col("l_suppkey") * 31 + F.col("l_partkey")
    return g.select(
        F.concat_ws("/", "l_suppkey", "l_partkey").alias("source_id"),
        F.col("l_suppkey").cast("string").alias("reciter_slug"),
        F.col("l_partkey").cast("string").alias("stem"),
        F.floor("p").alias("size_bytes"),
        F.when(key % 97 == 0, F.lit(None)).when(key % 89 == 0, F.lit(0.0)).otherwise(F.col("q")).alias("duration_seconds"),
        F.when(key % 97 == 0, "unreadable header").alias("error"),
    )


def timed_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """segments with an id and bounds on a grid of whole samples (10 s apart, 16 kHz)."""
    s = segments(spark, sf_dir)
    length = F.floor(F.least(F.col("duration_seconds"), F.lit(9.5)) * 16000)
    return s.select(
        F.col("event_id").alias("ord"), "reciter_slug", "source_id", "index", F.lit(16000).alias("sample_rate"),
        F.format_string("%s__%s__%04d", "reciter_slug", "stem", "index").alias("segment_id"),
        (F.col("index") * 160000).cast("long").alias("start_sample"),
        (F.col("index") * 160000 + length).cast("long").alias("end_sample"),
        "is_last_of_source", "event_id", F.format_string("%s__%s__%04d.flac", "reciter_slug", "stem", "index").alias("audio_path"),
    ).withColumn("start_seconds", F.col("start_sample") / 16000).withColumn("end_seconds", F.col("end_sample") / 16000)


def corrections(segs: DataFrame) -> DataFrame:
    """A patch table over timed segments, with each action and some that don't apply."""
    k = F.col("event_id") % 50
    action = F.when(k == 1, "adjust").when(k == 2, "drop").when(k == 3, "split").when(k == 4, "merge").when(k == 5, "frobnicate").when(k == 6, "adjust").when(k == 7, "adjust")
    none = F.array().cast("array<double>")
    # a merge names the next of its recording where that has an even key, else one that isn't there
    return segs.where(k.between(1, 7)).select(
        F.when(k == 7, F.concat("segment_id", F.lit("-gone"))).otherwise(F.col("segment_id")).alias("segment_id"),
        action.alias("action"),
        F.when(k.isin(1, 7), F.col("start_seconds") + 0.25).when(k == 6, F.col("end_seconds")).alias("new_start"),
        F.when(k.isin(1, 7), F.col("end_seconds")).when(k == 6, F.col("start_seconds")).alias("new_end"),
        F.when(k == 3, F.array(F.col("start_seconds") + 0.25, F.col("start_seconds") + 0.125, F.lit(-1.0))).otherwise(none).alias("at_seconds"),
        F.when(k == 4, F.array(F.format_string("%s__%04d", F.regexp_extract("segment_id", "^(.*)__[0-9]+$", 1), F.col("index") + 1))).otherwise(F.array().cast("array<string>")).alias("with_ids"),
        # of the drifted ones, half moved at their start, half at their end alone
        F.when(k == 1, F.col("start_seconds") + F.when(F.col("event_id") % 200 == 1, 99.0).otherwise(0.0)).alias("orig_start"),
        F.when(k == 1, F.col("end_seconds") + F.when(F.col("event_id") % 200 == 101, 99.0).otherwise(0.0)).alias("orig_end"),
        F.concat(F.lit("seen "), k.cast("string")).alias("note"),
        F.col("ord").alias("c_ord"),
    )


def document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, texts: the texts of each document, which is one row from here on, so that its words never travel."""
    d = table(spark, sf_dir, "documents").where("doc_id IS NOT NULL AND text IS NOT NULL")
    return d.groupBy("doc_id").agg(F.collect_list("text").alias("texts"))


def document_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, w: each document's words (word, raw_word, verse) in order, with the line as verse; a word keeps its letters and digits of any script."""

    def told(text):
        lines = F.transform(F.split(text, "\n"), lambda body, line: F.transform(F.filter(F.split(body, r"\s+"), lambda w: w != ""), lambda w, k: F.struct(line.alias("verse"), k.alias("k"), w.alias("raw_word"))))
        return F.flatten(lines)

    # rows of one id are one document, whose lines are read side by side
    ws = F.when(F.size("texts") == 1, told(F.col("texts")[0])).otherwise(F.array_sort(F.flatten(F.transform("texts", told))))
    plain = lambda w: F.regexp_replace(F.lower(w), r"[^\p{L}\p{M}\p{N}]", "")
    w = F.transform(ws, lambda s: F.struct(plain(s["raw_word"]).alias("word"), s["raw_word"].alias("raw_word"), s["verse"].alias("verse")))
    return document_texts(spark, sf_dir).select("doc_id", w.alias("w"))


def ref_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of the documents by position."""
    return exploded(document_words(spark, sf_dir), "w", "pos", "doc_id")
