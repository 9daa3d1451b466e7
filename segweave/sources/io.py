"""Readers and writers of the data model: manifests, shards, corrections, catalogues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import shard_source, slug

SEGMENT = (
    "segment_id string, reciter_slug string, source_id string, source_path string, index int, start_sample long, end_sample long, start_seconds double, end_seconds double, "
    "duration_seconds double, sample_rate int, audio_path string, source_is_complete boolean, is_last_of_source boolean, surah_number int, asr string, label string, "
    "ref_start int, ref_end int, ayah_start int, ayah_end int, align_distance double, align_ok boolean, is_formula boolean, is_repeat boolean"
)
CORRECTION = "segment_id string, action string, start_seconds double, end_seconds double, at_seconds array<double>, with_ids array<string>, `with` array<string>, note string, orig_start_seconds double, orig_end_seconds double"
#: File suffixes of recordings.
AUDIO = ("aac", "flac", "m4a", "mp3", "ogg", "opus", "wav")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def read_manifest(spark: SparkSession, path: str, schema: str = SEGMENT) -> DataFrame:
    """Rows of a JSONL manifest; lines that don't parse are left out, blanks around a line don't matter, a missing file is empty."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    lines = spark.read.text(path).select(F.regexp_replace("value", r"^\s+|\s+$", "").alias("value")).where("value LIKE '{%'")
    # a torn line parses to a row of nulls or to null, so the key decides
    return lines.select(F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("r")).select("r.*").where("segment_id IS NOT NULL")


def append_manifest(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").option("ignoreNullFields", "false").json(path)


def read_corrections(spark: SparkSession, path: str) -> DataFrame:
    """Corrections of a JSONL file with their line order; blank and # lines are skipped, others must parse and name a segment; a missing file is empty."""
    if not _exists(spark, path):
        return spark.createDataFrame([], "segment_id string, action string, new_start double, new_end double, at_seconds array<double>, with_ids array<string>, orig_start double, orig_end double, note string, c_ord long")
    lines = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("c_ord")).where("trim(value) <> '' AND trim(value) NOT LIKE '#%'")
    r = lines.select("c_ord", F.from_json("value", CORRECTION, {"mode": "FAILFAST"}).alias("r")).select("c_ord", "r.*")
    named = F.when(F.col("segment_id").isNull(), F.raise_error(F.lit("a correction without segment_id")).cast("string")).otherwise(F.col("segment_id"))
    return r.select(named.alias("segment_id"), F.coalesce("action", F.lit("adjust")).alias("action"), F.col("start_seconds").alias("new_start"), F.col("end_seconds").alias("new_end"), F.coalesce("at_seconds", F.array().cast("array<double>")).alias("at_seconds"), F.coalesce("with", "with_ids", F.array().cast("array<string>")).alias("with_ids"), F.col("orig_start_seconds").alias("orig_start"), F.col("orig_end_seconds").alias("orig_end"), "note", "c_ord")


def discover(spark: SparkSession, root: str, limit: int | None = None) -> DataFrame:
    """path, reciter_slug and source_id of the recordings below root, by path, up to `limit`; contents aren't read, and files without bytes are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    base = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri().getPath().rstrip("/")
    parent, stem = F.regexp_extract("path", "([^/]+)/[^/]+$", 1), F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1)
    folder = F.regexp_replace(F.regexp_extract("path", "^(.*)/[^/]+$", 1), "^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "")
    group = F.when(folder == base, "unknown").otherwise(slug(parent))
    found = files.where(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(*AUDIO)).select("path", "length", group.alias("reciter_slug"), F.concat(group, F.lit("/"), stem).alias("source_id")).orderBy("path")
    return found if limit is None else found.limit(limit)


#: Directories of a published folder: so many whatever the number of recordings, whose files would else be tiny and countless.
SHARDS = 64


def publish(rows: DataFrame, path: str) -> None:
    """Write shards, each of the recordings whose hash falls in it; those in rows replace what was there, others stay.

    What a shard keeps is staged with the new rows before the shard is replaced, and a replacement that was
    broken off is ended by the next publication, so that no recording is lost.
    """
    spark = rows.sparkSession
    _replace(spark, path)
    placed = rows.withColumn("shard", F.pmod(F.xxhash64("source_id"), F.lit(SHARDS)).cast("int"))
    if _exists(spark, path) and _any_shard(spark, path):
        old = spark.read.option("mergeSchema", True).parquet(path)
        ids = rows.select(F.col("source_id").alias("_id")).distinct()
        kept = old.join(F.broadcast(placed.select("shard").distinct()), "shard", "left_semi").join(ids, F.col("source_id").eqNullSafe(F.col("_id")), "left_anti")
        _write(placed.unionByName(kept, allowMissingColumns=True), f"{path}/_staged", "static")
        _replace(spark, path)
    else:
        _write(placed, path)


def _write(placed: DataFrame, path: str, others: str = "dynamic") -> None:
    # only a static overwrite leaves a mark that it was ended
    placed.repartition(SHARDS, "shard").sortWithinPartitions("shard", "source_id").write.mode("overwrite").option("partitionOverwriteMode", others).partitionBy("shard").parquet(path)


def _replace(spark: SparkSession, path: str) -> None:
    """Put the shards that are staged whole in place of the old ones."""
    staged = f"{path}/_staged"
    if _exists(spark, f"{staged}/_SUCCESS") and _any_shard(spark, staged):
        _write(spark.read.option("mergeSchema", True).parquet(staged), path)
    at = spark._jvm.org.apache.hadoop.fs.Path(staged)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _any_shard(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return any(s.getPath().getName().startswith("shard=") for s in at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at))


def published(spark: SparkSession, path: str) -> DataFrame:
    """The distinct recordings published; none where nothing is."""
    return spark.read.parquet(path).select("source_id").distinct() if _exists(spark, path) and _any_shard(spark, path) else spark.createDataFrame([], "source_id string")


def read_shards(spark: SparkSession, path: str, groups: list[str] | None = None) -> DataFrame:
    """Rows of the shards without their audio, so that the scan never touches it."""
    df = spark.read.option("mergeSchema", True).parquet(path)
    df = df.drop("audio", "shard")
    return df.where(F.split("source_id", "/")[0].isin(groups)) if groups else df


def clips(shards: DataFrame, wanted: DataFrame) -> DataFrame:
    """segment_id and audio bytes of the wanted (source_id, segment_id); missing bytes are empty."""
    return shards.select("source_id", "segment_id", F.coalesce("audio.bytes", F.lit(b"")).alias("bytes")).join(wanted.select("source_id", "segment_id").distinct(), ["source_id", "segment_id"], "left_semi")


def write_params(spark: SparkSession, path: str, params: dict) -> None:
    """Parameters as one JSON file, in place of what was there."""
    import json

    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
    try:
        out.write(bytearray(json.dumps(params, ensure_ascii=False, indent=2).encode()))
    finally:
        out.close()


def reference_words(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, pos, raw_word, verse of a text in JSON: verses (chapter, verse, text), in a list or under a name of their own; verses in numeric order."""
    rows = spark.read.option("multiLine", True).json(path)
    if "chapter" not in rows.columns:
        rows = rows.select(F.explode(rows.columns[0]).alias("r")).select("r.*")
    verses = rows.select(F.col("chapter").cast("long").alias("doc_id"), F.col("verse").cast("int").alias("verse"), "text")
    words = verses.select("doc_id", "verse", F.posexplode(F.filter(F.split("text", r"\s+"), lambda w: w != "")).alias("k", "raw_word"))
    order = Window.partitionBy("doc_id").orderBy("verse", "k")  # a chapter is one group
    return words.select("doc_id", (F.row_number().over(order) - 1).alias("pos"), "raw_word", "verse")


def readable_shards(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of the shards that can be read; one that is damaged or gone costs its own rows, not the run."""
    return spark.read.schema(schema).option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True).option("recursiveFileLookup", True).parquet(path)


def label_rows(rows: DataFrame, aligned: DataFrame, words: DataFrame) -> DataFrame:
    """rows with what alignment found written back: label, verses, bounds in the reference, distance, ok and repeat.

    aligned has source_id, index, ref_start, ref_end, distance, ok, is_repeat; words
    source_id, pos, raw_word, verse. A row without a place has null label and bounds and is not ok.
    """
    placed = aligned.where("ref_start >= 0 AND ref_end > ref_start")
    said = placed.select("source_id", "index", F.explode(F.sequence("ref_start", F.col("ref_end") - 1)).alias("pos")).join(words, ["source_id", "pos"])
    told = said.groupBy("source_id", "index").agg(F.array_sort(F.collect_list(F.struct("pos", "raw_word"))).alias("w"), F.min("verse").alias("ayah_start"), F.max("verse").alias("ayah_end"))
    told = told.select("source_id", "index", F.array_join(F.transform("w", lambda x: x["raw_word"]), " ").alias("label"), "ayah_start", "ayah_end")
    found = aligned.join(told, ["source_id", "index"], "left").select("source_id", "index", "label", "ayah_start", "ayah_end", F.when(F.col("ref_start") >= 0, F.col("ref_start")).alias("ref_start"), F.when(F.col("ref_start") >= 0, F.col("ref_end")).alias("ref_end"), F.col("distance").alias("align_distance"), F.col("ok").alias("align_ok"), "is_repeat")
    new = [c for c in found.columns if c not in ("source_id", "index")]
    return rows.drop(*new).join(found, ["source_id", "index"], "left")


def pulled(files: DataFrame) -> DataFrame:
    """Files and gigabytes by group, and of all (group null)."""
    return files.rollup("reciter_slug").agg(F.count(F.lit(1)).alias("files"), F.round(F.sum("size_bytes") / 1e9, 6).alias("gigabytes"))


def catalogue(df: DataFrame, rewaya: str = "", variants: bool = True) -> DataFrame:
    """slug, server, surahs of a nested catalogue row (column reciters), by slug."""
    m = df.select(F.explode("reciters").alias("r")).select("r.name", F.explode("r.moshaf").alias("m")).where(F.coalesce("m.server", F.lit("")) != "")
    variant = F.translate(F.lower("m.name"), "-' ", "").contains("alasbahani")
    m = m.where(F.lower("m.name").contains(rewaya.lower())).withColumn("variant", variant)
    m = m if variants else m.where("NOT variant")
    return m.select(F.concat(slug(F.col("name")), F.when(F.col("variant"), "--variant-tariq").otherwise("")).alias("slug"), F.concat(F.regexp_replace("m.server", "/+$", ""), F.lit("/")).alias("server"), F.col("m.surah_list").alias("surah_list"), F.col("m.surah_total").alias("surah_total")).orderBy("slug")


def shard_rows(spark: SparkSession, glob: str) -> DataFrame:
    """Rows of data/<group>/<stem>.parquet files with the recording their path names, in path and row order."""
    df = spark.read.parquet(glob)
    return df.select("*", shard_source(F.regexp_extract("_metadata.file_path", r"(data/[^/]+/[^/]+\.parquet)$", 1)).alias("path_source"), F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_row"))
