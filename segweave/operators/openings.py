"""Opening and closing formulas, which are spoken but aren't part of the reference text.

They are put in front of the reference, so that a transcript that runs a formula
into the first words aligns like any other; afterwards positions are counted
from the text again, and what lies in the formulas alone is marked.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import distance


def opening_prefix(docs: DataFrame, phrases: list[tuple[list[str], list[str], tuple[int, ...]]]) -> DataFrame:
    """doc_id, words, raw_words: what may be said before each document (doc_id, number).

    A phrase is its plain words, its written ones and the numbers of documents
    that go without it; one whose plain and written words differ in number is left out.
    """
    usable = [(plain, raw, without) for plain, raw, without in phrases if len(plain) == len(raw)]
    none = F.array().cast("array<string>")

    def told(k: int) -> Column:
        return F.concat(none, *[F.when(~F.coalesce(F.col("number").isin(*p[2]), F.lit(False)), F.array(*map(F.lit, p[k]))).otherwise(none) if p[2] else F.array(*map(F.lit, p[k])) for p in usable])

    return docs.select("doc_id", told(0).alias("words"), told(1).alias("raw_words"))


def with_openings(ref: DataFrame, prefix: DataFrame) -> DataFrame:
    """ref (doc_id, pos, word, raw_word, verse) with the prefix's words before it, of null verse."""
    sizes = prefix.select("doc_id", F.size("words").alias("_size"))
    text = ref.join(sizes, "doc_id", "left").select("doc_id", (F.col("pos") + F.coalesce("_size", F.lit(0))).cast("int").alias("pos"), "word", "raw_word", "verse")
    said = prefix.select("doc_id", F.posexplode(F.arrays_zip(F.col("words").alias("word"), F.col("raw_words").alias("raw_word"))).alias("pos", "w"))
    return text.unionByName(said.select("doc_id", "pos", "w.word", "w.raw_word", F.lit(None).cast(ref.schema["verse"].dataType).alias("verse")))


def without_openings(aligned: DataFrame, prefix: DataFrame) -> DataFrame:
    """aligned with positions in the text itself and is_formula: placed, and in the prefix alone."""
    sizes = prefix.select("doc_id", F.size("words").alias("_size"))
    size, placed = F.coalesce("_size", F.lit(0)), F.col("ref_start") >= 0
    at = lambda c: F.when(placed, F.greatest(F.lit(0), F.col(c) - size)).otherwise(F.col(c)).cast("int")
    rows = aligned.join(sizes, "doc_id", "left").withColumn("is_formula", placed & (F.col("ref_end") <= size))
    return rows.withColumns({"ref_start": at("ref_start"), "ref_end": at("ref_end")}).drop("_size")


def formula_words(words: Column, formulas: list[list[str]], most: float, from_end: bool = False) -> Column:
    """How many words at one end are formulas, one after another, each within the distance `most`; of several that fit the first named."""
    formulas = [f for f in formulas if f]
    if not formulas:
        return F.lit(0)
    run = F.reverse(words) if from_end else words

    def step(taken: Column) -> Column:
        found = F.lit(0)
        for f in reversed(formulas):
            part = F.slice(run, taken + 1, len(f))
            said = F.array_join(F.reverse(part) if from_end else part, " ")
            found = F.when((F.size(run) - taken >= len(f)) & (distance(said, F.lit(" ".join(f))) <= most), F.lit(len(f))).otherwise(found)
        return found

    turns = F.sequence(F.lit(1), F.floor(F.size(run) / min(map(len, formulas))).cast("int") + 1)
    return F.when(F.coalesce(F.size(words), F.lit(0)) > 0, F.aggregate(turns, F.lit(0), lambda taken, _: taken + step(taken))).otherwise(F.lit(0))


def formula_label(spoken: Column, candidates: list[tuple[str, str]]) -> Column:
    """The label of the candidate (plain text, label) nearest to what was spoken; of equals the first; empty if none has anything in common."""
    scored = F.array(*[F.struct(distance(spoken, F.lit(plain)).alias("score"), F.lit(k).alias("k"), F.lit(label).alias("label")) for k, (plain, label) in enumerate(candidates)])
    best = F.array_min(scored)
    return F.when((F.coalesce(spoken, F.lit("")) != "") & (best["score"] < 1.0), best["label"]).otherwise(F.lit(""))


#: Marks of a failure that leaves a device dead, fixed values.
FATAL = ("illegal memory access", "device-side assert", "unspecified launch failure", "uncorrectable")


def fatal(kind: Column, message: Column) -> Column:
    """Whether an error leaves the device dead rather than the call."""
    text = F.lower(F.concat_ws(": ", kind, message))
    return text.contains("cuda") & reduce(lambda a, b: a | b, [text.contains(m) for m in FATAL])


def by_status(results: DataFrame) -> DataFrame:
    """Results counted by status."""
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def progress(done: Column, total: Column, elapsed: Column) -> Column:
    """(fraction, eta_seconds): all of nothing is done; the rate so far goes on."""
    return F.struct(F.coalesce(F.try_divide(done, total), F.lit(1.0)).alias("fraction"), F.coalesce(F.try_divide(elapsed, done) * (total - done), F.lit(0.0)).alias("eta_seconds"))
