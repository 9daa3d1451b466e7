import json

from pyspark.sql import functions as F

from segweave.operators import alignment, openings
from segweave.sources import io

PHRASES = [("i seek a refuge".split(), "I Seek A Refuge".split(), ()), ("in the name".split(), "In The Name".split(), (1, 9)), (["odd"], ["Odd", "one"], ())]


def test_formula_run_into_the_text(spark):
    text = [f"word{k}x{k * 7 % 13}" for k in range(40)]
    ref = spark.createDataFrame([(d, k, w, w.upper(), k // 8) for d in (1, 2) for k, w in enumerate(text)], "doc_id long, pos int, word string, raw_word string, verse int")
    prefix = openings.opening_prefix(spark.createDataFrame([(1, 1), (2, 2)], "doc_id long, number int"), PHRASES)
    assert {r.doc_id: len(r.words) for r in prefix.collect()} == {1: 4, 2: 7}
    whole = openings.with_openings(ref, prefix)
    assert [r.raw_word for r in whole.where("doc_id = 2").orderBy("pos").limit(8).collect()] == "I Seek A Refuge In The Name".split() + ["WORD0X0"]
    said = ["i seek a refuge", "in the name " + " ".join(text[:6]), " ".join(text[6:14]), " ".join(text[14:])]
    heard = spark.createDataFrame([(2, k, t) for k, t in enumerate(said)], "doc_id long, index int, transcript string")
    got = openings.without_openings(alignment.align_documents(whole.where("doc_id = 2"), heard), prefix).collect()
    assert sorted((r["index"], r.ref_start, r.ref_end, r.is_formula) for r in got) == [(0, 0, 0, True), (1, 0, 6, False), (2, 6, 14, False), (3, 14, 40, False)]


def test_formula_words_and_labels(spark):
    rows = [("i seek a refuge in the name of", 7, 0), ("in the nane in the name x", 6, 0), ("x in the name", 0, 3), ("", 0, 0), ("in the", 0, 0), (None, 0, 0)]
    df = spark.createDataFrame(rows, "t string, a int, b int").withColumn("w", F.filter(F.split("t", " "), lambda w: w != ""))
    plain = [p[0] for p in PHRASES[:2]]
    got = df.select("a", openings.formula_words(F.col("w"), plain, 0.2).alias("x"), "b", openings.formula_words(F.col("w"), plain, 0.2, from_end=True).alias("y"), "t").collect()
    assert all(r.x == r.a for r in got) and got[2].y == 3 and got[3].y == 0 and openings.formula_words(F.col("w"), [[]], 0.2) is not None
    label = openings.formula_label(F.col("t"), [("i seek a refuge", "A"), ("in the name", "B"), ("in the name", "C")])
    assert [r.v for r in df.select(label.alias("v")).collect()][1:6] == ["B", "B", "", "B", ""]


def test_failures_counts_and_progress(spark):
    rows = [("RuntimeError", "CUDA error: an illegal memory access"), ("RuntimeError", "CUDA out of memory"), ("CudaError", "Uncorrectable ECC"), ("E", "device-side assert"), (None, None)]
    got = spark.createDataFrame(rows, "kind string, message string").select(openings.fatal(F.col("kind"), F.col("message")).alias("v")).collect()
    assert [r.v for r in got] == [True, False, True, False, False]
    assert {r.status: r.n for r in openings.by_status(spark.createDataFrame([("ok",), ("ok",), ("failed",)], "status string")).collect()} == {"ok": 2, "failed": 1}
    p = spark.createDataFrame([(2, 8, 10.0), (0, 4, 3.0), (0, 0, 0.0)], "d int, t int, e double").select(openings.progress(F.col("d"), F.col("t"), F.col("e")).alias("p")).collect()
    assert [tuple(r.p) for r in p] == [(0.25, 30.0), (0.0, 0.0), (1.0, 0.0)]


def test_parameters_texts_and_limits(spark, tmp_path):
    for _ in range(2):
        io.write_params(spark, str(tmp_path / "p.json"), {"a": "é", "n": 1})
    assert json.loads((tmp_path / "p.json").read_text()) == {"a": "é", "n": 1}
    verses = [{"chapter": 2, "verse": 10, "text": "e f"}, {"chapter": 2, "verse": 9, "text": "c  d"}, {"chapter": 1, "verse": 1, "text": "a"}]
    for name, body in (("list.json", verses), ("named.json", {"text": verses})):
        (tmp_path / name).write_text(json.dumps(body))
        got = io.reference_words(spark, str(tmp_path / name)).orderBy("doc_id", "pos").collect()
        assert [tuple(r) for r in got] == [(1, 0, "a", 1), (2, 0, "c", 9), (2, 1, "d", 9), (2, 2, "e", 10), (2, 3, "f", 10)]
    for k in range(3):
        (tmp_path / "in" / f"g{k}").mkdir(parents=True)
        (tmp_path / "in" / f"g{k}" / "1.mp3").write_bytes(b"x")
    assert [r.source_id for r in io.discover(spark, str(tmp_path / "in"), limit=2).collect()] == ["g0/1", "g1/1"]
