import json
import random

import pytest
from pyspark.sql import functions as F

from segweave.functions import ranks, scalars
from segweave.operators import alignment, audit, quality, review
from segweave.operators import corrections as patch
from segweave.sources import io
from segweave.streaming.ingest import ingest


def value(spark, expression):
    return spark.range(1).select(expression.alias("v")).first()["v"]


def test_quantiles_round_like_whole_ranks(spark):
    rows = [("a", float(i)) for i in range(6)] + [("b", 1.0), ("b", None), ("c", None)]
    got = {r.g: r for r in ranks.ranks(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", {"near": (0.5, "nearest"), "low": (0.5, "floor"), "mid": (0.5, "median")}).collect()}
    assert tuple(got["a"])[1:] == (6, 2.0, 3.0, 2.5) and tuple(got["b"])[1:] == (1, 1.0, 1.0, 1.0) and "c" not in got


@pytest.mark.parametrize("text, want", [("  Ab--C d!", "ab-c-d"), ("***", ""), ("x", "x"), ("É a", "a")])
def test_slug(spark, text, want):
    assert value(spark, scalars.slug(F.lit(text))) == want


def test_scalars(spark):
    assert [value(spark, scalars.letters(F.lit(n))) for n in (0, 25, 26, 51, 52)] == ["a", "z", "aa", "az", "ba"]
    assert value(spark, scalars.shard_source(F.lit("data/a/b.parquet"))) == "a/b" and value(spark, scalars.shard_source(F.lit("data/a/b/c.parquet"))) is None
    assert value(spark, scalars.stem_number(F.lit("087-take2"))) == 872 and value(spark, scalars.stem_number(F.lit("x"))) is None
    assert value(spark, scalars.surah_list(F.lit("3, 1,x,3"), F.lit(5))) == [1, 3] and len(value(spark, scalars.surah_list(F.lit(None).cast("string"), F.lit(0)))) == 114
    assert value(spark, scalars.segment_id(F.lit("r"), F.lit("A b"), F.lit(12345))) == "r__a-b__12345"
    assert value(spark, scalars.runs(F.array(*map(F.lit, (1, 1, 2, 1))))) == [1, 2, 1]
    assert [e.name for e in value(spark, scalars.excerpts(F.lit(100.0), 3, 15.0))] == ["start", "middle", "end"] and value(spark, scalars.excerpts(F.lit(20.0), 3, 15.0))[0].name == "whole"
    assert tuple(value(spark, scalars.bounded_span(F.array(*map(F.lit, (1, 2, 3, 50, 51))), 10))) == (1, 4)
    assert value(spark, scalars.joined(F.array(F.lit("a"), F.lit("b")), F.lit(-3), F.lit(9))) == "a b"


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "reciter_slug string, duration_seconds double, align_distance double, asr string, label string")


def test_untranscribed_rows_dont_count_as_scored(spark):
    got = quality.label_fit(rows_of(spark, [("x", 8.0, 0.02, "a b", "a b")] * 90 + [("x", 34.0, 1.0, None, None)] * 10)).first()
    assert (got.scored, got.no_transcript) == (90, 0.1) and got.mean == pytest.approx(0.98)


def test_holes(spark):
    got = quality.waqf_fit(rows_of(spark, [("x", 12.0, None, "", None)] * 80 + [("x", 24.0, None, None, "l")] * 15 + [("x", 33.0, None, None, "")] * 5 + [("y", None, None, None, None)])).collect()
    assert [(r.reciter, r.over_20, r.over_30, r.unlabelled_long) for r in got] == [("x", 0.2, 0.05, 5)]


def test_verdicts_name_the_odd_group(spark):
    fine = [("f%d" % (i % 3), 5.0, 0.02, "a", "a") for i in range(30)]
    df = rows_of(spark, fine + [("bad", 35.0, 0.3, "a", None)] * 10)
    got = {(r.reciter, r.section) for r in quality.verdicts(quality.label_fit(df), quality.waqf_fit(df)).collect()}
    assert got == {("bad", 1), ("bad", 2)}


def test_outliers(spark):
    rows = [(f"r{i}/1", "r", "1", 10, 2.0, None) for i in range(4)] + [("r9/1", "r", "1", 10, 40.0, None), ("e/1", "r", "1", 0, 0.0, None), ("u/1", "r", "1", 5, None, "junk")] + [("a/2", "r", "2", 1, 1.0, None), ("b/2", "r", "2", 1, 50.0, None)]
    p = spark.createDataFrame(rows, "source_id string, reciter_slug string, stem string, size_bytes long, duration_seconds double, error string")
    assert [(r.source_id, r.kind) for r in audit.in_order(audit.find_outliers(p)).collect()] == [("u/1", "unreadable"), ("e/1", "empty"), ("r9/1", "too long")]
    assert audit.summary(p).first().files == 9


def test_sections_and_unknown_names(spark):
    df = rows_of(spark, [("r", float(i), 1 / (i + 1), "a", "a") for i in range(8)] + [("r", None, None, None, "")]).withColumn("ord", F.monotonically_increasing_id())
    assert [r.duration_seconds for r in review.pick(df, "duration", 2, True, "ord").collect()] == [7.0, 6.0]
    assert review.unlabelled(df, 5, "ord").count() == 1 and review.within(df, 2.0, 4.0).count() == 3
    with pytest.raises(ValueError):
        review.sections(df, ["nope"], 1, "ord")


def segs(spark):
    rows = [(f"s{i}", "a" if i < 5 else "b", i, i, 16000, 10.0 * i, 10.0 * i + 8, i == 4) for i in range(7)]
    return spark.createDataFrame(rows, "segment_id string, source_id string, index int, ord long, sample_rate int, start_seconds double, end_seconds double, is_last_of_source boolean")


def fixes(spark, tmp_path, *lines):
    (tmp_path / "c.jsonl").write_text("# notes\n\n" + "\n".join(json.dumps(x) for x in lines))
    return io.read_corrections(spark, str(tmp_path / "c.jsonl"))


def test_corrections(spark, tmp_path):
    c = fixes(spark, tmp_path, {"segment_id": "s0", "start_seconds": 0.5, "end_seconds": 7.5}, {"segment_id": "s1", "action": "split", "at_seconds": [15, 13, 99]}, {"segment_id": "s2", "action": "merge", "with": ["s3"]}, {"segment_id": "s4", "action": "merge", "with_ids": ["s5"]}, {"segment_id": "s6", "action": "x"}, {"segment_id": "zz", "action": "drop"}, {"segment_id": "s6", "action": "drop", "orig_start_seconds": 99.0})
    got = {r.segment_id: r for r in patch.apply(segs(spark), c).collect()}
    assert set(got) == {"s0", "s1_a", "s1_b", "s1_c", "s2", "s4"}
    assert (got["s0"].start_seconds, got["s0"].start_sample) == (0.5, 8000) and got["s1_b"].start_seconds == 13.0 and (got["s2"].start_seconds, got["s2"].end_seconds) == (20.0, 38.0)
    assert got["s4"].outcome == "refused" and tuple(patch.report(segs(spark), c).first()) == (3, 1, 3, 2)
    assert {tuple(r) for r in patch.exceptions(segs(spark), c).collect()} == {("s4", "refused"), ("s6", "drifted"), ("zz", "unmatched")}
    assert "s6" in {r.segment_id for r in patch.apply(segs(spark), c, strict_drift=True).collect()}


def test_corrected_rows_are_retimed_as_the_data_model_has_it(spark, tmp_path):
    r = random.Random(5)
    values = [k / 16000 for k in (8, 24, 40, 1, 3, 16008, 32008, 160040)] + [r.randrange(1 << 24) / 16000 for _ in range(3000)] + [r.random() * 1e4 for _ in range(500)] + [2.0005, 2.0015, 0.0]
    got = [x.v for x in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").orderBy("i").select(scalars.thousandths(F.col("v")).alias("v")).collect()]
    assert got == [round(v, 3) for v in values]
    c = fixes(spark, tmp_path, {"segment_id": "s0", "start_seconds": 0.0005, "end_seconds": 7.12345, "note": "late"}, {"segment_id": "s2", "action": "merge", "with": ["gone", "s3", "s1"]}, {"segment_id": "s4", "action": "split", "at_seconds": [43.33333]}, {"segment_id": "s5", "action": "drop"})
    rows = segs(spark).withColumn("audio_path", F.concat("segment_id", F.lit(".flac")))
    got = {x.segment_id: x for x in patch.apply(rows, c).collect()}
    assert (got["s0"].start_seconds, got["s0"].end_seconds, got["s0"].duration_seconds, got["s0"].start_sample, got["s0"].end_sample) == (0.001, 7.123, round(7.12345 - 0.0005, 3), 8, round(7.12345 * 16000))
    assert (got["s0"].corrected, got["s0"].correction_note, got["s0"].audio_path) == (True, "late", "s0.flac")
    assert got["s2"].merged_from == ["s2", "s3", "s1"] and (got["s2"].start_seconds, got["s2"].end_seconds, got["s2"].audio_path) == (10.0, 38.0, None)
    assert got["s4_a"].end_seconds == 43.333 and got["s4_b"].parent_segment_id == "s4" and got["s4_b"].audio_path is None and got["s4_b"].is_last_of_source
    assert (got["s6"].corrected, got["s6"].correction_note, got["s6"].audio_path, got["s6"].merged_from) == (False, None, "s6.flac", None) and "s5" not in got
    assert tuple(patch.report(rows, c).first()) == (3, 1, 2, 2)
    assert {tuple(x) for x in patch.exceptions(rows, c).collect()} == {("s2", "missing_part")}


def test_quantiles_of_large_groups(spark):
    """Groups beyond `most` go by brackets; they are as exact as the others."""
    r = random.Random(6)
    rows = [("a", r.choice([0.0, 1.0, r.random(), r.random() ** 9 * 1e6])) for _ in range(20_000)] + [("b", float(i)) for i in range(7)] + [(None, 5.0)] * 3000 + [("c", None)]
    wanted = {"low": (0.01, "floor"), "mid": (0.5, "median"), "near": (0.95, "nearest"), "last": (1.0, "floor"), "first": (0.0, "nearest")}
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    got = {x.g: tuple(x)[1:] for x in ranks.ranks(df, ["g"], "v", wanted, most=2000).collect()}
    for g in ("a", "b", None):
        v = sorted(x for k, x in rows if k == g)
        n = len(v)
        assert got[g] == (n, v[min(n - 1, n // 100)], (v[(n - 1) // 2] + v[n // 2]) / 2, v[round((n - 1) * 0.95)], v[-1], v[0])
    assert set(got) == {"a", "b", None}


def test_ingest_takes_the_newest_file_of_a_batch(spark, tmp_path):
    import os

    schema, folder = "source_id string, n int", tmp_path / "in"
    folder.mkdir()
    for name, at, lines in (("b", 1000, [("x", 1), ("y", 1)]), ("a", 2000, [("x", 2), ("x", 3)]), ("c", 1000, [("y", 4)])):
        (folder / f"{name}.json").write_text("\n".join(json.dumps({"source_id": k, "n": n}) for k, n in lines))
        os.utime(folder / f"{name}.json", (at, at))
    for _ in range(2):
        ingest(spark, str(folder), str(tmp_path / "out"), str(tmp_path / "mark"), schema)
        assert sorted((x.source_id, x.n) for x in spark.read.parquet(str(tmp_path / "out")).collect()) == [("x", 2), ("x", 3), ("y", 4)]


def test_folders_lines_and_damaged_shards(spark, tmp_path):
    (tmp_path / "in" / "zed" / "in").mkdir(parents=True)
    (tmp_path / "in" / "zed" / "in" / "1.mp3").write_bytes(b"x")
    (tmp_path / "in" / "2.MP3").write_bytes(b"x")
    assert sorted(x.source_id for x in io.discover(spark, str(tmp_path / "in")).collect()) == ["in/1", "unknown/2"]
    (tmp_path / "m.jsonl").write_text('  {"segment_id": "a"} \n\t{"segment_id": "b"}\n{"segm')
    assert [x.segment_id for x in io.read_manifest(spark, str(tmp_path / "m.jsonl")).collect()] == ["a", "b"]
    assert io.read_corrections(spark, str(tmp_path / "no.jsonl")).count() == 0
    (tmp_path / "c.jsonl").write_text('{"action": "drop"}')
    with pytest.raises(Exception, match="without segment_id"):
        io.read_corrections(spark, str(tmp_path / "c.jsonl")).collect()
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "s" / "a"))
    (tmp_path / "s" / "bad.parquet").write_bytes(b"PAR1 not a shard PAR1")
    assert io.readable_shards(spark, str(tmp_path / "s"), "id long").count() == 3
    assert [value(spark, scalars.letters(F.lit(n))) for n in (701, 702, 703, 18277, 18278)] == ["zz", "aaa", "aab", "zzz", "aaaa"]


def test_labels_are_written_back(spark):
    rows = spark.createDataFrame([("s", 0, "x", "old"), ("s", 1, "y", "old"), ("t", 0, "z", None)], "source_id string, index int, asr string, label string")
    aligned = spark.createDataFrame([("s", 0, 0, 3, 0.1, True, False), ("s", 1, -1, -1, 1.0, False, False)], "source_id string, index int, ref_start int, ref_end int, distance double, ok boolean, is_repeat boolean")
    words = spark.createDataFrame([("s", k, w, k // 2) for k, w in enumerate("A b C d".split())], "source_id string, pos int, raw_word string, verse int")
    got = {(x["source_id"], x["index"]): x for x in io.label_rows(rows, aligned, words).collect()}
    assert (got["s", 0].label, got["s", 0].ayah_start, got["s", 0].ayah_end, got["s", 0].ref_end, got["s", 0].align_ok) == ("A b C", 0, 1, 3, True)
    assert (got["s", 1].label, got["s", 1].ref_start, got["s", 1].align_ok) == (None, None, False) and got["t", 0].label is None and got["t", 0].asr == "z"


def test_chain_is_as_long_as_any(spark):
    r = random.Random(9)
    for _ in range(60):
        points = [(r.randrange(9), r.randrange(9)) for _ in range(r.randrange(0, 12))]
        chain = alignment.rising_chain(points)
        assert set(chain) <= set(points) and all(a[0] < b[0] and a[1] < b[1] for a, b in zip(chain, chain[1:], strict=False))
        best = {p: 1 for p in points}
        for p in sorted(points):
            best[p] = 1 + max([best[q] for q in points if q[0] < p[0] and q[1] < p[1]], default=0)
        assert len(chain) == max(best.values(), default=0)


def test_drift_at_either_bound(spark, tmp_path):
    drop = lambda k, **orig: {"segment_id": f"s{k}", "action": "drop", **{f"orig_{b}_seconds": v for b, v in orig.items()}}
    c = fixes(spark, tmp_path, drop(0, end=9.0), drop(1, start=10.0, end=18.04), drop(2, start=20.0, end=27.9), drop(3, start=30.06), drop(4, end=48.0), drop(5))
    assert {tuple(r) for r in patch.exceptions(segs(spark), c).collect()} == {(s, "drifted") for s in ("s0", "s2", "s3")}
    assert {r.segment_id for r in patch.apply(segs(spark), c, strict_drift=True).collect()} == {"s0", "s2", "s3", "s6"}


def test_malformed_corrections_raise_and_torn_manifest_lines_dont(spark, tmp_path):
    (tmp_path / "bad.jsonl").write_text('{"segment_id": "a"}\n{"segm')
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        io.read_corrections(spark, str(tmp_path / "bad.jsonl")).collect()
    got = io.read_manifest(spark, str(tmp_path / "bad.jsonl"))
    assert [r.segment_id for r in got.collect()] == ["a"] == [r.segment_id for r in got.select("segment_id").collect()] and io.read_manifest(spark, str(tmp_path / "none")).count() == 0


def test_discovery_and_publication(spark, tmp_path):
    for name in ("A b/1.mp3", "A b/x.txt", "top.WAV"):
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_bytes(b"x")
    assert {r.source_id for r in io.discover(spark, str(tmp_path / "in")).collect()} >= {"unknown/top"}
    df = spark.createDataFrame([("a/1", "s1", "v1"), ("a/2", "s2", "v1")], "source_id string, segment_id string, v string")
    io.publish(df, str(tmp_path / "out"))
    io.publish(df.where("source_id = 'a/2'").withColumn("v", F.lit("v2")), str(tmp_path / "out"))
    assert {(r.source_id, r.v) for r in io.read_shards(spark, str(tmp_path / "out")).collect()} == {("a/1", "v1"), ("a/2", "v2")}
    assert io.published(spark, str(tmp_path / "no")).count() == 0


def test_stream_resumes_and_overwrites(spark, tmp_path):
    schema, at = "source_id string, v int", [str(tmp_path / x) for x in ("in", "out", "mark")]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text('{"source_id": "a", "v": 1}\n{"source_id": "b", "v": 1}\n{"sour')
    ingest(spark, *at, schema)
    (tmp_path / "in" / "2.json").write_text('{"source_id": "b", "v": 2}\n')
    for _ in range(2):
        ingest(spark, *at, schema)
        assert sorted((r.source_id, r.v) for r in spark.read.parquet(at[1]).collect()) == [("a", 1), ("b", 2)]


def case(seed, words=700, rate=0.2):
    r = random.Random(seed)
    ref = ["".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 8))) for _ in range(words)]
    spans, at = [], 0
    while at < words:
        spans.append((at, min(words, at + r.randrange(3, 13))))
        at = spans[-1][1]
    spoil = lambda w: "".join(r.choice("xyz") if r.random() < rate else c for c in w)
    return ref, spans, [" ".join(map(spoil, ref[a:b])) for a, b in spans]


@pytest.mark.parametrize("rate, floor", [(0.0, 1.0), (0.2, 0.85), (0.3, 0.85), (0.4, 0.8)])
def test_alignment_accuracy(rate, floor):
    ref, spans, said = case(11, rate=rate)
    got = alignment.align_document(ref, said)
    good = sum(abs(g["ref_start"] - a) <= 1 and abs(g["ref_end"] - b) <= 1 for g, (a, b) in zip(got, spans, strict=True))
    assert good >= floor * len(spans)


def test_alignment_pieces():
    assert alignment.rising_chain([(0, 0), (1, 9), (2, 1), (3, 2), (4, 3)]) == [(0, 0), (2, 1), (3, 2), (4, 3)]
    assert alignment.distance("kitten", "sitting") == pytest.approx(3 / 7) and alignment.distance("", "a") == 1.0 and alignment.distance("", "") == 0.0
    assert alignment.distances(["ab", "abc"], ["ab", "x"]).round(3).tolist() == [[0.0, 1.0], [pytest.approx(0.333), 1.0]]
    assert alignment.dp_align(["a", "bb", "c"], ["a", "c"]) == [0, 2]
    assert alignment.align_document(["a"] * 5, ["", "zzz"])[0]["ref_start"] == -1
    ref, _, _ = case(3, 3000)
    got = alignment.align_document(ref, [" ".join(ref[2500:2508])])[0]
    assert (got["ref_start"], got["ref_end"]) == (2500, 2508)
    twice = alignment.align_document(ref, [" ".join(ref[:8]), " ".join(ref[:8]), " ".join(ref[8:16])])
    assert twice[0]["ok"] and twice[2]["ref_start"] in (7, 8)


@pytest.mark.parametrize("tokens", [1, 2])
def test_glued_words_get_their_whole_span(tokens):
    ref, _, _ = case(5, 220)
    size = 20 // tokens
    glued = " ".join("".join(ref[a : a + size]) for a in range(100, 120, size))
    got = alignment.align_document(ref, [" ".join(ref[:100]), ref[100] + " " + glued, " ".join(ref[120:])])[1]
    assert (got["ref_start"], got["ref_end"], got["ok"]) == (100, 120, True) and got["distance"] < 0.4


def test_extension_tries_what_the_plain_loops_try():
    r = random.Random(6)
    for seed in range(40):
        ref, _, _ = case(seed, 300)
        a = r.randrange(100, 150)
        b = a + r.randrange(1, 6)
        said = r.choice(["", " "]).join(ref[a - r.randrange(12) : b + r.randrange(60)])
        best = d = alignment.distance(said, " ".join(ref[a:b]))
        start, end = a, b
        for e in range(b + 1, min(len(ref), a + 80) + 1):
            if (v := alignment.distance(said, " ".join(ref[a:e]))) < best:
                best, end = v, e
        for s in range(a - 1, max(0, end - 80) - 1, -1):
            if (v := alignment.distance(said, " ".join(ref[s:end]))) < best:
                best, start = v, s
        assert alignment._extended(ref, said, a, b, d, alignment.Config()) == (pytest.approx(best), start, end)


def test_many_edits_at_once_and_documents_together(spark):
    import random

    import numpy as np

    from segweave.operators import edits

    draw = random.Random(3)
    strings = ["".join(draw.choice("abé\U0001f600 ") for _ in range(n)) for n in (0, 1, 5, 63, 64, 65, 128, 130) for _ in range(4)]
    a, b = (np.array([draw.randrange(len(strings)) for _ in range(300)]) for _ in range(2))
    plain = [int(alignment.prefix_edits(strings[i], strings[j])[-1]) for i, j in zip(a, b, strict=True)]
    assert edits.edits(strings, a, b).tolist() == plain == [edits.edits_of(strings[i], strings[j]) for i, j in zip(a, b, strict=True)]
    words = ["w%03d" % draw.randrange(60) for _ in range(200)]
    docs = [(words[k : k + 90], [" ".join(words[m : m + 7]) + "x" * (m % 2) for m in range(k, k + 80, 7)]) for k in range(0, 100, 9)] + [([], ["a"]), (["a"], [])]
    assert alignment.align_many(docs) == [alignment.align_document(*d) for d in docs]
    gaps = [(r, " ".join(t).split()) for r, t in docs]
    assert alignment.dp_aligned(gaps) == [alignment.dp_align(*g) for g in gaps]


def test_alignment_queries_shuffle_texts_once(spark):
    from segweave.plans.queries import QUERIES

    for name in ("align_documents", "span_extension", "word_anchors", "lis_chain", "ngram_anchors"):
        plan = str(QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan())
        assert plan.count("Exchange hashpartitioning") == 1 and "Window" not in plan, name


def test_shards_are_few_and_a_broken_off_replacement_is_ended(spark, tmp_path):
    at = tmp_path / "out"
    rows = spark.range(600).select(F.concat(F.lit("g/"), F.col("id")).alias("source_id"), F.lit(1).alias("v"))
    io.publish(rows, str(at))
    assert len(list(at.rglob("*.parquet"))) <= io.SHARDS
    io.publish(rows.where("source_id LIKE 'g/1%'").withColumn("v", F.lit(2)), str(at))
    got = {r.source_id: r.v for r in io.read_shards(spark, str(at)).collect()}
    assert got == {f"g/{k}": 1 + str(k).startswith("1") for k in range(600)} and io.published(spark, str(at)).count() == 600
    staged = spark.read.parquet(str(at)).withColumn("v", F.lit(3))
    io._write(staged, str(at / "_staged"), "static")
    io.publish(rows.where("source_id = 'g/5'"), str(at))
    assert sorted(r.v for r in io.read_shards(spark, str(at)).collect()) == [1] + [3] * 599 and not (at / "_staged").exists()
