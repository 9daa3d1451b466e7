import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from segweave.llm import language_id, mixing, packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
MODEL = Tokenizer.from_file(PATH)
TONGUES = {"aa": ["lo", "mi", "sa", "nor"], "bb": ["kru", "zat", "wex", "öl"], "cc": ["the", "and", "ing", "ed"]}


def say(r, lang, n):
    return " ".join("".join(r.choice(TONGUES[lang]) for _ in range(r.randrange(1, 4))) for _ in range(n))


def corpus(seed, n=150):
    r = random.Random(seed)
    return [(i, say(r, lang, r.randrange(5, 60)), lang) for i in range(n) for lang in [r.choice([*TONGUES])]]


def test_language_id_on_held_out_rows(docs):
    rows = corpus(1)
    df = docs(rows)
    got = {r.doc_id: r for r in language_id.languages(df, language_id.train(df, train_rows=60)).collect()}
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert {i for i, r in got.items() if r.held_out} == set(held)
    assert sum(got[i].lang_pred == lang for i, _, lang in rows if i in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_scores_match_dense_kernel_ridge():
    r = random.Random(2)
    rows = [(say(r, lang, r.randrange(1, 40)) + r.choice(["", " É ß", "!"]), lang) for lang in ("aa", "cc") for _ in range(30)]
    texts = [t for t, _ in rows] + ["", "zzz 999", "Qq", rows[0][0] * 3]

    def spectrum(t):
        return {t.lower()[i : i + n] for n in (1, 2, 3) for i in range(len(t.lower()) - n + 1)}

    def kernel(a, b):
        a, b = spectrum(a), spectrum(b)
        return len(a & b) / math.sqrt(max(1, len(a)) * max(1, len(b)))

    marks = [rows[k // 2 + 30 * (k % 2)][0] for k in range(20)]
    k = np.array([[kernel(t, m) for m in marks] for t in texts])
    value, vector = np.linalg.eigh(np.array([[kernel(a, b) for b in marks] for a in marks]))
    z = k @ (vector[:, value > 1e-6 * value[-1]] / np.sqrt(value[value > 1e-6 * value[-1]]))
    y = np.array([[1.0 if lang == x else -1.0 for x in ("aa", "cc")] for _, lang in rows])
    fitted, middle = z[:60], z[:60].mean(0)
    beta = np.linalg.solve((fitted - middle).T @ (fitted - middle) + 0.1 * np.eye(z.shape[1]), (fitted - middle).T @ (y - y.mean(0)))
    model = language_id.fit(rows, landmarks=20)
    assert np.allclose(model.scores(texts), (z - middle) @ beta + y.mean(0), atol=1e-5)
    assert model.predict(["²½ 12", "ʰ", None, ""])[0][0] == "und" and model.predict(["ª"])[0][0] != "und"


def test_labels_of_held_out_rows_are_never_learned(docs):
    rows = corpus(2, 60)
    wrong = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 3 == 1 else lang) for i, t, lang in rows]
    assert language_id.train(docs(wrong)).languages == sorted(TONGUES)


def test_language_edges(docs, nasty):
    model = language_id.train(docs(corpus(3)))
    got = language_id.languages(nasty, model).collect()
    assert len(got) == 12 and {r.lang_pred for r in got if r.doc_id in (1, 2, 3)} == {"und"} and not [r for r in got if r.doc_id is None][0].held_out
    none = language_id.train(docs([(1, "a b", None), (2, None, "en")]))
    assert [tuple(r) for r in language_id.languages(docs([(4, "text")]), none).select("lang_pred", "score").collect()] == [("und", 0.0)]
    assert language_id.languages(docs([]), model).collect() == []
    kept = language_id.accepted(nasty, model)
    assert kept.columns == nasty.columns and not {1, 2, 3} & {r.doc_id for r in kept.collect()}


def test_hilbert_keys_walk_in_unit_steps():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    key = packing.hilbert_keys(grid, 3)
    path = grid[np.argsort(key)]
    assert sorted(key) == list(range(512)) and (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def check_packing(df, length):
    pieces = packing.packed(df, PATH, length=length).collect()
    want = defaultdict(list)
    for r in df.collect():
        want[r.doc_id].append(np.array([*MODEL.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4"))
    total = sum(len(x) for v in want.values() for x in v)
    seq = defaultdict(list)
    for p in pieces:
        assert any(len(x) == p.doc_tokens and zlib.crc32(x[p.start : p.start + p.length].tobytes()) == p.ids_crc32 for x in want[p.doc_id])
        seq[p.sequence_id].append((p.offset, p.length))
    sizes = {}
    for s, parts in seq.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        sizes[s] = at
    assert sum(sizes.values()) == total and sorted(sizes) == list(range(len(sizes)))
    assert all(n == length or (n < length and n & (n - 1) == 0) for n in sizes.values()) and sum(n < length for n in sizes.values()) <= 10
    for doc_id, bodies in want.items():
        own = sorted((p.start, p.length) for p in pieces if p.doc_id == doc_id)
        assert sum(n for _, n in own) == sum(map(len, bodies))


def test_packing_holds_each_id_once(docs, nasty):
    check_packing(nasty, 1024)
    check_packing(docs([(i, say(random.Random(i), "cc", i)) for i in range(80)] + [(100 + i, "copy of one text") for i in range(50)]), 64)
    assert packing.packed(docs([]), PATH).collect() == []


def test_neighbours_on_the_curve_share_a_language(docs):
    rows = [(i, say(random.Random(i), "aa" if i % 2 else "bb", 60)) for i in range(120)]
    order = sorted(packing.packed(docs(rows), PATH, length=1 << 20).collect(), key=lambda p: p.offset)
    turns = sum(a.doc_id % 2 != b.doc_id % 2 for a, b in zip(order, order[1:], strict=False))
    assert turns < 40


def fill(sizes, weights, share, most):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    cap = {s: most * sizes[s] for s in names}
    left, open_, got = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] >= cap[s]}
        for s in over or open_:
            got[s] = cap[s] if over else level * w[s]
        left -= sum(got[s] for s in over)
        open_ -= over or open_
    return got


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_comes_near_its_targets(docs, seed):
    r = random.Random(seed)
    rows = [(i, None if i % 40 == 0 else say(r, "cc", r.randrange(0, 30)), None, r.choice(["b", "b", "b", "b", "a", None, "é", "z", ""])) for i in range(600)]
    got = {x.doc_id: x for x in mixing.mixed(docs(rows)).collect()}
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _, _ in rows}
    source = {i: s for i, _, _, s in rows}
    per = defaultdict(int)
    for i, s in source.items():
        per[s] += size[i]
    goal = fill(per, (3, 1, 2), 1.5, 2)
    taken = defaultdict(int)
    for i, x in got.items():
        assert x.size == size[i] and x.source_size == per[source[i]] and x.target == pytest.approx(goal[source[i]])
        assert x.taken in (0, x.size, 2 * x.size)
        taken[source[i]] += x.taken
    assert all(abs(taken[s] - goal[s]) <= 30 for s in per)
    again = {x.doc_id: x.taken for x in mixing.mixed(docs(rows).repartition(7)).collect()}
    assert again == {i: x.taken for i, x in got.items()}
    mix = mixing.copies(docs(rows))
    assert mix.columns == docs(rows).columns
    count = defaultdict(int)
    for x in mix.collect():
        count[x.doc_id] += size[x.doc_id]
    assert {i: n for i, n in count.items() if n} == {i: x.taken for i, x in got.items() if x.taken}


def test_mix_edges(docs, nasty):
    assert len(mixing.mixed(nasty).collect()) == 12 and mixing.mixed(docs([])).collect() == [] and mixing.copies(docs([])).collect() == []
    assert [x.taken for x in mixing.mixed(docs([(1, ""), (2, None)])).collect()] == [0, 0]
    text = mixing.mixed(nasty)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text


def test_pipeline_stages(spark, docs, tmp_path):
    r = random.Random(5)
    base = [(i, say(r, "cc" if i % 3 else "aa", 90), "cc" if i % 3 else "aa", f"s{i % 4}") for i in range(60)]
    copies = [(100 + i, base[i][1] + " extra", base[i][2], "s0") for i in range(10)]
    rows = base + copies + [(200, "123 456", None, "s1"), (201, None, None, None)]
    docs(rows, extra=False).write.parquet(str(tmp_path / "documents.parquet"))
    frame, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = frame.columns
        frame = stage(spark, frame, str(tmp_path))
        assert frame.columns == columns
        seen.append(sorted(x.doc_id for x in frame.collect()))
    assert seen[0] == sorted(x[0] for x in base + copies) and seen[1] == seen[2] == [x[0] for x in base]
    assert set(seen[3]) <= set(seen[2]) and len(seen[3]) > len(seen[2])
    (tmp_path / "few").mkdir()
    odd = [(1, say(r, "cc", 60), "cc", "a")] * 3 + [(1, None, None, None), (None, say(r, "cc", 60), "cc", None), (2, "", "cc", "a")]
    for rows_, extra in ((odd, True), ([], True)):
        at = str(tmp_path / "few" / f"{len(rows_)}")
        docs(rows_, extra).write.parquet(f"{at}/documents.parquet")
        pieces = corpus_pipeline.run(spark, at).collect()
        assert {x.doc_id for x in pieces} <= {1, None} and bool(pieces) == bool(rows_)
    last = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted({x.doc_id for x in last}) == sorted(set(seen[3]))
