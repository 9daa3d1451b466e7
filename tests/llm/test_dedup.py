import pathlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from segweave.llm import components, embedding_dedup, ngram_join, shared, substring_dedup


def least(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("kind", ["chain", "random", "hub", "none"])
def test_components(spark, kind):
    r = random.Random(3)
    edges = {"chain": [(i, i + 1) for i in range(60)], "random": [(r.randrange(80), r.randrange(80)) for _ in range(50)], "hub": [(0, i) for i in range(200)] + [(5, 5)], "none": []}[kind]
    want = least({x for e in edges for x in e if e[0] != e[1]}, edges)
    got = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {x.node: x.component for x in got} == want and len(got) == len(want)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingle_set(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_classes(rows):
    sets = {d: shingle_set(t) for d, t in rows if d is not None}
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return sets, least(ids, links)


def near_copies(seed, groups=12):
    r = random.Random(seed)
    vocab = [f"W{i}é" if i % 7 == 0 else f"w{i}" for i in range(400)]
    out = []
    for _ in range(groups):
        base = [r.choice(vocab) for _ in range(r.choice([1, 3, 4, 5, 6, 9, 40, 200]))]
        for _ in range(r.randrange(1, 12)):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 4])):
                w[r.randrange(len(w))] = r.choice(vocab)
            out.append((len(out), " ".join(w).swapcase() if r.random() < 0.2 else r.choice([" ", "\n", "  "]).join(w)))
    return out


def test_jaccard_classes_match_brute_force(docs, nasty):
    rows = near_copies(1, 30)
    sets, want = brute_classes(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_classes(docs(rows)).collect()}
    assert got == {d: (len(sets[d]), want[d]) for d in sets}
    got = ngram_join.jaccard_classes(nasty).collect()
    assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id is not None) == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 5), (6, 5), (7, 7), (8, 8), (9, 9), (9, 9)]
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    assert ngram_join.jaccard_classes(docs([])).collect() == []


def test_blocks_of_large_buckets_lose_no_link(docs):
    base = [f"t{i}" for i in range(60)]
    rows = [(i, " ".join(base[:50] + [f"x{i}"] + base[50:])) for i in range(120)]
    assert {r.component_id for r in ngram_join.jaccard_classes(docs(rows), block=400).collect()} == {0}
    rows = near_copies(7)
    assert {r.doc_id: r.component_id for r in ngram_join.jaccard_classes(docs(rows), block=150).collect()} == brute_classes(rows)[1]


@pytest.mark.parametrize("pairwise", [True, False])
def test_blocks_hold_what_meets(spark, pairwise):
    n = [200, 200, 200, 300, 300, 500, 800, 800]
    members = [(key, i, k, i) for key in (1, 2) for i, k in enumerate(n)] + [(3, 1, 200, 1), (3, 2, 200, 1), (4, 5, 500, 5)]
    got = {}
    for r in ngram_join.buckets(spark.createDataFrame(members, "key long, rep long, n long, component long"), pairwise, block=600).collect():
        got.setdefault(r.bucket, set()).add(r.rep)
    together = {(i, j) for g in got.values() for i in g for j in g if i < j}
    if pairwise:
        assert together == {(i, j) for i in range(8) for j in range(i + 1, 8)}
    else:
        assert all(0 in g for g in got.values()) and set().union(*got.values()) == set(range(8))
    whole = [g for g in ngram_join.buckets(spark.createDataFrame(members, "key long, rep long, n long, component long"), pairwise, block=1 << 30).collect()]
    assert len({r.bucket for r in whole}) == 1 and len(whole) == 8  # equal members once, one class and one member not at all


def test_blocks_hold_a_bounded_number_of_sets(spark):
    """A tree's bitmaps take sets times shingles, so many short sets are more than a block too."""
    most = ngram_join.BLOCK_SETS
    members = spark.range(3 * most).selectExpr("1L AS key", "id AS rep", "5L AS n", "id AS component")
    got = {}
    for r in ngram_join.buckets(members, True).collect():
        got.setdefault(r.bucket, set()).add(r.rep)
    assert set().union(*got.values()) == set(range(3 * most)) and max(map(len, got.values())) < 2.3 * most
    assert len(got) == 6 and sum(map(len, got.values())) == 3 * 3 * most


def test_parts_are_whole_and_memory_is_given_back(monkeypatch):
    back = []
    monkeypatch.setattr(shared, "give_back", lambda: back.append(1))
    rows = [(1, 0, b"a"), (1, 2, b"b"), (2, 2, b"c"), (4, 1, b"d")]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), *[pa.array([r[2] for r in rows])] * 4], ["part", "kind", "c0", "c1", "c2", "c3"])
    found = [(p, [(k, bytes(c[3])) for k, c in held]) for p, held in ngram_join.by_part(iter([batch.slice(0, 1), batch.slice(1, 2), batch.slice(3)]))]
    assert found == [(1, [(0, b"a"), (2, b"b")]), (2, [(2, b"c")]), (4, [(1, b"d")])] and back


@pytest.mark.parametrize("listed", ["none", "some", "all"])
def test_prefixes_lose_no_link(spark, docs, listed):
    rows = near_copies(3, 40) + [(1000 + i, " ".join([f"p{k}" for k in range(30)] + [f"q{i}_{k}" for k in range(i)])) for i in range(20)]
    sets, _ = brute_classes(rows)
    every = np.unique(np.concatenate([ngram_join.shingles(t) for _, t in rows if t]))
    common = {"none": every[:0], "some": every[::2], "all": every}[listed]
    none = spark.createDataFrame([], "doc_id long, component long, d1 long, d2 long")
    keys = {}
    for r in ngram_join.prefixes(docs(rows), none, common, 5).collect():
        keys.setdefault(r.rep, set()).add(r.key)
    ids = [d for d in sets if sets[d]]
    linked = [(a, b) for a in ids for b in ids if a < b and sets[a] != sets[b] and 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b])]
    assert len(linked) > 50 and all(keys[a] & keys[b] for a, b in linked)


def test_each_linked_pair_of_a_table_is_found(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = ngram_join.jaccard_classes(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    assert {r.doc_id: r.component_id for r in got.collect()} == brute_classes(rows)[1]


def test_tree_finds_the_links_of_all_pairs():
    r = np.random.default_rng(2)
    for _ in range(5):
        base = [r.choice(500, r.integers(4, 40), replace=False) for _ in range(6)]
        sets = sorted((np.unique(np.where(r.random(len(b)) < 0.08, r.integers(500, 600, len(b)), b)).astype(np.uint64) for b in base for _ in range(20)), key=len)
        want = [(i, j) for i in range(len(sets)) for j in range(i) if 7 * len(np.intersect1d(sets[i], sets[j])) >= 3 * (len(sets[i]) + len(sets[j]))]
        union = components.Union(len(sets))
        forest = ngram_join.SignatureTree(sets, leaf=4).links(union)
        assert [union.find(i) for i in range(len(sets))] == list(least(range(len(sets)), want).values())
        assert set(map(tuple, map(sorted, forest))) <= set(map(tuple, map(sorted, want)))


def test_representatives(docs):
    rows = near_copies(4) + [(None, "kept as it is"), (None, None)]
    _, want = brute_classes(rows)
    got = ngram_join.representatives(docs(rows))
    assert got.columns == docs(rows).columns
    assert sorted(r.doc_id for r in got.where("doc_id IS NOT NULL").collect()) == sorted({*want.values()}) and got.where("doc_id IS NULL").count() == 2
    got = ngram_join.representatives(docs([(1, "a b c d e f"), (1, "a b c d e f"), (1, None), (2, "A b c d e f"), (3, None), (3, "")]))
    assert sorted((r.doc_id, r.text) for r in got.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()) == [(1, "a b c d e f"), (3, "")]


def test_embeddings_match_brute_force(spark):
    r = np.random.default_rng(1)
    base = r.normal(size=(40, 24))
    x = np.concatenate([base, base[:20] + r.normal(size=(20, 24)) * 0.2, base[:10] * 3, base[:10] + r.normal(size=(10, 24)) * 0.28]).astype(np.float32).astype(float)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    links = [(i, j) for i in range(len(x)) for j in range(len(x)) if i != j and u[i] @ u[j] >= 0.95]
    top = least(range(len(x)), links)
    odd = [(900, None), (901, []), (902, [0.0] * 24), (903, [None] * 24), (904, [float("nan")] * 24), (905, [float("inf")] * 24), (906, [1.0] * 7), (None, x[0].tolist())]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(0, x[0].tolist())] + odd, "vec_id long, embedding array<float>").selectExpr("*", "1 AS n", "2 AS links", "3 AS k").repartition(3)
    got = embedding_dedup.linked(df).collect()
    n = {i: sum(a == i for a, _ in links) for i in range(len(x))}
    want = [(i, n[i], top[i], top[i] == i) for i in [*range(len(x)), 0]] + [(v, 0, v, True) for v, _ in odd[:-1]] + [(None, None, None, False)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert embedding_dedup.linked(df.limit(0)).collect() == [] and len(embedding_dedup.linked(df.where("vec_id > 900")).collect()) == 6


def test_embeddings_of_several_lengths_and_blocks(spark):
    r = np.random.default_rng(4)
    base = r.normal(size=(60, 12)) * np.geomspace(3, 0.3, 12)
    x = [v.tolist() for k in range(40) for v in base + r.normal(size=base.shape) * 0.15] + [[1.0, 2.0, 3.0], [1.0, 2.0, 3.0], [1.0, 2.0, 3.01], [3.0, -1.0], [6.0, -2.0], [5.0], [2.0], [-2.0]]
    u = [np.array(v) / np.linalg.norm(v) for v in x]
    same = np.array([len(v) for v in x])
    cosine = np.full((len(x), len(x)), -1.0)
    for w in set(same.tolist()):
        at = np.flatnonzero(same == w)
        m = np.stack([u[i] for i in at])
        cosine[np.ix_(at, at)] = m @ m.T
    np.fill_diagonal(cosine, -1)
    assert not ((cosine > 0.95 - 1e-9) & (cosine < 0.95 + 1e-9)).any()
    top = least(range(len(x)), list(zip(*np.nonzero(cosine >= 0.95), strict=True)))
    got = embedding_dedup.linked(spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>").repartition(5))
    assert {r.vec_id: (r.n_links, r.component_id) for r in got.collect()} == {i: (int((cosine[i] >= 0.95).sum()), top[i]) for i in range(len(x))}


def test_suffix_bounds_lose_nothing():
    r = np.random.default_rng(5)
    x = r.normal(size=(300, 48)) * np.geomspace(3, 0.1, 48)
    x /= np.linalg.norm(x, axis=1)[:, None]
    i, j = embedding_dedup.survivors(x, x, 0.9)
    assert set(zip(*np.nonzero(x @ x.T >= 0.9), strict=True)) <= set(zip(i, j, strict=True)) and len(i) < 0.2 * 300 * 300


def passage(r, n):
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randrange(2, 9))) for _ in range(n))


def test_repeated_passages_go_wherever_they_stand(docs):
    r = random.Random(8)
    shared = [passage(r, 60) for _ in range(12)]
    rows = [(i, passage(r, 40) + " " + shared[i % 12] + r.choice([" ", "\n", ".\n"]) + passage(r, 70)) for i in range(36)]
    clean = [(100 + i, passage(r, 200)) for i in range(20)]
    got = {x.doc_id: x for x in substring_dedup.deduplicated(docs(rows + clean)).collect()}
    for i, text in clean + rows[:12]:
        assert got[i].text == text and not got[i].cut_spans
    for i, text in rows[12:]:
        cut = sum(len(text.encode()[s.start : s.end].split()) for s in got[i].cut_spans)
        assert 35 <= cut <= 62 and got[i].n_chars == len(got[i].text) < len(text)
        assert got[i].text.startswith(text[:100]) and got[i].text.endswith(text[-200:])


def test_chunks_match_a_plain_loop():
    r = random.Random(9)
    texts = ["", " \n", "one", *("".join(r.choice(["ab", "é ", " ", "\n", "xyz", "😀"]) for _ in range(300)) for _ in range(8))]
    raw = [t.encode() for t in texts]
    for text, rows in zip(raw, substring_dedup.chunks(raw), strict=True):
        found = [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", text)]
        want, open_ = [], None
        for k, (a, b) in enumerate(found):
            open_, n = (a, 1) if open_ is None else (open_, n + 1)
            h = sum(int(substring_dedup.GEAR[c]) << d for d, c in enumerate(text[max(0, b - 16) : b][::-1])) & 0xFFFF
            if h < (1 << 16) // substring_dedup.MEAN_WORDS or k == len(found) - 1:
                want.append([open_, b, n])
                open_ = None
        assert rows.tolist() == want


def test_passages_without_a_cut_go_too(docs):
    r = random.Random(12)
    rows, want = [], []
    while len(want) < 20:
        line = passage(r, r.randrange(1, 10))
        p = " ".join([line] * 80)
        if len(substring_dedup.chunks([p.encode()])[0]) > 2:
            continue
        p = " ".join(p.split()[:80])
        want.append(p)
        rows += [(10 * len(want) + k, f"{passage(r, 40)} {p} {passage(r, 40)}") for k in range(2)]
    got = {x.doc_id: x for x in substring_dedup.deduplicated(docs(rows)).collect()}
    texts = dict(rows)
    for k in range(1, 21):
        cut = sum(len(texts[10 * k + 1].encode()[s.start : s.end].split()) for s in got[10 * k + 1].cut_spans)
        assert 55 <= cut <= 80


def test_least_ends_match_a_plain_loop():
    r = random.Random(10)
    raw = [" ".join(r.choice(v) for _ in range(r.randrange(200))).encode() for v in (["a"], ["a", "b"], ["ab", "é", "xyz"], [f"w{i}" for i in range(300)]) for _ in range(6)]
    cut = 0
    for text, plain, rows in zip(raw, substring_dedup.chunks(raw), substring_dedup.chunks(raw, most=8), strict=True):
        found = [m.end() for m in re.finditer(rb"[^\x20\x09-\x0D]+", text)]
        h = [sum(int(substring_dedup.GEAR[c]) << d for d, c in enumerate(text[max(0, b - 16) : b][::-1])) & 0xFFFF for b in found]
        want, at = [], 0
        for _, b, n in plain.tolist():
            stop = found.index(b)
            ends = {stop} | {min(range(i, i + 8), key=lambda k: (h[k], -k)) for i in range(at, stop - 7)}
            want += [found[k] for k in sorted(ends)]
            cut += n > 8
            at = stop + 1
        assert rows[:, 1].tolist() == want and rows[:, 2].sum() == len(found) and (rows[:, 2] <= 16).all()
    assert cut > 5


def test_substring_edges(docs, nasty):
    got = substring_dedup.deduplicated(nasty).collect()
    by = {}
    for x in got:
        by.setdefault(x.doc_id, []).append(x)
    assert by[1][0].text is None and by[2][0].text == "" and by[5][0].cut_spans == []
    assert all(len(x.text) < 40 for x in by[6]) and len(by[9]) == 2 and by[None][0].text == "no id here at all"
    assert substring_dedup.deduplicated(docs([])).collect() == []
    p = passage(random.Random(1), 50)
    repeated = substring_dedup.deduplicated(docs([(1, p + " " + p), (2, None)])).where("doc_id = 1").first()
    assert len(repeated.text) < 1.3 * len(p)


def test_cuts_match_a_plain_run(docs):
    """Owners, marks and cuts of all documents at once, without Spark."""
    r = random.Random(12)
    shared = [passage(r, n) for n in (30, 60, 90)]
    rows = [(i, " ".join([passage(r, 20), shared[i % 3], passage(r, 15), r.choice(shared), r.choice(["", "\n"]), passage(r, 9)])) for i in range(40)]
    rows += [(50, shared[0]), (51, shared[0] + " " + shared[0]), (7, rows[3][1]), (52, None), (None, shared[1])]
    raw = [(d, (t or "").encode()) for d, t in rows]
    cut = substring_dedup.chunks([t for _, t in raw], most=substring_dedup.MOST_WORDS)
    keys = [substring_dedup.digests(t, c) for (_, t), c in zip(raw, cut, strict=True)]
    owner = {}
    for (d, _), ks in zip(raw, keys, strict=True):
        for k in ks if d is not None else []:
            owner[k] = min(owner.get(k, d), d)
    want = []
    for (d, t), ks, c in zip(raw, keys, cut, strict=True):
        gone, first = [], set()
        for k, (a, b, n) in zip(ks, c.tolist(), strict=True):
            gone.append((d is not None and (owner[k] < d or k in first), a, b, n))
            first.add(k)
        out, at, i = b"", 0, 0
        while i < len(gone):
            j = i
            while j < len(gone) and gone[j][0]:
                j += 1
            if j > i and sum(g[3] for g in gone[i:j]) >= substring_dedup.MIN_WORDS:
                out, at = out + t[at : gone[i][1]], gone[j - 1][2]
            i = max(j, i + 1)
        want.append((d, (out + t[at:]).decode()))
    df = docs(rows).selectExpr("*", "1 AS cut_spans", "2 AS _marks", "3 AS _id", "4 AS id", "5 AS row", "6 AS digest", "7 AS marks")
    got = substring_dedup.deduplicated(df)
    assert sorted(got.columns) == sorted(df.columns)
    assert sorted([(x.doc_id, x.text or "") for x in got.collect()], key=str) == sorted(want, key=str)
    assert sum(len(t) for _, t in want) < 0.7 * sum(len(t or "") for _, t in rows)


def test_embeddings_travel_once(spark):
    """What lies in the shared folder grows with the rows, not with the tiles; large groups of copies are folded before."""
    r = np.random.default_rng(6)
    base = r.normal(size=(9000, 64)).astype(np.float32)
    base[1:4500:3] = base[:4500:3] + r.normal(size=(1500, 64)) * 0.2
    base[5000:5300], base[5300:5303] = base[0], base[0] + 0.01
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(base)], "vec_id long, embedding array<float>")
    before = shared.made_paths()
    got = {x.vec_id: (x.n_links, x.component_id) for x in embedding_dedup.linked(df.repartition(4)).collect()}
    u = base.astype(float) / np.linalg.norm(base.astype(float), axis=1)[:, None]
    links = u @ u.T >= 0.95
    np.fill_diagonal(links, False)
    top = least(range(len(u)), list(zip(*np.nonzero(links), strict=True)))
    assert got == {i: (int(links[i].sum()), top[i]) for i in range(len(u))}
    files = [f for p in shared.made_paths() if p not in before for f in pathlib.Path(p.removeprefix("file://")).rglob("*") if f.is_file()]
    assert sum(f.stat().st_size for f in files) < 2 * base.nbytes


@pytest.mark.parametrize("groups", [1, 2, 3, 6, 7])
def test_groups_of_blocks_meet_once(groups):
    met = [embedding_dedup.pair(k, groups) for k in range(embedding_dedup.pairs_of(groups))]
    assert sorted(tuple(sorted(m)) for m in met if m) == [(a, b) for a in range(groups) for b in range(a, groups)]
