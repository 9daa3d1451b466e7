import random
import re

from pyspark.sql import functions as F

from segweave.llm import quality_rules as q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = len(words)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + 3]) for i in range(n - 2)]
    often = {g for g in grams if grams.count(g) > 1} if len(grams) < 3000 else {g for g, c in __import__("collections").Counter(grams).items() if c > 1}
    hit = {i + k for i, g in enumerate(grams) if g in often for k in range(3)}
    return n, sum(map(len, words)), sum(c in q.SYMBOLS for c in text), len(lines) - len(set(lines)), len(hit), n < 50 or 100 * len(hit) > 50 * n


def rows(seed):
    r = random.Random(seed)
    return [(i, "".join(r.choice(["a", "b", "cé", "#", "😀"]) + r.choice([" ", "  ", "\n", "\t", " \n", "\x0b"]) for _ in range(r.randrange(200)))) for i in range(150)]


def check(df):
    want = sorted(((r.doc_id, *brute(r.text)) for r in df.collect()), key=str)
    got = q.quality_rules(df)
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert sorted(map(tuple, got.select(base).collect()), key=str) == want
    assert got.where("base_failed AND kept").count() == 0


def test_measures(docs, nasty):
    check(docs(rows(1)))
    check(nasty)


def test_clashing_hashes_fall_back_to_words(docs, monkeypatch):
    real = F.xxhash64
    monkeypatch.setattr(F, "xxhash64", lambda *c: (real(*c) % 3) * (1 << 40))
    check(docs(rows(2)))


def test_policies_and_ablation(docs):
    clean = " ".join(f"clean{i} word" for i in range(60))
    df = docs([(1, clean), (2, "few words"), (3, "a b c " * 100), (4, " ".join(["##"] * 3 + [clean] + ["$$$"] * 30)), (5, None)])
    book = q.ledger(df)
    assert {r.doc_id for r in q.verdicts(book).where("kept").collect()} == {1}
    assert {r.doc_id for r in q.verdicts(book, "v1_lenient").where("kept").collect()} == {1, 4}
    by = {r.rule: (r.failing, r.only_this, r.kept_without) for r in q.ablation(book).collect()}
    assert by["many_symbols"] == (1, 1, 2) and by["few_words"][0] == 2 and by["many_words"] == (0, 0, 1)


def test_empty(docs):
    assert q.quality_rules(docs([])).collect() == [] and q.ablation(q.ledger(docs([]))).collect() == []


def test_native(docs):
    plan = q.quality_rules(docs([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan.replace("Exchange RoundRobin", "")
