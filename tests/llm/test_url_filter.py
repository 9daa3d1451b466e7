import pytest

from segweave.llm import url_filter as u
from segweave.llm.queries import URL_RULES

CASES = [
    ("http://a.b.net/x?q", "a.b.net", "/x", "net/", "block"),
    ("https://WWW.Example.NET/en/1#t", "www.example.net", "/en/1", "example.net/en/", "allow"),
    ("https://example.net/EN/1", "example.net", "/EN/1", "net/", "block"),
    ("http://x.example.com/de/9", "x.example.com", "/de/9", "example.com/de/", "block"),
    ("http://example.com/de", "example.com", "/de", None, "allow"),
    ("http://badexample.com/de/9", "badexample.com", "/de/9", None, "allow"),
    ("http://q.org/fr/1", "q.org", "/fr/1", "org/fr/", "allow"),
    ("http://x.net", "x.net", "", None, "allow"),
    ("http://x.net?a/b", "x.net", "", None, "allow"),
    ("x.net/a", "", "", None, "allow"),
    ("s://\nN.net/\n?z", "\nn.net", "/\n", "net/", "block"),
    ("a://b://c.net/", "b:", "//c.net/", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
]


def test_cases(spark):
    pages = spark.createDataFrame([(i, c[0], "h", "x") for i, c in enumerate(CASES)], "page_id long, url string, html string, host string").repartition(3)
    got = {r.page_id: tuple(r)[1:] for r in u.url_verdicts(pages, URL_RULES).collect()}
    assert got == {i: c[1:] for i, c in enumerate(CASES)}
    assert u.url_verdicts(pages.limit(0), URL_RULES).collect() == []


def test_long_urls_and_repeated_rows(spark, tmp_path):
    host, path = ".".join(["a"] * 40_000) + ".net", "/" + "b" * 300_000
    pages = spark.createDataFrame([(1, f"s://{host}{path}"), (1, f"s://{host}{path}"), (2, "s://" + "c" * 100_000 + "/")], "page_id long, url string")
    assert sorted((r.page_id, len(r.host), len(r.path), r.verdict) for r in u.url_verdicts(pages, URL_RULES).collect()) == [(1, len(host), len(path), "block")] * 2 + [(2, 100_000, 1, "allow")]
    (tmp_path / "rules").write_bytes(u.pack_rules(URL_RULES))
    assert len(u.DigestArray(str(tmp_path / "rules")).candidates(host, path)) <= 2 * len({len(r.partition("/")[2]) for r in URL_RULES})


def test_colliding_keys_are_confirmed(tmp_path, monkeypatch):
    import xxhash

    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda b: len(b) % 3)
    rules = {f"h{i}.com/p{i}/": "block" if i % 2 else "allow" for i in range(50)}
    (tmp_path / "rules").write_bytes(u.pack_rules(rules))
    array = u.DigestArray(str(tmp_path / "rules"))
    rows = array.find([*rules, "h1.com/p2/", "zzz"])
    assert [array.stored(i).decode() for i in rows[:50]] == list(rules) and rows[50:].tolist() == [-1, -1]


def test_bad_rules():
    with pytest.raises(ValueError):
        u.pack_rules({"net": "block"})
    assert len(u.pack_rules({})) == 32
