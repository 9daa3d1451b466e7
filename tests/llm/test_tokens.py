import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from segweave.llm import token_counts, token_output, tokens
from segweave.llm.tokens import PieceEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
MODEL = Tokenizer.from_file(PATH)
ENCODE, COUNT = PieceEncoder(PATH), token_counts.MergeTable(PATH)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t aeé'st1!?.　\x1c\x85​﻿"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_pieces_give_what_whole_texts_give(text):
    whole = MODEL.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ENCODE([text])[0], ENCODE.dtype).tolist() == whole
    assert COUNT([text]) == [len(whole)]


def test_each_stem_is_encoded_once_and_old_ones_go(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 300)
    encode, given = PieceEncoder(PATH), []
    fill = encode.stems.fill
    encode.stems.fill = lambda fresh: given.extend(fresh.to_pylist()) or fill(fresh)
    r = random.Random(5)
    texts = [" ".join(r.choice(["stem", "été", "<|endoftext|>", "!", "x\n"]) + r.choice(["", ",", ".", "?!", "7"]) for _ in range(60)) for _ in range(5)]
    for _ in range(2):
        assert [np.frombuffer(x, encode.dtype).tolist() for x in encode(texts)] == [MODEL.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(given) == len(set(given)) and " stem" in given and " stem," not in given
    many = [" ".join(f"w{r.randrange(10**6)}{r.choice('ab')}{r.choice(['', '.'])}" for _ in range(200)) for _ in range(9)]
    for t in many + texts + many:
        assert np.frombuffer(encode([t])[0], encode.dtype).tolist() == MODEL.encode(t, add_special_tokens=False).ids
        assert len(encode.stems.texts) <= 300
    monkeypatch.setattr(tokens, "STEM_BYTES", 1000)
    assert encode(["long" * 999]) == PieceEncoder(PATH)(["long" * 999]) and len(encode.stems.texts) == 0
    assert encode([]) == [] and encode([None, ""]) == [b"", b""]


def test_counts_of_long_runs_and_specials():
    texts = ["a" * 5000, "ab" * 3001, "<|endoftext|>" * 3, " <|endoftext|> x<|endoftext|>", "", "!" * 777, " " * 99, "\n \n" * 40, "".join(random.Random(1).choice("etaoin") for _ in range(20000))]
    assert COUNT(texts) == [len(MODEL.encode(t, add_special_tokens=False).ids) for t in texts]


def expected(rows, end):
    out, start = [], 0
    encoded = [(d, np.array([*MODEL.encode(text or "", add_special_tokens=False).ids, end], "<u4")) for d, text in rows]
    for doc_id, ids in sorted(encoded, key=lambda r: (r[0] is not None, r[0] or 0, r[1].astype("<u2").tobytes())):
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_round_trip_with_nulls_ties_and_long_texts(nasty):
    got = token_output.token_records(nasty, PATH)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    rows = [(r.doc_id, r.text) for r in nasty.collect()]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == expected(rows, 2)


def test_index_seeks_and_damage_is_found(spark, docs, tmp_path):
    manifest = token_output.write(docs([(i, f"text {i}") for i in range(20)]), PATH, shards=4).collect()
    assert sum(m.docs for m in manifest) == 20
    index = token_output.read_index(manifest[0].path)
    doc_id, ids = token_output.read_record(manifest[0].path, int(index["offset"][3]))
    assert MODEL.decode(ids[:-1].tolist()) == f"text {doc_id}" and ids[-1] == 2
    record = bytearray(token_output.frame(1, b"\x05\x00", 2))
    record[-6] ^= 1
    with pytest.raises(ValueError):
        token_output.unframe(memoryview(bytes(record)), 0)


def test_empty_table(docs):
    assert token_output.token_records(docs([]), PATH).collect() == []
    assert token_counts.token_counts(docs([]), PATH).collect() == []


def test_counts_with_nulls_and_long_texts(nasty):
    want = sorted(((r.doc_id, len((r.text or "").encode()), n := len(MODEL.encode(r.text or "", add_special_tokens=False).ids), n > 512) for r in nasty.collect()), key=str)
    assert sorted(map(tuple, token_counts.token_counts(nasty, PATH).collect()), key=str) == want
