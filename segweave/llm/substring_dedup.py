"""Substring dedup by content-defined chunking.

A gear rolling hash over the last 16 bytes is looked at where a word ends; a
chunk ends where it falls under a threshold, about every fourth word. A cut
depends on nothing but those bytes, so text that is shifted by insertions is cut
alike again after a few words. Text of few distinct contexts may hold no such
end, so a chunk of more than `MOST_WORDS` words is cut once more, where the hash
is the least of that many word ends in a row. Chunks are known by their 64-bit digest; of
the chunks that several documents hold, the document of the least id keeps
its own, and a chunk that a document repeats stays where it stands first. A run of
neighbouring duplicate chunks with `min_words` words or more is cut out of the
text, shorter ones stay: words that texts share by chance aren't passages.

Owners of digests are found by a pre-aggregated minimum, occurrences meet them
in a join that splits skewed digests, and what travels is ids and numbers; texts
meet their own list of marks once.

Null texts stay null and rows with null doc_id stay whole and own nothing.
Rows that share a doc_id are seen as one document: they don't cut each other, and
each is cut where any other document owns the chunk. A text of any length is
chunked whole. An empty table gives no row. Extra columns are carried along whatever
their names; only an input column `cut_spans` gives way to the operator's.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

MEAN_WORDS, MIN_WORDS = 4, 25
#: Words of a chunk beyond which it is cut at the least hashes.
MOST_WORDS = 8
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def gear_table() -> np.ndarray:
    """A 16-bit number for each byte; white space counts alike, the padding between texts not at all."""
    table = np.random.default_rng(10).integers(0, 1 << 16, 256).astype(np.uint16)
    table[_SPACE] = table[32]
    table[0] = 0
    return table


GEAR = gear_table()


def _word_ends(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Of each word of all texts: its first and last byte in the text, its text, the hash at its end."""
    pad = b"\0" * 16
    data = np.frombuffer(pad + pad.join(texts) + pad, np.uint8)
    h = GEAR[data]
    for step in (1, 2, 4, 8):
        shifted = np.zeros_like(h)
        shifted[step:] = h[:-step] << np.uint16(step)
        h = h + shifted
    inside = ~_SPACE[data] & (data != 0)
    edge = np.flatnonzero(np.diff(inside.astype(np.int8)))
    first, last = edge[::2] + 1, edge[1::2]
    size = np.array([len(t) for t in texts], np.int64)
    base = 16 + np.r_[0, np.cumsum(size + 16)[:-1]].astype(np.int64)
    text = np.searchsorted(base, first, "right") - 1
    return first - base[text], last - base[text], text, h[last]


def chunks(texts: list[bytes], mean_words: int = MEAN_WORDS, most: int | None = None) -> list[np.ndarray]:
    """For each text its chunks as rows (start, end, words); white space before a chunk's first word belongs to no chunk.

    With `most`, chunks of more words are cut again at the least hashes.
    """
    first, last, text, h = _word_ends(texts)
    ends = h < (1 << 16) // mean_words
    if len(ends):
        ends[np.flatnonzero(np.diff(text))] = True
        ends[-1] = True
    if most is not None:
        ends |= _least_ends(h, np.flatnonzero(ends), most)
    stop = np.flatnonzero(ends)
    begin = np.r_[0, stop[:-1] + 1].astype(np.int64)[: len(stop)]
    rows = np.stack([first[begin], last[stop] + 1, stop - begin + 1], 1) if len(stop) else np.zeros((0, 3), np.int64)
    return np.split(rows, np.searchsorted(text[stop], np.arange(1, len(texts)))) if texts else []


def _least_ends(h: np.ndarray, stop: np.ndarray, most: int) -> np.ndarray:
    """Word ends that are the least (of equals: the last) of some `most` ends in a row inside one chunk.

    What is chosen depends on the hashes near it alone, and any `most` words in a row hold one.
    """
    chosen = np.zeros(len(h), bool)
    begin = np.r_[0, stop[:-1] + 1].astype(np.int64)[: len(stop)]
    long = stop - begin + 1 > most
    size = (stop - begin - most + 1)[long]  # windows of each; the chunk's own end is in none
    if len(size):
        start = np.repeat(begin[long] - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
        windows = np.lib.stride_tricks.sliding_window_view(h, most)[start]
        chosen[start + most - 1 - windows[:, ::-1].argmin(1)] = True
    return chosen


def digests(text: bytes, rows: np.ndarray) -> list[int]:
    """Signed 64-bit digests of the chunks' words."""
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    out = np.array([digest(b" ".join(text[a:b].split())) for a, b in rows[:, :2].tolist()], np.uint64)
    return out.astype(np.int64).tolist()


def _bytes(text: str | None) -> bytes:
    return (text or "").encode().replace(b"\0", b"\x01")  # of the same length; the padding byte is ours


def occurrences(docs: DataFrame) -> DataFrame:
    """digest and doc_id of the distinct chunks of each row with an id."""

    def step(columns, texts):
        raw = [_bytes(t) for t in texts]
        found = [list(set(digests(t, rows))) for t, rows in zip(raw, chunks(raw, most=MOST_WORDS), strict=True)]
        ids = np.repeat(np.array(columns[0], np.int64), [len(f) for f in found])
        return pa.RecordBatch.from_pydict({"digest": pa.array([d for f in found for d in f], pa.int64()), "doc_id": ids})

    return shared.text_map(docs.where("doc_id IS NOT NULL"), ["doc_id"], step, "digest long, doc_id long")


def owned(found: DataFrame) -> DataFrame:
    """digest and owner (least doc_id) of the chunks that several documents hold, from their occurrences."""
    found = found.groupBy("digest").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("other"))
    return found.where("owner < other").select("digest", "owner")


def spans(text: bytes, rows: np.ndarray, marked: set[int], min_words: int) -> list[tuple[int, int]]:
    """Byte ranges to cut: runs of marked chunks, or such as stood before in the text, of min_words words or more."""
    seen, out, run, words = set(), [], None, 0
    keys = digests(text, rows)
    if not marked and len(set(keys)) == len(keys):
        return []
    for i, (a, b, n) in enumerate([*rows.tolist(), (0, 0, 0)]):
        if i < len(keys) and (keys[i] in marked or keys[i] in seen):
            run, words = (a if run is None else run), words + n
            last = b
        elif run is not None:
            if words >= min_words:
                out.append((run, last))
            run, words = None, 0
        if i < len(keys):
            seen.add(keys[i])
    return out


def without(text: bytes, cuts: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, b in cuts:
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]])


def deduplicated(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """docs with cut texts (n_chars, if there, follows), and the column cut_spans of the byte ranges that went."""
    docs = docs.drop("cut_spans")
    found = shared.staged(occurrences(docs), "chunks")
    owners = shared.staged(owned(found), "chunk-owners")
    marks = found.join(owners, "digest").where("owner < doc_id").groupBy("doc_id").agg(F.collect_set("digest").alias("marks"))
    names = docs.columns
    spans_type = "array<struct<start: bigint, end: bigint>>"
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        at = names.index("text")
        for whole in batches:
            flat = pa.RecordBatch.from_arrays([*whole.column(0).flatten(), whole.column(1)], [*map(str, range(len(names))), "marks"])
            for batch in shared.small_batches(shared.steady(iter([flat])), str(at)):
                texts, marked, ids = batch.column(at).to_pylist(), batch.column(len(names)).to_pylist(), batch.column(names.index("doc_id")).to_pylist()
                raw = [_bytes(t) for t in texts]
                cuts = [spans(t, rows, set(m or ()), min_words) if i is not None else [] for t, rows, m, i in zip(raw, chunks(raw, most=MOST_WORDS), marked, ids, strict=True)]
                kept = [t if not c else without(t.encode(), c).decode() for t, c in zip(texts, cuts, strict=True)]
                columns = list(batch.columns[: len(names)])
                columns[at] = pa.array(kept, pa.string())
                if "n_chars" in names:
                    k = names.index("n_chars")
                    columns[k] = pa.array([n if not c else len(t) for n, c, t in zip(columns[k].to_pylist(), cuts, kept, strict=True)], columns[k].type)
                yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(columns, names), pa.array([[{"start": a, "end": b} for a, b in c] for c in cuts], span)], ["row", "cut_spans"])

    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"))
    marked = rows.join(marks, F.col("id") == F.col("doc_id"), "left").select("row", "marks")
    schema = rows.select("row").withColumn("cut_spans", F.lit(None).cast(spans_type)).schema
    return marked.mapInArrow(run, schema).select("row.*", "cut_spans")
