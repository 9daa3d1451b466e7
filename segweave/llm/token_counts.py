"""Token counts by rank-synchronous array merging.

Pre-tokens of a batch lie in ragged numpy arrays: one symbol array and the row
of each symbol. A round finds each row's lowest-ranked neighbouring pair and
merges all of its occurrences from the left at once; merges made later in
training have higher ranks, so this gives the same symbols as one merge at a
time. Rows without a pair to merge leave the arrays; what is left of each row
are its tokens.

Null texts count as empty (0 tokens), rows of equal doc_id are counted each on
its own, an empty table gives no row, and extra columns are ignored. Special
strings in a text are one token, as is the tokenizer's default. A text of any
length is one row of a batch and is counted whole; a vocabulary file that isn't
plain byte-level BPE raises ValueError.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared
from .tokens import BATCH_BYTES, CACHE_PIECES, Memo, check_byte_level

#: The split of byte-level pre-tokenizers, a fixed public pattern.
PRETOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_NONE = np.iinfo(np.int64).max


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class MergeTable:
    """Ranks of pairs as a sorted key array, probed with binary search."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        check_byte_level(spec)
        vocab = spec["model"]["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left, right, made = (np.array([vocab[x] for x in side], np.int64) for side in ([m[0] for m in merges], [m[1] for m in merges], [m[0] + m[1] for m in merges]))
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made
        self.start = np.array([vocab[c] for c in byte_symbols()], np.int64)
        self.split = regex.compile(PRETOKEN)
        specials = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        self.words: dict[str, int] = {}
        self.memo = Memo(self.fill)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], _NONE)

    def count(self, words: list[str]) -> np.ndarray:
        """Surviving symbols of each pre-token."""
        raw = [w.encode("utf-8") for w in words]
        size = np.array([len(r) for r in raw], np.int64)
        out = size.copy()
        symbol = self.start[np.frombuffer(b"".join(raw), np.uint8)]
        row = np.repeat(np.arange(len(raw)), size)
        while len(symbol) > 1:
            rank = self.rank(symbol[:-1], symbol[1:])
            rank[row[:-1] != row[1:]] = _NONE
            heads = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            padded = np.r_[rank, _NONE]
            lowest = np.minimum.reduceat(padded, heads)
            width = np.diff(np.r_[heads, len(row)])
            hit = np.flatnonzero((padded == np.repeat(lowest, width)) & (padded != _NONE))
            if not len(hit):
                break
            # of pairs that overlap (equal symbols in a run) every second one merges, from the left
            opens = np.r_[True, np.diff(hit) != 1]
            run = np.flatnonzero(opens)[np.cumsum(opens) - 1]
            hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
            symbol[hit] = self.made[padded[hit]]
            keep = np.ones(len(symbol), bool)
            keep[hit + 1] = False
            np.subtract.at(out, row[hit], 1)
            live = np.repeat(lowest != _NONE, width) & keep
            symbol, row = symbol[live], row[live]
        return out

    def fill(self, known: dict[str, int], fresh: list[str], texts: list[str]) -> None:
        if len(self.words) > CACHE_PIECES:
            self.words.clear()
        marks = [len(self.special.findall(t)) if self.special else 0 for t in texts]
        cut = [[w for part in (self.special.split(t) if m else [t]) for w in self.split.findall(part)] for t, m in zip(texts, marks, strict=True)]
        lacking = list({w for words in cut for w in words}.difference(self.words))
        for at in range(0, len(lacking), 8192):
            self.words.update(zip(lacking[at : at + 8192], self.count(lacking[at : at + 8192]).tolist(), strict=True))
        for piece, m, words in zip(fresh, marks, cut, strict=True):
            known[piece] = m + sum(map(self.words.__getitem__, words))

    def __call__(self, texts: list[str] | pa.Array) -> list[int]:
        found, place, bounds = self.memo(texts)
        return np.add.reduceat(np.array(found, np.int64)[place], bounds[:-1]).tolist() if len(place) else []


_TABLES: dict[str, MergeTable] = {}


def merge_table(path: str) -> MergeTable:
    if path not in _TABLES:
        _TABLES[path] = MergeTable(path)
    return _TABLES[path]


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of each row; no shuffle."""

    def run(batches):
        for batch in shared.small_batches(shared.steady(batches, "token_counts"), limit=BATCH_BYTES):
            n = np.array(merge_table(vocabulary)(batch.column(1)), np.int64)
            size = pc.cast(pc.fill_null(pc.binary_length(batch.column(1)), 0), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), size, pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


shared.CACHES["token_counts"] = _TABLES.clear
