"""Packing along a space-filling curve.

Each document's token histogram is hashed to a vector, projected to few
dimensions and placed on a Hilbert curve. Documents are range-partitioned by
their place on the curve, so neighbours there share sequences, and their
tokens form one stream that is cut every `length` tokens. Only the end of the
whole stream remains; it is cut at the powers of two that make it up, so no
sequence is padded.

Tokens are encoded once and staged; bounds of the ranges come from the staged
keys, weighed by their documents' tokens, the number of tokens in each range
from a light pass, and then each range knows where it begins in the stream. Equal documents have equal places;
a hash of doc_id and row in the low bits of the key spreads them, so a group of copies
of any size is split between ranges.

Null and empty texts are a document of just the end id; a text of any length is
one document, cut over as many sequences as it fills. Rows that share a
doc_id are packed each on its own; they and those with null ids get a hash of
their own place in the table, so that copies are split between ranges too. An
empty table gives no row; extra columns are ignored. A vocabulary file that
isn't plain byte-level BPE raises ValueError.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared
from .tokens import BATCH_BYTES, encoder

DIMENSIONS, BITS, HASHED = 4, 12, 256
TIE_BITS = 15
#: Tokens that weigh as much as a document itself when ranges are balanced.
WEIGHT = 512
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert indexes of rows of whole coordinates, each of `bits` bits (Skilling's transform)."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            up = (x[i] & q) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(up, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where(x[n - 1] & q, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> bit & 1)
    return key


def projection() -> np.ndarray:
    return np.random.default_rng(4).choice([-1.0, 1.0], (HASHED, DIMENSIONS))


def curve_keys(tokens: list[np.ndarray]) -> np.ndarray:
    """Places of token sequences on the curve: hashed counts, damped, of norm 1, projected and quantised over [-4, 4]."""
    size = np.array([len(t) for t in tokens])
    flat = np.concatenate(tokens).astype(np.uint64)
    slot = ((flat + np.uint64(1)) * _SPREAD >> np.uint64(56)).astype(np.int64)
    counts = np.bincount(np.repeat(np.arange(len(tokens)), size) * HASHED + slot, minlength=len(tokens) * HASHED).reshape(-1, HASHED)
    v = np.sqrt(counts)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    grid = np.clip((v @ projection() + 4) / 8 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
    return hilbert_keys(grid)


def cut(start: int, size: int, total: int, length: int) -> list[tuple[int, int, int, int]]:
    """Pieces (offset in the document, size, sequence, offset there) of a document at `start` in a stream of `total` tokens."""
    full, tail = divmod(total, length)
    ends, at = [], full * length
    for bit in range(tail.bit_length() - 1, -1, -1):
        if tail >> bit & 1:
            ends.append((at, at + (1 << bit)))
            at += 1 << bit
    out, done = [], 0
    while done < size:
        here = start + done
        if here < full * length:
            seq, low = divmod(here, length)
            room = length - low
        else:
            k = next(k for k, (_, end) in enumerate(ends) if here < end)
            seq, low, room = full + k, here - ends[k][0], ends[k][1] - here
        n = min(room, size - done)
        out.append((done, n, seq, low))
        done += n
    return out


_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def packed(docs: DataFrame, vocabulary: str, length: int = 1024, end_id: int = 0) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of each piece."""
    spark = docs.sparkSession

    def encoded(batches):
        encode = encoder(vocabulary)
        end, seen, task = np.array([end_id], encode.dtype).tobytes(), 0, TaskContext.get().partitionId()
        for batch in shared.small_batches(shared.steady(batches, "tokens"), limit=BATCH_BYTES):
            ids = [x + end for x in encode(batch.column(1))]
            tokens = [np.frombuffer(x, encode.dtype) for x in ids]
            ties = np.array([zlib.crc32(b"%d %d %d" % (d or 0, task, seen + k)) >> (32 - TIE_BITS) for k, d in enumerate(batch.column(0).to_pylist())], np.int64)
            seen += len(ids)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(curve_keys(tokens) << TIE_BITS | ties), pa.array([len(t) for t in tokens], pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "place", "n", "ids"])

    rows = shared.staged(docs.select("doc_id", "text").mapInArrow(encoded, "doc_id long, place long, n long, ids binary"), "packing-tokens")
    weighed = rows.select(F.explode(F.expr(f"array_repeat(place, int(n div {WEIGHT}) + 1)")).alias("place"))
    bounds = shared.spread(weighed, "place", shared.partitions(spark))

    def ranged(batches):
        edges = np.array(bounds, np.int64)
        for batch in batches:
            place = batch.column(batch.schema.names.index("place")).to_numpy()
            part = np.searchsorted(edges, place, "right")
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), *batch.columns], ["part", *batch.schema.names])

    sizes = dict(map(tuple, rows.select("place", "n").mapInArrow(ranged, "part int, place long, n long").groupBy("part").agg(F.sum("n")).collect()))
    starts, total = {}, 0
    for part in sorted(sizes):
        starts[part], total = total, total + sizes[part]
    width = encoder(vocabulary).dtype.itemsize

    def pieces(batches):
        at, now = 0, None
        for batch in batches:
            out = []
            for part, doc_id, n, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4)), strict=True):
                if part != now:
                    now, at = part, starts[part]
                wide = np.frombuffer(ids, f"<u{width}").astype("<u4")
                out += [(doc_id, lo, size, zlib.crc32(wide[lo : lo + size].tobytes()), n, seq, low) for lo, size, seq, low in cut(at, n, total, length)]
                at += n
            columns = list(zip(*out, strict=True)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [x.split()[0] for x in _PIECE.split(", ")])

    full = rows.mapInArrow(ranged, "part int, doc_id long, place long, n long, ids binary")
    return full.repartitionById(len(bounds) + 1, full.part).sortWithinPartitions("part", "place", "doc_id", "ids").mapInArrow(pieces, _PIECE)
