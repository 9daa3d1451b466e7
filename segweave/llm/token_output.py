"""Token-ID output: length-delimited binary records with masked checksums and an offset index.

A shard is a run of records ``length u64 | masked crc of length u32 | payload |
masked crc of payload u32``; the payload is ``has_id u8 | id width u8 | doc_id
i64 | ids``. Beside it lies an index of ``(offset u64, n_tokens u32)`` entries, one for
each record, by which a shuffled reader seeks without scanning. The
checksum is CRC-32, masked by rotation and an added constant so that a checksum
of bytes that hold checksums stays sound.

Rows with null doc_id come first, null or empty texts are a record with only
the end id, and rows that share a doc_id follow each other. A doc_id (or null)
with more rows than a shard should have is dealt over several shards, in each
of which its rows are ordered by their ids' bytes. A text of any length is one record.
Extra columns are ignored; an empty table gives no shard and no row. A vocabulary file
that isn't plain byte-level BPE raises ValueError.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared
from .tokens import BATCH_BYTES, encoder

#: Added to the rotated checksum.
MASK_DELTA = 0xA282EAD8
HEAD, PAYLOAD, ENTRY = "<QI", "<BBq", "<QI"
_MANIFEST = "shard int, path string, docs long, tokens long, bytes long"
_RECORD = "doc_id long, start long, n_tokens long, ids_crc32 long"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes, width: int) -> bytes:
    payload = struct.pack(PAYLOAD, doc_id is not None, width, doc_id or 0) + ids
    length = struct.pack("<Q", len(payload))
    return length + struct.pack("<I", masked(length)) + payload + struct.pack("<I", masked(payload))


def unframe(data: memoryview, at: int) -> tuple[int | None, np.ndarray, int]:
    """doc_id, ids and the next record's offset; raises ValueError on a damaged record."""
    length, check = struct.unpack_from(HEAD, data, at)
    if check != masked(bytes(data[at : at + 8])):
        raise ValueError(f"damaged length at {at}")
    begin, end = at + struct.calcsize(HEAD), at + struct.calcsize(HEAD) + length
    payload = data[begin:end]
    if len(payload) < length or struct.unpack_from("<I", data, end)[0] != masked(payload):
        raise ValueError(f"damaged record at {at}")
    has_id, width, doc_id = struct.unpack_from(PAYLOAD, payload)
    return doc_id if has_id else None, np.frombuffer(payload[struct.calcsize(PAYLOAD) :], f"<u{width}"), end + 4


def write(docs: DataFrame, vocabulary: str, end_id: int = 2, shards: int | None = None) -> DataFrame:
    """Write the shards of docs in ascending doc_id order; returns their manifest.

    A task writes under a name of its own, and only the manifest of the task
    that succeeded names its files, so lost executors and second attempts leave
    no half-written shard in it. Texts are encoded where they are read; only
    ids are shuffled.
    """
    spark = docs.sparkSession
    folder = shared.fresh_path(spark, "token-shards")
    count = shards or shared.partitions(spark)

    lowest = int(np.iinfo(np.int64).min)
    bounds = shared.spread(docs.select(F.coalesce("doc_id", F.lit(lowest)).alias("doc_id")), "doc_id", count)

    def encoded(batches):
        encode, edges, seen = encoder(vocabulary), np.array(bounds, np.int64), 0
        for batch in shared.small_batches(shared.steady(batches, "tokens"), limit=BATCH_BYTES):
            end = np.array([end_id], encode.dtype).tobytes()
            ids = [x + end for x in encode(batch.column(1))]
            low = batch.column(0).fill_null(lowest).to_numpy(zero_copy_only=False)
            shard = shared.ranges(edges, low, seen + np.arange(len(low)))
            seen += len(low)
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), batch.column(0), pa.array(ids, pa.binary()), pa.array([encode.dtype.itemsize] * len(ids), pa.int32())], ["shard", "doc_id", "ids", "width"])

    def run(batches):
        shard = TaskContext.get().partitionId()
        files, base = shared.arrow_files(folder)
        files.create_dir(base, recursive=True)
        name, out, index, at, docs_n, tokens = f"{base}/{shard:06d}-{uuid.uuid4().hex}", None, None, 0, 0, 0
        for batch in batches:
            if batch.num_rows and out is None:
                out, index = files.open_output_stream(name + ".rec"), files.open_output_stream(name + ".idx")
            for doc_id, ids, width in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                record = frame(doc_id, ids, width)
                out.write(record)
                index.write(struct.pack(ENTRY, at, len(ids) // width))
                at, docs_n, tokens = at + len(record), docs_n + 1, tokens + len(ids) // width
        if out is not None:
            out.close()
            index.close()
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "path": [name], "docs": [docs_n], "tokens": [tokens], "bytes": [at]})

    ids = docs.select("doc_id", "text").mapInArrow(encoded, "shard int, doc_id long, ids binary, width int")
    ordered = ids.repartitionById(len(bounds) + 1, ids.shard).sortWithinPartitions("doc_id", "ids")
    return shared.staged(ordered.mapInArrow(run, _MANIFEST), "token-manifest")


def read_index(path: str) -> np.ndarray:
    """Offsets and token counts of a shard's records."""
    files, name = shared.arrow_files(path)
    with files.open_input_file(name + ".idx") as f:
        return np.frombuffer(f.read(), np.dtype([("offset", "<u8"), ("n_tokens", "<u4")]))


def read_record(path: str, offset: int) -> tuple[int | None, np.ndarray]:
    """One record by its offset."""
    files, name = shared.arrow_files(path)
    with files.open_input_file(name + ".rec") as f:
        f.seek(offset)
        length = struct.unpack(HEAD, f.read(struct.calcsize(HEAD)))[0]
        f.seek(offset)
        return unframe(memoryview(f.read(struct.calcsize(HEAD) + length + 4)), 0)[:2]


def read(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each record, checked on the way.

    The driver only adds up one row for each shard.
    """
    rows, start = [], 0
    for _, path, docs, tokens, size in sorted(map(tuple, manifest.collect())):
        rows.append((len(rows), path, start, docs, tokens, size))
        start += tokens

    def run(batches):
        for batch in batches:
            for path, base, docs, tokens, size in zip(*(batch.column(k).to_pylist() for k in range(1, 6)), strict=True):
                index = read_index(path)
                files, name = shared.arrow_files(path)
                with files.open_input_file(name + ".rec") as f:
                    if (len(index), int(index["n_tokens"].sum()), f.size()) != (docs, tokens, size):
                        raise ValueError(f"{path} or its index isn't what the manifest says")
                    for lo in range(0, len(index), 1024):
                        part = index[lo : lo + 1024]
                        end = int(index["offset"][lo + 1024]) if lo + 1024 < len(index) else f.size()
                        f.seek(int(part["offset"][0]))
                        data = memoryview(f.read(end - int(part["offset"][0])))
                        got = [unframe(data, int(o - part["offset"][0])) for o in part["offset"]]
                        n = np.array([len(g[1]) for g in got], np.int64)
                        if (n != part["n_tokens"]).any():
                            raise ValueError(f"the index of {path} doesn't fit its records")
                        starts = base + np.cumsum(n) - n
                        base += int(n.sum())
                        yield pa.RecordBatch.from_pydict({"doc_id": pa.array([g[0] for g in got], pa.int64()), "start": starts, "n_tokens": n, "ids_crc32": pa.array([zlib.crc32(g[1].astype("<u4").tobytes()) for g in got], pa.int64())})

    shards = spark.createDataFrame(rows, "shard int, path string, base long, docs long, tokens long, bytes long")
    return shards.repartitionById(max(1, len(rows)), shards.shard).mapInArrow(run, _RECORD)


def token_records(docs: DataFrame, vocabulary: str, end_id: int = 2, shards: int | None = None) -> DataFrame:
    """Write docs as token records and return what reading them back gives."""
    return read(docs.sparkSession, write(docs, vocabulary, end_id, shards))
