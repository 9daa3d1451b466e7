"""Embedding near-dedup by PCA-ordered tiled comparison.

Vectors are normalised in double precision and turned into the corpus's
principal axes. They are dealt into blocks along a Hilbert curve over the leading
axes; vectors whose cosine reaches the threshold are no farther apart than `reach`, so
two blocks meet unless their boxes on the leading axes are too far apart.
Where two blocks meet, a tile, the
products of the leading axes are summed first; the rest of a product is at
most the product of the suffix norms, so a pair whose partial sum and bound stay
below the threshold is done. Pairs that survive all steps are decided by the
plain cosine in double precision.

Vectors travel once: each block is written to a file in the shared folder, and the
tasks that compare read the blocks they need from there, groups of blocks at a time. Beside them
only ids and digests are shuffled, so the disk in use grows with the rows, not with the tiles.

Equal vectors are folded to one row with their number as blocks are made, those of large groups
before they travel, so a group of copies of any size is one row of a tile. A task returns
counts of links and spanning forests of its links, never all pairs. Null and zero vectors and those with null or
non-finite components link with nothing; vectors of different lengths don't
link with each other. The axes are those of the most common length (ties: the longer);
vectors of other lengths are compared in their own coordinates. Long vectors make
smaller blocks. Rows that share vec_id and vector are one; where
vectors differ under one vec_id, it shows its largest number of links and least
component. A null vec_id has null results. An empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared
from .components import components
from .packing import hilbert_keys

#: Rows and components of a block, and axes summed between two looks at the bound.
BLOCK, BLOCK_VALUES, STEPS = 2048, 1 << 18, (16, 32)
#: Axes that make the curve, and that make a block's box.
CURVE_AXES, BOX_AXES = 4, 16
#: Blocks of a group, bytes of blocks that a task keeps, rows whose counts of links it keeps.
GROUP, KEPT_BYTES, KEPT_ROWS = 16, 64 << 20, 1 << 20
#: Copies from which a group is folded before its vectors travel, and how many such groups are broadcast at most.
COPIES, COPIED_MOST = 64, 250_000
#: Bits of a vector's digest that part equal places on the curve.
TIE_BITS = 15
#: Rows of the sample that gives the axes; any axes are right, these prune well.
AXIS_ROWS = 4096
_SLACK = 1e-9
#: Slack for each axis of a bound that is summed in single precision, several times its rounding.
_SINGLE = 2.0**-22


def axes(sample: np.ndarray) -> np.ndarray:
    """Orthonormal axes as columns, of falling variance."""
    value, vector = np.linalg.eigh(sample.T @ sample)
    return np.ascontiguousarray(vector[:, ::-1])


def units(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def survivors(x: np.ndarray, y: np.ndarray, threshold: float, steps: tuple[int, ...] = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of x and y (in principal axes) whose product the suffix bounds can't keep below the threshold."""
    steps = [*[s for s in steps if s < x.shape[1]], x.shape[1]]
    i = None
    for s in steps:
        rest_x, rest_y = (np.sqrt((m[:, s:] ** 2).sum(1)) for m in (x, y))
        if i is None:  # all pairs: the suffix norms are one more axis of a product in single precision
            possible = np.c_[x[:, :s], rest_x].astype(np.float32) @ np.c_[y[:, :s], rest_y].astype(np.float32).T >= np.float32(threshold - _SINGLE * (s + 2))
            if s == x.shape[1] or np.count_nonzero(possible) < 0.05 * possible.size:
                i, j = np.divmod(np.flatnonzero(possible), max(1, len(y)))
        else:
            part = [np.einsum("ij,ij->i", x[i[lo : lo + 65536], :s], y[j[lo : lo + 65536], :s]) for lo in range(0, len(i), 65536)]
            keep = np.concatenate(part or [np.zeros(0)]) + rest_x[i] * rest_y[j] >= threshold - _SLACK
            i, j = i[keep], j[keep]
    return i, j


def tile(x: np.ndarray, y: np.ndarray, turned_x: np.ndarray, turned_y: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of rows of x and y, each once; x and y are unit vectors in the given components, and turned ones in principal axes."""
    i, j = survivors(turned_x, turned_y, threshold)
    if same:
        i, j = i[i < j], j[i < j]
    good = np.concatenate([np.einsum("ij,ij->i", x[i[lo : lo + 65536]], y[j[lo : lo + 65536]]) >= threshold for lo in range(0, len(i), 65536)] or [np.zeros(0, bool)])
    return i[good], j[good]


def usable(batch: pa.RecordBatch) -> list[tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]]:
    """Of vec_id, embedding the rows, vectors, bytes and digests (two longs) of each length, without those that link with nothing and repeated rows."""
    import xxhash

    size = pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)  # a null component is a NaN
    stop = np.cumsum(size)
    bad, filled = (np.r_[0, np.cumsum(m)] for m in (~np.isfinite(flat), flat != 0))
    good = (bad[stop] == bad[stop - size]) & (filled[stop] > filled[stop - size])
    found = []
    for w in np.unique(size[good]).tolist():
        rows = np.flatnonzero(good & (size == w))
        x = flat[(stop[rows] - w)[:, None] + np.arange(w)] + flat.dtype.type(0)  # no negative zeros
        raw = [r.tobytes() for r in x]
        digest = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, raw)), "<i8").reshape(-1, 2)
        ids = batch.column(0).take(pa.array(rows)).to_numpy()
        first = np.sort(np.unique(np.c_[ids, digest], axis=0, return_index=True)[1])
        found.append((rows[first], x[first], [raw[k] for k in first.tolist()], digest[first]))
    return found


def pairs_of(groups: int) -> int:
    """How many numbers `pair` takes."""
    return groups * (groups // 2 + 1)


def pair(number: int, groups: int) -> tuple[int, int] | None:
    """The groups that meet under a number, each two under one; None: they meet under another."""
    g, apart = divmod(number, groups // 2 + 1)
    return None if 2 * apart == groups and 2 * g >= groups else (g, (g + apart) % groups)


def linked(embeddings: DataFrame, threshold: float = 0.95) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row."""
    spark = embeddings.sparkSession
    kind = embeddings.schema["embedding"].dataType.elementType.simpleString()
    given = embeddings.select("vec_id", F.col("embedding") if kind == "float" else F.col("embedding").cast("array<double>").alias("embedding")).where("vec_id IS NOT NULL")
    dtype = np.dtype("<f4" if kind == "float" else "<f8")

    def keyed(batches):
        for batch in batches:
            ids = batch.column(0)
            for rows, x, _, digest in usable(batch):
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), pa.array(np.full(len(rows), x.shape[1], np.int32)), *map(pa.array, digest.T.copy())], ["vec_id", "width", "d1", "d2"])

    keys = shared.staged(given.mapInArrow(keyed, "vec_id long, width int, d1 long, d2 long"), "vector-keys")
    counted = shared.staged(keys.groupBy("width", "d1", "d2").agg(F.count(F.lit(1)).alias("rows"), F.min("vec_id").alias("rep")), "vector-counts")
    sizes = counted.groupBy("width").agg(F.count(F.lit(1)).alias("n"), F.sum("rows").alias("rows")).orderBy(F.desc("n"), F.desc("width")).collect()
    if not sizes:
        nothing = F.when(F.col("vec_id").isNotNull(), F.lit(0).cast("long"))
        return embeddings.select("vec_id", nothing.alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    distinct, common = sum(r["n"] for r in sizes), sizes[0]["width"]

    # a sample of distinct vectors gives the axes and the ranges of the curve; any of both are right
    sample = counted.where(F.col("width") == common).orderBy("d1", "d2").limit(AXIS_ROWS).select(F.col("rep").alias("vec_id"))
    sample = given.where(F.size("embedding") == common).join(F.broadcast(sample), "vec_id", "left_semi").dropDuplicates(["vec_id"]).orderBy("vec_id").limit(AXIS_ROWS).collect()
    drawn = np.array([r["embedding"] for r in sample if None not in r["embedding"]], np.float64).reshape(-1, common)
    drawn = units(drawn[np.isfinite(drawn).all(1) & (drawn != 0).any(1)])
    turn = axes(drawn)
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + _SLACK

    def turned(x: np.ndarray) -> np.ndarray:
        return x @ turn if x.shape[1] == len(turn) else x

    def along(x: np.ndarray) -> np.ndarray:
        lead = np.zeros((len(x), CURVE_AXES))
        lead[:, : min(x.shape[1], CURVE_AXES)] = turned(x)[:, :CURVE_AXES]
        return hilbert_keys(np.clip((lead + 1) * 2048, 0, 4095).astype(np.int64)) << TIE_BITS

    to = max(1, min(-(-distinct // BLOCK), shared.partitions(spark)))
    places = np.sort(along(drawn))
    bounds = places[np.arange(1, to) * len(places) // to] if len(places) else places

    copied = counted.where(F.col("rows") > max(COPIES, sum(r["rows"] for r in sizes) // COPIED_MOST)).select("d1", "d2")
    copied = shared.staged(keys.join(F.broadcast(copied), ["d1", "d2"]).groupBy("d1", "d2").agg(F.min("vec_id").alias("rep"), F.count_distinct("vec_id").alias("copies")), "vector-copies")

    def placed(batches):
        for batch in batches:
            ids = batch.column(0)
            for rows, x, raw, digest in usable(batch):
                place = along(units(x)) | digest[:, 0] & (1 << TIE_BITS) - 1
                part = np.searchsorted(bounds, place, "right").astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(np.full(len(rows), x.shape[1], np.int32)), pa.array(place), *map(pa.array, digest.T.copy()), ids.take(pa.array(rows)), pa.array(raw, pa.binary())], ["part", "width", "place", "d1", "d2", "vec_id", "vector"])

    folder = shared.fresh_path(spark, "vector-blocks")

    def blocks(batches):
        """Rows d1, d2, rep, n of distinct vectors, and one of each block that says where its file has it and its box."""
        files, base = shared.arrow_files(folder)
        files.create_dir(base, recursive=True)
        name = f"{folder}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        out, at = None, 0

        def full(held):
            nonlocal out, at
            if out is None:
                out = files.open_output_stream(shared.arrow_files(name)[1])
            width, n = held[0][0], len(held)
            rep, count = (np.array([h[k] for h in held], "<i8") for k in (3, 4))
            vectors = b"".join(h[5] for h in held)
            out.write(rep.tobytes() + count.tobytes() + vectors)
            box = np.zeros((2, BOX_AXES))
            lead = turned(units(np.frombuffer(vectors, dtype).reshape(n, -1)))[:, :BOX_AXES]
            box[:, : lead.shape[1]] = lead.min(0), lead.max(0)
            none = [None] * n
            columns = [[h[1] for h in held] + [None], [h[2] for h in held] + [None], [*rep.tolist(), None], [*count.tolist(), None], [*none, name], [*none, at], [*none, n], [*none, width], [*none, box.tobytes()]]
            at += 16 * n + len(vectors)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _block, strict=True)], schema=_block)

        held, last = [], None  # held: width, d1, d2, rep, n, vector
        for batch in batches:
            for width, d1, d2, vec_id, copies, vector in zip(*(batch.column(c).to_pylist() for c in ("width", "d1", "d2", "vec_id", "copies", "vector")), strict=True):
                if held and held[-1][:3] == [width, d1, d2]:
                    if copies is None and vec_id != last:
                        held[-1][4] += 1
                    last = vec_id
                    continue
                if held and (width != held[0][0] or len(held) >= min(BLOCK, max(16, BLOCK_VALUES // width))):
                    yield full(held)
                    held = []
                held.append([width, d1, d2, vec_id, copies or 1, vector])
                last = vec_id
        if held:
            yield full(held)
        if out is not None:
            out.close()

    _block = pa.schema([*[(c, pa.int64()) for c in ("d1", "d2", "rep", "n")], ("path", pa.string()), *[(c, pa.int64()) for c in ("at", "rows", "width")], ("box", pa.binary())])
    rows = given.mapInArrow(placed, "part int, width int, place long, d1 long, d2 long, vec_id long, vector binary").join(F.broadcast(copied), ["d1", "d2"], "left").where("rep IS NULL OR vec_id = rep")
    rows = rows.select("part", "width", "place", "d1", "d2", "vec_id", "copies", "vector")
    ordered = rows.repartitionById(to, rows.part).sortWithinPartitions("width", "place", "d1", "d2", "vec_id")
    made = shared.staged(ordered.mapInArrow(blocks, "d1 long, d2 long, rep long, n long, path string, at long, rows long, width long, box binary"), "vectors-folded")
    folded = made.where("path IS NULL").select("d1", "d2", "rep", "n")
    index = made.where("path IS NOT NULL").select("path", "at", "rows", "width", "box").orderBy("path", "at").collect()
    box = np.array([np.frombuffer(r["box"], np.float64) for r in index]).reshape(-1, 2, BOX_AXES)
    group = max(1, min(GROUP, len(index) // 32))
    groups = -(-len(index) // group)
    shipped = spark.sparkContext.broadcast(([tuple(r)[:4] for r in index], box[:, 0], box[:, 1]))

    def compared(batches):
        where, low, high = shipped.value
        kept: OrderedDict[int, tuple] = OrderedDict()
        size, sums, up = 0, {}, {}

        def block(k: int) -> tuple:
            nonlocal size
            if k not in kept:
                path, at, n, width = where[k]
                files, name = shared.arrow_files(path)
                with files.open_input_file(name) as f:
                    f.seek(at)
                    data = f.read(n * (16 + width * dtype.itemsize))
                x = units(np.frombuffer(data, dtype, offset=16 * n).reshape(n, width))
                kept[k] = np.frombuffer(data, "<i8", n), np.frombuffer(data, "<i8", n, 8 * n), x, turned(x)
                size += 2 * x.nbytes
                while size > KEPT_BYTES and len(kept) > 2:
                    _, old = kept.popitem(last=False)
                    size -= 2 * old[2].nbytes
            kept.move_to_end(k)
            return kept[k]

        def find(a: int) -> int:
            while up.setdefault(a, a) != a:
                up[a] = a = up[up[a]]
            return a

        def counts() -> pa.RecordBatch:
            found = [(block_reps[n > 0], n[n > 0]) for block_reps, n in sums.values()]
            sums.clear()
            a, n = (np.concatenate([f[k] for f in found] or [np.zeros(0, np.int64)]) for k in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.nulls(len(a), pa.int64()), pa.array(n)], ["a", "b", "links"])

        for batch in batches:
            for number in batch.column(0).to_pylist():
                met = pair(number, groups)
                if met is None:
                    continue
                xs, ys = (np.arange(g * group, min((g + 1) * group, len(where))) for g in met)
                gap = np.maximum(np.maximum(low[xs][:, None] - high[ys], low[ys] - high[xs][:, None]), 0)
                tree = []
                for r, c in np.argwhere((gap**2).sum(-1) <= reach * reach + _SLACK).tolist():
                    k, other = int(xs[r]), int(ys[c])
                    if met[0] == met[1] and k > other or where[k][3] != where[other][3]:
                        continue
                    (rep_x, n_x, x, turned_x), (rep_y, n_y, y, turned_y) = block(k), block(other)
                    i, j = tile(x, y, turned_x, turned_y, threshold, k == other)
                    if not len(i):
                        continue
                    for b, reps, at, n in ((k, rep_x, i, n_y[j]), (other, rep_y, j, n_x[i])):
                        np.add.at(sums.setdefault(b, (reps, np.zeros(len(reps), np.int64)))[1], at, n)
                    for a, b in zip(rep_x[i].tolist(), rep_y[j].tolist(), strict=True):
                        s, t = find(a), find(b)
                        if s != t:
                            up[max(s, t)] = min(s, t)
                            tree.append((a, b))
                    if len(up) > KEPT_ROWS // 4:  # what is one class is told again
                        up.clear()
                    if len(sums) * BLOCK > KEPT_ROWS:
                        yield counts()
                if tree:
                    a, b = zip(*tree, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.nulls(len(a), pa.int64())], ["a", "b", "links"])
        yield counts()

    numbers = spark.range(0, pairs_of(groups), 1, max(1, min(pairs_of(groups), shared.partitions(spark))))
    found = shared.staged(numbers.mapInArrow(compared, "a long, b long, links long"), "vector-links")
    linked_to = components(found.where("b IS NOT NULL"))
    links = found.where("links IS NOT NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    classes = folded.join(linked_to, F.col("rep") == linked_to.node, "left").drop("node").join(links, F.col("rep") == links.node, "left").select("d1", "d2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "rep").alias("component"))
    member = keys.select("vec_id", "d1", "d2").join(classes, ["d1", "d2"]).groupBy(F.col("vec_id").alias("_v")).agg(F.max("links").alias("links"), F.min("component").alias("component"))
    out = embeddings.select("vec_id").join(member, F.col("vec_id") == F.col("_v"), "left")
    return out.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.coalesce("links", F.lit(0).cast("long"))).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"), F.coalesce(F.col("vec_id") == F.coalesce("component", "vec_id"), F.lit(False)).alias("kept"))
