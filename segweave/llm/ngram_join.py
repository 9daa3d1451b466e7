"""N-gram Jaccard self-join with signature trees.

A document is the set of its distinct 5-word shingles (64-bit hashes); two link
if their Jaccard similarity reaches 0.75. Equal sets are folded first. Sets that
may link are routed into buckets; in each a signature tree, ordered by size,
keeps in every node the OR of its sets' bitmaps over the bucket's shingles and
its range of sizes. A dual traversal drops node pairs whose greatest possible
overlap can't reach the threshold, and those that are one class already; what
is left is counted bit by bit.

One tree over all documents would prune nothing: the OR of sixteen unlike texts
already meets that of sixteen others. So there are two rounds of many trees.

- The first joins what is plainly alike: buckets of equal bands of minimum
  hashes, the members dealt into blocks that each hold the bucket's least
  member too. It needs to find nothing; it makes the second round small.
- The second is exact. All shingles are put in one order: first those that a
  single class holds, then by the number of sets that hold them, last those that
  a bounded sample of sets shows to be common. Two sets that link share one of
  the first n // 4 + 1 of either (the prefix of n shingles, as at most a
  quarter of either set is not in the other), and it is one that several classes
  hold; so each set is routed by those, and large buckets are cut into blocks that
  meet pair by pair. What the sample holds changes the order alone, never the answer.

Shingles travel as packed arrays, each range of hashes to one task in bounded
parts; a shingle that many documents hold is in the sample's list and doesn't
travel. Buckets are counted before their members are dealt, so no task holds an unbounded one.

Null and empty texts and those without words have no shingles and link with
nothing; with fewer words than a shingle, the whole sequence is one shingle. A text of any length
is one set. Rows that share a doc_id are one node; if their sets differ, the set of least
digest is the node's. A null doc_id is carried with null
component and links nobody. An empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared
from .components import Union, components

WORDS = 5
#: Bands of the first round and the minimum hashes of each.
BANDS, ROWS = 4, 4
#: Shingles of a block of a bucket in the first round and in the second, sets of a block (a tree's bitmaps take sets times shingles), sets of a tree's leaf.
FIRST_BLOCK, BLOCK_SHINGLES, BLOCK_SETS, LEAF = 60_000, 600_000, 2000, 16
#: Sets of the sample that tells common shingles, in how many of them one is common, and how many are listed at most.
SAMPLE_SETS, COMMON_IN, COMMON_MOST = 8192, 16, 100_000
#: Shingles that a task looks at together.
PART_SHINGLES = 400_000
#: Bytes with A-Z lower-cased and all white space as spaces.
_PLAIN = bytes(32 if 9 <= b <= 13 else b + 32 if 65 <= b <= 90 else b for b in range(256))
#: What a packed row holds: sets with class and numbers, common shingles, others, classes that aren't the sets' own, shingles of several classes.
_NODE, _DIRECT, _SHINGLE, _CLASS, _SHARED = range(5)
_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """xxhash of each word of all texts, and where each text's words begin (and the last one's end)."""
    import xxhash

    raw = pa.array(texts, pa.binary())
    _, offsets, data = raw.buffers()
    even = pa.Array.from_buffers(pa.string(), len(raw), [None, offsets, pa.py_buffer((data.to_pybytes() if data else b"").translate(_PLAIN))])
    parts = pc.split_pattern(even, " ")
    bounds = np.r_[0, np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False), dtype=np.int64)]
    flat = parts.flatten()
    filled = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    if not filled.all():
        flat, bounds = flat.filter(pa.array(filled)), np.r_[0, np.cumsum(filled)][bounds]
    coded = flat.dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    known = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))
    return known[coded.indices.to_numpy(zero_copy_only=False)], bounds


def batch_shingles(texts: list[str], size: int = WORDS) -> list[np.ndarray]:
    """Sorted 64-bit hashes of the distinct shingles of each text."""
    if not texts:
        return []
    w, bounds = word_hashes([t.encode() for t in texts])

    def rolled(w: np.ndarray, span: int) -> np.ndarray:
        h = np.full(max(0, len(w) - span + 1), span, np.uint64)
        for k in range(span if len(h) else 0):
            h = h * _P + w[k : len(w) - span + 1 + k]
        h ^= h >> np.uint64(29)
        h *= _Q
        return h ^ h >> np.uint64(32)

    whole = rolled(w, size)
    pairs = zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
    return [shared.distinct(whole[a : b - size + 1] if b - a >= size else rolled(w[a:b], b - a)) if b > a else w[:0] for a, b in pairs]


def shingles(text: str, size: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles."""
    return batch_shingles([text], size)[0]


def band_keys(found: np.ndarray) -> np.ndarray:
    """One key for each band of minimum hashes."""
    draw = np.random.default_rng(6)
    a = draw.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
    x = draw.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
    low = (found >> np.uint64(32)).astype(np.uint32)[:, None]
    least = np.min([((low[at : at + 2048] ^ x) * a).min(0) for at in range(0, len(low), 2048)], axis=0).astype(np.uint64).reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        key = (key ^ least[:, k]) * _P
        key ^= key >> np.uint64(31)
    return key.astype(np.int64)


def profiles(docs: DataFrame, sampled: float = 0.0) -> DataFrame:
    """doc_id, n_shingles, digest of the set (two longs), band keys, and for a share `sampled` of the digests the set itself."""
    most = int(sampled * float(1 << 63))

    def step(columns, texts):
        found = batch_shingles(texts)
        data = [f.tobytes() for f in found]
        d1, d2 = zip(*map(_digest, data), strict=True) if found else ((), ())
        chosen = [d if len(d) and (x & (1 << 63) - 1) < most else None for d, x in zip(data, d1, strict=True)]
        bands = pa.array([band_keys(f) if len(f) else None for f in found], pa.list_(pa.int64()))
        return pa.RecordBatch.from_pydict({"doc_id": pa.array(columns[0], pa.int64()), "n_shingles": pa.array([len(f) for f in found], pa.int64()), "d1": pa.array(d1, pa.int64()), "d2": pa.array(d2, pa.int64()), "bands": bands, "sampled": pa.array(chosen, pa.binary())})

    return shared.text_map(docs, ["doc_id"], step, "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>, sampled binary")


def _digest(data: bytes) -> list[int]:
    import xxhash

    return np.frombuffer(xxhash.xxh3_128_digest(data), "<i8").tolist()


def common_shingles(rows: DataFrame) -> np.ndarray:
    """Sorted hashes of the shingles that many of the sampled sets hold, the most common ones up to the bound."""

    def flat(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int64))], ["shingle"])

    sets = rows.where("sampled IS NOT NULL").select("d1", "d2", "sampled").dropDuplicates(["d1", "d2"]).select("sampled")
    counts = sets.mapInArrow(flat, "shingle long").groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= COMMON_IN)
    found = counts.orderBy(F.desc("n"), "shingle").limit(COMMON_MOST).select("shingle").collect()
    return np.sort(np.array([r[0] for r in found], np.int64).view(np.uint64))


def buckets(members: DataFrame, pairwise: bool, block: int = BLOCK_SHINGLES) -> DataFrame:
    """bucket, rep, component of the buckets `key` that hold several classes, from members key, rep, n, component.

    Buckets of equal members are kept once. Those of more than `block` shingles, or of more than BLOCK_SETS sets,
    are dealt into blocks; pairwise, each two blocks meet, else each block holds the
    bucket's least member as well. Pairwise, buckets that overlap are one bucket as
    long as they hold no more than a block together, so that no set travels twice.
    Counts are aggregated before members move, and a large bucket's members are dealt by salt.
    """
    members = members.withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(shared.partitions(members.sparkSession))))
    weight = F.greatest("n", F.lit(block // BLOCK_SETS))
    part = members.groupBy("key", "salt").agg(F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("rep")).alias("mix"), F.sum(weight).alias("words"), F.min("rep").alias("pivot"), F.min("component").alias("low"), F.max("component").alias("high"))
    whole = part.groupBy("key").agg(F.sum("size").alias("size"), F.bit_xor("mix").alias("mix"), F.sum("words").alias("words"), F.min("pivot").alias("pivot"), F.min("low").alias("low"), F.max("high").alias("high"), F.collect_list("salt").alias("salts"))
    kept = whole.where("size > 1 AND low < high").groupBy("size", "mix", "words", "pivot").agg(F.min(F.struct("key", "salts")).alias("own"))
    kept = kept.select("own.key", "pivot", F.ceil(F.col("words") / block).alias("blocks"), F.explode("own.salts").alias("salt"))
    found = members.join(kept, ["key", "salt"])
    mine = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    if not pairwise:
        names = F.transform(F.when(F.col("rep") == F.col("pivot"), every).otherwise(F.array(mine)), lambda b: F.xxhash64("key", b))
        return found.select(F.explode(names).alias("bucket"), "rep", "component")
    found = shared.staged(found.select("key", "rep", "n", "component", "pivot", "blocks"), "buckets-found")
    groups = components(found.select(F.col("rep").alias("a"), F.col("pivot").alias("b")))
    sets = shared.staged(found.select("rep", "n", "component").distinct().join(groups.select(F.col("node").alias("rep"), F.col("component").alias("cluster")), "rep"), "bucket-clusters")
    large = shared.staged(sets.groupBy("cluster").agg(F.sum(weight).alias("words")).where(F.col("words") > block).select("cluster"), "large-clusters")
    small = sets.join(large, "cluster", "left_anti").select(F.xxhash64(F.lit("cluster"), "cluster").alias("bucket"), "rep", "component")
    rest = found.join(shared.rows_with(sets, large, "cluster").select("rep"), "rep", "left_semi")
    names = F.transform(every, lambda other: F.xxhash64("key", F.least(mine, other), F.greatest(mine, other)))
    return small.unionByName(rest.select(F.explode(names).alias("bucket"), "rep", "component"))


def by_part(batches):
    """Lists of (kind, columns) of one part after another, from rows part, kind and four columns in order of part."""
    held, now = [], None
    for batch in shared.steady(batches):
        part, kind = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for r, p in enumerate(part):
            if p != now and held:
                yield now, held
                held = []
            now = p
            held.append((kind[r], [batch.column(2 + c)[r].as_buffer() for c in range(4)]))
    if held:
        yield now, held


def prefixes(docs: DataFrame, classes: DataFrame, common: np.ndarray, parts: int) -> DataFrame:
    """key, rep, n, component: the shingles of each set's prefix that several classes hold.

    `classes` has doc_id, component (null: a copy, left out) and digest (d1, d2; null: any) of
    the documents that aren't a class of their own.
    """
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(common)
    rows = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    small = F.broadcast(classes) if classes.count() <= shared.BROADCAST_KEYS else classes
    rows = rows.join(small.withColumn("known", F.lit(True)), "doc_id", "left").where("known IS NULL OR component IS NOT NULL")
    rows = rows.select("doc_id", F.coalesce("component", "doc_id").alias("component"), "d1", "d2", "text")

    def packed(kind: int, by: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
        """A row for each value of `by`, with the bytes of its part of each column."""
        order = np.argsort(by.astype(np.uint16) if parts <= 1 << 16 else by, kind="stable")  # 16 bits are sorted by radix
        by = by[order]
        heads = np.flatnonzero(np.r_[True, by[1:] != by[:-1]]) if len(by) else np.zeros(0, int)
        stops = np.r_[heads[1:], len(by)] if len(by) else heads
        cut = [[c[a:b].tobytes() for a, b in zip(heads, stops, strict=True)] for c in (x[order] for x in columns)]
        cut += [[None] * len(heads)] * (4 - len(cut))
        return pa.RecordBatch.from_arrays([pa.array(by[heads].astype(np.int64)), pa.array(np.full(len(heads), kind, np.int32)), *[pa.array(c, pa.binary()) for c in cut]], ["part", "kind", "c0", "c1", "c2", "c3"])

    def node_part(rep: np.ndarray) -> np.ndarray:
        return (rep.view(np.uint64) * _P >> np.uint64(32)).astype(np.int64) % parts

    def entries(batches):
        for batch in shared.small_batches(shared.steady(batches)):
            ids, component, d1, d2, texts = (c.to_pylist() for c in batch.columns)
            nodes, names, direct = [], [], []
            for i, k, x, y, found in zip(ids, component, d1, d2, batch_shingles([t or "" for t in texts]), strict=True):
                n = len(found)
                if not n or (x is not None and _digest(found.tobytes()) != [x, y]):
                    continue
                at = np.searchsorted(shipped.value, found)
                often = np.zeros(n, bool) if not len(shipped.value) else shipped.value[np.minimum(at, len(shipped.value) - 1)] == found
                part = (found >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
                own = shared.distinct(part[~often] << np.uint64(32) | found[~often] & np.uint64(0xFFFFFFFF))
                short = n // 4 + 1 - len(own)
                nodes.append((i, k, n, short))
                names.append(own)
                direct.append(found[often][: max(0, short)])
            if not nodes:
                continue
            rep, comp, n, short = (np.array(c, t) for c, t in zip(zip(*nodes, strict=True), (np.int64, np.int64, np.int32, np.int32), strict=True))
            yield packed(_NODE, node_part(rep), [rep, comp, n, short])
            size = [len(d) for d in direct]
            yield packed(_DIRECT, node_part(np.repeat(rep, size)), [np.concatenate(direct).view(np.int64), np.repeat(rep, size)])
            size, name = [len(x) for x in names], np.concatenate(names)
            # a class is told only of those that aren't their own
            yield packed(_SHINGLE, (name >> np.uint64(32)).astype(np.int64), [name.astype(np.uint32), np.repeat(rep, size)])
            other = np.repeat(rep != comp, size)
            yield packed(_CLASS, (name[other] >> np.uint64(32)).astype(np.int64), [name[other].astype(np.uint32), np.repeat(comp, size)[other], np.repeat(rep, size)[other]])

    def joined(held, kind: int, types: tuple) -> list[np.ndarray]:
        """The arrays of one kind."""
        own = [columns for k, columns in held if k == kind]
        return [np.concatenate([np.zeros(0, t), *[np.frombuffer(columns[c], t) for columns in own]]) for c, t in enumerate(types)]

    def shared_by_classes(batches):
        """Of a range of shingles those that several classes hold, with the number of sets, dealt by set; what is dealt by set already passes."""
        for part, held in by_part(batches):
            for kind, types in ((_NODE, (np.int64, np.int64, np.int32, np.int32)), (_DIRECT, (np.int64, np.int64))):
                columns = joined(held, kind, types)
                if len(columns[0]):
                    yield packed(kind, np.full(len(columns[0]), part), columns)
            name, rep = joined(held, _SHINGLE, (np.uint32, np.int64))
            if not len(name):
                continue
            other, comp, whose = joined(held, _CLASS, (np.uint32, np.int64, np.int64))
            order = np.argsort(name, kind="stable")
            name, rep = name[order], rep[order]
            heads = np.flatnonzero(np.r_[True, name[1:] != name[:-1]])
            count = np.diff(np.r_[heads, len(name)])
            # the least and greatest class of each shingle, with told ones in place of the sets' own
            own = np.ones(len(name), bool)
            if len(other):
                own = ~np.isin(rep, whose)
            big, small = np.iinfo(np.int64).max, np.iinfo(np.int64).min
            low, high = np.minimum.reduceat(np.where(own, rep, big), heads), np.maximum.reduceat(np.where(own, rep, small), heads)
            at = np.searchsorted(name[heads], other)
            np.minimum.at(low, at, comp)
            np.maximum.at(high, at, comp)
            keep = np.repeat(low < high, count)
            yield packed(_SHARED, node_part(rep[keep]), [name[keep].astype(np.int64) | part << 32, rep[keep], np.repeat(count, count)[keep].astype(np.int32)])

    def first_ones(batches):
        """Of each set's entries those of its prefix."""
        for _, held in by_part(batches):
            rep, comp, n, short = joined(held, _NODE, (np.int64, np.int64, np.int32, np.int32))
            rep, at = np.unique(rep, return_index=True)
            comp, n, short = comp[at], n[at], short[at]
            name, whose, sets = joined(held, _SHARED, (np.int64, np.int64, np.int32))
            order = np.lexsort((name, sets, whose))
            name, whose = name[order], whose[order]
            new = np.r_[True, (whose[1:] != whose[:-1]) | (name[1:] != name[:-1])][: len(name)]  # repeated rows of a document
            name, node = name[new], np.searchsorted(rep, whose[new])
            size = np.bincount(node, minlength=len(rep))
            place = np.arange(len(node)) - np.repeat(np.cumsum(size) - size, size)
            good = place < np.repeat(short + size, size)  # those that one class holds come before them
            more, whose = joined(held, _DIRECT, (np.int64, np.int64))
            name, node = np.r_[name[good], more], np.r_[node[good], np.searchsorted(rep, whose)]
            yield pa.RecordBatch.from_arrays([pa.array(name), pa.array(rep[node]), pa.array(n[node].astype(np.int64)), pa.array(comp[node])], ["key", "rep", "n", "component"])

    blob = "part long, kind int, c0 binary, c1 binary, c2 binary, c3 binary"
    to = shared.partitions(spark)
    found = rows.mapInArrow(entries, blob).repartition(to, "part").sortWithinPartitions("part").mapInArrow(shared_by_classes, blob)
    return found.repartition(to, "part").sortWithinPartitions("part").mapInArrow(first_ones, "key long, rep long, n long, component long")


class SignatureTree:
    """Nodes over sets in ascending order of size; level 0 has the leaves."""

    def __init__(self, sets: list[np.ndarray], leaf: int = LEAF):
        self.n, self.leaf = np.array([len(s) for s in sets], np.int64), leaf
        flat = np.concatenate(sets)
        row = np.repeat(np.arange(len(sets)), self.n)
        _, token, seen = np.unique(flat, return_inverse=True, return_counts=True)
        number = np.cumsum(seen > 1) - 1  # shingles of one set alone overlap with nothing
        common = seen[token] > 1
        row, token = row[common], number[token[common]]
        self.bits = np.zeros((len(sets), int((seen > 1).sum()) // 64 + 1), np.uint64)
        np.bitwise_or.at(self.bits, (row, token >> 6), np.uint64(1) << (token & 63).astype(np.uint64))
        start = np.arange(0, len(sets), leaf)
        last = np.minimum(start + leaf, len(sets)) - 1
        self.levels = [(np.bitwise_or.reduceat(self.bits, start, axis=0), self.n[start], self.n[last])]
        while len(self.levels[-1][0]) > 1:
            union, low, high = self.levels[-1]
            at = np.arange(0, len(union), 2)
            self.levels.append((np.bitwise_or.reduceat(union, at, axis=0), low[at], high[np.minimum(at + 1, len(union) - 1)]))

    def members(self, level: int, node: int) -> range:
        width = self.leaf << level
        return range(node * width, min((node + 1) * width, len(self.n)))

    def links(self, union: Union) -> list[tuple[int, int]]:
        """A spanning forest of the links, with what `union` joins already left out."""
        out: list[tuple[int, int]] = []
        todo = [(len(self.levels) - 1, 0, 0)]
        while todo:
            level, a, b = todo.pop()
            bits, low, high = self.levels[level]
            if a != b:
                if 4 * high[a] < 3 * low[b] or 7 * int(np.bitwise_count(bits[a] & bits[b]).sum()) < 3 * (low[a] + low[b]):
                    continue
                root = union.find(self.members(level, a)[0])
                if all(union.find(i) == root for i in self.members(level, a)) and all(union.find(i) == root for i in self.members(level, b)):
                    continue
            if level:
                size, kids = len(self.levels[level - 1][0]), [(2 * a, 2 * b), (2 * a, 2 * b + 1), (2 * a + 1, 2 * b), (2 * a + 1, 2 * b + 1)]
                kids = sorted({(x, y) for x, y in kids if x <= y and y < size}, key=lambda k: k[0] != k[1])
                todo += [(level - 1, x, y) for x, y in reversed(kids)]
                continue
            rows, columns = self.members(0, a), self.members(0, b)
            overlap = np.bitwise_count(self.bits[rows.start : rows.stop, None] & self.bits[None, columns.start : columns.stop]).sum(-1, dtype=np.int64)
            need = self.n[rows.start : rows.stop, None] + self.n[None, columns.start : columns.stop]
            for i, j in np.argwhere(7 * overlap >= 3 * need).tolist():
                i, j = rows.start + i, columns.start + j
                if i < j and union.join(i, j):
                    out.append((i, j))
        return out


def compared(docs: DataFrame, members: DataFrame) -> DataFrame:
    """Links a, b that join the sets of each bucket into its classes, from members bucket, rep, component."""
    members = shared.staged(members, "buckets")

    def sets(columns, texts):
        found = [f.tobytes() for f in batch_shingles(texts)]
        d1, d2 = zip(*map(_digest, found), strict=True) if found else ((), ())
        return pa.RecordBatch.from_pydict({"rep": pa.array(columns[0], pa.int64()), "d1": pa.array(d1, pa.int64()), "d2": pa.array(d2, pa.int64()), "set": pa.array(found, pa.binary())})

    wanted = shared.rows_with(docs.select(F.col("doc_id").alias("rep"), "text").where("rep IS NOT NULL"), members.select("rep").distinct(), "rep")
    found = shared.text_map(wanted, ["rep"], sets, "rep long, d1 long, d2 long, set binary").where(F.length("set") > 0)
    found = found.groupBy("rep").agg(F.min(F.struct("d1", "d2", "set")).alias("own")).select("rep", "own.set")
    rows = members.join(found, "rep").select("bucket", "rep", "component", "set", F.length("set").alias("size"))

    def joined(batches):
        def links(held):
            tree, union, first = SignatureTree([np.frombuffer(s, np.uint64) for _, _, s in held]), Union(len(held)), {}
            for i, (_, component, _) in enumerate(held):  # what is one class already isn't compared
                union.join(first.setdefault(component, i), i)
            return [(held[i][0], held[j][0]) for i, j in tree.links(union)]

        held, now = [], None
        for batch in shared.steady(batches):
            out = []
            for bucket, rep, component, data in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if bucket != now and held:
                    out += links(held)
                    held = []
                held.append((rep, component, data))
                now = bucket
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])
        if held:
            out = links(held)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    dealt = rows.repartition(shared.partitions(docs.sparkSession), "bucket").sortWithinPartitions("bucket", "size", "rep")
    return shared.staged(dealt.mapInArrow(joined, "a long, b long"), "links")


def classified(docs: DataFrame, block: int = BLOCK_SHINGLES) -> DataFrame:
    """doc_id, n_shingles, component_id and digest (d1, d2) of each row, staged."""
    count = docs.count()
    rows = shared.staged(profiles(docs, min(1.0, SAMPLE_SETS / max(1, count))), "shingle-profiles")
    some = rows.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.struct("d1", "d2", F.col("n_shingles").alias("n"), "bands")).alias("own"), F.count_distinct("d1", "d2").alias("sets")).select("doc_id", "own.*", "sets")
    some = shared.staged(some, "shingle-nodes")
    folded = shared.staged(some.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("other"), F.first("n").alias("n"), F.first("bands").alias("bands")), "shingle-classes")
    banded = folded.select("rep", "n", F.col("rep").alias("component"), F.explode("bands").alias("key"))
    groups = shared.staged(components(compared(docs, buckets(banded, False, min(block, FIRST_BLOCK)))), "classes-first")

    copies = folded.where("rep < other").select("d1", "d2", "rep")
    copies = shared.staged(some.select("doc_id", "d1", "d2").join(copies, ["d1", "d2"]).where("rep <> doc_id").select("doc_id", "rep"), "shingle-copies")
    # of documents with several sets the digest of the one that counts
    odd = some.where("sets > 1").select("doc_id", "d1", "d2")
    linked = groups.where("node <> component").select(F.col("node").alias("doc_id"), "component")
    known = linked.join(odd, "doc_id", "full").select("doc_id", F.coalesce("component", "doc_id").alias("component"), "d1", "d2")
    none = F.lit(None).cast("long")
    known = known.join(copies, "doc_id", "left_anti").unionByName(copies.select("doc_id", none.alias("component"), none.alias("d1"), none.alias("d2")))
    words = folded.agg(F.sum("n")).first()[0] or 0
    prefix = prefixes(docs, shared.staged(known, "classes-known"), common_shingles(rows), max(1, -(-words // PART_SHINGLES)))
    more = compared(docs, buckets(shared.staged(prefix, "prefixes"), True, block))

    found = components(groups.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
    found = shared.staged(found, "classes-linked")
    copied = copies.join(found, F.col("rep") == found.node, "left").select(F.col("doc_id").alias("node"), F.coalesce("component", "rep").alias("component"))
    found = found.unionByName(copied)
    return rows.select("doc_id", "n_shingles", "d1", "d2").join(found, F.col("doc_id") == found.node, "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"), "d1", "d2")


def jaccard_classes(docs: DataFrame, block: int = BLOCK_SHINGLES) -> DataFrame:
    """doc_id, n_shingles, component_id of each row."""
    return classified(docs, block).select("doc_id", "n_shingles", "component_id")


def representatives(docs: DataFrame) -> DataFrame:
    """One row of docs for each class: that whose doc_id is its component_id; rows with null ids stay.

    Of rows that repeat a doc_id, the one whose set counts stays; of several such, that of the least text.
    """
    found = shared.staged(classified(docs), "classes")
    lost = found.where("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.join(lost, "doc_id", "left_anti").select(docs.columns)
    repeated = shared.staged(found.where("doc_id = component_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("doc_id"), "repeated-ids")
    if repeated.isEmpty():
        return kept
    packed = shared.rows_with(kept.select("doc_id", F.struct("*").alias("_row"), "text"), repeated, "doc_id")

    def digested(batches):
        for batch in shared.small_batches(shared.steady(batches)):
            d = [_digest(f.tobytes()) + [not len(f)] for f in batch_shingles([t or "" for t in batch.column(2).to_pylist()])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array([x[k] for x in d], t) for k, t in ((2, pa.bool_()), (0, pa.int64()), (1, pa.int64()))]], ["doc_id", "_row", "text", "bare", "d1", "d2"])

    schema = packed.withColumn("bare", F.lit(False)).withColumn("d1", F.lit(0).cast("long")).withColumn("d2", F.lit(0).cast("long")).schema
    first = packed.mapInArrow(digested, schema).groupBy("doc_id").agg(F.min_by("_row", F.struct("bare", "d1", "d2", "text")).alias("_row")).select("_row.*")
    return kept.join(repeated, "doc_id", "left_anti").select(docs.columns).unionByName(first.select(docs.columns))
