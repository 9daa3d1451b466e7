"""URL filter over a sorted digest array.

Rules are strings ``host/path``: they fit a host and all its subdomains where
the URL's path starts with the rule's path (from its slash on). They are kept
as one file: the sorted 64-bit xxhash keys of the rule strings, and the rule
strings themselves in key order. Executors map that file into memory; a page's
candidate strings (each suffix of its host with each prefix of its path that
has the length of some rule's path) are hashed, probed by vectorised binary
search, and a hit counts only if the stored string equals the candidate, so
colliding keys do no harm. No host suffix has more labels than the longest rule's host, so
the candidates of a URL stay few however long it is. The longest rule that fits wins; pages that no rule
fits are allowed.

Null URLs and those without ``://`` have empty host and path and fit no rule.
URLs of any length are judged whole, in batches of bounded bytes.
Repeated rows are judged each on its own, an empty table gives no row, extra
columns are ignored.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

_MAGIC = b"SDA1"


def pack_rules(rules: dict[str, str]) -> bytes:
    """The file of rules (rule string to verdict): header, keys, string offsets, strings, verdicts and path lengths."""
    import xxhash

    for rule, verdict in rules.items():
        if "/" not in rule or verdict not in ("allow", "block"):
            raise ValueError(f"{rule!r}: {verdict!r}: a rule is host/path, a verdict allow or block")
    text = [r.encode() for r in rules]
    keys = np.array([xxhash.xxh64_intdigest(t) for t in text], np.uint64)
    order = np.argsort(keys, kind="stable")
    ends = np.cumsum([len(text[i]) for i in order], dtype=np.uint64) if len(text) else np.zeros(0, np.uint64)
    lengths = np.array(sorted({len(r.partition("/")[2]) + 1 for r in rules}), np.uint64)
    blocked = np.array([list(rules.values())[i] == "block" for i in order], np.uint8)
    out = io.BytesIO()
    out.write(_MAGIC.ljust(8, b"\0"))
    out.write(np.array([len(keys), len(lengths), max((r.partition("/")[0].count(".") + 1 for r in rules), default=0)], np.uint64).tobytes())
    for part in (keys[order], ends, lengths, blocked):
        out.write(part.tobytes())
    out.write(b"".join(text[i] for i in order))
    return out.getvalue()


class DigestArray:
    """The rule file, mapped into memory."""

    def __init__(self, path: str):
        data = np.memmap(path, np.uint8, "r")
        if bytes(data[:4]) != _MAGIC:
            raise ValueError(f"{path} is no rule file")
        n, k, self.labels = data[8:32].view(np.uint64).tolist()
        self.keys = data[32 : 32 + 8 * n].view(np.uint64)
        self.ends = data[32 + 8 * n : 32 + 16 * n].view(np.uint64)
        self.lengths = data[32 + 16 * n : 32 + 16 * n + 8 * k].view(np.uint64).tolist()
        at = 32 + 16 * n + 8 * k
        self.blocked, self.text = data[at : at + n], data[at + n :]

    def stored(self, i: int) -> bytes:
        return bytes(self.text[int(self.ends[i - 1]) if i else 0 : int(self.ends[i])])

    def find(self, wanted: list[str]) -> np.ndarray:
        """Row of each string, -1 where it isn't stored."""
        import xxhash

        raw = [w.encode() for w in wanted]
        keys = np.array([xxhash.xxh64_intdigest(r) for r in raw], np.uint64)
        at, end = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
        out = np.full(len(raw), -1)
        for i in np.flatnonzero(at < end):
            out[i] = next((row for row in range(at[i], end[i]) if self.stored(row) == raw[i]), -1)
        return out

    def candidates(self, host: str, path: str) -> list[str]:
        """Strings of rules that would fit, the longest first."""
        labels = host.rsplit(".", self.labels)[-self.labels :] if self.labels else []
        hosts = [".".join(labels[i:]) for i in range(len(labels))]
        return sorted((h + path[: int(n)] for h in hosts for n in self.lengths if n <= len(path)), key=len, reverse=True)


_OPEN: dict[str, DigestArray] = {}


def url_verdicts(pages: DataFrame, rules: dict[str, str]) -> DataFrame:
    """page_id, host, path, rule (null if none fits) and verdict of each page; no shuffle."""
    spark = pages.sparkSession
    at = shared.fresh_path(spark, "url-rules")
    files, path = shared.arrow_files(at)
    files.create_dir(path.rpartition("/")[0], recursive=True)
    with files.open_output_stream(path) as out:
        out.write(pack_rules(rules))
    spark.sparkContext.addFile(at)
    name = at.rpartition("/")[2]

    def run(batches):
        if name not in _OPEN:
            _OPEN[name] = DigestArray(SparkFiles.get(name))
        array = _OPEN[name]
        for batch in shared.small_batches(shared.small_batches(batches, "host"), "path"):
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            candidates = [array.candidates(h, p) for h, p in zip(hosts, paths, strict=True)]
            flat = list({c for cs in candidates for c in cs})
            found = dict(zip(flat, array.find(flat).tolist(), strict=True))
            best = [next((c for c in cs if found[c] >= 0), None) for cs in candidates]
            verdict = ["block" if rule is not None and array.blocked[found[rule]] else "allow" for rule in best]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best, pa.string()), pa.array(verdict)], ["page_id", "host", "path", "rule", "verdict"])

    host = F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    path = F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return pages.select("page_id", lowered.alias("host"), path.alias("path")).mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")
