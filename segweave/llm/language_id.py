"""Language ID by string kernels.

A text is the set of its character 1- to 3-grams (a blended spectrum by
presence); the kernel of two texts is the cosine of their sets: the grams that
both have over the root of the product of the sets' sizes. A bounded sample of
labelled rows gives landmarks; the Nyström map of the kernel to them feeds one
kernel ridge regression for each language against the rest. No gram is left
out: those of a text that no landmark has meet nothing, but count for its size.
Texts are scored in batches: their presence over the landmarks' grams times the
landmarks times the regression weights. The last two are multiplied once.

The model is fitted on at most `train_rows` labelled rows of at most
`train_chars` characters, the same number for each language (of more than
`train_rows` languages the commonest), drawn by hash; its parts are bounded by
these parameters, so it is shipped whole.
Null texts and texts without a letter (Unicode category L) are `und` with score
0, as is all where nothing could be learned. Texts of any length are scored
whole, in slices. Rows are scored each on its own; a null doc_id is not
held out; extra columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import shared

UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
#: Characters whose grams are held at once.
SLICE = 1 << 18


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the 1- to 3-grams of the texts, and the text of each."""
    size = np.array([len(t) for t in texts], np.int64)
    cp = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    row = np.repeat(np.arange(len(texts)), size)
    b, t = row[1:] == row[:-1], row[2:] == row[:-2]
    two = (cp[:-1] << np.uint64(21) | cp[1:] | np.uint64(1 << 63))[b] if len(cp) > 1 else cp[:0]
    three = (cp[:-2] << np.uint64(42) | cp[1:-1] << np.uint64(21) | cp[2:])[t] if len(cp) > 2 else cp[:0]
    return np.concatenate([cp | np.uint64(3 << 62), two, three]), np.concatenate([row, row[1:][b], row[2:][t]])


def windows(texts: list[str], most: int = SLICE) -> Iterator[tuple[list[str], np.ndarray]]:
    """The lower-cased texts in groups of about `most` characters with their rows; longer texts in slices that share 2 characters, so no gram is lost."""
    group, rows, held = [], [], 0
    for row, text in enumerate(texts):
        text = text.lower()
        for at in range(0, max(1, len(text) - 2), most):
            part = text[at : at + most + 2]
            if group and held + len(part) > most:
                yield group, np.array(rows)
                group, rows, held = [], [], 0
            group.append(part)
            rows.append(row)
            held += len(part)
    if group:
        yield group, np.array(rows)


def gram_sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct grams of all texts, one text after another, and where each one's begin (and the last one's end)."""
    parts: list[list[np.ndarray]] = [[] for _ in texts]
    for group, rows in windows(texts):
        code, row = grams(group)
        order = np.argsort(row.astype(np.uint16) if len(group) < 1 << 16 else row, kind="stable")  # 16 bits are sorted by radix
        code, ends = code[order], np.cumsum(np.bincount(row, minlength=len(group)))
        for k, (a, b) in enumerate(zip(np.r_[0, ends[:-1]], ends, strict=True)):
            parts[rows[k]].append(shared.distinct(code[a:b]))
    sets = [p[0] if len(p) == 1 else shared.distinct(np.concatenate(p)) if p else np.zeros(0, np.uint64) for p in parts]
    return np.concatenate([np.zeros(0, np.uint64), *sets]), np.r_[0, np.cumsum([len(s) for s in sets], dtype=np.int64)]


def products(texts: list[str], codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Presence of the sorted `codes` in each text, over the root of the number of its grams, times the table of a row a code."""
    flat, bounds = gram_sets(texts)
    out = np.zeros((len(texts), table.shape[1]))
    if len(codes) and len(flat):
        at = np.minimum(np.searchsorted(codes, flat), len(codes) - 1)
        hit = codes[at] == flat
        ends = np.r_[0, np.cumsum(hit)][bounds]
        filled = np.flatnonzero(ends[1:] > ends[:-1])
        if len(filled):
            out[filled] = np.add.reduceat(table[at[hit]], ends[:-1][filled], axis=0)
    return out / np.sqrt(np.maximum(1, np.diff(bounds)))[:, None]


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray  #: sorted grams of the landmarks
    weights: np.ndarray  #: grams x languages: landmarks, of norm 1, times the regression's weights
    bias: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        """One-versus-rest scores, about 1 for the language of a text and -1 for others."""
        return products(texts, self.codes, self.weights) + self.bias

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        known = [i for i, t in enumerate(texts) if t and _LETTER.search(t)] if self.languages else []
        for lo in range(0, len(known), 512):
            part = known[lo : lo + 512]
            s = self.scores([texts[i] for i in part])
            p = np.exp(4 * (s - s.max(1, keepdims=True)))
            p /= p.sum(1, keepdims=True)
            best = s.argmax(1)
            for i, k, v in zip(part, best, p[np.arange(len(part)), best], strict=True):
                names[i] = self.languages[k]
                score[i] = v
        return names, np.clip(score, 0, 1)


def fit(rows: list[tuple[str, str]], landmarks: int = 192, ridge: float = 0.1) -> Model:
    """A model of (text, language) rows; rows without a letter teach nothing."""
    rows = [r for r in rows if _LETTER.search(r[0])]
    languages = sorted({r[1] for r in rows})
    if not rows:
        return Model([], np.zeros(0, np.uint64), np.zeros((0, 0)), np.zeros(0))
    label = np.array([languages.index(r[1]) for r in rows])
    seen = [0] * len(languages)
    place = []
    for k in label:
        place.append(seen[k])
        seen[k] += 1
    turn = np.argsort(place, kind="stable")[:landmarks]  # languages in turn
    flat, bounds = gram_sets([rows[i][0] for i in turn])
    codes, at = np.unique(flat, return_inverse=True)
    marks = np.zeros((len(codes), len(turn)), np.float32)
    size = np.diff(bounds)
    marks[at, np.repeat(np.arange(len(turn)), size)] = np.repeat(1 / np.sqrt(size), size)
    k = np.concatenate([products([r[0] for r in rows[lo : lo + 16]], codes, marks) for lo in range(0, len(rows), 16)])
    value, vector = np.linalg.eigh(k[turn])
    good = value > 1e-6 * value[-1]
    white = vector[:, good] / np.sqrt(value[good])
    z = k @ white
    y = np.where(label[:, None] == np.arange(len(languages)), 1.0, -1.0)
    middle, mean = z.mean(0), y.mean(0)
    beta = np.linalg.solve((z - middle).T @ (z - middle) + ridge * np.eye(z.shape[1]), (z - middle).T @ (y - mean))
    return Model(languages, codes, marks.astype(np.float64) @ (white @ beta), mean - middle @ beta)


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, train_rows: int = 1200, train_chars: int = 100_000) -> Model:
    """Fit on a sample by hash of the labelled rows that aren't held out; the driver gets the sample alone."""
    labelled = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.char_length("text") <= train_chars)).select("lang", "text", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)).alias("draw"))
    found = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(train_rows).collect()
    counts = {r["lang"]: r["count"] for r in found}
    if not counts:
        return fit([])
    each = max(1, train_rows // len(counts))
    # a little more than is needed of each language, then the least draws of these
    most = F.create_map(*[x for lang, n in sorted(counts.items()) for x in (F.lit(lang), F.lit(min(1 << 30, int((1 << 30) * 1.5 * (each + 8) / n))))])
    drawn = labelled.where(F.col("draw") < F.coalesce(F.try_element_at(most, F.col("lang")), F.lit(0)))
    first = drawn.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("draw", "text"))).where(F.col("k") <= each)
    return fit([(r["text"], r["lang"]) for r in first.select("lang", "text", "k").orderBy("lang", "k").collect()])


def languages(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each row; no shuffle."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def step(columns, texts):
        names, score = shipped.value.predict(texts)
        return pa.RecordBatch.from_pydict({"doc_id": pa.array(columns[0], pa.int64()), "held_out": pa.array(columns[1], pa.bool_()), "lang_pred": names, "score": score})

    return shared.text_map(docs.select("doc_id", held_out().alias("held_out"), "text"), ["doc_id", "held_out"], step, "doc_id long, held_out boolean, lang_pred string, score double")


def accepted(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """Rows of docs whose language is recognised with a score of `least` or more."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        at = docs_columns.index("text")
        for batch in shared.small_batches(shared.steady(batches)):
            names, score = shipped.value.predict(batch.column(at).to_pylist())
            yield batch.filter(pa.array([n != UNKNOWN and s >= least for n, s in zip(names, score, strict=True)]))

    docs_columns = docs.columns
    return docs.mapInArrow(run, docs.schema)
