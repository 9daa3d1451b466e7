"""Encoding whole texts with the tokenizers library, a chunk cache in front of it.

The pre-tokenizer of byte-level BPE never joins what stands left and right of a
single space between two characters that are not white space, so a text may be
encoded piece by piece, cut in front of each such space. Arrow cuts a batch of
texts, numbers its distinct pieces and parts them from the marks at their ends; those that no earlier
batch had are encoded by the library, and the texts are put together by these numbers.
"""

from __future__ import annotations

import itertools
import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import shared

#: Distinct pieces that a Python worker keeps, in two generations.
CACHE_PIECES = 800_000
#: Bytes of texts and ids from which a worker's cache is emptied.
STEM_BYTES = 256 << 20
#: Bytes of text that are cut and looked up at once.
BATCH_BYTES = 4 << 20
#: White space but space and line feed, a fixed Unicode list.
_OTHER_SPACE = "[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: Marks that may be encoded apart from the letter before them.
MARKS = ".,!?;:#*$%&"
#: Texts with white space that touches white space, other white space, or a line feed at their end.
_UNEVEN = f"  |\n | \n|\n\n|{_OTHER_SPACE}|\n\\z"
_SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")
_ANY_OTHER_SPACE = re.compile(_OTHER_SPACE)
#: Pieces that the library encodes as one text.
JOINED = 256
#: What stands for space and line feed in byte-level vocabularies, fixed public values.
SPACE_SYMBOLS = ("\u0120", "\u010a")


def check_byte_level(spec: dict) -> None:
    """Raise ValueError unless the vocabulary file is one that texts may be cut for: byte-level BPE, no normalizer, no changes to what is encoded."""
    pre, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and spec.get("normalizer") is None
    whole = model.get("type", "BPE") == "BPE" and not model.get("dropout") and not model.get("ignore_merges") and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
    added = all(not t.get(k) for t in spec.get("added_tokens", []) for k in ("lstrip", "rstrip", "single_word")) and not any(c.isspace() for t in spec.get("added_tokens", []) for c in t["content"])
    if not (plain and whole and added and not spec.get("truncation") and not spec.get("padding")):
        raise ValueError("not a vocabulary of plain byte-level BPE: texts can't be encoded piece by piece")


def pieces(texts: pa.Array) -> pa.ListArray:
    """Each text cut in front of safe spaces; each piece but the first has lost its space.

    Where white space never touches other white space, a line feed is a
    pre-token of its own and is cut as well; such a piece begins with it.
    """
    uneven = pc.match_substring_regex(texts, _UNEVEN)
    even = pc.split_pattern(pc.replace_substring(texts.filter(pc.invert(uneven)), "\n", " \n"), " ")
    if not pc.any(uneven).as_py():
        return even
    others = pa.array([_SAFE_CUT.split(t) for t in texts.filter(uneven).to_pylist()], even.type)
    flags = uneven.to_numpy(zero_copy_only=False)
    place = np.where(flags, len(even) + np.cumsum(flags) - 1, np.cumsum(~flags) - 1)
    return pa.concat_arrays([even, others]).take(pa.array(place))


def spaced(pieces: list[str]) -> list[str]:
    """What stands in the text for pieces that aren't the first."""
    return [p if p[:1] == "\n" else " " + p for p in pieces]


class Generations:
    """What `fill` finds for each key; a generation that is full becomes the old one, and what it held is kept only if it is asked for again."""

    def __init__(self, fill, most: int):
        self.fill, self.most, self.young, self.old = fill, most, {}, {}

    def __call__(self, keys: list[str], text) -> list:
        """What was found for distinct keys; text(keys) is what `fill` gets for new keys."""
        if len(self.young) > self.most // 2:
            self.young, self.old = {}, self.young
        found = [*map(self.young.get, keys)]
        lacking = [k for k, f in zip(keys, found, strict=True) if f is None]
        if not lacking:
            return found
        fresh = []
        for k in lacking:
            f = self.old.get(k)
            if f is None:
                fresh.append(k)
            else:
                self.young[k] = f
        self.fill(self.young, fresh, text(fresh))
        return [*map(self.young.__getitem__, keys)]


class Memo:
    """What `fill` finds for the pieces of texts, kept by piece."""

    def __init__(self, fill):
        self.first, self.later = Generations(fill, CACHE_PIECES // 8), Generations(fill, CACHE_PIECES)

    def __call__(self, texts: list[str] | pa.Array) -> tuple[list, np.ndarray, np.ndarray]:
        """What was found for distinct pieces, each piece's place in that list, and where each text's pieces begin (and the last one's end)."""
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        cut = pieces(texts)
        bounds = np.r_[0, np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False), dtype=np.int64)]
        flat = cut.flatten()
        coded = flat.dictionary_encode()
        place = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        heads = flat.take(pa.array(bounds[:-1])).dictionary_encode()
        place[bounds[:-1]] = -1
        # pieces that only begin texts aren't looked up among the others
        used = np.bincount(place[place >= 0], minlength=len(coded.dictionary)) > 0
        found = self.later(coded.dictionary.filter(pa.array(used)).to_pylist(), spaced)
        place = np.where(place >= 0, (np.cumsum(used) - 1)[place] if len(used) else -1, -1)
        place[bounds[:-1]] = len(found) + heads.indices.to_numpy(zero_copy_only=False)
        return found + self.first(heads.dictionary.to_pylist(), list), place, bounds


class Stems:
    """What `fill` finds for texts, kept in Arrow arrays and found again by one hash join for a batch; those used longest ago go first."""

    def __init__(self, fill, most: int):
        self.fill, self.most, self.turn = fill, most, 0
        self.clear()

    def clear(self) -> None:
        self.texts, self.found, self.used = pa.array([], pa.string()), pa.array([], pa.binary()), np.zeros(0, np.int64)

    def __call__(self, texts: pa.StringArray) -> pa.BinaryArray:
        """What was found for each text; new texts are best given once."""
        at = pc.fill_null(pc.index_in(texts, value_set=self.texts), -1).to_numpy(zero_copy_only=False).copy()
        new = np.flatnonzero(at < 0)
        if len(new):
            fresh = texts.take(pa.array(new))
            at[new] = len(self.texts) + np.arange(len(new))
            self.texts, self.found = pa.concat_arrays([self.texts, fresh]), pa.concat_arrays([self.found, self.fill(fresh)])
            self.used = np.r_[self.used, np.zeros(len(new), np.int64)]
        self.turn += 1
        self.used[at] = self.turn
        out = self.found.take(pa.array(at))
        if self.texts.nbytes + self.found.nbytes > STEM_BYTES:
            self.clear()
        elif len(self.texts) > self.most:
            kept = pa.array(np.sort(np.argpartition(self.used, -(self.most // 2))[-(self.most // 2) :]))
            self.texts, self.found, self.used = self.texts.take(kept), self.found.take(kept), self.used[kept.to_numpy()]
        return out


class PieceEncoder:
    """ids of whole texts as little-endian bytes of `width` per id."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        check_byte_level(json.loads(self.model.to_str()))
        vocabulary = self.model.get_vocab(with_added_tokens=True)
        self.dtype = np.dtype("u2" if max(vocabulary.values()) < 1 << 16 else "u4")
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
        self.opens[[i for token, i in vocabulary.items() if token[:1] in SPACE_SYMBOLS]] = True
        self.stems = Stems(self.fill, CACHE_PIECES)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(f.ids, self.dtype) for f in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def fill(self, fresh: pa.StringArray) -> pa.BinaryArray:
        """ids of texts; those that begin with white space are encoded by joined runs where it is each one's only white space: just there an id begins with white space."""
        opened = pc.match_substring_regex(fresh, "\\A[ \n]").to_numpy(zero_copy_only=False)
        order = np.r_[np.flatnonzero(opened), np.flatnonzero(~opened)]
        texts, runs = fresh.take(pa.array(order)).to_pylist(), np.count_nonzero(opened)
        ids, sizes = [], []

        def apart(part: list[str]) -> None:
            found = self.encode(part)
            ids.extend(found)
            sizes.append([len(f) for f in found])

        for at in range(0, runs, JOINED):
            part = texts[at : min(at + JOINED, runs)]
            whole = "".join(part)
            if whole.count(" ") + whole.count("\n") == len(part) and not _ANY_OTHER_SPACE.search(whole):
                found = self.encode([whole])[0]
                starts = np.flatnonzero(self.opens[found])
                if len(starts) == len(part):
                    ids.append(found)
                    sizes.append(np.diff(starts, append=len(found)))
                    continue
            apart(part)
        for at in range(runs, len(texts), 4096):
            apart(texts[at : at + 4096])
        ends = np.cumsum(np.r_[0, *sizes], dtype=np.int64) * self.dtype.itemsize
        found = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.concatenate([np.zeros(0, self.dtype), *ids]))])
        return found.take(pa.array(np.argsort(order)))

    def pieces_ids(self, texts: pa.StringArray) -> pa.BinaryArray:
        """Marks that end a piece after a Latin letter are a pre-token of their own, so such a piece is its stem's ids and the marks'."""
        marked = pc.match_substring_regex(texts, f"[A-Za-z][{MARKS}]+\\z")
        stems = pc.if_else(marked, pc.utf8_rtrim(texts, characters=MARKS), texts).dictionary_encode()
        marks = pc.struct_field(pc.extract_regex(texts.filter(marked), f"(?P<mark>[{MARKS}]+)\\z"), "mark").dictionary_encode()
        found = self.stems(pa.concat_arrays([stems.dictionary, marks.dictionary]))
        # the last one is what pieces without marks end with
        ends = pa.concat_arrays([found.slice(len(stems.dictionary)), pa.array([b""], pa.binary())])
        end = np.full(len(texts), len(ends) - 1)
        end[marked.to_numpy(zero_copy_only=False)] = marks.indices.to_numpy(zero_copy_only=False)
        return pc.binary_join_element_wise(found.take(stems.indices), ends.take(pa.array(end)), pa.scalar(b"", pa.binary()))

    def __call__(self, texts: list[str] | pa.Array) -> list[bytes]:
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        cut = pieces(texts)
        bounds = np.r_[0, np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False), dtype=np.int64)]
        flat = cut.flatten()
        coded, heads = flat.dictionary_encode(), flat.take(pa.array(bounds[:-1])).dictionary_encode()
        place = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        place[bounds[:-1]] = len(coded.dictionary) + heads.indices.to_numpy(zero_copy_only=False)
        # pieces that only begin texts aren't looked up among the others
        used = np.bincount(place, minlength=len(coded.dictionary) + len(heads.dictionary)) > 0
        later = coded.dictionary.filter(pa.array(used[: len(coded.dictionary)]))
        later = pc.if_else(pc.starts_with(later, "\n"), later, pc.binary_join_element_wise("", later, " "))
        joined = self.pieces_ids(pa.concat_arrays([later, heads.dictionary])).take(pa.array((np.cumsum(used) - 1)[place]))
        _, ends, data = joined.buffers()
        data = memoryview(data) if data else b""
        at = np.frombuffer(ends, np.int32)[bounds].tolist() if len(place) else [0]
        return [bytes(data[lo:hi]) for lo, hi in itertools.pairwise(at)]


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """This worker's encoder for the vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


shared.CACHES["tokens"] = _ENCODERS.clear
