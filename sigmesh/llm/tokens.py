"""Token ids of whole texts with the tokenizers library.

A tokenizer that cuts texts at white space encodes each piece on its own, so
the ids of a piece are kept and reused: only pieces not seen before go
through the library. Texts whose cuts are not plain (pieces that begin or end
with white space, or rare control characters) are encoded whole. The result
is always that of ``encode(text, add_special_tokens=False)``.

The tokenizer file's path is a parameter; nothing is trained here.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces a worker remembers; beyond that it forgets those it met once.
KEPT_PIECES = 1_000_000
#: New pieces that go through the library in one text, between marks.
JOINED = 256
#: Signs that both kinds of tokenizer cut off a word of letters only.
_SIGNS = ".,;:!%&$#*|"
_ODD = re.compile("[\x1c-\x1f]")  # white space for str.split, but not for the tokenizers
#: A line end between other characters is a piece of its own with "space", and what follows it has no space before it.
_LINE_END = re.compile(r"\n(?<=\S\n)(?=\S)")
_LINE = "\0\0"


class _Known(dict):
    """Numbers pieces in the order they are first looked up."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self.new.append(piece)
        self[piece] = n = len(self)
        return n


def _room(values: np.ndarray, size: int) -> np.ndarray:
    """``values`` with room for ``size`` of them."""
    while size > len(values):
        values = np.concatenate([values, np.empty_like(values)])
    return values


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks in parallel
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.batch = getattr(self.tok, "encode_batch_fast", self.tok.encode_batch)
        spec = json.loads(self.tok.to_str())
        pre = spec.get("pre_tokenizer") or {}
        steps = pre.get("pretokenizers", [pre])
        #: "space": a piece carries the one space before it; "words": white space only separates; "": no cuts
        self.cuts = ""
        if len(steps) == 1 and steps[0].get("type") == "ByteLevel" and steps[0].get("use_regex") \
                and not steps[0].get("add_prefix_space") and spec.get("normalizer") is None:
            self.cuts = "space"
        elif steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed" and steps[0].get("invert") \
                and not (steps[-1].get("use_regex") or steps[-1].get("add_prefix_space")):
            self.cuts = "words"
        self._forget()
        # a mark that is a token of its own wherever it stands, and the text that surrounds it
        self.mark, self.join = ("\t", "\t") if self.cuts == "space" else ("\x01", " \x01 ")
        ids = self.tok.encode(self.mark, add_special_tokens=False).ids
        self.mark_id = ids[0] if len(ids) == 1 else None

    def size(self) -> int:
        return self.tok.get_vocab_size(with_added_tokens=True)

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.batch(texts, add_special_tokens=False)]

    def _each(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that stand alone: many in one text, cut again at the marks."""
        groups = [pieces[i:i + JOINED] for i in range(0, len(pieces), JOINED)]
        out: list[bytes] = []
        for g, ids in zip(groups, self._whole([self.join.join(g) for g in groups])):
            at = np.flatnonzero(np.frombuffer(ids, "<u4") == self.mark_id) if self.mark_id is not None else ()
            if len(at) != len(g) - 1:
                out += self._whole(g)
                continue
            edges = [-1, *at.tolist(), len(ids) // 4]
            out += [ids[4 * a + 4:4 * b] for a, b in zip(edges, edges[1:])]
        return out

    def _places(self, texts: list[str]) -> list[np.ndarray | None]:
        """The number in ``known`` of each piece of each text; none for texts that are not cut.

        With "space", pieces begin with the space before them, all but the first of a line, which are marked."""
        get = self.known.__getitem__
        if self.cuts == "words":
            cut = [None if _ODD.search(t) else t.split() for t in texts]
            return [None if c is None else np.fromiter(map(get, c), np.int64, len(c)) for c in cut]
        there = [i for i, t in enumerate(texts) if "\0" not in t]
        cut = pc.split_pattern(pa.array(["\0" + _LINE_END.sub(f" {_LINE} \0", texts[i]) for i in there], pa.large_string()), " ")
        pieces = pc.dictionary_encode(cut.values)  # each different piece is looked up once
        number = np.fromiter(map(get, pieces.dictionary.to_numpy(zero_copy_only=False)), np.int64, len(pieces.dictionary))[pieces.indices.to_numpy()]
        edges = cut.offsets.to_numpy()
        out: list[np.ndarray | None] = [None] * len(texts)
        for i, lo, hi in zip(there, edges, edges[1:]):
            out[i] = number[lo:hi]
        return out

    def _learn(self, new: list[str]) -> None:
        """Append the ids of new pieces to the store, in their order; a piece that can't stand alone gets length -1."""
        ids: dict[str, bytes] = {}
        letters, rest = [], []
        for k in new:
            (letters if k.isalpha() else rest).append(k)
        # a word of letters and its closing signs are tokens of their own: their ids are joined
        ends = {}
        for k in rest:
            word = k.rstrip(_SIGNS)
            if len(word) < len(k) and (word[1:] if self.cuts == "space" and word[:1] == "\0" else word).isalpha():
                ends[k] = word, k[len(word):]
        rest = [k for k in rest if k not in ends]
        for w in {w for w, _ in ends.values()}.difference(new):
            n = self.sizes[self.known[w]] if w in self.known else -1
            if n >= 0:  # learnt before
                at = self.starts[self.known[w]]
                ids[w] = self.flat[at:at + n].tobytes()
            else:
                (letters if w.isalpha() else rest).append(w)
        parts = {t for _, t in ends.values()}
        signs = dict(zip(parts, self._whole(list(parts))))
        if self.cuts == "words":
            marked = [k for k in rest if self.mark in k]
            plain = letters + [k for k in rest if self.mark not in k]
            ids.update(zip(marked, self._whole(marked)))
            ids.update(zip(plain, self._each(plain)))
        else:
            plain = letters + [k for k in rest if k and self.mark not in k and "\0" not in k and not k[0].isspace() and not k[-1].isspace()]
            ids.update(zip(plain, self._each([" " + k for k in plain])))
            heads = [k for k in rest if k[:1] == "\0" and k[1:] and "\0" not in k[1:] and not k[-1].isspace()]
            alone = [k for k in heads if k[1].isspace() or self.mark in k]
            ids.update(zip(alone, self._whole([k[1:] for k in alone])))
            joined = [k for k in heads if k not in ids]
            ids.update(zip(joined, self._each([k[1:] for k in joined])))
            if _LINE in rest:
                ids[_LINE], = self._whole(["\n"])
        for k, (word, tail) in ends.items():
            ids[k] = ids[word] + signs[tail]
        blobs = [ids.get(k) for k in new]
        n, had = np.array([-1 if b is None else len(b) // 4 for b in blobs], dtype=np.int64), len(self.known) - len(new)
        flat = np.frombuffer(b"".join(b for b in blobs if b), "<u4")
        self.flat = _room(self.flat, self.stored + len(flat))
        self.starts, self.sizes, self.again = (_room(x, len(self.known)) for x in (self.starts, self.sizes, self.again))
        held = np.maximum(n, 0)
        self.starts[had:len(self.known)] = self.stored + np.cumsum(held) - held
        self.sizes[had:len(self.known)] = n
        self.again[had:len(self.known)] = False
        self.flat[self.stored:self.stored + len(flat)] = flat
        self.stored += len(flat)

    def _forget(self) -> None:
        self.known = _Known()
        self.flat, self.stored = np.empty(1 << 16, dtype="<u4"), 0
        self.starts, self.sizes, self.again = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64), np.zeros(1 << 12, bool)

    def _forget_rare(self) -> None:
        """Forget the pieces that were not asked for again; all of them if that leaves too many."""
        keep = np.flatnonzero(self.again[:len(self.known)])
        if len(keep) > KEPT_PIECES // 2:
            return self._forget()
        keys = list(self.known)
        self.known = _Known()
        self.known.update(zip([keys[i] for i in keep], range(len(keep))))
        n = self.sizes[keep]
        held = np.maximum(n, 0)
        ends = np.cumsum(held)
        flat = self.flat[np.arange(held.sum()) + np.repeat(self.starts[keep] - ends + held, held)]
        self.flat[:len(flat)], self.stored = flat, len(flat)
        self.starts[:len(keep)], self.sizes[:len(keep)], self.again[:len(keep)] = ends - held, n, False

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text as little-endian uint32."""
        if not self.cuts:
            return [np.frombuffer(b, "<u4") for b in self._whole(texts)]
        if len(self.known) > KEPT_PIECES:
            self._forget_rare()
        before = len(self.known)
        places = self._places(texts)
        if self.known.new:
            self._learn(self.known.new)
            self.known.new = []
        for p in places:
            if p is not None:
                self.again[p] = p < before
        starts, sizes = self.starts, self.sizes
        out: list[np.ndarray | None] = []
        for p in places:
            n = None if p is None else sizes[p]
            if n is None or len(n) and n.min() < 0:
                out.append(None)
                continue
            ends = np.cumsum(n)
            total = int(ends[-1]) if len(ends) else 0
            out.append(self.flat[np.arange(total) + np.repeat(starts[p] - ends + n, n)])
        left = [i for i, o in enumerate(out) if o is None]
        for i, b in zip(left, self._whole([texts[i] for i in left])):
            out[i] = np.frombuffer(b, "<u4")
        return out


_LOADED: dict[str, Encoder] = {}


def load(path: str) -> Encoder:
    """The encoder of a tokenizer file, once per worker."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def encoded(batches: Iterator[pa.RecordBatch], path: str, end_id: int, group_chars: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray]]:
    """For every row its batch, place and ids (the end id last) as uint32; null text counts as empty."""
    enc = load(path)
    end = np.array([end_id], dtype="<u4")
    for b in batches:
        col = b.column("text")
        lo, n = 0, b.num_rows
        while lo < n:
            texts, held = [], 0
            while lo + len(texts) < n and held < group_chars:
                texts.append(col[lo + len(texts)].as_py() or "")
                held += len(texts[-1])
            for i, ids in enumerate(enc.encode(texts)):
                yield b, lo + i, np.concatenate([ids, end])
            lo += len(texts)


def crc(ids: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4", copy=False).tobytes())
