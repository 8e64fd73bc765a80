"""Tokenising whole texts with the tokenizers library, each distinct piece of a slice once.

A text is cut into pieces at places where neither vocabulary's pre-tokeniser can join across:
a single blank or line break between two non-space characters.  Arrow cuts the texts and numbers
the distinct pieces; each distinct piece goes through the library once and numpy lays its ids out
at every place it stands.  A bounded per-worker cache keeps the ids of pieces.  Unusual white
space never makes a boundary (it stays inside a piece), so the ids equal those of the whole text.
"""

from __future__ import annotations

import json
import os
import re
from functools import cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: a piece keeps one leading blank or line break; runs of white space and rare spaces stay inside it
_PIECE = re.compile(r"(?:\A\s*|[ \n])\S+(?:(?:\s{2,}|[^\S \n])\S+)*(?:\s+\Z)?|\s+")
#: pieces a worker keeps; once full, further pieces are encoded per call (memory bound, no effect on results)
CACHE_PIECES = 600_000
#: new pieces encoded as one text, and such texts a call
_TOGETHER, _TEXTS = 64, 64
_LONGEST_CACHED = 64
#: white space that is not one blank or line break between two other characters (all of Unicode's white space is named)
_ODD = (r"\A[ \n]|[ \n]\z|[ \n][ \n]|[\t\x0B\f\r\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
        r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
_FIRST = "\n\n"  # marks a text's first piece, which has no blank before it; no plain text holds two line breaks in a row


@cache
def tokenizer(path: str):
    """The tokenizer of a vocabulary file, special-token strings read as ordinary text."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks use the cores
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


class _Bulk:
    """Encodes many pieces as one text and finds each piece's ids again, where the vocabulary lets it.

    With word ends, every pre-token's last token carries the mark: a piece that is one run of letters holds one mark at
    least, a run of letters with one stop behind it two.  If a text of n such pieces holds n (or 2n) marks, each has
    just that many.  In a byte-level vocabulary every token stands for a known number of bytes.  Where
    neither rule applies, or the count is off, pieces are encoded one by one.
    """

    def __init__(self, path: str):
        self.tokenizer = tokenizer(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        size = max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])], default=0) + 1
        self.ends = self.bytes = None
        if mark := spec["model"].get("end_of_word_suffix"):
            self.ends = np.zeros(size, bool)
            self.ends[[i for t, i in spec["model"]["vocab"].items() if t.endswith(mark)]] = True
        elif spec["normalizer"] is None and (spec["pre_tokenizer"] or {}).get("type") == "ByteLevel":
            self.bytes = np.zeros(size, np.int64)
            for t, i in spec["model"]["vocab"].items():
                self.bytes[i] = len(t)  # one character of a token is one byte

    def _kind(self, key) -> int:
        """Marks of a piece (1 or 2; 1 in a byte-level vocabulary); 0: on its own.  First pieces have no blank before them."""
        if isinstance(key, tuple) or key.startswith(_FIRST):
            return 0
        if self.bytes is not None:
            return 1
        if self.ends is None:
            return 0
        word = key[1:] if key[0] == "\n" else key
        return 1 if word.isalpha() else 2 if len(word) > 1 and word[-1] in ".,;:!?" and word[:-1].isalpha() else 0

    def _cut(self, ids: np.ndarray, pieces: list[str], kind: int) -> np.ndarray | None:
        """Number of ids of each piece; None if they can't be told apart."""
        if self.bytes is not None:
            upto = np.cumsum(self.bytes[ids])
            ends = np.cumsum([len(p.encode("utf-8", "surrogatepass")) for p in pieces])
            at = np.searchsorted(upto, ends)
            if at[-1] >= len(upto) or not np.array_equal(upto[at], ends):
                return None
        else:
            at = np.flatnonzero(self.ends[ids])
            if len(at) != kind * len(pieces) or at[-1] != len(ids) - 1:
                return None
            at = at[kind - 1::kind]
        return np.diff(at, prepend=-1)

    def _by_bytes(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """(ids of all pieces, number of ids of each) in a byte-level vocabulary; None if they can't be told apart."""
        texts = ["".join(pieces[i:i + _TOGETHER]) for i in range(0, len(pieces), _TOGETHER)]
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ends = np.cumsum(pc.binary_length(pa.array(pieces, pa.string())).to_numpy())
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        ids = np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum()))
        upto = np.cumsum(self.bytes[ids])
        at = np.searchsorted(upto, ends)
        if at[-1] >= len(upto) or not np.array_equal(upto[at], ends):
            return None
        last = np.minimum(np.arange(1, len(texts) + 1) * _TOGETHER, len(pieces)) - 1
        if not np.array_equal(at[last] + 1, np.cumsum(sizes)):  # a text's ids are those of its own pieces
            return None
        return ids, np.diff(at, prepend=-1)

    def encode(self, keys: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, size) of each key's ids in the returned ids."""
        start, size = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        found: list[np.ndarray] = []
        done = 0
        by_kind: dict[int, list[int]] = {}
        if self.bytes is not None:
            alone = [j for j, key in enumerate(keys) if isinstance(key, tuple) or key.startswith(_FIRST)]
            left = np.ones(len(keys), bool)
            left[alone] = False
            members = np.flatnonzero(left)
            for i in range(0, len(members), _TEXTS * _TOGETHER):
                part = members[i:i + _TEXTS * _TOGETHER]
                coded = self._by_bytes([key if key[0] == "\n" else " " + key for key in map(keys.__getitem__, part.tolist())])
                if coded is None:
                    by_kind.setdefault(1, []).extend(part.tolist())
                    continue
                size[part] = coded[1]
                start[part] = done + np.cumsum(coded[1]) - coded[1]
                found.append(coded[0])
                done += len(coded[0])
        else:
            for j, key in enumerate(keys):
                by_kind.setdefault(self._kind(key), []).append(j)
            alone = by_kind.pop(0, [])
        for kind, members in by_kind.items():
            for i in range(0, len(members), _TEXTS * _TOGETHER):
                groups = [members[k:k + _TOGETHER] for k in range(i, min(i + _TEXTS * _TOGETHER, len(members)), _TOGETHER)]
                pieces = [[_piece(keys[j]) for j in g] for g in groups]
                for g, p, e in zip(groups, pieces, self.tokenizer.encode_batch_fast(list(map("".join, pieces)), add_special_tokens=False)):
                    ids = np.array(e.ids, np.uint32)
                    n = self._cut(ids, p, kind) if len(ids) else None
                    if n is None:
                        alone += g
                        continue
                    size[g] = n
                    start[g] = done + np.cumsum(n) - n
                    found.append(ids)
                    done += len(ids)
        for i in range(0, len(alone), 4096):
            part = alone[i:i + 4096]
            lists = [e.ids for e in self.tokenizer.encode_batch_fast([_piece(keys[j]) for j in part], add_special_tokens=False)]
            n = np.fromiter(map(len, lists), np.int64, len(lists))
            size[part] = n
            start[part] = done + np.cumsum(n) - n
            found.append(np.fromiter(chain.from_iterable(lists), np.uint32, int(n.sum())))
            done += len(found[-1])
        return start, size, np.concatenate(found) if found else np.zeros(0, np.uint32)


class _Pieces:
    """Ids of the pieces a worker has met: place of each key, and the ids of all of them end to end."""

    def __init__(self, path: str):
        self.bulk = _Bulk(path)
        self.place: dict[str, int] = {}
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def ids(self, keys: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, size) of each key's ids in the returned ids; new keys are encoded once and kept while there is room."""
        at = np.fromiter(map(self.place.get, keys, repeat(-1)), np.int64, len(keys))
        fresh = np.flatnonzero(at < 0)
        if not len(fresh):
            return self.start[at], self.size[at], self.flat
        new = [keys[j] for j in fresh.tolist()]
        inside, sizes, ids = self.bulk.encode(new)
        starts = inside + len(self.flat)
        at[fresh] = len(self.start) + np.arange(len(fresh))
        start, size = np.concatenate([self.start, starts]), np.concatenate([self.size, sizes])
        flat = np.concatenate([self.flat, ids])
        if len(self.place) < CACHE_PIECES:
            room = CACHE_PIECES - len(self.place)
            kept = [j for j, k in enumerate(new) if len(k) <= _LONGEST_CACHED and not isinstance(k, tuple)][:room]
            self.place.update(zip(map(new.__getitem__, kept), range(len(self.start), len(self.start) + len(kept))))
            kept = np.array(kept, np.int64)
            length = sizes[kept]
            ends = np.cumsum(length)
            taken = np.repeat(inside[kept] - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)
            self.start = np.concatenate([self.start, ends - length + len(self.flat)])
            self.size, self.flat = np.concatenate([self.size, length]), np.concatenate([self.flat, ids[taken]])
        return start[at], size[at], flat


@cache
def _memory(path: str) -> _Pieces:
    return _Pieces(path)


def _piece(key) -> str:
    """The text of a key: a first piece, one after a line break, one after a blank, or (in a tuple) a piece as it is."""
    if isinstance(key, tuple):
        return key[0]
    return key[2:] if key.startswith(_FIRST) else key if key[0] == "\n" else " " + key


def encode(texts: pa.Array | list[str | None], path: str) -> list[np.ndarray]:
    """Ids (uint32) of every whole text, add_special_tokens=False; null reads as empty."""
    if not isinstance(texts, pa.Array):
        texts = pa.array(texts, pa.string())
    empty = pc.fill_null(pc.equal(texts, ""), True).to_numpy(zero_copy_only=False)
    strange = pc.fill_null(pc.match_substring_regex(texts, _ODD), False).to_numpy(zero_copy_only=False)
    plain, odd = np.flatnonzero(~empty & ~strange), np.flatnonzero(strange)
    marked = pc.binary_join_element_wise(_FIRST, pc.replace_substring(texts.take(pa.array(plain)), "\n", " \n"), "")
    cut = pc.split_pattern(marked, " ")
    coded = cut.flatten().dictionary_encode()
    keys: list = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # to_pylist makes a scalar of each first
    cuts, places = [np.diff(cut.offsets.to_numpy())], [coded.indices.to_numpy()]
    more: dict = {}
    for i in odd.tolist():
        codes = np.array([more.setdefault(p, len(keys) + len(more)) for p in _PIECE.findall(texts[i].as_py())])
        cuts.append(np.array([len(codes)]))
        places.append(codes)
    keys += [(p,) for p in more]
    where = np.concatenate(places)
    start, size, ids = _memory(path).ids(keys)
    n = size[where]
    ends = np.r_[0, np.cumsum(n)]
    flat = ids[np.repeat(start[where] - ends[:-1], n) + np.arange(ends[-1])]
    out: list[np.ndarray] = [np.array([], np.uint32)] * len(texts)
    last = ends[np.cumsum(np.concatenate(cuts))]
    for i, a, b in zip(plain.tolist() + odd.tolist(), np.r_[0, last[:-1]].tolist(), last.tolist()):
        out[i] = flat[a:b]
    return out
