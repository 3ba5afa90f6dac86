"""Texts cut at single spaces, with results kept for each distinct chunk.

In the patterns of byte-level vocabularies a single space between two other characters starts
a new piece, so what a chunk and the space before it become does not depend
on the rest of the text.  Where white space stands next to a space the text is not cut.
"""

import contextlib
import gc
import json
import re
from collections.abc import Callable
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex

from turnout.llm.tables import rows_of

#: Distinct chunks in a generation of what a Python worker remembers.
MOST = 250_000
#: Texts that are encoded together; or characters of such, where a longer text is encoded by itself.
TOGETHER = 64
LETTERS = 1 << 22
#: Results put one after another at a time.
GATHERED = 1 << 16
#: Chunks encoded in one text.
IN_ONE = 1 << 15

#: White space other than spaces and line ends.
_OTHER = re.compile(r"[^\S \n]")
_ASCII_OTHER = "\t\v\f\r\x1c\x1d\x1e\x1f"
#: Rust's white space is the Unicode property; Python's has four separators more.
PIECES = regex.compile(public_tokenizers.PATTERN.replace(r"\s", r"\p{White_Space}").replace(
    r"\S", r"\P{White_Space}"
))


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in plain)
    return {b: chr(256 + i) for i, b in enumerate(others)}


BYTE_LETTERS = _byte_letters()
#: The same as a table for all bytes, in UTF-16.
LETTER_OF = np.asarray([ord(BYTE_LETTERS.get(b, chr(b))) for b in range(256)], "<u2")


def special_names(path: str) -> re.Pattern:
    """The names of special tokens of a vocabulary file, which the library looks for before all else."""
    with open(path, encoding="utf-8") as file:
        names = [t["content"] for t in json.load(file).get("added_tokens", [])]
    return re.compile("|".join(map(re.escape, names)) or r"(?!)")


def cut_at_spaces(text: str) -> bool:
    """Whether no white space stands next to a space."""
    if "  " in text or " \n" in text or "\n " in text:
        return False
    return not (any(c in text for c in _ASCII_OTHER) if text.isascii() else _OTHER.search(text))


def together(batches, letters: int = LETTERS):
    """Lists of ids and of texts of about so many characters in all."""
    held, size = ([], []), 0
    for batch in batches:
        for doc_id, text in rows_of(batch, "doc_id", "text"):
            if held[0] and size + len(text or "") > letters:
                yield held
                held, size = ([], []), 0
            held[0].append(doc_id)
            held[1].append(text)
            size += len(text or "") + 1
    if held[0]:
        yield held


class Memo(dict):
    """Results of a function by its argument; starts anew when full."""

    def __init__(self, make: Callable, most: int):
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.make(key)
        return value


class Kept(dict):
    """Results by argument, made for many arguments at once, in two generations.

    A full generation becomes the old one, from which what is asked for again moves on, so that
    frequent arguments stay and memory is bounded.
    """

    def __init__(self, make_all: Callable[[list], list], most: int = MOST):
        self.make_all, self.most, self.old = make_all, most, {}

    def results(self, keys: list) -> list:
        """The results for ``keys``, which differ from each other; all of them are here then."""
        made = list(map(self.get, keys))
        new = [i for i, one in enumerate(made) if one is None]
        if not new:
            return made
        if len(self) + len(new) > self.most:
            self.old = dict(self)
            self.clear()
            self.update((key, one) for key, one in zip(keys, made, strict=True) if one is not None)
        old, rest = self.old.get, []
        for i in new:
            made[i] = old(keys[i])
            if made[i] is None:
                rest.append(i)
        for i, one in zip(rest, self.make_all([keys[i] for i in rest]), strict=True):
            made[i] = one
        self.update((keys[i], made[i]) for i in new)
        return made

    def learn(self, keys) -> None:
        """Make sure that all of ``keys``, which differ from each other, are here."""
        self.results(list(keys))

    def located(self, keys: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the ids for each key start, how many they are, and the ids."""
        made = self.results(keys.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, made), np.int64, len(made)) // 4
        return np.cumsum(sizes) - sizes, sizes, np.frombuffer(b"".join(made), "<u4")


class KeptWords:
    """Ids of chunks with a space before them, in Arrow arrays; unknown ones are encoded many in one text.

    Each chunk's share of that text's ids is told by ``lengths``, the bytes that each id stands for.  When
    more than ``most`` chunks would be kept, only those that are asked for at the time stay.
    """

    def __init__(
        self, encode: Callable[[str], np.ndarray], lengths: np.ndarray, whole: re.Pattern, most: int = MOST,
    ):
        self.encode, self.lengths, self.whole, self.most = encode, lengths, whole, most
        self.keys, self.ends, self.ids = pa.array([], pa.large_string()), np.zeros(1, np.int64), np.empty(0, "<u4")

    def located(self, keys: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For ``keys``, which differ from each other, where the ids of each start, how many they are, and the ids."""
        found = pc.index_in(keys, value_set=self.keys)
        new = found.is_null().to_numpy(zero_copy_only=False)
        at = found.fill_null(0).to_numpy().astype(np.int64)
        if new.any():
            if len(self.keys) + new.sum() > self.most:
                self._only(at[~new])
                at[~new] = np.arange(len(at) - new.sum())
            at[new] = len(self.keys) + np.arange(new.sum())
            self._learn(keys.filter(pa.array(new)))
        return self.ends[at], self.ends[at + 1] - self.ends[at], self.ids

    def _only(self, at: np.ndarray) -> None:
        starts, n = self.ends[at], self.ends[at + 1] - self.ends[at]
        ends = np.cumsum(n)
        self.ids = self.ids[np.repeat(starts - ends + n, n) + np.arange(n.sum())]
        self.keys, self.ends = self.keys.take(pa.array(at)), np.concatenate([[0], ends])

    def _learn(self, keys: pa.Array) -> None:
        ids, sizes = [self.ids], [np.diff(self.ends, prepend=0)]
        for first in range(0, len(keys), IN_ONE):
            one, n = self._encoded(keys.slice(first, IN_ONE))
            ids.append(one)
            sizes.append(n)
        self.keys = pa.concat_arrays([self.keys, keys])
        self.ids, self.ends = np.concatenate(ids), np.cumsum(np.concatenate(sizes))

    def _encoded(self, keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        text = " " + " ".join(keys.to_pylist())
        if not self.whole.search(text):
            ids = self.encode(text)
            ends, wanted = np.cumsum(self.lengths[ids]), np.cumsum(pc.binary_length(keys).to_numpy() + 1)
            cuts = np.minimum(np.searchsorted(ends, wanted), len(ids) - 1)
            if np.array_equal(ends[cuts], wanted) and ends[-1] == wanted[-1]:
                return ids, np.diff(cuts, prepend=-1)
        # Chunks side by side make what none of them holds.
        made = [self.encode(f" {key}") for key in keys.to_pylist()]
        return np.concatenate(made), np.asarray([len(x) for x in made])


def joined(split: pa.ListArray, results: Kept | KeptWords) -> list[bytes]:
    """For each list of keys its results, ids of four bytes each, one after another.

    Keys are numbered by Arrow, so that each distinct one is looked up once for all lists.
    """
    offsets = split.offsets.to_numpy()
    numbered = split.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    starts, sizes, ids = results.located(numbered.dictionary)
    places, total = numbered.indices.to_numpy(), np.zeros(len(numbered) + 1, np.int64)
    parts = []
    for first in range(0, len(places), GATHERED):
        some = places[first : first + GATHERED]
        n = sizes[some]
        ends = np.cumsum(n)
        total[first + 1 : first + 1 + len(n)] = total[first] + ends
        parts.append(ids[np.repeat(starts[some] - ends + n, n) + np.arange(ends[-1])].tobytes())
    every = b"".join(parts)
    cuts = (4 * total[offsets - offsets[0]]).tolist()
    return [every[a:b] for a, b in zip(cuts, cuts[1:])]


def pieces_of(chunks: list[str]) -> list[list[str]]:
    """The matches of the pattern in each chunk with a space before it.

    All other chunks than plain words go through the pattern in one text, where each space starts one.
    """
    parts = [[f" {c}"] if c.isalpha() and (c.isascii() or max(c) < "\u0250") else None for c in chunks]
    found = []
    for piece in PIECES.findall("".join([f" {c}" for c, p in zip(chunks, parts, strict=True) if not p])):
        if piece[0] == " ":
            found.append([piece])
        else:
            found[-1].append(piece)
    rest = iter(found)
    return [p or next(rest) for p in parts]


def by_pieces(encode_pieces: Callable[[list[str]], list[bytes]], most: int) -> Callable[[list[str]], list[bytes]]:
    """What makes results for chunks from those of their pieces, ``most`` of which are remembered."""
    known = Kept(encode_pieces, most)

    def encode_all(chunks):
        parts = pieces_of(chunks)
        known.learn(set(chain.from_iterable(parts)))
        get = known.__getitem__
        return [get(p[0]) if len(p) == 1 else b"".join(map(get, p)) for p in parts]

    return encode_all


@contextlib.contextmanager
def _uncollected():
    """No search for cycles while very many lists are made and none of them is in a cycle."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


class ByChunk:
    """Byte strings for texts, from those of their chunks.

    ``encode_all`` takes chunks, each standing for itself with a space before it, or is what keeps their
    ids; ``encode`` takes a whole text.  Texts in which ``whole`` finds something are not cut.
    """

    def __init__(
        self, encode: Callable[[str], bytes], encode_all: Callable[[list[str]], list[bytes]] | KeptWords,
        whole: re.Pattern | None = None, most: int = MOST,
    ):
        self.encode, self.whole = encode, whole or re.compile(r"(?!)")
        self.after_space = encode_all if isinstance(encode_all, KeptWords) else Kept(encode_all, most)

    @_uncollected()
    def __call__(self, texts: list[str | None]) -> list[bytes]:
        cut = [bool(t) and cut_at_spaces(t) and not self.whole.search(t) for t in texts]
        held = pa.array([t for t, c in zip(texts, cut, strict=True) if c], pa.large_string())
        split = pc.split_pattern(held, " ")
        offsets = split.offsets.to_numpy()
        later = np.ones(len(split.values), bool)
        later[offsets[:-1]] = False  # before the first chunk there is no space
        firsts = split.values.filter(pa.array(~later)).to_pylist()
        rest = pa.ListArray.from_arrays(
            pa.array(offsets - np.arange(len(offsets), dtype=np.int32)), split.values.filter(pa.array(later)))
        made = zip(firsts, joined(rest, self.after_space), strict=True)
        out = []
        for text, c in zip(texts, cut, strict=True):
            if c:
                first, ids = next(made)
                out.append((self.encode(first) if first else b"") + ids)
            else:
                out.append(self.encode(text) if text else b"")
        return out
