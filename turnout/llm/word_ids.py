"""Ids of a lower-case vocabulary with word ends, looked up by runs of text and by words.

White space only separates words in such a vocabulary, so a text's ids are those of its
runs between white space, and a run's are those of the matches of the vocabulary's pattern.
"""

import json
import os
import re
import struct
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

from turnout.llm.chunks import LETTER_OF, Kept, joined, special_names
from turnout.llm.worker import kept

VOCABULARY = "word_bpe_49k.json"
#: Words of a generation that a worker remembers, and runs.
WORDS, RUNS = 300_000, 500_000

#: Separators that Python splits at and the vocabulary's pattern does not.
_ODD = re.compile("[\x1c-\x1f]")
_FORMS = [struct.Struct(f"<{n}I").pack for n in range(17)]


class WordIds:
    """Ids of texts as little-endian unsigned 32-bit numbers, as the library gives them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        names = [t["content"] for t in spec["added_tokens"]]
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.pattern = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        self.spaced = regex.compile(f"(?:{self.pattern.pattern})| ")
        self.special = special_names(path)
        self.hint = os.path.commonprefix(names)  # quick to look for
        self.words = Kept(self._words, WORDS)
        self.runs = Kept(self._runs, RUNS)

    def whole(self, text: str) -> bytes:
        """A text at once, by the library."""
        (found,) = self.library.encode_batch_fast([text], add_special_tokens=False)
        return np.asarray(found.ids, "<u4").tobytes()

    def _words(self, words: list[str]) -> list[bytes]:
        # The library's model takes the letters that stand for the bytes of one word; 255 is in no text's bytes.
        raw = np.frombuffer("\udcff".join(words).encode("utf-8", "surrogateescape"), np.uint8)
        letters = LETTER_OF[raw].tobytes().decode("utf-16-le")
        tokenize = self.model.tokenize
        out = []
        for word in letters.split("\xff") if words else []:
            found = [t.id for t in tokenize(word)]
            out.append(_FORMS[len(found)](*found) if len(found) < len(_FORMS) else np.asarray(found, "<u4").tobytes())
        return out

    def _parts_of_all(self, runs: list[str]) -> list[list[str]]:
        """The words of each run; runs below the first combining marks go through the pattern in one text."""
        parts, low = [], []
        for run in runs:
            if run.isascii() or max(run) < "\u0250":
                run = run.lower()
                if not run.isalpha():
                    low.append(run)
                    run = None
                parts.append([run] if run else None)
            else:
                parts.append(self.pattern.findall(self.library.normalizer.normalize_str(run)))
        found = [[]]
        for word in self.spaced.findall(" ".join(low)):
            if word == " ":
                found.append([])
            else:
                found[-1].append(word)
        rest = iter(found)
        return [next(rest) if p is None else p for p in parts]

    def _runs(self, runs: list[str]) -> list[bytes]:
        parts = self._parts_of_all(runs)
        self.words.learn(set(chain.from_iterable(parts)))
        get = self.words.__getitem__
        return [get(p[0]) if len(p) == 1 else b"".join(map(get, p)) for p in parts]

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        cut = [not (_ODD.search(t) or self.hint in t and self.special.search(t)) if t else False for t in texts]
        held = pa.array([t for t, c in zip(texts, cut, strict=True) if c], pa.large_string())
        found = iter(joined(pc.utf8_split_whitespace(held), self.runs))
        return [next(found) if c else self.whole(t) if t else b"" for t, c in zip(texts, cut, strict=True)]


def word_ids(path: str | None = None) -> WordIds:
    """One for each Python worker."""
    path = path or public_tokenizers.path(VOCABULARY)
    return kept(("word ids", path), lambda: WordIds(path))
