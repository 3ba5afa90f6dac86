"""Token counts by byte-pair merging with a heap and a linked list; no ids are made.

Each word starts as a list of symbols.  The heap holds adjacent pairs by rank and place; the
lowest is popped again and again, its two symbols become one, and the pairs with its neighbours
are pushed.  The count is the number of symbols less the number of merges.
"""

import heapq
import json
import os
import re

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from turnout.llm.chunks import TOGETHER, Kept
from turnout.llm.worker import kept

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
SHIFT = 20  # bits of a symbol in a pair
PLACE = (1 << 40) - 1
#: Words of a generation that a worker remembers, and runs of text.
WORDS, CHUNKS = 250_000, 250_000

#: Separators that Python splits at and the vocabulary's pattern does not.
_ODD = re.compile("[\x1c-\x1f]")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if printable, else one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Counter:
    """Counts the tokens of texts by a vocabulary file with lower case and word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, pre = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        self.library = Tokenizer.from_file(path)
        self.pattern = regex.compile(pre[0]["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        names = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, names)) or r"(?!)")
        self.hint = os.path.commonprefix(names)  # quick to look for
        number = model["vocab"]
        letters, end = _byte_letters(), model["end_of_word_suffix"] or ""
        self.inner = [number[letters[b]] for b in range(256)]
        self.last = [number[letters[b] + end] for b in range(256)]
        self.rank, self.made = {}, []
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.rank[number[a] << SHIFT | number[b]] = rank
            self.made.append(number[a + b])
        self.known = Kept(lambda words: [self.word(w.encode("utf-8", "replace")) for w in words], WORDS)
        self.kept = Kept(self._chunks, CHUNKS)

    def word(self, data: bytes) -> int:
        """Symbols less merges of one word."""
        size = len(data)
        symbols = [self.inner[b] for b in data[:-1]] + [self.last[data[-1]]]
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        rank, merges = self.rank, 0
        heap = []
        for i in range(size - 1):
            r = rank.get(symbols[i] << SHIFT | symbols[i + 1])
            if r is not None:
                heap.append(r << 40 | i)
        heapq.heapify(heap)
        while heap:
            top = heapq.heappop(heap)
            r, i = top >> 40, top & PLACE
            j = after[i]
            # Entries whose symbols have changed meanwhile are stale.
            if j >= size or symbols[i] < 0 or rank.get(symbols[i] << SHIFT | symbols[j]) != r:
                continue
            symbols[i], symbols[j] = self.made[r], -1
            merges += 1
            k = after[i] = after[j]
            if k < size:
                before[k] = i
                new = rank.get(symbols[i] << SHIFT | symbols[k])
                if new is not None:
                    heapq.heappush(heap, new << 40 | i)
            h = before[i]
            if h >= 0:
                new = rank.get(symbols[h] << SHIFT | symbols[i])
                if new is not None:
                    heapq.heappush(heap, new << 40 | h)
        return size - merges

    def _words(self, chunk: str) -> list[str]:
        # Below the first combining marks there is nothing to compose.
        if chunk.isascii() or max(chunk) < "\u0250":
            low = chunk.lower()
            return [low] if low.isalpha() else self.pattern.findall(low)
        return self.pattern.findall(self.library.normalizer.normalize_str(chunk))

    def _chunks(self, chunks: list[str]) -> list[int]:
        """Tokens of runs of text, from those of their words; white space only separates words."""
        words = list(map(self._words, chunks))
        self.known.learn(set().union(*words))
        get = self.known.__getitem__
        return [sum(map(get, w)) for w in words]

    def chunk(self, chunk: str) -> int:
        """Tokens of one run of text."""
        return self._chunks([chunk])[0]

    def __call__(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text; those of its words are looked up, or made if they are new."""
        counts, words = [], []
        for text in texts:
            parts = [text or ""]
            if self.hint in parts[0]:
                parts = self.special.split(parts[0])
            odd, plain = [], []
            for part in parts:
                (odd if _ODD.search(part) else plain).append(part)
            counts.append(len(parts) - 1 + sum(map(self.chunk, odd)))
            words.append([w for part in plain for w in part.split()])
        self.kept.learn(set().union(*words))
        get = self.kept.__getitem__
        return [n + sum(map(get, w)) for n, w in zip(counts, words, strict=True)]


def counter(path: str) -> Counter:
    """One for each Python worker."""
    return kept(("token counts", path), lambda: Counter(path))


def _counted(path: str, limit: int):
    def run(batches):
        count = counter(path)
        for batch in batches:
            tokens = []
            for start in range(0, batch.num_rows, TOGETHER):
                tokens += count(batch.column("text").slice(start, TOGETHER).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(tokens, pa.int64()),
                 pa.array([n > limit for n in tokens], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return run


def token_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    vocabulary: str | None = None, limit: int = LIMIT,
) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` for each row.

    No begin, end or padding tokens and no truncation; the name of a special token inside a
    text counts as that one token.  A null or empty text has none.  Rows that repeat each other or
    lack an id are counted one by one; other columns are ignored.  Texts of any length are counted whole, and an
    empty table gives no rows.  ``vocabulary`` is a file that all machines can read.
    """
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    ).withColumn("n_bytes", F.coalesce(F.octet_length("text").cast("long"), F.lit(0).cast("long")))
    return texts.mapInArrow(
        _counted(vocabulary or public_tokenizers.path(VOCABULARY), limit),
        "doc_id long, n_bytes long, n_tokens long, over_limit boolean",
    )
