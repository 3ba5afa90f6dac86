"""Byte-level BPE, encoded in linear time by longest matches and backtracking.

Bytes are read as Latin-1 characters, so that one automaton finds all tokens in a piece.  The
encoding takes the longest token at each place that is compatible with the token before; at a dead
end it marks the place, drops the last token and tries the next shorter one.  Two tokens
are compatible if merging their bytes together leaves the border between them: no suffix of the
first and prefix of the second, in existence at the same time, merge before one of them is merged
inside its own token.  A row of tokens in which all neighbours are compatible is the one that
merging by rank gives.
"""

import base64
import hashlib
from array import array

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from turnout.llm.chunks import PIECES, ByChunk, Memo, by_pieces, together
from turnout.llm.worker import kept

NEVER = 1 << 62
PAIRS = 1_000_000  # compatibilities that a worker remembers
#: Pieces and chunks of a generation that a worker remembers, and characters encoded together.
PIECES_KEPT, CHUNKS_KEPT, LETTERS = 200_000, 150_000, 1 << 20
RANKS = "byte_bpe_multi_50k.tiktoken"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Encoder:
    """Encodes single pieces by a table of ranks; a merge makes the token of its rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self.automaton.make_automaton()
        self._spines = {}
        self._compatible = Memo(self._border_stays, PAIRS)

    def _halves(self, token: bytes) -> tuple[bytes, bytes]:
        """The two parts whose merge made the token."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best = min(
                range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], NEVER)
            )
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return tuple(parts)

    def _spine(self, token: int, side: int) -> list[tuple[bytes, int, int]]:
        """What stood at an edge of a token, last first: its bytes, made when, merged when."""
        key = 2 * token + side
        if key not in self._spines:
            part, until, spine = self.bytes_of[token], NEVER, []
            while True:
                made = -1 if len(part) == 1 else self.ranks[part]
                spine.append((part, made, until))
                if len(part) == 1:
                    break
                part, until = self._halves(part)[side], made
            self._spines[key] = spine
        return self._spines[key]

    def _border_stays(self, pair: tuple[int, int]) -> bool:
        for left, left_made, left_until in self._spine(pair[0], 1):
            for right, right_made, right_until in self._spine(pair[1], 0):
                if max(left_made, right_made) < min(left_until, right_until):
                    rank = self.ranks.get(left + right, NEVER)
                    # Of equal merges the one further left comes first.
                    if rank < left_until and rank <= right_until and rank < NEVER:
                        return False
        return True

    def piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        size = len(piece)
        at = [[] for _ in range(size)]  # tokens that start here, the longest last
        for last, found in self.automaton.iter(piece.decode("latin-1")):
            at[last + 1 - found[0]].append(found)
        alive = [True] * (size + 1)
        path = []  # places, tokens and how many shorter ones are left
        place, left = 0, len(at[0])
        while place < size:
            while left:
                length, token = at[place][left - 1]
                end = place + length
                left -= 1
                if alive[end] and (not path or self._compatible[path[-1][1], token]):
                    path.append((place, token, left))
                    place = end
                    left = len(at[place]) if place < size else 0
                    break
            else:
                alive[place] = False
                place, _, left = path.pop()
        return [token for _, token, _ in path]

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit numbers."""
        ids = array("I")
        for piece in PIECES.findall(text):
            ids.extend(self.piece(piece.encode("utf-8", "replace")))
        return np.asarray(ids, "<u4").tobytes()

    def pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of single pieces."""
        return [array("I", self.piece(piece.encode("utf-8", "replace"))).tobytes() for piece in pieces]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encoder(path: str) -> tuple[Encoder, ByChunk]:
    """One for each Python worker."""
    def make():
        own = Encoder(read_ranks(path))
        return own, ByChunk(own.encode, by_pieces(own.pieces, PIECES_KEPT), most=CHUNKS_KEPT)

    return kept(("byte pairs", path), make)


def _mapper(path: str, digest: bool):
    def run(batches):
        own, by_chunk = encoder(path)
        kinds = (pa.string(), pa.string()) if digest else (pa.list_(pa.int32()), pa.string())
        for doc_ids, texts in together(batches, LETTERS):
            held = ([], [], [], [])
            for doc_id, ids in zip(doc_ids, by_chunk(texts), strict=True):
                back = own.decode(ids)
                row = (doc_id, len(ids) // 4)
                if digest:
                    row += hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest()
                else:
                    row += np.frombuffer(ids, "<u4").astype(np.int32), back.decode("utf-8", "replace")
                for column, value in zip(held, row, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(held, (pa.int64(), pa.int64(), *kinds), strict=True)],
                _names(digest),
            )

    return run


def _names(digest: bool) -> list[str]:
    return ["doc_id", "n_tokens"] + (["ids_sha256", "decoded_sha256"] if digest else ["ids", "decoded"])


def byte_pairs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None,
    digest: bool = False,
) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` and ``decoded`` (or the SHA-256 of both) for each row.

    Every match of the pattern is encoded by itself, without special tokens: their names in a
    text are ordinary text.  A null or empty text has no ids.  Rows that repeat each
    other are encoded one by one, a row without an id too; other columns are ignored.  Texts of any length are
    encoded whole, and an empty table gives no rows.
    ``ranks`` is a file that all machines can read.
    """
    path = ranks or public_tokenizers.path(RANKS)
    schema = "doc_id long, n_tokens long, " + (
        "ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>, decoded string"
    )
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    ).mapInArrow(_mapper(path, digest), schema)
