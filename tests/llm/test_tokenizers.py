"""Byte-pair encodings, counts and token blocks against the libraries."""

import gc
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tests.llm.helpers import corpus, table
from turnout.llm import byte_pairs as bp, chunks as ck, token_blocks as tb, token_counts as tc

ODD = [
    "a", "aa", "the", " ", "  ", "\n", "\t", "é", "ß", "'s", "'re", "12", "3", "<|endoftext|>", "…", "日本",
    "🙂", "İ", "Σ", "é", " ", "\x1c", "!!", "==", "ing", " \n", "ſ", "ǅ", "\x85", "Ⅷ", "Ġ",
]


def texts():
    rng = random.Random(1)
    made = ["".join(rng.choices(ODD, k=rng.randrange(25))) for _ in range(400)]
    return made + ["a" * 3000, "ab" * 900, " " * 70, "=-" * 200, "word " * 3000]


def rows():
    return corpus() + list(enumerate(texts(), 5000))


def test_byte_pairs(spark):
    ranks = bp.read_ranks(public_tokenizers.path(bp.RANKS))
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = []
    for doc_id, text in rows():
        ids = np.asarray(library.encode_ordinary(text or ""), "<u4")
        expected.append((doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                         hashlib.sha256((text or "").encode()).hexdigest()))
    df = table(spark, rows(), "ids", "n_tokens")
    assert sorted(map(str, map(tuple, bp.byte_pairs(df, digest=True).collect()))) == sorted(map(str, expected))
    back = bp.byte_pairs(df.limit(5)).collect()
    assert [r.decoded for r in back] == [t or "" for _, t in rows()[:5]]
    assert bp.byte_pairs(table(spark, [])).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.binary(min_size=1, max_size=40).filter(lambda b: len(set(b)) < 8))
def test_pieces_merge_as_by_rank(piece):
    own, _ = bp.encoder(public_tokenizers.path(bp.RANKS))
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda i: own.ranks.get(parts[i] + parts[i + 1], bp.NEVER))
        if parts[best] + parts[best + 1] not in own.ranks:
            break
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    assert own.piece(piece) == [own.ranks[p] for p in parts]


def test_token_counts(spark):
    library = Tokenizer.from_file(public_tokenizers.path(tc.VOCABULARY))
    expected = []
    for doc_id, text in rows():
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        expected.append((doc_id, len((text or "").encode()), n, n > 2048))
    df = table(spark, rows(), "n_tokens")
    assert sorted(map(str, map(tuple, tc.token_counts(df).collect()))) == sorted(map(str, expected))
    assert any(e[3] for e in expected)
    assert tc.token_counts(table(spark, [])).collect() == []


def test_token_blocks(spark):
    library = Tokenizer.from_file(public_tokenizers.path(tb.VOCABULARY))
    order = sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    expected, start = [], 0
    for doc_id, text in order:
        ids = np.asarray([*library.encode(text or "", add_special_tokens=False).ids, tb.END], "<u4")
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), ids.tolist()))
        start += len(ids)
    found = [tuple(r) for r in tb.token_blocks(table(spark, rows(), "part", "seq", "base")).collect()]
    assert sorted(found, key=lambda r: r[1]) == expected
    assert tb.token_blocks(table(spark, [])).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=1600))
def test_blocks_round_trip(ids):
    packed = tb.pack(np.asarray(ids, np.uint32))
    assert tb.unpack(packed).tolist() == ids
    n, starts = tb.block_starts(packed)
    for i, at in enumerate(starts.tolist()):  # any block by itself
        part = ids[i * tb.BLOCK : (i + 1) * tb.BLOCK]
        assert tb.unpack_block(packed, at, len(part)).tolist() == part


def test_outliers_do_not_widen_a_block():
    ids = np.arange(512, dtype=np.uint32) % 16
    narrow = len(tb.pack(ids))
    ids[[3, 77]] = 50_000
    assert len(tb.pack(ids)) == narrow + 2 * 6


def test_pieces_of_chunks_in_one_text():
    chunks = [c for t in texts() if ck.cut_at_spaces(t) for c in t.split(" ")[1:]]
    chunks += ["word", "Zuüein,", "x's", "12a\nb", "la.\nCiónra", "end\n", "&&&", "日本", "ǅ"]
    assert ck.pieces_of(chunks) == [ck.PIECES.findall(f" {c}") for c in chunks]
    assert ck.pieces_of([]) == []


def test_a_piece_is_encoded_once_for_all_chunks():
    own = bp.Encoder(bp.read_ranks(public_tokenizers.path(bp.RANKS)))
    seen, piece = [], own.piece
    own.piece = lambda raw: seen.append(raw) or piece(raw)
    by_chunk = ck.ByChunk(own.encode, ck.by_pieces(own.pieces, 100), most=100)
    texts = ["a house, house. house!", "my house; house,", None, "", "  two  spaces"]
    found = by_chunk(texts)
    assert seen.count(b" house") == 1
    assert found == [own.encode(t or "") for t in texts]


def test_full_memos_give_the_same_ids():
    own = bp.Encoder(bp.read_ranks(public_tokenizers.path(bp.RANKS)))
    by_chunk = ck.ByChunk(own.encode, ck.by_pieces(own.pieces, 5), most=5)
    some = [t or "" for _, t in rows()]
    for start in range(0, len(some), 7):
        assert by_chunk(some[start : start + 7]) == [own.encode(t) for t in some[start : start + 7]]


def test_results_are_made_once_and_looked_up_in_one_pass():
    made = []
    memo = ck.Kept(lambda keys: made.extend(keys) or [k.encode() for k in keys], 3)
    assert memo.results(["a", "b"]) == [b"a", b"b"]
    assert memo.results(["b", "c"]) == [b"b", b"c"] and made == ["a", "b", "c"]
    assert memo.results(["d", "a", "c"]) == [b"d", b"a", b"c"]  # a new generation
    assert made == ["a", "b", "c", "d"] and set(memo) == {"d", "a", "c"}
    assert memo.results([]) == []


def test_no_search_for_cycles_while_texts_are_encoded():
    enabled = []
    by_chunk = ck.ByChunk(str.encode, lambda chunks: [enabled.append(gc.isenabled()) or b"1234" for _ in chunks])
    assert by_chunk(["a b c"]) == [b"a12341234"]
    assert enabled == [False, False] and gc.isenabled()


def test_white_space_beside_spaces_in_ascii_and_other_texts():
    for code in range(0x3000 + 1):
        for text in (f"a{chr(code)}b", f"a{chr(code)}é"):
            assert ck.cut_at_spaces(text) == (not chr(code).isspace() or chr(code) in " \n")


def test_kept_words_are_encoded_together_and_stay_bounded():
    texts = []

    def encode(text):  # an id for each byte; "xy z" as one
        texts.append(text)
        raw = text.encode().replace(b"xy z", b"\xff")
        return np.frombuffer(raw, np.uint8).astype("<u4")

    lengths = np.ones(256, np.int64)
    lengths[255] = 4
    words = ck.KeptWords(encode, lengths, re.compile("q r"), 5)

    def ids(*keys):
        starts, sizes, every = words.located(pa.array(keys, pa.large_string()))
        return [bytes(every[a : a + n].astype(np.uint8)).decode() for a, n in zip(starts, sizes)]

    assert ids("a", "é", "") == [" a", " é", " "] and texts == [" a é "]
    assert ids("b", "a") == [" b", " a"] and texts[1:] == [" b"]
    assert ids("xy", "zz", "a") == [" xy", " zz", " a"]  # a piece lies over both, so each is encoded by itself
    assert len(words.keys) == 3 and texts[2:] == [" xy zz", " xy", " zz"]
    assert ids("q", "r") == [" q", " r"] and texts[5:] == [" q", " r"]
    assert ids("a", "zz") == [" a", " zz"] and len(texts) == 7 and ids() == []
