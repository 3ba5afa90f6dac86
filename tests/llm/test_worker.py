"""What a Python worker keeps between tasks."""

import gc
import weakref

import public_tokenizers
import pytest

from turnout.llm import byte_pairs, jaccard_join, substrings, token_counts, toxicity



def encoder():
    return weakref.ref(byte_pairs.encoder(public_tokenizers.path(byte_pairs.RANKS))[0])


def test_an_operator_keeps_its_own():
    one = encoder()
    assert one() is byte_pairs.encoder(public_tokenizers.path(byte_pairs.RANKS))[0]


@pytest.mark.parametrize("task", [
    jaccard_join._mapper(5, False), substrings._partial_sketches(1 << 10), toxicity._featured,
    token_counts._counted(public_tokenizers.path(token_counts.VOCABULARY), 10),
])
def test_a_task_drops_what_other_operators_kept(task):
    one = encoder()
    list(task(iter([])))
    gc.collect()
    assert one() is None
