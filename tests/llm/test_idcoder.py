import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from textsift.llm import idcoder as C


def round_trip(ids, n):
    blocks = np.array_split(np.asarray(ids, np.uint32), n)
    coded = C.encode(blocks)
    got = C.decode(coded, [len(b) for b in blocks])
    assert np.array_equal(np.concatenate(got), np.asarray(ids, np.uint32))
    return sum(len(a) + len(c) for a, c in coded)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 5), st.integers(0, 2**32 - 1)), min_size=8, max_size=400), st.integers(1, 8))
def test_round_trip(ids, n):
    round_trip(ids, n)


def test_compresses_repetition_and_uniform():
    rng = np.random.default_rng(0)
    uniform = rng.integers(0, 49408, 20000)
    assert round_trip(uniform, 5) < 2.3 * 2 * len(uniform)
    assert round_trip(np.tile(rng.integers(0, 49408, 40), 500), 3) < 3000
    assert round_trip(np.full(20001, 7), 3) < 900
    skew = np.minimum(rng.zipf(1.3, 20000), 40000)
    assert round_trip(skew, 4) < 2 * len(skew)


def test_runs_up_to_the_confidence_limits():
    a = np.array([1, 2, 3] * 3000 + [4, 2, 3, 1] * 1000 + list(range(3000)))
    round_trip(a, 7)


def test_carries_run_through_the_code():
    """Long blocks of likely and unlikely ids in turn: the code's carries reach units put out before."""
    rng = np.random.default_rng(1)
    for odds in (0.01, 0.3, 0.9):
        ids = np.where(rng.random(60000) < odds, rng.integers(0, 1 << 20, 60000), 7)
        round_trip(ids, 31)
    assert C.encode([np.zeros(1, np.uint32)])[0][1] and round_trip([5], 1) < 16
