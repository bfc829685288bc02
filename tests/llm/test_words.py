import random
import tracemalloc

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from weblake.llm import words as W

from . import helpers as H


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40)), max_size=8), st.integers(1, 64))
def test_words_of_blocks_are_the_words_of_texts(texts, limit):
    for pattern, table, low in ((H.PLAIN, W.PLAIN_WORD, False), (H.ALNUM, W.ALNUM_WORD, True)):
        got = []
        for block in W.blocks(pa.array(texts, pa.string()), limit):
            found = W.split(block, table, lower=low)
            data = W.LOWER[block.data] if low else block.data
            each = [data[a:b].tobytes().decode() for a, b in zip(found.starts, found.ends)]
            got += [each[a:b] for a, b in zip(found.bounds[:-1], found.bounds[1:])]
        assert got == [H.words(H.lower(t) if low else t, pattern) for t in texts]


def test_equal_words_have_equal_hashes_and_others_not():
    rng = random.Random(3)
    texts = [H.prose(rng, 500, 5000) for _ in range(20)]
    block = next(W.blocks(pa.array(texts)))
    found = W.split(block, W.PLAIN_WORD)
    each = [w for t in texts for w in t.split()]
    by_word = {}
    for w, h in zip(each, found.hashes.tolist()):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_windows_and_short_rows():
    block = next(W.blocks(pa.array(["a b c d e f", "a b c d e", "a b", "b c d e f", "", None, "a b"])))
    hashes, bounds = W.windows(W.split(block, W.PLAIN_WORD), 5)
    assert np.diff(bounds).tolist() == [2, 1, 1, 1, 0, 0, 1]
    assert hashes[0] == hashes[2] and hashes[1] == hashes[4] and hashes[3] == hashes[5] and len(set(hashes.tolist())) == 3


def test_slices_large_strings_and_empty_columns():
    column = pa.array(["x y", None, "z"], pa.large_string()).slice(1)
    assert [W.split(b, W.PLAIN_WORD).counts.tolist() for b in W.blocks(column)] == [[0, 1]]
    assert list(W.blocks(pa.array([], pa.string()))) == []
    assert [b.n for b in W.blocks(pa.nulls(2))] == [2]


def test_hashing_a_large_block_holds_little_whatever_its_size():
    rng = np.random.default_rng(5)
    data = rng.integers(97, 105, 3 << 20).astype(np.uint8)
    data[rng.choice(len(data), len(data) // 6, replace=False)] = 32
    data[(1 << 20):(1 << 20) + (1 << 18) + 9] = 97       # one long word
    block = W.Block(0, 1, data, np.array([0, len(data)]))
    found = W.split(block, W.PLAIN_WORD)
    kept = dict(W._powers)
    W._powers.update(up=np.ones(1, W.U64), down=np.ones(1, W.U64))
    tracemalloc.start()
    try:
        again = W.span_hashes(data, found.starts, found.ends)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        W._powers.update(kept)
    assert peak < 40 << 20                                    # 100.7 MB when the whole block was summed at once
    assert (again == found.hashes).all()
    for i in rng.choice(len(again), 200, replace=False).tolist():
        a, b = found.starts[i], found.ends[i]
        assert W.span_hashes(data[a:b], np.array([0]), np.array([b - a]))[0] == again[i]


def test_spans_out_of_order_or_inside_each_other_hash_like_single_ones():
    data = np.random.default_rng(6).integers(0, 256, 3 << 18).astype(np.uint8)
    for starts, ends in (([700_000, 5, 5], [700_009, 9, 700_000]), ([0, 1, 300_000], [600_000, 600_001, 600_002]), ([], [])):
        starts, ends = np.array(starts, np.int64), np.array(ends, np.int64)
        each = [W.span_hashes(data[a:b], np.array([0]), np.array([b - a]))[0] for a, b in zip(starts, ends)]
        assert W.span_hashes(data, starts, ends).tolist() == each
