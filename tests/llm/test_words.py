import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import plain_words  # tests/llm comes first on the path

from skillframe.llm import words


@pytest.mark.parametrize("slice_bytes", [1, 50, 1 << 20])
@pytest.mark.parametrize("lower", [True, False])
def test_equal_words_have_equal_hashes_and_others_do_not(monkeypatch, rows, slice_bytes, lower):
    monkeypatch.setattr(words, "SLICE_BYTES", slice_bytes)
    texts = [r[1] for r in rows]
    got = [p.hashes[a:b].tolist() for p in words.slices(pa.array(texts).slice(0), lower) for a, b in zip(p.bounds[:-1], p.bounds[1:], strict=True)]
    there, back = {}, {}
    for text, hashes in zip(texts, got, strict=True):
        expected = plain_words(text, lower)
        assert len(expected) == len(hashes)
        for word, number in zip(expected, hashes, strict=True):
            assert there.setdefault(word, number) == number and back.setdefault(number, word) == word


def test_grams_and_whole_texts_do_not_depend_on_place():
    draw = random.Random(1)
    few = [["a", "b", "c", "d", "e", "f"][draw.randrange(6)] for _ in range(400)]
    part = next(words.slices(pa.array([" ".join(few), "a b c", "x a b c", "a b c"]), False))
    gram = words.grams(part.hashes, 3)
    places, doc = words.inside(part.bounds, 3)
    texts = {}
    everything = few + ["a", "b", "c", "x", "a", "b", "c", "a", "b", "c"]
    for p in places:
        assert texts.setdefault(tuple(everything[p : p + 3]), gram[p]) == gram[p]
    assert len(set(texts.values())) == len(texts)
    assert np.bincount(doc).tolist() == [398, 1, 2, 1]
    whole = words.whole(part.hashes, part.bounds)
    assert whole[1] == whole[3] and len(set(whole.tolist())) == 3


def test_empty_batches():
    assert list(words.slices(pa.array([], pa.string()), True)) == []
    part = next(words.slices(pa.array([None, ""], pa.string()), True))
    assert part.counts.tolist() == [0, 0] and len(words.grams(part.hashes, 5)) == 0
