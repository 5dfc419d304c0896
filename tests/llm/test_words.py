import numpy as np
import pyarrow as pa

from fieldlake.llm.words import PLAIN, SPACED, grams, hash_word, text_words
from helpers import odd_texts, plain, spaced


def test_words_and_grams_follow_the_texts():
    texts = [t for _, t in odd_texts()]
    for inside, cut in ((SPACED, spaced), (PLAIN, plain)):
        for most in (1 << 20, 16):
            seen = 0
            for first, hashes, places in text_words(pa.array(texts, pa.string()), inside, most):
                for k in range(len(places) - 1):
                    words = cut(texts[first + k])
                    own = hashes[places[k] : places[k + 1]]
                    assert len(own) == len(words)
                    assert own[:200].tolist() == [hash_word(w) for w in words[:200]]
                    seen += 1
                values, starts = grams(hashes, places, 3)
                for k in range(len(places) - 1):
                    words = cut(texts[first + k])
                    expected = max(len(words) - 2, 0) if len(words) >= 3 else min(len(words), 1)
                    assert starts[k + 1] - starts[k] == expected
                    named = {}
                    for gram, value in zip(zip(words, words[1:], words[2:]), values[starts[k] : starts[k + 1]].tolist()):
                        assert named.setdefault(gram, value) == value
                    assert len(set(named.values())) == len(named)
            assert seen == len(texts)


def test_slices_and_nulls_of_arrow_arrays():
    array = pa.array(["a b", None, "c", ""], pa.string()).slice(1)
    (first, hashes, places), = text_words(array)
    assert first == 0 and places.tolist() == [0, 0, 1, 1] and hashes.tolist() == [hash_word("C")]
    assert np.array_equal(hashes, np.array([hash_word("c")], dtype=np.uint64))
