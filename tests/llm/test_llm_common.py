import numpy as np

from ebbline.llm.common import WordBlock, codes_of


def test_words_with_zero_bytes_stay_apart():
    words = WordBlock([b"\x00a \x00b \x00 a\x00 a \x00a", b"", b" "])
    assert words.codes.tolist() == [0, 1, 2, 3, 4, 0] and words.counts.tolist() == [6, 0, 0]


def test_codes_number_equal_keys():
    codes, distinct = codes_of(np.array([5, 3, 5, -1]))
    assert codes.tolist() == [0, 1, 0, 2] and distinct.tolist() == [5, 3, -1]
    assert len(codes_of(np.zeros(0, np.int64))[0]) == 0
