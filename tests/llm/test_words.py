import tracemalloc

import numpy as np

from txgraph.llm.words import block_hashes


def hashes(texts):
    data = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, data)])
    return block_hashes(np.frombuffer(b"".join(data), np.uint8), offsets)


def test_words_are_told_apart_and_never_cross_texts():
    long = "ab" * 40_000
    texts = ["", "One two", "ONE", "a\tb\x0bc  d\r\n", "", "abcdefgh abcdefghi abcdefgh\u00e9", long, long + "c", "d" + long, "e", "f ", " g", ""]
    got, before = hashes(texts)
    words = [w for t in texts for w in t.encode().split()]
    lowered = [w.lower() for w in words]
    assert np.diff(before).tolist() == [len(t.encode().split()) for t in texts] and before[-1] == len(words) == len(got)
    assert len(set(got.tolist())) == len(set(lowered)) and got[0] == got[2]
    alone = [int(hashes([w.decode()])[0][0]) for w in words]
    assert alone == got.tolist()
    assert hashes(["", " "])[0].tolist() == [] and hashes([])[1].tolist() == [0]


def test_memory_goes_with_words_and_not_with_bytes():
    data = np.frombuffer(b"lengthy words of a text " * 40_000, np.uint8)
    tracemalloc.start()
    block_hashes(data, np.array([0, len(data)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 * len(data)
