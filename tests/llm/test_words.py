import random

import numpy as np
import pyarrow as pa

from railgauge.llm.words import shingle_hashes, slices, words_of


def test_words_are_those_of_the_bytes():
    texts = ["a  b\tc", None, "", "\x1cx y z\xa0w", " lead", "trail ", "ab", "AB ab"]
    words = words_of(pa.array(texts))
    expected = [(t or "").encode().split() for t in texts]
    got = [words.data[a:b].tobytes() for a, b in zip(words.starts, words.ends)]
    assert got == [w for ws in expected for w in ws]
    assert np.diff(words.first).tolist() == [len(ws) for ws in expected]


def test_hashes_know_words_wherever_they_stand():
    rng = random.Random(0)
    texts = [" ".join(rng.choice("abcDE") * rng.randint(1, 9) for _ in range(50)) for _ in range(40)]
    words = words_of(pa.array(texts))
    flat = [w for t in texts for w in t.encode().split()]
    assert len(set(words.hashes().tolist())) == len(set(flat))
    assert len(set(zip(flat, words.hashes().tolist()))) == len(set(flat))
    assert len(set(words.hashes(lower=True).tolist())) == len({w.lower() for w in flat})
    assert words_of(pa.array(texts).slice(3, 5)).hashes().tolist() == words_of(pa.array(texts[3:8])).hashes().tolist()


def test_shingles_tell_order():
    a = words_of(pa.array(["x y z", "z y x", "x y z"])).hashes()
    first, second, third = (shingle_hashes(a[i : i + 3], 3)[0] for i in (0, 3, 6))
    assert first == third != second
    assert len(shingle_hashes(a[:2], 3)) == 0


def test_slices_keep_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, None, "b" * 50, "c"]})
    parts = list(slices(batch, "text", 20))
    assert sum(p.num_rows for p in parts) == 4 and len(parts) == 3
