import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from railgauge.llm import tokenizing
from railgauge.llm.common import cut
from railgauge.llm.packing import _numbered, difference, divide, pack
from railgauge.llm.queries import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")


def test_differencing_balances():
    rng = random.Random(2)
    sizes = [rng.randint(1, 400) for _ in range(200)]
    part = difference(sizes, 8)
    sums = np.bincount(part, weights=sizes, minlength=8)
    assert sums.sum() == sum(sizes) and sums.max() - sums.min() <= 3


def test_windows_rise_until_all_fit():
    assert [sorted(p) for p in divide([3, 3, 3], 4)] == [[0], [1], [2]]
    assert divide([], 4) == []
    sizes = [random.Random(i).randint(1, 4095) for i in range(300)]
    parts = divide(sizes, 4096)
    assert sorted(i for p in parts for i in p) == list(range(300))
    assert all(sum(sizes[i] for i in p) <= 4096 for p in parts)
    assert len(parts) <= 1.05 * sum(sizes) / 4096 + 1


@pytest.mark.parametrize("window", [4096, 64])
def test_round_trip(table, awkward, window):
    library = tokenizing.load(PATH)
    rows = [r.asDict() for r in pack(table(awkward), PATH, window=window).collect()]
    expected = defaultdict(list)
    for doc_id, text in awkward:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        for at in range(0, len(ids), window):
            piece = np.array(ids[at : at + window], "<u4").tobytes()
            expected[doc_id].append((at, len(piece) // 4, zlib.crc32(piece), len(ids)))
    found = defaultdict(list)
    for r in rows:
        found[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in expected.items()}
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window


def test_little_padding(spark, sf_dir):
    from railgauge.llm.queries import op2_packing

    rows = op2_packing(spark, sf_dir).select("sequence_id", "length").toPandas().groupby("sequence_id")["length"].sum()
    assert (4096 - rows).sum() <= 0.03 * 4096 * len(rows) + 4096


def test_batches_are_dealt_evenly(spark):
    """Many small partitions and a power of two of batches: every batch gets its share."""
    pieces = cut(spark.range(4096).repartition(400))
    numbered = _numbered(pieces)
    assert sorted(r["number"] for r in numbered.collect()) == list(range(4096))
    sizes = [r["count"] for r in numbered.selectExpr("number % 512 as batch").groupBy("batch").count().collect()]
    assert len(sizes) == 512 and set(sizes) == {8}


def test_no_rows(table):
    assert pack(table([]), PATH).collect() == []
