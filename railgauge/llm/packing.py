"""Packing of token sequences into windows by Karmarkar-Karp multiway differencing.

Documents are tokenized in the scan and cut at multiples of the window; only the pieces' sizes move on.
Whole windows are done. The rests are dealt into batches of a bounded size, and each batch is divided
into k near-equal windows: every rest starts as a partition of k parts with one filled, and the two
partitions of the largest imbalance are merged again and again, the fullest part of one with the
emptiest of the other. k starts at the least possible number and rises while a window is too full.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokenizing
from .common import cut
from .words import slices

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PLACED = f"{PIECES}, sequence_id long, offset long"


class _WordIds(dict):
    """The ids of each word as little-endian 32-bit integers; forgotten beyond a number of words."""

    def __init__(self, tokenizer, most: int = 600_000, chunk: int = 4000) -> None:
        super().__init__()
        self.tokenizer, self.most, self.chunk = tokenizer, most, chunk

    def learn(self, words: set[str]) -> None:
        if len(self) > self.most:
            self.clear()
        new = list(words - self.keys())
        for at in range(0, len(new), self.chunk):
            some = new[at : at + self.chunk]
            # No word has white space in it, so each is one pre-token of the line.
            encoded = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ids = np.array(encoded.ids, dtype="<u4").tobytes()
            cuts = (4 * np.searchsorted(np.array(encoded.word_ids), np.arange(len(some) + 1))).tolist()
            self.update((word, ids[a:b]) for word, a, b in zip(some, cuts, cuts[1:], strict=False))


@lru_cache(maxsize=2)
def _known(path: str) -> _WordIds:
    """A worker keeps what it has learnt for its later tasks."""
    return _WordIds(tokenizing.load(path))


def _pieces(path: str, end_id: int, window: int):
    last = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known(path)
        tokenizer = known.tokenizer
        special = tokenizing.specials(tokenizer)
        for batch in batches:
            for part in slices(batch, "text"):
                texts = [t or "" for t in part.column("text").to_pylist()]
                words = [None if special is not None and special.search(t) else tokenizing.word_level_pieces(t) for t in texts]
                known.learn({w for found in words if found for w in found})
                rows = []
                for doc_id, text, found in zip(part.column("doc_id").to_pylist(), texts, words, strict=True):
                    if found is None:
                        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
                    else:
                        ids = b"".join(map(known.__getitem__, found))
                    ids += last
                    for at in range(0, len(ids), 4 * window):
                        piece = ids[at : at + 4 * window]
                        rows.append((doc_id, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4))
                names = [f.split()[0] for f in PIECES.split(", ")]
                yield pa.RecordBatch.from_pydict({n: pa.array(c, pa.int64()) for n, c in zip(names, zip(*rows, strict=True), strict=True)})

    return run


def difference(sizes: list[int], k: int) -> np.ndarray:
    """The part (0 to k - 1) of each size, with near-equal sums, by multiway differencing.

    A partition is its parts' sums in rising order. A merge notes the order into which its parts were
    sorted; walking the merges backwards then hands every part of the last partition down to the sizes.
    """
    heap = []
    for i, size in enumerate(sizes):
        sums = np.zeros(k, dtype=np.int64)
        sums[-1] = size
        heap.append((-size, i, sums))
    heapq.heapify(heap)
    merges = []
    while len(heap) > 1:
        _, a, sums = heapq.heappop(heap)
        _, b, other = heapq.heappop(heap)
        sums = sums + other[::-1]
        order = np.argsort(sums, kind="stable")
        sums = sums[order]
        sums -= sums[0]  # only differences matter from here on
        heapq.heappush(heap, (-int(sums[-1]), len(sizes) + len(merges), sums))
        merges.append((a, b, order))
    handed = {heap[0][1]: np.arange(k)} if heap else {}
    for number in range(len(merges) - 1, -1, -1):
        a, b, order = merges[number]
        given = np.empty(k, dtype=np.int64)
        given[order] = handed.pop(len(sizes) + number)
        handed[a], handed[b] = given, given[::-1]
    return np.array([handed[i][-1] for i in range(len(sizes))], dtype=np.int64)


def divide(sizes: list[int], window: int) -> list[list[int]]:
    """The fewest parts from the least possible number on for which differencing keeps to the window."""
    k = max(1, -(-sum(sizes) // window))
    while True:
        part = difference(sizes, k)
        if len(sizes) == 0 or np.bincount(part, weights=sizes).max() <= window:
            return [np.flatnonzero(part == p).tolist() for p in range(k) if (part == p).any()]
        k += 1


def _pack(window: int):
    def run(key: tuple, batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values(["doc_id", "start", "ids_crc32", "doc_tokens"], ignore_index=True)
        sizes = batch["length"].tolist()
        rests = [i for i, size in enumerate(sizes) if size < window]
        parts = [[i] for i, size in enumerate(sizes) if size == window]
        parts += [[rests[j] for j in part] for part in divide([sizes[i] for i in rests], window)]
        sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
        for number, part in enumerate(parts):
            at = 0
            for i in part:
                sequence[i], offset[i] = (int(key[0]) << 32) + number, at
                at += sizes[i]
        return batch.drop(columns="batch").assign(sequence_id=sequence, offset=offset)

    return run


def _numbered(pieces: DataFrame) -> DataFrame:
    """The rows of a checkpoint with consecutive numbers, so that dealing by number fills every batch alike.

    The checkpoint fixes which rows a partition has and their order, so numbers do not change when a task runs again.
    """
    own = F.monotonically_increasing_id()
    placed = pieces.withColumns({"task": F.shiftright(own, 33).cast("int"), "place": own.bitwiseAND((1 << 33) - 1)})
    sizes = sorted((row["task"], row["count"]) for row in placed.groupBy("task").count().collect())  # a row per partition
    firsts = np.cumsum([0, *(size for _, size in sizes)]).tolist()
    before = [(task, first) for (task, _), first in zip(sizes, firsts, strict=False)]
    offsets = pieces.sparkSession.createDataFrame(before, "task int, first long")
    return placed.join(F.broadcast(offsets), "task").withColumn("number", F.col("first") + F.col("place")).drop("task", "place", "first")


def pack(docs: DataFrame, tokenizer_path: str, window: int = 4096, end_id: int = 2, windows_in_batch: int = 128) -> DataFrame:
    """Per piece of docs (doc_id long, text): doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its text's ids without special tokens, then end_id; null and empty texts are end_id
    alone. It is cut at multiples of the window, and pieces fill sequences of at most `window` ids from
    offset 0 without gaps. ids_crc32 is taken over the piece's ids as little-endian 32-bit integers.
    Rows that share a doc_id, or have none, are packed one by one. Other columns are ignored. An empty
    table packs to no rows. windows_in_batch bounds the work of one group; the number of batches grows
    with the input.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = cut(rows.mapInArrow(_pieces(tokenizer_path, end_id, window), PIECES))
    rest = F.when(F.col("length") < window, F.col("length"))
    ids, count = pieces.agg(F.coalesce(F.sum(rest), F.lit(0)), F.count("*")).first()
    batches = max(1, -(-ids // (window * windows_in_batch)), -(-count // (window // 2)))
    dealt = _numbered(pieces).withColumn("batch", F.pmod("number", F.lit(batches))).drop("number")
    return dealt.groupBy("batch").applyInPandas(_pack(window), PLACED)
