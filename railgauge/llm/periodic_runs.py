"""Periodic runs of words by seed and extend: k-grams that every run must repeat, widened along their lag.

A run of smallest period q and at least 4 * q words agrees with itself q words later over 3 * q words or
more, so for lags up to k, k-grams with k at most 3 times the least lag are guaranteed to lie in that
overlap. Levels k = 5, 15, 45, ... therefore cover the lags 1-5, 6-15, 16-45, ...; a level's k-grams are
hashed from three of the level before. As k is never below the lag, a k-gram's next occurrence in a run
is exactly one period away, so a text's pairs of neighbouring occurrences are all the seeds there are: never
more than its words, however often one k-gram occurs. A seed is widened to both sides along its lag, and
a table of how far each lag is covered keeps a stretch from being widened again.

A text is looked at whole inside the scan; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import Words, mix, shingle_hashes, slices, words_of

FIRST_K = 5
RUNS = "array<struct<start: long, length: long, period: long>>"
WORDS = "[^\\x20\\x09-\\x0D]+"


def least_length(period, least: int = 6, times: int = 4):
    """The words that a run of a period needs."""
    return np.maximum(least, times * period)


def _agreeing(hashes: np.ndarray, a: int, b: int, most: int, step: int) -> int:
    """How many words from a and b on are equal, forwards (step 1) or backwards (step -1), up to `most`."""
    done, size = 0, 16
    while done < most:
        size = min(size, most - done)
        i, j = a + step * done, b + step * done
        if step > 0:
            differ = np.flatnonzero(hashes[i : i + size] != hashes[j : j + size])
        else:
            differ = np.flatnonzero(hashes[i - size + 1 : i + 1][::-1] != hashes[j - size + 1 : j + 1][::-1])
        if len(differ):
            return done + int(differ[0])
        done += size
        size *= 4
    return done


def _seeds(keys: np.ndarray, at: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Position and lag of the neighbouring occurrences of equal keys, by lag and position.

    Of seeds at consecutive positions and one lag only the first is left: its widening covers the others.
    """
    order = np.argsort(keys, kind="stable")
    keys, at = keys[order], at[order]
    lag = np.diff(at)
    use = (keys[1:] == keys[:-1]) & (lag >= low) & (lag <= high)
    at, lag = at[:-1][use], lag[use]
    order = np.lexsort((at, lag))
    at, lag = at[order], lag[order]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (lag[1:] != lag[:-1]) | (at[1:] != at[:-1] + 1)
    return at[new], lag[new]


def find_runs(words: Words, least: int = 6) -> np.ndarray:
    """Rows of text, start, length, period: start is a word number in the text; by text, start and period."""
    hashes, owner = words.hashes(), words.owner()
    first, last = words.first[:-1][owner], words.first[1:][owner]
    left = last - np.arange(len(owner))
    found = []
    grams = np.zeros(len(hashes), dtype=np.uint64)
    level = shingle_hashes(hashes, FIRST_K)
    grams[: len(level)] = level
    salt = mix(owner.astype(np.uint64) + np.uint64(1))
    k, low = FIRST_K, 1
    at = np.flatnonzero((left >= k) & (last - first >= least))
    while len(at):
        covered: dict[int, int] = {}
        for i, lag in zip(*(x.tolist() for x in _seeds(grams[at] ^ salt[at], at, low, k)), strict=True):
            if i < covered.get(lag, 0):
                continue
            begin = i - _agreeing(hashes, i - 1, i + lag - 1, i - int(first[i]), -1)
            end = i + lag + k
            end += _agreeing(hashes, end - lag, end, int(last[i]) - end, 1)
            covered[lag] = end - lag
            if end - begin >= least_length(lag, least):
                found.append((int(owner[i]), begin - int(first[i]), end - begin, lag))
        low, wider = k + 1, 3 * k
        # A text too short for a run of the next level's least lag is done.
        at = at[(left[at] >= wider) & (last[at] - first[at] >= 4 * low)]
        grams[at] = mix((grams[at] * np.uint64(3) + grams[at + k]) * np.uint64(5) + grams[at + 2 * k])
        k = wider
    return np.array(sorted(found, key=lambda r: (r[0], r[1], r[3])), dtype=np.int64).reshape(-1, 4)


def _without(words: Words, dropped: np.ndarray) -> pa.Array:
    """The texts' words that are not dropped, joined by one space."""
    keep = np.flatnonzero(~dropped)
    owner = words.owner()[keep]
    more = np.zeros(len(keep), dtype=np.int64)
    more[:-1] = owner[1:] == owner[:-1]
    starts, ends = words.starts[keep], words.ends[keep]
    data = np.append(words.data, np.uint8(0x20))
    data[ends[more == 1]] = 0x20
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends + more, -1)
    data = data[np.cumsum(inside[:-1], dtype=np.int8) > 0]
    sizes = np.bincount(owner, weights=ends - starts + more, minlength=words.texts)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    return pa.LargeStringArray.from_buffers(words.texts, buffers[1], buffers[2]).cast(pa.string())


def _runs(least: int):
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = words_of(part.column("text"))
                runs = find_runs(words, least)
                begins = words.first[:-1][runs[:, 0]] + runs[:, 1]
                change = np.zeros(len(words.starts) + 1, dtype=np.int64)
                np.add.at(change, begins + runs[:, 3], 1)
                np.add.at(change, begins + runs[:, 2], -1)
                fields = pa.StructArray.from_arrays([pa.array(runs[:, c]) for c in (1, 2, 3)], fields=list(kind.value_type))
                offsets = np.searchsorted(runs[:, 0], np.arange(words.texts + 1)).astype(np.int32)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"),
                        "n_words": pa.array(np.diff(words.first), pa.int64()),
                        "runs": pa.ListArray.from_arrays(pa.array(offsets), fields, type=kind),
                        "collapsed": _without(words, np.cumsum(change[:-1]) > 0),
                    }
                )

    return run


def periodic_runs(docs: DataFrame, least: int = 6) -> DataFrame:
    """Per row of docs (doc_id long, text): doc_id, n_words, runs, collapsed.

    Words are runs of characters other than space and \\x09-\\x0D. A run is a stretch of words with smallest
    period q and at least max(least, 4 * q) words that no neighbouring word extends; runs are in order of start
    and period. `collapsed` has the words that no run contains after its first q, joined by one space.
    A null or empty text, or one of white space, has no words, no runs and an empty `collapsed`. Rows that
    share a doc_id, or have none, are looked at one by one. Texts of any length are taken whole; memory
    is in proportion to a 4 MB slice or the longest text. An empty table gives no rows. Other columns are
    ignored. `least` is 6 or more.
    """
    if least < 6:
        raise ValueError("runs need 6 words or more: shorter ones may not repeat a gram of 5")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_runs(least), f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def looped(words: Column, start: Column, period: Column) -> Column:
    """The words, joined by one space, with each from `start` on (below their number) taken from the first `period` of them."""

    def repeat(bound: Column) -> Column:
        words, start, period = bound["words"], bound["start"], bound["period"]
        numbers = F.sequence(F.lit(0).cast("long"), F.greatest(F.size(words) - 1, F.lit(0)).cast("long"))
        source = lambda i: F.when(i < start, i).otherwise(start + F.pmod(i - start, period))
        return F.array_join(F.transform(numbers, lambda i: F.get(words, source(i).cast("int"))), " ")

    # An array of one element binds the three, so that they are not worked out again for each word.
    bound = F.struct(words.alias("words"), start.alias("start"), period.alias("period"))
    return F.get(F.transform(F.array(bound), repeat), F.lit(0))


def with_loops(docs: DataFrame) -> DataFrame:
    """doc_id, text, where a tenth of the documents, chosen by their id, end in a loop of their own words.

    With h the unsigned crc32 of the decimal id: where h % 10 is 0, g is h / 10 and n the number of words, the
    words from a = g % n on repeat with period 1 + (n - a) / (3 + g % 8), divisions rounded down. A row
    without doc_id or without words keeps its text.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def loop(words: Column) -> Column:
        n = F.size(words).cast("long")
        start = F.pmod(g, F.greatest(n, F.lit(1).cast("long")))
        return F.when(n > 0, looped(words, start, 1 + F.floor((n - start) / (3 + g % 8)).cast("long")))

    words = F.regexp_extract_all("text", F.lit(WORDS), F.lit(0))
    text = F.when(h % 10 == 0, F.get(F.transform(F.array(words), loop), F.lit(0)))
    return rows.select("doc_id", F.coalesce(text, F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (ties: smallest start, then period), and digests of the runs and of the rest."""
    key = lambda r: F.struct((-r["length"]).alias("a"), r["start"].alias("b"), r["period"].alias("c"))
    best = F.array_min(F.transform("runs", key))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    rows = found.select("*", best.alias("best"))
    length, period = -F.col("best.a"), F.col("best.c")
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.b").alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("1000 * -best.a div best.c").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
