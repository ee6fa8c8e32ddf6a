"""Removal of passages that occur elsewhere, by suffix automata of reference shards.

A window is `span` consecutive words. Every window has an anchor: the first of its `anchor_words`-word
sequences with the least hash. Neighbouring windows of one anchor form a context, so each window lies
in exactly one context, and equal windows lie in contexts with equal anchors. Hence:

1. Contexts are listed as hashes, and those whose anchor occurs once are done: nothing in them repeats.
2. Where all contexts of an anchor are equal, all their windows repeat.
3. The other distinct contexts are the reference. The contexts of one anchor are a shard; its suffix
   automaton counts every subsequence, and the contexts streamed through it give the matching
   statistics from which the repeated windows are read. The reference grows with the corpus, so
   shards meet their contexts by key, not by a broadcast to all.
4. A shard of very many contexts (a short line used in many places) is not built in one task: its
   windows are counted by their 128-bit hashes, aggregated before the shuffle.

Words covered by a repeated window are removed from their documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automaton import SuffixAutomaton
from .common import cut, written
from .words import WORD_BASE, Words, mix, powers, shingle_hashes, slices, words_of

INVERSE = pow(WORD_BASE, -1, 1 << 64)
#: A place: first word (31 bits), number of windows (6 bits), part of the text's hash (26 bits).
KEY_BITS, COUNT_BITS = 26, 6


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The first position of the least of each `width` neighbours."""
    place = np.arange(len(values))
    done = 1
    while done < width:
        step = min(done, width - done)
        n = len(place) - step
        left, right = place[:n], place[step : step + n]
        place = np.where(values[left] <= values[right], left, right)
        done += step
    return place


def _contexts(words: Words, span: int, anchor_words: int) -> dict[str, np.ndarray]:
    """text, first word, number of windows, anchor and content hash of every context of a batch."""
    hashes = words.hashes()
    starts = np.arange(max(len(hashes) - span + 1, 0))
    owner = words.owner()[: len(starts)]
    inside = starts + span <= words.first[1:][owner]
    grams = shingle_hashes(hashes, anchor_words)
    least = _least(grams, span - anchor_words + 1)[: len(starts)] if len(starts) else starts
    starts, owner, least = starts[inside], owner[inside], least[inside]
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
    begin = np.flatnonzero(new)
    windows = np.diff(np.append(begin, len(starts)))
    first, owner, least = starts[begin], owner[begin], least[begin]
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * powers(WORD_BASE, len(hashes)), out=sums[1:])
    content = mix((sums[first + windows + span - 1] - sums[first]) * powers(INVERSE, len(hashes))[first] + windows.astype(np.uint64))
    return {"text": owner, "first": first, "windows": windows, "anchor": grams[least], "content": content}


def _list_contexts(span: int, anchor_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = words_of(part.column("text"))
                found = _contexts(words, span, anchor_words)
                doc, key = (part.column(c).to_numpy()[found["text"]] for c in ("doc_id", "text_key"))
                local = found["first"] - words.first[:-1][found["text"]]
                place = ((local << COUNT_BITS | found["windows"]) << KEY_BITS) | key
                yield pa.RecordBatch.from_pydict(
                    {"anchor": found["anchor"].view(np.int64), "content": found["content"].view(np.int64), "doc_id": doc, "place": place}
                )

    return run


def _cut_contexts(span: int):
    """The words of the contexts that a document is asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows = {"anchor": [], "content": [], "n": [], "words": []}
                for text, key, wanted in zip(*(part.column(c).to_pylist() for c in ("text", "text_key", "wanted")), strict=True):
                    words = text.encode().split()
                    for w in wanted:
                        place = w["place"]
                        if place & ((1 << KEY_BITS) - 1) != key:
                            continue
                        windows, first = place >> KEY_BITS & ((1 << COUNT_BITS) - 1), place >> (KEY_BITS + COUNT_BITS)
                        rows["words"].append(b" ".join(words[first : first + windows + span - 1]).decode())
                        for name in ("anchor", "content", "n"):
                            rows[name].append(w[name])
                yield pa.RecordBatch.from_pydict(
                    {n: pa.array(v, pa.string() if n == "words" else pa.int64()) for n, v in rows.items()}
                )

    return run


def _match_shard(contexts: list[tuple[int, int, str]], span: int) -> list[tuple[int, int]]:
    """(content, bits of the repeated windows) of a shard's distinct contexts (content, n, words)."""
    numbers: dict[bytes, int] = {}
    coded = [[numbers.setdefault(w, len(numbers)) for w in words.encode().split()] for _, _, words in contexts]
    shard = SuffixAutomaton()
    for (_, n, _), sequence in zip(contexts, coded, strict=True):
        shard.add(sequence, n)
    shard.weigh()
    return [(content, shard.repeated(sequence, span)) for (content, _, _), sequence in zip(contexts, coded, strict=True)]


def _match(span: int):
    """Shards come sorted by anchor; one is held at a time."""

    def out(anchor: int, found: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {
                "anchor": pa.array([anchor] * len(found), pa.int64()),
                "content": pa.array([c for c, _ in found], pa.int64()),
                "bits": pa.array([b for _, b in found], pa.int64()),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, shard = None, []
        for batch in batches:
            rows: list[pa.RecordBatch] = []
            for a, *context in zip(*(batch.column(c).to_pylist() for c in ("anchor", "content", "n", "words")), strict=True):
                if a != anchor and shard:
                    rows.append(out(anchor, _match_shard(shard, span)))
                    shard = []
                anchor = a
                if not shard or shard[-1][0] != context[0]:  # a repeated row asks for a context again
                    shard.append(tuple(context))
            if rows:
                yield pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
        if shard:
            yield out(anchor, _match_shard(shard, span))

    return run


def _hash_windows(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = words_of(batch.column("words"))
            hashes = words.hashes()
            owner = words.owner()[: max(len(hashes) - span + 1, 0)]
            starts = np.arange(len(owner))
            use = starts + span <= words.first[1:][owner]
            columns = {n: batch.column(n).to_numpy()[owner[use]] for n in ("anchor", "content", "n")}
            for name, salt in (("low", 0), ("high", 1)):
                columns[name] = shingle_hashes(mix(hashes + np.uint64(salt)), span)[use].view(np.int64)
            columns["bit"] = np.int64(1) << (starts - words.first[:-1][owner])[use]
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _remove(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                out = {"n_words": [], "n_removed": [], "kept": []}
                columns = (part.column(c).to_pylist() for c in ("text", "text_key", "places", "bits"))
                for text, key, places, bits in zip(*columns, strict=True):
                    words = (text or "").encode().split()
                    cover = np.zeros(len(words) + 1, dtype=np.int32)
                    for place, bit in zip(places or (), bits or (), strict=True):
                        if place & ((1 << KEY_BITS) - 1) != key:
                            continue
                        at = place >> (KEY_BITS + COUNT_BITS)
                        if bit & (bit + 1) == 0:  # all windows of the context
                            cover[at] += 1
                            cover[at + bit.bit_length() - 1 + span] -= 1
                            continue
                        while bit:
                            p = at + (bit & -bit).bit_length() - 1
                            cover[p] += 1
                            cover[p + span] -= 1
                            bit &= bit - 1
                    keep = np.cumsum(cover[:-1]) == 0
                    left = int(keep.sum())
                    out["n_words"].append(len(words))
                    out["n_removed"].append(len(words) - left)
                    out["kept"].append(b" ".join(words if left == len(words) else compress(words, keep)).decode())
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "without": part.column("without"), **out})

    return run


def remove_repeats(docs: DataFrame, span: int = 35, anchor_words: int = 8, shard_contexts: int = 4096) -> DataFrame:
    """Per row of docs (doc_id long, text): doc_id, n_words, n_removed, kept (the words left, joined by a space).

    Words are runs of characters other than space and \\x09-\\x0D. A word goes if a window of `span`
    words that covers it also starts at any other place of the input, its own document included.
    Null and empty texts have no words, and texts of fewer than `span` words lose none. Rows that share
    a doc_id, or have none, count as separate documents. Other columns are ignored. span may exceed
    anchor_words by 61 at most. shard_contexts only chooses between two exact ways.
    """
    if not 0 < span - anchor_words + 1 < 63:
        raise ValueError("span must exceed anchor_words by 0 to 61 words")
    key = F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND((1 << KEY_BITS) - 1).alias("text_key")
    # A row without an id goes by the hash of its text, so that such rows do not meet; equal ones have equal places.
    own = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit(""))))
    keyed = docs.select(own.alias("doc_id"), "text", key, F.col("doc_id").isNull().alias("without"))
    contexts = keyed.filter("text is not null").mapInArrow(
        _list_contexts(span, anchor_words), "anchor long, content long, doc_id long, place long"
    )
    anchors = contexts.groupBy("anchor").agg(
        F.count("*").alias("n"), F.min("content").alias("low"), F.max("content").alias("high")
    ).filter("n > 1")
    # Written, so that the join below has plain shuffles on both sides, whose skewed keys Spark splits.
    anchors = written(anchors, "anchors")
    repeated = cut(contexts.join(anchors.select("anchor", (F.col("low") == F.col("high")).alias("alike")), "anchor"))
    windows_of = f"cast(shiftright(place, {KEY_BITS}) & {(1 << COUNT_BITS) - 1} as int)"
    all_bits = F.expr(f"shiftleft(1L, {windows_of}) - 1")
    alike = repeated.filter("alike").select("doc_id", "place", all_bits.alias("bits"))
    mixed = repeated.filter("not alike")
    distinct = mixed.groupBy("anchor", "content").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "place")).alias("at"))
    wanted = distinct.groupBy(F.col("at.doc_id").alias("doc_id")).agg(
        F.collect_list(F.struct("anchor", "content", "n", F.col("at.place").alias("place"))).alias("wanted")
    )
    reference = cut(
        keyed.filter("text is not null").join(wanted, "doc_id")
        .mapInArrow(_cut_contexts(span), "anchor long, content long, n long, words string")
    )
    large = reference.groupBy("anchor").count().filter(F.col("count") > shard_contexts).select("anchor")
    windows = reference.join(large, "anchor", "left_semi").dropDuplicates(["anchor", "content"]).mapInArrow(
        _hash_windows(span), "anchor long, content long, n long, low long, high long, bit long"
    )
    twice = windows.groupBy("low", "high").agg(F.sum("n").alias("times")).filter("times > 1").select("low", "high")
    counted = windows.join(twice, ["low", "high"], "left_semi").groupBy("anchor", "content").agg(F.bit_or("bit").alias("bits"))
    matched = (
        reference.join(large, "anchor", "left_anti")
        .repartition("anchor")
        .sortWithinPartitions("anchor", "content")
        .mapInArrow(_match(span), "anchor long, content long, bits long")
    )
    bits = matched.unionByName(counted).filter("bits <> 0")
    spans = alike.unionByName(mixed.join(bits, ["anchor", "content"]).select("doc_id", "place", "bits"))
    # A set: rows equal in id and text have the same places, once for all of them.
    by_doc = spans.groupBy("doc_id").agg(F.collect_set(F.struct("place", "bits")).alias("spans"))
    by_doc = by_doc.select("doc_id", F.col("spans.place").alias("places"), F.col("spans.bits").alias("bits"))
    cleaned = keyed.join(by_doc, "doc_id", "left").mapInArrow(
        _remove(span), "doc_id long, without boolean, n_words long, n_removed long, kept string"
    )
    return cleaned.withColumn("doc_id", F.when(~F.col("without"), F.col("doc_id"))).drop("without")
