"""Benchmark decontamination by latent semantic retrieval, with a check of word order and answer.

1. Terms are the benchmark's words, hashed to a bounded number of columns; other words add nothing to a
   product with an item. Their document frequencies are counted over all documents.
2. Documents are cut into overlapping passages, and a passage is a TF-IDF row. A randomised range finder
   runs over the passages of all documents and the items: every task adds up its rows' share of A'(A W)
   for a random W, and only those sums, of a fixed size, are added together. Items are weighted, so that
   the space keeps their directions however rarely they occur. An item that is much longer than a passage
   is cut into pieces of a passage's length, which are searched for one by one.
3. All passages and pieces are compared by cosine in that space; passages whose terms cannot reach the
   cosine with any piece, however they are weighted, are passed over. A candidate is confirmed on the
   passage with its neighbourhood: the longest common subsequence of words must hold most of the whole
   item, or a good part of it and the answer, which is the item's end.
4. Items of a few words would be lost among the other words of a passage. They are also looked for where
   a passage holds enough of their words, and confirmed on a window of twice their length.

Items go through the documents in blocks; each block is one pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import Words, slices, words_of

TERM_BITS = 16
HALF = 20  # words; a passage is two halves and starts every half
RANK, OVERSAMPLING = 128, 16
ITEM_WEIGHT = 30.0
COMMON, FEWEST = 0.1, 8  # share of documents from which a word is common; other words that an item should have
SHORT = 12  # words; items with fewer are also looked for in windows of their own
PAIRS = 1 << 21  # pairs of a passage and a short item that are counted at a time
SUMS, ENTRIES = 2048, 16  # sums that are built up at a time, to stay in the cache; entries in a part of a long one

#: Bytes that part words here: white space and ASCII punctuation.
MARKS = bytes(c for c in range(128) if not chr(c).isalnum())
WORD = re.compile("[^" + re.escape(MARKS.decode()) + "]+")


def terms_of(texts: pa.Array) -> tuple[Words, np.ndarray]:
    """Words without punctuation and their columns; A-Z count as a-z."""
    words = words_of(texts, MARKS)
    return words, (words.hashes(lower=True) >> np.uint64(64 - TERM_BITS)).astype(np.int64)


def words_in_order(text: str) -> list[str]:
    """The words as the check of order sees them."""
    return WORD.findall(text.lower())


def pieces_of(words: np.ndarray) -> np.ndarray:
    """The number of pieces that items of so many words are cut into; pieces have 30 to 40 words."""
    return np.where(words > 3 * HALF, -(-words // (2 * HALF)), 1)


@dataclass(frozen=True)
class Space:
    """A block of items and the latent space; everything in it is bounded by the block and the columns."""

    item_ids: list[int]
    items: list[list[str]]
    #: the row of `basis` for each column that an item has, else -1
    row_of: np.ndarray
    idf: np.ndarray
    basis: np.ndarray
    #: a row per piece, and the item of each piece; the pieces of an item follow one another
    vectors: np.ndarray
    item_of: np.ndarray
    #: the largest square of each row's weight in a unit piece
    reach: np.ndarray
    #: rows (rising), items and counts of the words of short items, and how many words were left out of each item
    short: tuple[np.ndarray, np.ndarray, np.ndarray]
    left_out: np.ndarray


def _document_frequency(row_of: np.ndarray, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, docs = np.zeros(rows, np.int64), 0
        for batch in batches:
            for part in slices(batch, "text"):
                words, columns = terms_of(part.column("text"))
                term = row_of[columns]
                use = term >= 0
                pairs = np.unique(term[use] * words.texts + words.owner()[use])
                count += np.bincount(pairs // words.texts, minlength=rows)
                docs += part.num_rows
        yield pa.RecordBatch.from_pydict({"row": np.arange(rows + 1), "n": np.append(count, docs)})

    return run


def _passages(part: pa.RecordBatch, row_of: np.ndarray, idf: np.ndarray):
    """The weighted terms of a batch's passages: passage, row and weight, and each passage's text and first word.

    A passage is a pair of neighbouring halves; the last half of a text stands alone.
    """
    words, columns = terms_of(part.column("text"))
    owner = words.owner()
    term = row_of[columns]
    use = term >= 0
    use[use] = idf[term[use]] > 0
    counts = np.diff(words.first)
    halves = -(-counts // HALF)
    base = np.cumsum(halves) - halves
    place = (np.arange(len(owner)) - words.first[:-1][owner])[use]
    half = base[owner[use]] + place // HALF
    term = term[use]
    # Each word counts in the passage that starts with its half and in the one before.
    before = place >= HALF
    passage = np.concatenate([half, half[before] - 1])
    cells, n = np.unique(passage * len(idf) + np.concatenate([term, term[before]]), return_counts=True)
    text = np.repeat(np.arange(words.texts), halves)
    first = (np.arange(len(text)) - base[text]) * HALF
    return words, cells // len(idf), cells % len(idf), (1 + np.log(n)) * idf[cells % len(idf)], text, first


def _starts(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    return np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)


def _sums(starts: np.ndarray, row: np.ndarray, weight: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Per run of entries, from one start to the next, the sum of weight * table[row].

    All runs get their first entries, then those that have them their second ones, and so on.
    """
    size = np.diff(starts, append=len(row))
    weight = weight.astype(np.float32)[:, None]
    out = np.empty((len(starts), table.shape[1]), np.float32)
    one = np.empty((min(len(starts), SUMS), table.shape[1]), np.float32)
    for a in range(0, len(starts), SUMS):
        order = a + np.argsort(-size[a : a + SUMS], kind="stable")
        begin, rising = starts[order], size[order][::-1]
        total = np.zeros((len(order), table.shape[1]), np.float32)
        for k, m in enumerate(len(order) - np.searchsorted(rising, np.arange(rising[-1]), "right")):
            entry = begin[:m] + k
            np.take(table, row[entry], axis=0, out=one[:m], mode="clip")
            one[:m] *= weight[entry]
            total[:m] += one[:m]
        out[order] = total
    return out


def _project(passage: np.ndarray, row: np.ndarray, weight: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The passages that have terms, and A basis for them."""
    starts = _starts(passage)
    return passage[starts], _sums(starts, row, weight, basis)


def _range_sums(row_of: np.ndarray, idf: np.ndarray, start: np.ndarray):
    """A'(A start) over a task's passages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(start.shape, np.float64)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                _, passage, row, weight, _, _ = _passages(part, row_of, idf)
                found, product = _project(passage, row, weight, start)
                order = np.argsort(row.astype(np.uint16), kind="stable")  # there are 2**TERM_BITS rows at most
                at, row, weight = np.searchsorted(found, passage)[order], row[order], weight[order]
                # A frequent term's passages are added up in parts of equal size, and then the parts.
                starts = _starts(row)
                place = np.arange(len(row)) - np.repeat(starts, np.diff(starts, append=len(row)))
                parts = np.flatnonzero(place % ENTRIES == 0)
                of_parts = _sums(parts, at, weight, product)
                of_rows = _sums(np.searchsorted(parts, starts), np.arange(len(parts)), np.ones(len(parts)), of_parts)
                total[row[starts]] += of_rows
        used = np.flatnonzero(np.abs(total).sum(axis=1))
        values = [total[r].astype(np.float32).tobytes() for r in used]
        yield pa.RecordBatch.from_pydict({"row": pa.array(used, pa.int64()), "values": pa.array(values, pa.binary())})

    return run


def _add_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for row, values in zip(batch.column("row").to_pylist(), batch.column("values").to_pylist(), strict=True):
            sums[row] = sums.get(row, 0) + np.frombuffer(values, np.float32).astype(np.float64)
    rows = sorted(sums)
    values = [sums[r].astype(np.float32).tobytes() for r in rows]
    yield pa.RecordBatch.from_pydict({"row": pa.array(rows, pa.int64()), "values": pa.array(values, pa.binary())})


def build_space(docs: DataFrame, item_ids: list[int], texts: list[str]) -> Space | None:
    """The space of a block of items over all documents; None where no item has a word."""
    words, columns = terms_of(pa.array(texts, pa.string()))
    distinct = np.unique(columns)
    if not len(distinct):
        return None
    rows = len(distinct)
    row_of = np.full(1 << TERM_BITS, -1, np.int64)
    row_of[distinct] = np.arange(rows)
    counted = docs.select("text").mapInArrow(_document_frequency(row_of, rows), "row long, n long")
    found = {r["row"]: r["n"] for r in counted.groupBy("row").agg(F.sum("n").alias("n")).collect()}  # rows + 1 numbers
    n_docs = found.get(rows, 0)
    df = np.array([found.get(i, 0) for i in range(rows)], float)
    idf = np.log(1 + n_docs / (df + 1))
    owner, term = words.owner(), row_of[columns]
    sizes = np.diff(words.first)
    parts = pieces_of(sizes)
    item_of = np.repeat(np.arange(len(texts)), parts)
    place = np.arange(len(owner)) - words.first[:-1][owner]
    piece = (np.cumsum(parts) - parts)[owner] + place * parts[owner] // sizes[owner]
    cells, n = np.unique(piece * rows + term, return_counts=True)
    # Words of very many texts are left out, but for items that would keep few others.
    common = df > COMMON * n_docs + 1
    rare = np.bincount(cells // rows, weights=~common[cells % rows], minlength=len(item_of))
    needed = np.zeros(rows, dtype=bool)
    needed[cells[rare[cells // rows] < FEWEST] % rows] = True
    idf[common & ~needed] = 0
    own = np.zeros((len(item_of), rows))
    own[cells // rows, cells % rows] = (1 + np.log(n)) * idf[cells % rows]
    length = np.linalg.norm(own, axis=1, keepdims=True)
    own /= np.where(length > 0, length, 1)
    # A short item is one piece. Words that no passage counts are left out of its count too.
    used = idf[cells % rows] > 0
    few = used & (sizes[item_of[cells // rows]] < SHORT)
    order = np.flatnonzero(few)[np.argsort(cells[few] % rows, kind="stable")]
    short = (cells[order] % rows, item_of[cells[order] // rows], n[order])
    left_out = np.bincount(item_of[cells // rows], weights=n * ~used, minlength=len(texts))

    width = min(RANK + OVERSAMPLING, rows)
    start = np.random.default_rng(11).standard_normal((rows, width)).astype(np.float32)
    partial = docs.select("text").mapInArrow(_range_sums(row_of, idf, start), "row long, values binary")
    summed = partial.repartition("row").mapInArrow(_add_rows, "row long, values binary")
    sums = np.zeros((rows, width))
    for r in summed.collect():  # at most 2**TERM_BITS rows of a fixed width
        sums[r["row"]] = np.frombuffer(r["values"], np.float32)
    scale = np.linalg.norm(sums) or 1.0
    of_items = own.T @ (own @ start)
    basis, _ = np.linalg.qr(sums / scale + ITEM_WEIGHT * of_items / (np.linalg.norm(of_items) or 1.0))
    small = own @ basis
    if len(item_of) > RANK:  # keep the directions that matter most to the items
        _, _, turn = np.linalg.svd(small, full_matrices=False)
        basis = basis @ turn[:RANK].T
        small = own @ basis
    # Over the squared share of a piece that the space holds, so that the piece itself comes to 1.
    held = np.square(small).sum(axis=1, keepdims=True)
    vectors = (small / np.where(held > 0, held, 1)).astype(np.float32)
    reach = np.square(own).max(axis=0)
    items = [words_in_order(t) for t in texts]
    return Space(item_ids, items, row_of, idf, basis.astype(np.float32), vectors, item_of, reach, short, left_out)


def common_words(a: list[str], b: list[str]) -> list[int]:
    """The positions in a of a longest common subsequence of a and b."""
    where: dict[str, int] = {}
    for i, word in enumerate(a):
        where[word] = where.get(word, 0) | 1 << i
    ones = (1 << len(a)) - 1
    rows, state = [], ones
    for word in b:
        hit = state & where.get(word, 0)
        state = ((state + hit) | (state - hit)) & ones
        rows.append(state)
    out, i = [], len(a) - 1
    for j in range(len(b) - 1, -1, -1):
        before = rows[j - 1] if j else ones
        while i >= 0 and rows[j] >> i & 1:  # the last word of a that j still adds to
            i -= 1
        if i < 0:
            break
        if before >> i & 1:
            out.append(i)
            i -= 1
    return out[::-1]


def confirm(item: list[str], passage: list[str], most: float, part: float) -> tuple[int, bool, bool]:
    """Length of the common subsequence, whether it holds the answer, and whether the item is in the passage.

    The answer is the last fifth of the item, 3 words at least; half of it must be in the subsequence.
    """
    held = common_words(item, passage)
    answer = max(3, len(item) // 5)
    found = sum(i >= len(item) - answer for i in held) * 2 >= min(answer, len(item))
    return len(held), found, len(held) >= most * len(item) or (len(held) >= part * len(item) and found)


def confirm_short(item: list[str], words: list[str], most: float, part: float) -> tuple[int, bool, bool]:
    """confirm, on the best window of twice the item's length, half a passage and a word at most."""
    width, own = min(2 * len(item), HALF + 1), set(item)
    at = [i for i, word in enumerate(words) if word in own]
    found = (0, False, False)
    for a in at:  # a window that begins with another word holds no more
        if sum(a <= i < a + width for i in at) >= min(most, part) * len(item):
            found = max(found, confirm(item, words[a : a + width], most, part), key=lambda f: (f[2], f[0], f[1]))
    return found


def _with_short(passage: np.ndarray, row: np.ndarray, space: Space, least: float) -> Iterator[tuple[int, int]]:
    """(passage, short item) where the passage may hold that share of the item's words; passages rise."""
    rows, items, counts = space.short
    if not len(rows):
        return
    need = np.array([least * len(i) for i in space.items]) - space.left_out - 1e-9
    begin = np.searchsorted(rows, row)
    size = np.searchsorted(rows, row, "right") - begin
    use = size > 0
    passage, begin, size = passage[use], begin[use], size[use]
    before = np.cumsum(size) - size
    # Passages are dealt whole to groups with a bounded number of pairs.
    group = before[np.searchsorted(passage, passage)] // PAIRS
    cuts = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True]) if len(group) else []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        at = np.repeat(begin[a:b] - before[a:b] + before[a], size[a:b]) + np.arange(size[a:b].sum())
        pairs, where = np.unique(np.repeat(passage[a:b], size[a:b]) * len(space.items) + items[at], return_inverse=True)
        enough = np.bincount(where, weights=counts[at]) >= need[pairs % len(space.items)]
        for pair in pairs[enough].tolist():
            yield divmod(pair, len(space.items))


def _matches(part: pa.RecordBatch, space: Space, cosine: float, most: float, part_of: float) -> dict[tuple[int, int], tuple]:
    """(row, item): length of the common subsequence, cosine, whether the answer is in it."""
    longest = max((len(i) for i in space.items), default=0)
    _, passage, row, weight, text, first = _passages(part, space.row_of, space.idf)
    known: dict[int, list[str]] = {}

    def words(d: int) -> list[str]:
        nonlocal known
        if d not in known:
            known = {d: words_in_order(part.column("text")[d].as_py())}
        return known[d]

    within = np.bincount(passage, weights=space.reach[row], minlength=1) >= cosine**2
    hits: dict[tuple[int, int], tuple[int, bool]] = {}
    for p, i in _with_short(passage, row, space, min(most, part_of)):
        at = int(first[p])
        size, answer, inside = confirm_short(space.items[i], words(int(text[p]))[at : at + 2 * HALF], most, part_of)
        if inside:
            hits[p, i] = (size, answer)
            within[p] = True
    passage, row, weight = (x[within[passage]] for x in (passage, row, weight))
    found, product = _project(passage, row, weight, space.basis)
    # Against the whole row's length, so that terms outside the space count against it.
    squares = np.bincount(np.searchsorted(found, passage), weights=weight**2, minlength=len(found))
    near = (product @ space.vectors.T) / np.sqrt(np.where(squares > 0, squares, 1))[:, None]
    best: dict[tuple[int, int], tuple] = {}

    def keep(d: int, i: int, size: int, close: float, answer: bool) -> None:
        if (size, close) > best.get((d, i), (0, 0.0))[:2]:
            best[d, i] = (size, close, answer)

    for (p, i), (size, answer) in hits.items():
        close = near[np.searchsorted(found, p), np.searchsorted(space.item_of, i)]
        keep(int(text[p]), i, size, float(close), answer)
    for p, v in zip(*np.nonzero(near >= cosine), strict=True):
        d, i = int(text[found[p]]), int(space.item_of[v])
        at = int(first[found[p]])
        beside = min(longest, max(len(space.items[i]), 3 * HALF))
        around = words(d)[max(0, at - beside) : at + 2 * HALF + beside]
        size, answer, inside = confirm(space.items[i], around, most, part_of)
        if inside:
            keep(d, i, size, float(near[p, v]), answer)
    return best


def _list(space: Space, limits: tuple[float, float, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                best = _matches(part, space, *limits)
                keys = sorted(best)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id").take(pa.array([d for d, _ in keys], pa.int64())),
                        "item_id": pa.array([space.item_ids[i] for _, i in keys], pa.int64()),
                        "n_item_words": pa.array([len(space.items[i]) for _, i in keys], pa.int64()),
                        "n_common": pa.array([best[k][0] for k in keys], pa.int64()),
                        "cosine": pa.array([best[k][1] for k in keys], pa.float64()),
                        "has_answer": pa.array([best[k][2] for k in keys], pa.bool_()),
                    }
                )

    return run


def _without(space: Space, limits: tuple[float, float, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                clean = np.ones(part.num_rows, dtype=bool)
                clean[[d for d, _ in _matches(part, space, *limits)]] = False
                yield part.filter(pa.array(clean))

    return run


MATCHES = "doc_id long, item_id long, n_item_words long, n_common long, cosine double, has_answer boolean"
COSINE, MOST, PART, BLOCK = 0.4, 0.8, 0.6, 1024


def _spaces(docs: DataFrame, benchmark: DataFrame, block: int) -> Iterator[Space]:
    """A space per block of items with about so many pieces; only one block's items are on the driver at a time."""
    items = benchmark.filter("item_id is not null and length(text) > 0").select(F.col("item_id").cast("long").alias("item_id"), "text")
    ordered = items.orderBy("item_id", "text").toLocalIterator()
    batch, size = [], 0
    for r in chain(ordered, [None]):
        n = int(pieces_of(np.array(len(words_in_order(r["text"]))))) if r else 0
        if batch and (r is None or size + n > block):
            space = build_space(docs, [b["item_id"] for b in batch], [b["text"] for b in batch])
            if space is not None:
                yield space
            batch, size = [], 0
        if r:
            batch, size = [*batch, r], size + n


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, most: float = MOST, part: float = PART, block: int = BLOCK
) -> DataFrame:
    """Per document and benchmark item found in it: doc_id, item_id, n_item_words, n_common, cosine, has_answer.

    docs has doc_id (long) and text, benchmark has item_id (long) and text. An item is found where a
    passage's latent cosine with one of its pieces reaches `cosine` and the longest common subsequence with
    the passage and its neighbourhood holds `most` of the item's words, or `part` of them and its answer.
    The neighbourhood has as many words on either side as the item, or 60 if the item has fewer, but no
    more than the block's longest item. An item of fewer than 12 words is also found where a window of twice
    its length (21 words at most) holds as much, whatever the cosine. Words are compared without case and punctuation. Null and empty texts and items without words match nothing; items
    without an id are not looked for. Rows that share a doc_id are searched one by one and give a row
    each; repeated items give a row each. Other columns are ignored.

    The benchmark is searched for in blocks of `block` pieces; each block reads the documents once.
    An item of up to 60 words is one piece, a longer one is cut into pieces of 30 to 40 words.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(F.length("text") > 0)
    found = docs.sparkSession.createDataFrame([], MATCHES)
    for space in _spaces(rows, benchmark, block):
        found = found.unionByName(rows.mapInArrow(_list(space, (cosine, most, part)), MATCHES))
    return found


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, most: float = MOST, part: float = PART, block: int = BLOCK
) -> DataFrame:
    """The rows of docs, all columns, in which find_leaks would find no item."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(F.length("text") > 0)
    for space in _spaces(rows, benchmark, block):
        docs = docs.mapInArrow(_without(space, (cosine, most, part)), docs.schema)
    return docs


def judge_leaks(docs: DataFrame, benchmark: DataFrame, **limits: float) -> DataFrame:
    """Per doc_id of docs (not null): doc_id, contaminated, item_ids (rising)."""
    found = find_leaks(docs, benchmark, **limits).groupBy("doc_id").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id is not null").distinct()
    none = F.expr("cast(array() as array<bigint>)")
    return ids.join(found, "doc_id", "left").select(
        "doc_id", F.col("item_ids").isNotNull().alias("contaminated"), F.coalesce("item_ids", none).alias("item_ids")
    )
