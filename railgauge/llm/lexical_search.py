"""Ranked lexical search over a length-stratified index.

A document's length enters its score only through the normaliser m, so documents of equal m form a
stratum, in which a term's postings are grouped by tf, highest first. The impact of a posting is then one number
per stratum and tf, and the first group of a term bounds what the term can add anywhere in the stratum.
A query sums these bounds per stratum, visits strata from the highest sum on, and stops where no stratum
can reach its k-th best score any more.

Every document is indexed for the terms of the query set, which is searched in blocks of a bounded number
of terms. One scan writes the documents' postings to the shared folder, from which document frequencies are counted;
each task then indexes its part in pieces of bounded size, carries its best rows from piece to piece, and
hands on k rows per item, which are merged in two rounds.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import shared_folder, written
from .urls import LOWER, UPPER
from .words import slices, words_of

TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
SEPARATORS = bytes(c for c in range(128) if not chr(c).isalnum())
#: Distinct terms of a block of items: what the driver and each task hold of the query set.
BLOCK_TERMS = 1 << 18
#: Postings of a piece of the index.
PIECE = 1 << 21
#: Sums below are exact in doubles up to here.
EXACT = 1 << 53


def term_hashes(terms: list[str]) -> np.ndarray:
    """A 64-bit hash of each term, which is one word."""
    return words_of(pa.array(terms, pa.string()), SEPARATORS).hashes(lower=True)


def _postings(vocabulary: np.ndarray):
    """Per document with a term at all: n, and the numbers in the vocabulary of the terms it has, with tf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = words_of(part.column("text"), SEPARATORS)
                hashes, n = words.hashes(lower=True), np.diff(words.first)
                number = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
                known = vocabulary[number] == hashes
                keys = words.owner()[known] * len(vocabulary) + number[known]
                keys, tf = np.unique(keys, return_counts=True)
                offsets = np.searchsorted(keys, np.arange(words.texts + 1) * len(vocabulary)).astype(np.int32)
                lists = [
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))
                    for values in (keys % len(vocabulary), tf)
                ]
                rows = pa.RecordBatch.from_pydict(
                    {"doc_id": part.column("doc_id"), "n": pa.array(n, pa.int64()), "terms": lists[0], "tfs": lists[1]}
                )
                yield rows.filter(pa.array(n > 0))

    return run


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers starts[i] .. starts[i] + counts[i] - 1 of each i, one after the other."""
    begin = np.cumsum(counts) - counts
    return np.repeat(starts - begin, counts) + np.arange(int(counts.sum()))


class Index:
    """Documents in order of m and doc_id; postings by term, stratum and falling tf."""

    def __init__(self, m: np.ndarray, doc_id: np.ndarray, n_terms: np.ndarray, terms: np.ndarray, tfs: np.ndarray, saturation: int) -> None:
        order = np.lexsort((doc_id, m))
        place = np.empty(len(m), dtype=np.int64)
        place[order] = np.arange(len(m))
        self.doc_id, m = doc_id[order], m[order]
        self.m, self.stratum_first = np.unique(m, return_index=True)
        self.stratum_size = np.diff(np.append(self.stratum_first, len(m)))
        stratum_of = np.repeat(np.arange(len(self.m)), self.stratum_size)
        doc = np.repeat(place, n_terms)
        stratum, most = stratum_of[doc], int(tfs.max(initial=0)) + 1
        order = np.lexsort((-tfs, stratum, terms)) if int(terms.max(initial=0) + 1) * len(self.m) * most >= 1 << 62 else np.argsort(
            (terms * len(self.m) + stratum) * most + (most - 1 - tfs), kind="stable"
        )
        self.doc, terms, stratum, tfs = doc[order], terms[order], stratum[order], tfs[order]
        new_list = np.ones(len(terms), dtype=bool)
        new_list[1:] = (terms[1:] != terms[:-1]) | (stratum[1:] != stratum[:-1])
        new_group = new_list.copy()
        new_group[1:] |= tfs[1:] != tfs[:-1]
        self.group_first = np.flatnonzero(new_group)
        self.group_size = np.diff(np.append(self.group_first, len(terms)))
        # One impact per stratum and tf.
        pairs, which = np.unique(stratum[self.group_first] * most + tfs[self.group_first], return_inverse=True)
        tf = pairs % most
        self.impact = (10**9 * tf // (1000 * tf + saturation * self.m[pairs // most]))[which]
        lists = np.flatnonzero(new_list[self.group_first])
        self.list_first, self.list_size = lists, np.diff(np.append(lists, len(self.group_first)))
        self.list_term, self.list_stratum = terms[self.group_first][lists], stratum[self.group_first][lists]
        self.list_bound = self.impact[lists]

    def lists_of(self, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all lists of the terms, and the weight of each one's term."""
        begin, end = (np.searchsorted(self.list_term, terms, side) for side in ("left", "right"))
        return _ranges(begin, end - begin), np.repeat(weights, end - begin)

    def scores(self, lists: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The sum of weight times impact per document, over some lists."""
        groups = _ranges(self.list_first[lists], self.list_size[lists])
        parts = self.impact[groups] * np.repeat(weights, self.list_size[lists])
        docs = self.doc[_ranges(self.group_first[groups], self.group_size[groups])]
        return _sums(docs, np.repeat(parts, self.group_size[groups]), len(self.doc_id))


def _sums(where: np.ndarray, what: np.ndarray, size: int) -> np.ndarray:
    if int(what.max(initial=0)) * len(what) < EXACT:
        return np.bincount(where, weights=what, minlength=size).astype(np.int64)
    out = np.zeros(size, dtype=np.int64)
    np.add.at(out, where, what)
    return out


def search(index: Index, terms: np.ndarray, weights: np.ndarray, best: np.ndarray, k: int) -> np.ndarray:
    """The k best rows of (score, doc_id) among `best` and the index's; equal scores by rising doc_id."""
    lists, weights = index.lists_of(terms, weights)
    bounds = _sums(index.list_stratum[lists], index.list_bound[lists] * weights, len(index.m))
    order = np.argsort(-bounds, kind="stable")
    order = order[bounds[order] > 0]
    at, docs = 0, 4 * k
    while at < len(order):
        least = best[-1, 0] if len(best) == k else 1
        # A stratum that can just reach the last score may hold a smaller doc_id.
        end = at + int(np.searchsorted(-bounds[order[at:]], -least, side="right"))
        end = min(end, at + 1 + int(np.searchsorted(np.cumsum(index.stratum_size[order[at:]]), docs)))
        if end <= at:
            break
        visit = np.zeros(len(index.m), dtype=bool)
        visit[order[at:end]] = True
        use = visit[index.list_stratum[lists]]
        scores = index.scores(lists[use], weights[use])
        found = np.flatnonzero(scores >= max(least, 1))
        rows = np.concatenate([best, np.stack([scores[found], index.doc_id[found]], axis=1)])
        best = rows[np.lexsort((rows[:, 1], -rows[:, 0]))[:k]]
        at, docs = end, docs * 16
    return best


#: Stands for a missing doc_id, which comes last among equal scores.
NO_ID = np.iinfo(np.int64).max


def _search(ids: list, terms: list[np.ndarray], weights: np.ndarray, k: int, saturation: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [np.empty((0, 2), dtype=np.int64) for _ in ids]
        held: list[list[np.ndarray]] = []

        def look() -> None:
            index = Index(*(np.concatenate(c) for c in zip(*held, strict=True)), saturation)
            held.clear()
            for i, found in enumerate(best):
                best[i] = search(index, terms[i], weights[terms[i]], found, k)

        size = 0
        for batch in batches:
            lists, tfs = batch.column("terms"), batch.column("tfs")
            held.append(
                [
                    batch.column("m").to_numpy(),
                    batch.column("doc_id").fill_null(int(NO_ID)).to_numpy(),
                    lists.value_lengths().to_numpy(),
                    lists.flatten().to_numpy().astype(np.int64),
                    tfs.flatten().to_numpy().astype(np.int64),
                ]
            )
            size += len(held[-1][3]) + batch.num_rows
            if size >= PIECE:
                look()
                size = 0
        if held:
            look()
        rows = np.concatenate([np.empty((0, 2), dtype=np.int64), *best])
        owners = [ids[i] for i, found in enumerate(best) for _ in range(len(found))]
        doc_id = pa.array(rows[:, 1], mask=rows[:, 1] == NO_ID)
        yield pa.RecordBatch.from_pydict({"item_id": pa.array(owners, id_type), "doc_id": doc_id, "score": pa.array(rows[:, 0])})

    return run


def _schema(item_id: T.DataType, **others: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in {"item_id": item_id, **others}.items()])


def _search_block(docs: DataFrame, wanted: DataFrame, item_type: T.DataType, k: int, slope: int, saturation: int) -> DataFrame | None:
    """item_id, rank, doc_id, score for a block's rows of item_id and term; None if no document has a term."""
    pairs = wanted.collect()
    names = sorted({p["term"] for p in pairs})
    hashes = term_hashes(names)
    order = np.argsort(hashes)
    vocabulary, number = hashes[order], {names[j]: i for i, j in enumerate(order.tolist())}
    of_item: dict = {}
    for p in pairs:
        of_item.setdefault(p["item_id"], []).append(number[p["term"]])
    found = written(docs.mapInArrow(_postings(vocabulary), "doc_id long, n long, terms array<int>, tfs array<int>"), "postings")
    count, length = found.agg(F.count("*"), F.sum("n")).first()
    if not count:
        return None
    frequency = np.zeros(len(names), dtype=np.int64)
    for row in found.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        frequency[row["term"]] = row["count"]
    weights = np.array([math.floor(1000 * math.log((2 * count + 2) / (2 * f + 1))) for f in frequency.tolist()], dtype=np.int64)
    m = F.expr(f"cast({100 - slope} + (cast(n as decimal(19, 0)) * {slope * count}) div {length} as bigint)")
    rows = found.select("doc_id", m.alias("m"), "terms", "tfs")
    items = _search(list(of_item), [np.array(sorted(t)) for t in of_item.values()], weights, k, saturation, to_arrow_type(item_type))
    schema = _schema(item_type, doc_id=T.LongType(), score=T.LongType())
    # A row per item, task and rank: merged among groups of tasks first, as many as each holds.
    groups = math.isqrt(rows.rdd.getNumPartitions())
    best = rows.mapInArrow(items, schema).withColumn("tasks", F.spark_partition_id() % F.lit(max(groups, 1)))
    in_order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for keys in (["item_id", "tasks"], ["item_id"]):
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*in_order))).filter(F.col("rank") <= k)
    return best.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, slope: int = 90, saturation: int = 8) -> DataFrame:
    """Per row of items (item_id, text) its k best documents (doc_id long, text): item_id, rank, doc_id, score.

    Terms are maximal runs of ASCII letters and digits and of all characters beyond ASCII; only A-Z are
    lower-cased. With N documents that have a term, L terms in them, n terms in one, df documents with a
    term and tf of it in one: a term weighs floor(1000 * ln((2N + 2) / (2 df + 1))), a document's m is
    100 - slope + slope * n * N div L, and its score is the sum over the item's distinct terms of weight *
    (10**9 tf div (1000 tf + saturation * m)). Only scores above 0 are ranked, highest first, equal ones by
    rising doc_id, a null doc_id (for which 2**63 - 1 stands) last.

    Null, empty and term-less texts are in no result and not in N; items without terms have no rows. Rows of
    items that share an item_id (null included) are one item with the terms of all. Documents that share a
    doc_id are ranked one by one. Without documents or items the result is empty. Other columns are ignored.
    """
    spark, item_type = docs.sparkSession, items.schema["item_id"].dataType
    terms = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(TERM), F.lit(0))
    pairs = written(items.select("item_id", F.explode(F.array_distinct(terms)).alias("term")).distinct(), "item-terms")
    blocks = -(-pairs.count() // BLOCK_TERMS)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = _schema(item_type, rank=T.IntegerType(), doc_id=T.LongType(), score=T.LongType())
    folder, paths = f"{shared_folder(spark)}/ranked-{uuid.uuid4().hex}", []
    for block in range(blocks):
        wanted = pairs.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        found = None if wanted.isEmpty() else _search_block(rows, wanted, item_type, k, slope, saturation)
        if found is not None:
            # Written at once, so that the driver holds one block's items at a time.
            paths.append(f"{folder}/{block}")
            found.write.parquet(paths[-1])
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
