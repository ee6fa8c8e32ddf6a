"""Token counts: pieces counted once per distinct pre-token, joined to per-document frequencies.

A block of documents is cut into pre-tokens. Each pre-token belongs to one of PARTS parts by its
checksum, and a block sends each part one packed row: its distinct pre-tokens with the documents that
hold them and how often. Where a part's rows meet, a pre-token is encoded when it first appears, its
number of pieces joins all its frequencies, and the products are summed per document. No ids are kept.
With more partitions than parts, blocks fall into groups that meet separately (a pre-token is then
encoded once per group), so that the rows of a block do not become more and smaller as the input grows.

Nearly every pre-token is rare, so single rows per pre-token would weigh more than the texts; packed
rows take a fraction. A frequent pre-token costs its bucket a few bytes per document, like any other.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokenizing
from .common import shuffle_partitions
from .words import slices

#: Stands for a missing document id inside the blocks.
NO_ID = -(1 << 63)
#: Parts of the vocabulary; a document is summed once per part.
PARTS = 32


class _Numbers(dict):
    """A number for each distinct key, in order of arrival."""

    def __missing__(self, key):
        number = self[key] = len(self)
        return number


def _pack(array: np.ndarray) -> bytes:
    return zlib.compress(array.tobytes(), 1)


def _unpack(data: bytes, kind=np.uint32) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), dtype=kind)


def _frequencies(path: str, groups: int):
    """Rows (bucket, ids, text, lengths, holders, docs, counts) for each block of documents.

    text holds the bucket's pre-tokens one after the other, lengths their lengths, holders the number
    of documents of each, then docs (positions in ids) and counts run in the same order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizing.load(path)
        special = tokenizing.specials(tokenizer)
        for batch in batches:
            for block in slices(batch, "text", 8 << 20):
                ids = _pack(block.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False))
                numbers, parts = _Numbers(), []
                for text in block.column("text").to_pylist():
                    pieces = tokenizing.byte_level_pieces(text, tokenizer, special)
                    parts.append(np.fromiter(map(numbers.__getitem__, pieces), np.int64, len(pieces)))
                owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
                pairs, counts = np.unique(np.concatenate(parts) * len(parts) + owner, return_counts=True)
                piece, doc = pairs // len(parts), pairs % len(parts)
                names = np.array([*numbers, None], dtype=object)[:-1]
                bucket = np.fromiter((zlib.crc32(p.encode()) % PARTS for p in names), np.int64, len(names))
                holders = np.bincount(piece, minlength=len(names))
                by_piece = np.argsort(bucket, kind="stable")
                by_pair = np.argsort(bucket[piece], kind="stable")
                group = zlib.crc32(ids) % groups
                rows = {n: [] for n in ("bucket", "ids", "text", "lengths", "holders", "docs", "counts")}
                for b in np.unique(bucket):
                    own = by_piece[np.searchsorted(bucket[by_piece], b) : np.searchsorted(bucket[by_piece], b, "right")]
                    rows["bucket"].append(int(b))
                    rows["ids"].append(ids)
                    rows["text"].append(zlib.compress("".join(names[own]).encode(), 1))
                    rows["lengths"].append(_pack(np.fromiter(map(len, names[own]), np.uint32, len(own))))
                    rows["holders"].append(_pack(holders[own].astype(np.uint32)))
                ends = np.searchsorted(bucket[piece][by_pair], rows["bucket"], "right")
                for begin, end in zip([0, *ends[:-1]], ends, strict=True):
                    rows["docs"].append(_pack(doc[by_pair[begin:end]].astype(np.uint32)))
                    rows["counts"].append(_pack(counts[by_pair[begin:end]].astype(np.uint32)))
                rows["bucket"] = [group * PARTS + b for b in rows["bucket"]]
                yield pa.RecordBatch.from_pydict({n: pa.array(v, pa.int32() if n == "bucket" else pa.binary()) for n, v in rows.items()})

    return run


def _totals(path: str, most_known: int = 1_000_000):
    """Tokens per document that a bucket's pre-tokens add. Beyond most_known, known pre-tokens are forgotten."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizing.load(path)
        known: dict[str, int] = {}
        for batch in batches:
            for row in batch.to_pylist():
                text, ends = zlib.decompress(row["text"]).decode(), np.cumsum(_unpack(row["lengths"])).tolist()
                pieces = [text[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
                if len(known) > most_known:
                    known.clear()
                new = [p for p in pieces if p not in known]
                known.update(zip(new, map(len, tokenizer.encode_batch_fast(new, add_special_tokens=False)), strict=True))
                tokens = np.fromiter(map(known.__getitem__, pieces), np.float64, len(pieces))
                ids = _unpack(row["ids"], np.int64)
                each = np.repeat(tokens, _unpack(row["holders"])) * _unpack(row["counts"])
                sums = np.bincount(_unpack(row["docs"]), weights=each, minlength=len(ids)).astype(np.int64)
                has = sums > 0
                yield pa.RecordBatch.from_pydict({"doc_id": ids[has], "n_tokens": sums[has]})

    return run


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 512) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    docs needs doc_id (long) and text; other columns are ignored. Null and empty texts have 0 bytes
    and 0 tokens. Rows that share a doc_id, also a null one, are one document: their bytes and tokens
    are summed. Special strings inside texts count as the one token that the library makes of them.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(F.length("text") > 0)
    groups = max(1, shuffle_partitions(docs) // PARTS)
    packed = texts.mapInArrow(
        _frequencies(tokenizer_path, groups),
        "bucket int, ids binary, text binary, lengths binary, holders binary, docs binary, counts binary",
    )
    parts = packed.repartition("bucket").mapInArrow(_totals(tokenizer_path), "doc_id long, n_tokens long")
    totals = parts.groupBy("doc_id").agg(F.sum("n_tokens").alias("n_tokens"))
    sizes = docs.groupBy("doc_id").agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("n_bytes"))
    key = F.coalesce("doc_id", F.lit(NO_ID))
    tokens = F.coalesce("n_tokens", F.lit(0)).cast("long")
    return (
        sizes.withColumn("key", key)
        .join(totals.withColumnRenamed("doc_id", "key"), "key", "left")
        .select("doc_id", "n_bytes", tokens.alias("n_tokens"), (tokens > limit).alias("over_limit"))
    )
