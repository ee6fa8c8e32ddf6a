"""Near-duplicate groups by circulant MinHash, banding and exact Jaccard similarity.

1. Every text becomes its set of word shingles, a 128-bit fingerprint of that set, and a signature:
   one permutation (sigma) places each shingle on a circle of 2**32 positions, and coordinate j is
   the least value of a second permutation (pi) over the set shifted by j. Bands of the signature
   are hashed to keys.
2. Texts with equal sets are one node, so copies are never compared.
3. In every bucket (nodes with a common key) each node is checked against the bucket's first node,
   and the confirmed links give components.
4. Nodes that buckets connect, but that are not all in one component, form a cluster. Its nodes get a
   longer signature, and pairs in different components whose signatures come within five standard
   errors of the similarity are checked too. Pairs within a component need no check. A cluster of one
   block of nodes is compared as a whole. In a larger one only nodes are compared that share one of
   their rarest shingles: in one order of all shingles, by how often a block of nodes has them, two sets of the
   similarity meet in the first n - ceil(similarity * n) + 1 of theirs, so no pair is lost, and texts of one
   template that differ in words of their own meet nowhere. Shingles held by many nodes are compared block by
   block, so a large one is spread over many tasks.

Checks read the whole texts and count the intersection of the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .components import components
from .words import mix, shingle_hashes, slices, words_of

ROWS, BANDS = 6, 42  # a pair at similarity 0.8 shares no band with probability 3e-6
NO_ID = -(1 << 63)
LONG, MARGIN, BLOCK = 1024, 5.0, 512  # coordinates and standard errors of the longer signature; nodes in a block
COMMON = 10  # nodes of a block that have a shingle before it counts as common
EARLIER = 32  # rarer shingles that a node brings along, so that a pair is not found again at each that it shares
SIGMA_SEED, PI_SEED = 0x2545F491, 0x9E3779B9


def _permutation(values: np.ndarray, seed: int, out: np.ndarray | None = None) -> np.ndarray:
    """A bijection of 32-bit integers."""
    x = np.bitwise_xor(values, np.uint32(seed), out=out)
    shifted = np.empty_like(x)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        np.right_shift(x, np.uint32(shift), out=shifted)
        x ^= shifted
        x *= np.uint32(factor)
    np.right_shift(x, np.uint32(16), out=shifted)
    x ^= shifted
    return x


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, text by text in rising order, and where each begins.

    A text with fewer than k words, but some, has its whole sequence as its only shingle.
    """
    words = words_of(texts)
    counts = np.diff(words.first)
    hashes = words.hashes(lower=True)
    all_shingles = np.zeros(len(hashes), dtype=np.uint64)
    full = shingle_hashes(hashes, k)
    all_shingles[: len(full)] = full
    owner = words.owner()
    left = np.repeat(words.first[1:], counts) - np.arange(len(hashes))
    use = left >= k
    for d in np.flatnonzero((counts > 0) & (counts < k)):
        a = words.first[d]
        all_shingles[a] = mix(shingle_hashes(hashes[a : a + counts[d]], int(counts[d])) + np.uint64(counts[d]))[0]
        use[a] = True
    values, owner = all_shingles[use], owner[use]
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(words.texts + 1))


def set_fingerprints(values: np.ndarray, starts: np.ndarray) -> list[bytes | None]:
    """128 bits per set, whatever its order; None for an empty set."""
    sums = []
    for seed in (0x1234567, 0x89ABCDEF01):
        total = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(mix(values + np.uint64(seed)), out=total[1:])
        sums.append(mix(total[starts[1:]] - total[starts[:-1]] + np.diff(starts).astype(np.uint64)))
    packed = np.stack(sums, axis=1).tobytes()
    return [packed[16 * i : 16 * i + 16] if starts[i + 1] > starts[i] else None for i in range(len(starts) - 1)]


def _coordinates(values: np.ndarray, starts: np.ndarray, first: int, count: int) -> Iterator[np.ndarray]:
    """Signature coordinates first to first + count - 1 of all non-empty sets, one after the other."""
    begins = starts[:-1][np.flatnonzero(np.diff(starts))]
    places = _permutation((values >> np.uint64(32)).astype(np.uint32), SIGMA_SEED)
    shifted = np.empty_like(places)
    for j in range(first, first + count if len(begins) else first):
        np.add(places, np.uint32(j), out=shifted)
        yield np.minimum.reduceat(_permutation(shifted, PI_SEED, out=shifted), begins)


def band_keys(values: np.ndarray, starts: np.ndarray, rows: int = ROWS, bands: int = BANDS) -> np.ndarray:
    """bands keys (64 bits) for each non-empty set."""
    keys = np.zeros((int((np.diff(starts) > 0).sum()), bands), dtype=np.uint64)
    for j, least in enumerate(_coordinates(values, starts, 0, rows * bands)):
        keys[:, j // rows] = mix(keys[:, j // rows] + least + np.uint64(j + 1))
    return keys


def long_signatures(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The low bytes of LONG coordinates of each non-empty set, other ones than the bands use."""
    out = np.zeros((int((np.diff(starts) > 0).sum()), LONG), dtype=np.uint8)
    for j, least in enumerate(_coordinates(values, starts, ROWS * BANDS, LONG)):
        out[:, j] = least & np.uint32(255)
    return out


def _sketch(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                values, starts = shingle_sets(part.column("text"), k)
                keys, filled = band_keys(values, starts), np.diff(starts) > 0
                packed = np.full(part.num_rows, None, dtype=object)
                packed[filled] = [row.tobytes() for row in keys]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"),
                        "text_key": part.column("text_key"),
                        "n_shingles": np.diff(starts).astype(np.int64),
                        "set_id": pa.array(set_fingerprints(values, starts), pa.binary()),
                        "keys": pa.array(packed, pa.binary()),
                    }
                )

    return run


def _explode_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = np.frombuffer(b"".join(batch.column("keys").to_pylist()), dtype=np.int64)
        each = len(keys) // max(batch.num_rows, 1)
        columns = {name: np.repeat(batch.column(name).to_numpy(), each) for name in ("node", "n_shingles")}
        yield pa.RecordBatch.from_pydict({"key": keys, **columns})


def _same_sets(k: int):
    """Rows whose text has the set that is looked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = set_fingerprints(*shingle_sets(part.column("text"), k))
                keep = pa.array([f == w for f, w in zip(found, part.column("set_id").to_pylist(), strict=True)], pa.bool_())
                yield part.filter(keep).select(["node", "text"])

    return run


def _confirm(k: int, percent: int):
    """Pairs whose full sets reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_a"):
                keep = np.zeros(part.num_rows, dtype=bool)
                for at in range(0, part.num_rows, 64):
                    some = part.slice(at, 64)
                    a, a_at = shingle_sets(some.column("text_a"), k)
                    b, b_at = shingle_sets(some.column("text_b"), k)
                    for i in range(some.num_rows):
                        x, y = a[a_at[i] : a_at[i + 1]], b[b_at[i] : b_at[i + 1]]
                        both = len(np.intersect1d(x, y, assume_unique=True))
                        keep[at + i] = 100 * both >= percent * (len(x) + len(y) - both) and both > 0
                yield part.filter(pa.array(keep)).select(["a", "b"])

    return run


def _sign(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                signed = [row.tobytes() for row in long_signatures(*shingle_sets(part.column("text"), k))]
                yield pa.RecordBatch.from_pydict({"node": part.column("node"), "signature": pa.array(signed, pa.binary())})

    return run


def _shingles_of(k: int):
    """A row per shingle of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                values, starts = shingle_sets(part.column("text"), k)
                cluster = np.repeat(part.column("cluster").to_numpy(), np.diff(starts))
                yield pa.RecordBatch.from_pydict({"cluster": cluster, "shingle": values.view(np.int64)})

    return run


def rarest(values: np.ndarray, common: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The shingles of a set that one at least is shared with every set of the similarity.

    common: rising shingles with their counts; all others come before them, by their own value.
    """
    size = len(values)
    at = np.minimum(np.searchsorted(common, values), max(len(common) - 1, 0))
    held = counts[at] * (common[at] == values) if len(common) else np.zeros(size, dtype=np.int64)
    return values[np.lexsort((values, held))[: size - -(-percent * size // 100) + 1]]


def _rarest(k: int, percent: int):
    """Rows come sorted by cluster and block, the common shingles of the cluster before its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = counts = np.empty(0, dtype=np.uint64)
        for batch in batches:
            first = np.flatnonzero(~batch.column("common").is_null().to_numpy(zero_copy_only=False)).tolist()
            for a, b in zip([0, *first], [*first, batch.num_rows], strict=True):
                rows = batch.slice(a, b - a)
                if a < b and a in first:
                    shingles, held = (part.to_numpy() for part in rows.column("common")[0].values.flatten())
                    order = np.argsort(shingles.view(np.uint64))
                    common, counts = shingles.view(np.uint64)[order], held[order]
                    rows = rows.slice(1)
                for part in slices(rows, "text", 1 << 20):
                    values, starts = shingle_sets(part.column("text"), k)
                    found = [rarest(values[x:y], common, counts, percent) for x, y in zip(starts[:-1], starts[1:], strict=True)]
                    each = [len(f) for f in found]
                    columns = {n: np.repeat(part.column(n).to_numpy(), each) for n in ("cluster", "root", "node", "n_shingles")}
                    tokens = np.concatenate([np.empty(0, np.uint64), *found]).view(np.int64)
                    before = [f[max(0, j - EARLIER) : j].tobytes() for f in found for j in range(len(f))]
                    yield pa.RecordBatch.from_pydict({**columns, "token": tokens, "before": pa.array(before, pa.binary())})

    return run


def _near(rows: list[dict], percent: int) -> list[tuple[int, int]]:
    """Pairs (larger node, smaller node) of one pair of blocks that the long signatures leave open.

    Rows of the first block come with side 0, of the second with side 1; a block with itself has side 0 only.
    Nodes that share an earlier shingle meet there too, so the pair is left to it.
    """
    signatures = np.frombuffer(b"".join(r["signature"] for r in rows), np.uint8).reshape(len(rows), LONG)
    node, root, size, side = (np.array([r[n] for r in rows]) for n in ("node", "root", "n_shingles", "side"))
    share = percent / 100
    least = LONG * (share - MARGIN * np.sqrt(share * (1 - share) / LONG))
    earlier = [frozenset(np.frombuffer(r["before"], np.int64).tolist()) for r in rows]
    out = []
    for a in np.flatnonzero(side == 0):
        others = np.flatnonzero(side == 1) if (side == 1).any() else np.arange(a + 1, len(rows))
        fits = 100 * np.minimum(size[others], size[a]) >= percent * np.maximum(size[others], size[a])
        others = others[fits & (root[others] != root[a])]
        alike = (signatures[others] == signatures[a]).sum(axis=1)
        out += [(max(node[a], node[b]), min(node[a], node[b])) for b in others[alike >= least] if earlier[a].isdisjoint(earlier[b])]
    return out


def _compare_blocks(percent: int):
    """Rows come sorted by cluster, token and pair of blocks; one pair of blocks is held at a time."""

    def out(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({n: pa.array([p[i] for p in pairs], pa.int64()) for i, n in enumerate("ab")})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            found: list[tuple[int, int]] = []
            for row in batch.to_pylist():
                now = (row["cluster"], row["token"], row["low"], row["high"])
                if now != key:
                    found += _near(held, percent) if held else []
                    key, held = now, []
                held.append(row)
            yield out(found)
        if held:
            yield out(_near(held, percent))

    return run


def _texts(nodes: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """node, text: one text per node, fetched by its document and the hash of its text."""
    return (
        nodes.select("node", "id", "text_key", "set_id").join(docs.select(_id(), "text_key", "text"), ["id", "text_key"])
        .select("node", "set_id", "text")
        .mapInArrow(_same_sets(k), "node long, text string").dropDuplicates(["node"])
    )


def _links(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) that hold on full sets."""
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"
    )
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_confirm(k, percent), "a long, b long")


def _text_key() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key")


def _id() -> Column:
    return F.coalesce("doc_id", F.lit(NO_ID)).alias("id")


def _meetings(placed: DataFrame, mixed: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """cluster, token, blocks, root, node, n_shingles, before: nodes that are to be compared with all of their cluster and token.

    Clusters of one block have the token 0. In larger ones a token is a shingle among the rarest of its nodes,
    in different components.
    """
    nodes = placed.join(mixed, "cluster")
    columns = ["cluster", "token", "blocks", "root", "node", "n_shingles", "before"]
    small = nodes.filter("blocks = 1").withColumns({"token": F.lit(0).cast("long"), "before": F.lit(b"")}).select(*columns)
    large = nodes.filter("blocks > 1").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).join(texts, "node")
    # The nodes of one block say how common a shingle is; the order may be any, a good one only saves work. A
    # cluster has at most BLOCK / COMMON times as many common shingles as a set of it has on average.
    seen = large.filter("block = 0").select("cluster", "text").mapInArrow(_shingles_of(k), "cluster long, shingle long")
    seen = seen.groupBy("cluster", "shingle").agg(F.count("*").alias("count")).filter(F.col("count") >= COMMON)
    common = seen.groupBy("cluster").agg(F.collect_list(F.struct("shingle", "count")).alias("common"))
    heads = mixed.filter("blocks > 1").join(common, "cluster", "left").select(
        "cluster", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"),
        F.coalesce("common", F.expr("cast(array() as array<struct<shingle:bigint,count:bigint>>)")).alias("common"),
    )
    rows = large.select("cluster", "block", "root", "node", "n_shingles", "text").unionByName(heads, allowMissingColumns=True)
    rows = rows.repartition("cluster", "block").sortWithinPartitions("cluster", "block", F.col("common").isNull())
    tokens = rows.mapInArrow(_rarest(k, percent), "cluster long, root long, node long, n_shingles long, token long, before binary")
    tokens = cut(tokens)
    shared = tokens.groupBy("cluster", "token").agg(F.min("root").alias("first"), F.max("root").alias("last"), F.count("*").alias("n"))
    shared = shared.filter("first < last").select("cluster", "token", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    return small.unionByName(tokens.join(shared, ["cluster", "token"]).select(*columns))


def _judged(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Per row: doc_id, text_key, n_shingles, root (of its group; null without words), component_id."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _text_key())
    sketches = cut(docs.mapInArrow(_sketch(k), "doc_id long, text_key long, n_shingles long, set_id binary, keys binary"))
    nodes = sketches.filter("set_id is not null").groupBy("set_id").agg(
        F.min("doc_id").alias("doc_id"), F.min(F.struct(F.col("doc_id").isNull().alias("without"), _id(), "text_key")).alias("row"),
        F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys"),
    )
    nodes = cut(nodes.repartition("set_id").withColumn("node", F.monotonically_increasing_id()))
    named = nodes.select("node", "set_id", "doc_id", "row.id", "row.text_key", "n_shingles")
    entries = nodes.select("node", "n_shingles", "keys").mapInArrow(
        _explode_keys, "key long, node long, n_shingles long"
    )
    buckets = entries.groupBy("key").agg(F.min("node").alias("leader"), F.max("node").alias("last")).filter("leader < last")
    members = cut(entries.join(buckets.select("key", "leader"), "key"))
    to_leader = cut(members.filter("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct())
    clusters = cut(components(to_leader).withColumnRenamed("root", "cluster"))
    texts = cut(_texts(clusters.join(named, "node"), docs, k))
    links = cut(_links(to_leader, texts, k, percent))
    placed = clusters.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = cut(placed.join(named.select("node", "n_shingles"), "node"))
    mixed = placed.groupBy("cluster").agg(F.min("root").alias("first"), F.max("root").alias("last"), F.count("*").alias("n"))
    mixed = mixed.filter("first < last").select("cluster", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    met = cut(_meetings(placed, mixed, texts, k, percent))
    signed = met.select("node").distinct().join(texts, "node").mapInArrow(_sign(k), "node long, signature binary")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.expr("sequence(0, blocks - 1)"))
    dealt = met.join(signed, "node").withColumn("block", block).withColumn("other", other).select(
        "cluster", "token", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        (F.col("block") > F.col("other")).cast("int").alias("side"), "root", "node", "n_shingles", "before", "signature",
    )
    keys = ["cluster", "token", "low", "high"]
    open_pairs = dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_compare_blocks(percent), "a long, b long").distinct()
    links = links.unionByName(_links(cut(open_pairs.join(to_leader, ["a", "b"], "left_anti")), texts, k, percent))
    reached = named.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = reached.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    groups = reached.join(least, "root").select("set_id", "root", "component_id")
    own = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return (
        sketches.select("doc_id", "text_key", "n_shingles", "set_id")
        .join(groups, "set_id", "left")
        .select("doc_id", "text_key", "n_shingles", "root", own.alias("component_id"))
    )


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Per row of docs (doc_id long, text): doc_id, n_shingles, component_id, kept.

    Words are runs of characters other than space and \\x09-\\x0D, with A-Z lower-cased; sets are the
    distinct k-word shingles; two texts are linked when 100 * intersection >= percent * union.
    component_id is the smallest doc_id reachable over links, kept says that it is the row's own.
    Null texts and texts without words have an empty set and are linked with nothing. Rows that
    share a doc_id are separate documents. Rows without a doc_id are linked like others; where no row of a
    group has one, component_id is null and every row is kept. Other columns are ignored.
    """
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return _judged(docs, k, percent).select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs, all columns, with one row left of each group of near-duplicates.

    The row with the smallest doc_id stays (a null one only where there is no other), of several the one
    with the smallest hash of its text. Rows without words all stay.
    """
    judged = _judged(docs, k, percent).withColumn("id", F.coalesce("doc_id", F.lit(NO_ID)))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "id", "text_key")).alias("first")
    leaders = judged.filter("root is not null").groupBy("root").agg(first)
    leaders = leaders.select(F.col("first.id").alias("__id"), F.col("first.text_key").alias("__key"), F.lit(True).alias("__leads"))
    empty = judged.filter("root is null").select(F.col("id").alias("__id"), F.col("text_key").alias("__key"), F.lit(False).alias("__leads"))
    stay = leaders.unionByName(empty.distinct())
    keyed = docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "__key": _text_key()})
    found = keyed.join(stay, ["__id", "__key"])
    again = F.row_number().over(Window.partitionBy("__id", "__key").orderBy("__leads"))
    found = found.withColumn("__again", again).filter("not __leads or __again = 1")
    return found.select(*docs.columns)
