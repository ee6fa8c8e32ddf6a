import random

import numpy as np
import pyarrow as pa
import pytest

from railgauge.llm import near_duplicates as near_duplicates_module
from railgauge.llm.components import components
from railgauge.llm.near_duplicates import LONG, drop_near_duplicates, long_signatures, near_duplicates, rarest, shingle_sets

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingles(text, k):
    words = (text or "").encode().translate(LOWER).split()
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[p : p + k]) for p in range(len(words) - k + 1))


def plain(rows, k, percent=80):
    """(doc_id, n_shingles, component_id, kept) of each row, by all pairs."""
    sets = [shingles(t, k) for _, t in rows]
    group = list(range(len(rows)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                group[root(a)] = root(b)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        least = min(ids, default=None) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), least, least is None or doc_id == least))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def family(seed=0, n=70):
    """Copies of one text with few to many changed words, some copies of copies, some whole copies."""
    rng = random.Random(seed)
    base = [f"v{rng.randint(0, 900)}" for _ in range(120)]
    rows = []
    for i in range(n):
        words = list(base) if i % 5 else rows[rng.randrange(len(rows))][1].split() if rows else list(base)
        for _ in range(rng.randint(0, 9)):
            words[rng.randrange(len(words))] = f"n{rng.randint(0, 10**6)}"
        rows.append((1000 - i, " ".join(words)))
    return rows + [(2000 + i, t) for i, (_, t) in enumerate(rows[:10])]


@pytest.mark.parametrize("k", [4, 5])
def test_family_against_all_pairs(table, k):
    rows = family(k)
    expected = plain(rows, k)
    assert 5 < len({c for _, _, c, _ in expected}) < 65
    assert got(near_duplicates(table(rows), k)) == expected


@pytest.mark.parametrize("block", [4, 16])
def test_large_clusters_against_all_pairs(table, monkeypatch, block):
    """Clusters of several blocks go by their rarest shingles, and lose no pair."""
    monkeypatch.setattr(near_duplicates_module, "BLOCK", block)
    monkeypatch.setattr(near_duplicates_module, "COMMON", 2)
    rows = family(6, 120)
    assert got(near_duplicates(table(rows), 4)) == plain(rows, 4)


def test_template_below_the_similarity_meets_nowhere(spark, table, monkeypatch):
    """Texts of one template, each with words of its own: rows to compare do not grow with the pairs."""
    monkeypatch.setattr(near_duplicates_module, "BLOCK", 32)
    rng = random.Random(8)
    base, rows = [f"v{i}" for i in range(200)], []
    for i in range(400):
        words = list(base)
        for at in rng.sample(range(200), 14):
            words[at] = f"n{i}x{at}"
        rows.append((i, " ".join(words)))
    met, real = [], near_duplicates_module._meetings
    monkeypatch.setattr(near_duplicates_module, "_meetings", lambda *a: met.append(real(*a)) or met[-1])
    found = got(near_duplicates(table(rows), 4))
    assert {r[2] for r in found} == set(range(400))
    assert met[0].count() < 3 * len(rows)


def test_rarest_shingles_of_alike_sets_meet():
    rng = np.random.default_rng(3)
    for _ in range(500):
        both = rng.integers(0, 1 << 62, rng.integers(1, 60), dtype=np.uint64)
        a, b = (np.unique(np.append(both, rng.integers(0, 1 << 62, rng.integers(0, 12), dtype=np.uint64))) for _ in "ab")
        common = np.unique(rng.choice(both, min(len(both), 20)))
        counts = rng.integers(1, 5, len(common))
        shared = len(np.intersect1d(a, b))
        if 100 * shared >= 80 * (len(a) + len(b) - shared):
            assert len(np.intersect1d(rarest(a, common, counts, 80), rarest(b, common, counts, 80)))


def test_near_copies_without_an_id_are_linked(table):
    words = [f"w{i}" for i in range(100)]
    near = " ".join([*words[:99], "other"])
    rows = [(None, " ".join(words)), (None, near), (7, " ".join(["other", *words[1:]])), (None, "all alone here with words")]
    assert got(near_duplicates(table(rows), 4)) == plain(rows, 4)
    left = drop_near_duplicates(table(rows[:2] + rows[3:]), 4).collect()
    assert len(left) == 2


def test_awkward_rows(table, awkward):
    assert got(near_duplicates(table(awkward), 4)) == plain(awkward, 4)


def test_drop_leaves_one_of_each_group(table, awkward):
    rows = awkward + family(3)
    left = drop_near_duplicates(table(rows), 4)
    assert left.columns == table(rows).columns
    kept = [(r["doc_id"], r["text"]) for r in left.collect()]
    judged = {}
    for (doc_id, _, component, _), (_, text) in zip(sorted_by_row(rows, 4), rows):
        if shingles(text, 4):
            judged.setdefault(component if component is not None else text, []).append((doc_id, text))
    for group in judged.values():
        assert sum(r in group for r in kept) == 1
    assert sorted(map(repr, (r for r in kept if not shingles(r[1], 4)))) == sorted(map(repr, (r for r in rows if not shingles(r[1], 4))))


def sorted_by_row(rows, k):
    return [next(p for p in plain(rows, k) if p[0] == d and p[1] == len(shingles(t, k))) for d, t in rows]


def test_no_rows(table):
    assert got(near_duplicates(table([]))) == []
    assert drop_near_duplicates(table([])).collect() == []


def test_signatures_estimate_similarity():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    other = [w if rng.random() > 0.05 else "x" + w for w in words]
    texts = [" ".join(words), " ".join(other)]
    a, b = (shingles(t, 4) for t in texts)
    signed = long_signatures(*shingle_sets(pa.array(texts), 4))
    true = len(a & b) / len(a | b)
    assert abs(float(np.mean(signed[0] == signed[1])) - true) < 5 * np.sqrt(true * (1 - true) / LONG) + 1 / 256


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(61)} | {100: 100, 101: 100, 102: 100}
