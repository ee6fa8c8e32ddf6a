import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from railgauge.llm import lexical_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k=10):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, ts in wanted.items():
        scored = []
        for d, c in counts:
            m = 10 + 90 * sum(c.values()) * n_docs // n_terms
            parts = (math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in ts if t in c)
            scored.append((sum(parts), d))
        best = sorted((x for x in scored if x[0] > 0), key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k]
        out += [(item, i + 1, d, s) for i, (s, d) in enumerate(best)]
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def items(spark):
    def build(rows):
        return spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "1 as rank", "2 as term", "'z' as doc_id")

    return build


ITEMS = [(1, "w1 w2, W3; w1 zzz"), (2, None), (3, ""), (4, "東京 naïve ÅNGSTRÖM"), (5, "ångström ab x"), (6, "?!"), (None, "er w7"), (7, "w5"), (7, "w6 w5")]


def test_awkward_rows(table, awkward, items):
    assert got(lexical_search.rank_documents(table(awkward), items(ITEMS))) == plain(awkward, ITEMS)


def test_ties_and_every_item_in_a_block_of_its_own(table, items, monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", 1)
    docs = [(i, f"same words {'more ' * (i % 3)}x{i % 5}") for i in range(60)] + [(None, "same words")] * 2
    wanted = [(i, t) for i, t in enumerate(["same", "words x3", "more", "x1 x2 x3", "none"])]
    assert got(lexical_search.rank_documents(table(docs), items(wanted), k=4)) == plain(docs, wanted, 4)


def test_nothing(table, items, awkward):
    assert got(lexical_search.rank_documents(table([]), items(ITEMS))) == []
    assert got(lexical_search.rank_documents(table(awkward), items([]))) == []
    assert got(lexical_search.rank_documents(table([(1, None), (2, "--")]), items(ITEMS))) == []


def test_pieces_and_pruned_strata_change_nothing(monkeypatch):
    """Small pieces, so that best rows are carried on; fewer postings are scored than there are."""
    rng = np.random.default_rng(3)
    size, vocabulary = 4000, 60
    m = rng.integers(10, 300, size)
    n_terms = rng.integers(0, 12, size)
    lists = [np.sort(rng.choice(vocabulary, n, replace=False)) for n in n_terms]
    tfs = [rng.geometric(0.5, n) for n in n_terms]
    weights = rng.integers(0, 8000, vocabulary)
    scored = []
    real = lexical_search.Index.scores
    monkeypatch.setattr(lexical_search.Index, "scores", lambda self, rows, w: scored.append(int(self.group_size[lexical_search._ranges(self.list_first[rows], self.list_size[rows])].sum())) or real(self, rows, w))
    whole = 0
    for terms_of in (np.array([1, 2, 3]), np.arange(30), np.array([59])):
        best = np.empty((0, 2), dtype=np.int64)
        for a in range(0, size, 1000):
            part = slice(a, a + 1000)
            index = lexical_search.Index(m[part], np.arange(a, a + 1000), n_terms[part], np.concatenate(lists[part]), np.concatenate(tfs[part]), 8)
            best = lexical_search.search(index, terms_of, weights[terms_of], best, 10)
        expected = []
        for d in range(size):
            hits = [(weights[t], tf) for t, tf in zip(lists[d], tfs[d], strict=True) if t in terms_of]
            whole += len(hits)
            expected.append((-sum(int(w) * (10**9 * int(tf) // (1000 * int(tf) + 8 * int(m[d]))) for w, tf in hits), d))
        assert [(-s, d) for s, d in best.tolist()] == [x for x in sorted(expected)[:10] if x[0] < 0]
    assert sum(scored) < whole


def test_sums_beyond_doubles():
    where, what = np.array([0, 0, 1]), np.array([1 << 60, 1, 3])
    assert lexical_search._sums(where, what, 2).tolist() == [(1 << 60) + 1, 3]
