import random
from collections import Counter

import pytest

from railgauge.llm.automaton import SuffixAutomaton
from railgauge.llm.substrings import remove_repeats


def plain(rows, span):
    words = [(t or "").encode().split() for _, t in rows]
    count = Counter(tuple(w[p : p + span]) for w in words for p in range(len(w) - span + 1))
    out = []
    for (doc_id, _), w in zip(rows, words):
        keep = [True] * len(w)
        for p in range(len(w) - span + 1):
            if count[tuple(w[p : p + span])] > 1:
                keep[p : p + span] = [False] * span
        kept = b" ".join(x for x, k in zip(w, keep) if k).decode()
        out.append((doc_id, len(w), len(w) - sum(keep), kept))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_automaton_counts_every_subsequence():
    rng = random.Random(1)
    for _ in range(60):
        sequences = [([rng.randint(0, 2) for _ in range(rng.randint(0, 14))], rng.randint(1, 2)) for _ in range(4)]
        span = rng.randint(1, 4)
        count = Counter()
        for s, n in sequences:
            for p in range(len(s) - span + 1):
                count[tuple(s[p : p + span])] += n
        automaton = SuffixAutomaton()
        for s, n in sequences:
            automaton.add(s, n)
        automaton.weigh()
        for s, _ in sequences:
            bits = sum(1 << p for p in range(len(s) - span + 1) if count[tuple(s[p : p + span])] > 1)
            assert automaton.repeated(s, span) == bits


@pytest.mark.parametrize("shard_contexts", [1, 4096])
@pytest.mark.parametrize("span", [4, 9])
def test_against_brute_force(table, span, shard_contexts):
    rng = random.Random(span)
    rows = [(i, " ".join(rng.choice("abcdefgh" if i % 3 else "ab") for _ in range(rng.randint(0, 40)))) for i in range(80)]
    found = remove_repeats(table(rows), span=span, anchor_words=2, shard_contexts=shard_contexts)
    assert got(found) == plain(rows, span)


def test_awkward_rows(table, awkward):
    assert got(remove_repeats(table(awkward))) == plain(awkward, 35)


def test_no_rows(table):
    assert got(remove_repeats(table([]))) == []
