import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from railgauge.llm import periodic_runs
from railgauge.llm.words import words_of

SPACES = " \t\n\x0b\x0c\r"


def words(text):
    for c in SPACES[1:]:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def plain_runs(w):
    """Every lag on its own: the stretches that agree with themselves, without those of a smaller period."""
    number = {}
    codes = np.array([number.setdefault(x, len(number)) for x in w], dtype=np.int64)
    out = []
    for q in range(1, len(w) // 4 + 1):
        same = np.concatenate([[False], codes[q:] == codes[:-q], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for i, j in edges.reshape(-1, 2).tolist():
            length, part = j + q - i, w[i : j + q]
            if length >= max(6, 4 * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                out.append((i, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def plain(doc_id, text, loops):
    w = words(text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if loops and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w, plain_runs(w)


def digest_row(doc_id, text):
    w, runs = plain(doc_id, text, True)
    best = min(((-n, s, q) for s, n, q in runs), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    shown = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
    return (doc_id, len(runs), *shown, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(kept(w, runs)))


def test_runs_against_every_lag():
    rng = random.Random(5)
    for _ in range(600):
        texts = []
        for _ in range(rng.randint(1, 4)):
            n = rng.choice([0, 1, 5, 6, 7, 20, 60, 150, 400])
            w = [rng.choice("abcdefghijklmnopqrst"[: rng.choice([1, 2, 3, 20])]) for _ in range(n)]
            if n and rng.random() < 0.6:
                s, p = rng.randrange(n), rng.randint(1, max(1, n // 4))
                w = [w[i] if i < s else w[s + (i - s) % p] for i in range(n)] + [rng.choice("abc") for _ in range(rng.randint(0, 9))]
            texts.append(w)
        found = periodic_runs.find_runs(words_of(pa.array([" ".join(w) for w in texts]))).tolist()
        assert [tuple(r) for r in found] == [(d, *r) for d, w in enumerate(texts) for r in plain_runs(w)]


def test_widening_is_done_once_per_stretch(monkeypatch):
    """A text of one repeated word has as many seeds as words, and is widened once to each side."""
    calls = []
    real = periodic_runs._agreeing
    monkeypatch.setattr(periodic_runs, "_agreeing", lambda *a: calls.append(a) or real(*a))
    found = periodic_runs.find_runs(words_of(pa.array(["x " * 50_000, "y"])))
    assert found.tolist() == [[0, 0, 50_000, 1]] and len(calls) == 2


def test_awkward_rows(table, awkward):
    rows = awkward + [(80, "a b " * 7 + "c"), (None, "a b " * 7), (80, "la " * 6), (81, "la " * 5), (82, "é　é\x1cé " * 9)]
    found = sorted(periodic_runs.periodic_runs(table(rows)).collect(), key=repr)
    expected = []
    for doc_id, text in rows:
        w, runs = plain(doc_id, text, False)
        expected.append((doc_id, len(w), runs, kept(w, runs)))
    assert sorted(([r[0], r[1], [tuple(x) for x in r[2]], r[3]] for r in found), key=repr) == sorted(map(list, expected), key=repr)


def test_loops_and_digests(table, awkward):
    rows = [(i, awkward[i % 30][1]) for i in range(100, 400)] + awkward
    found = periodic_runs.digests(periodic_runs.periodic_runs(periodic_runs.with_loops(table(rows)))).collect()
    assert sorted(map(tuple, found), key=repr) == sorted((digest_row(*r) for r in rows), key=repr)
    assert sum(r["n_runs"] for r in found) >= 10  # the loops of a tenth of the rows, if nothing else


def test_no_rows(table):
    assert periodic_runs.digests(periodic_runs.periodic_runs(periodic_runs.with_loops(table([])))).collect() == []


def test_shorter_runs_are_refused(table):
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(table([]), least=5)
