import hashlib
import random
import re

import numpy as np

from railgauge.llm import tagger
from railgauge.llm.personal import KINDS, base_spans, find_personal_data, luhn, mask_personal_data, train

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    def fits(kind, body):
        digits = re.sub("[^0-9]", "", body)
        if kind == "ip":
            return all(int(p) <= 255 for p in body.split("."))
        return {"email": True, "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]

    found = [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if fits(k, m[0])]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def line(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_check_digit():
    assert luhn("4539148803436467") and not luhn("4539148803436468") and luhn("0000")


def test_patterns_against_plain_search():
    rng = random.Random(6)
    parts = ["1", "12", "255", "256", ".", "@", "a", "b-c", "_", " ", "-", "+", "(", ")", "4539148803436467", "é", "x.y", "1.2.3.4", "+1 (017) 555-7713", "\n"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert [(KINDS[k], a, b) for k, a, b in base_spans(text)] == plain(text), text


def test_patterns_are_linear():
    for text in ("a" * 200_000 + "@", "1" * 200_000, "1." * 100_000, "+" * 100_000, "1 " * 100_000, "@" * 100_000):
        base_spans(text)


def test_gradient():
    rng = np.random.default_rng(0)
    w = {k: (v + 0.1 * rng.standard_normal(v.shape)).astype(np.float64) for k, v in tagger.initial(5).items()}
    symbols, tags = rng.integers(1, 129, (3, 7)), rng.integers(0, 5, (3, 7))
    symbols[1, 5:] = tags[1, 5:] = 0
    _, gradient = tagger.loss_and_gradient(symbols, tags, w)
    for k in w:
        i = (symbols[0, 2], 3) if k == "embed" else tuple(rng.integers(0, d) for d in w[k].shape)
        held, sides = w[k][i], []
        for step in (1e-3, -1e-3):
            w[k][i] = held + step
            sides.append(tagger.loss_and_gradient(symbols, tags, w)[0])
        w[k][i] = held
        assert abs((sides[0] - sides[1]) / 2e-3 - gradient[k][i]) < 5e-3 * max(1, abs(gradient[k][i])), k


def test_best_tags_against_all_paths():
    import itertools

    rng = np.random.default_rng(2)
    w = {"move": rng.standard_normal((3, 3)), "begin": rng.standard_normal(3)}
    score, lengths = rng.standard_normal((4, 5, 3)), np.array([5, 3, 1, 4])
    for row, n in enumerate(lengths):
        def total(path):
            return w["begin"][path[0]] + sum(score[row, t, k] for t, k in enumerate(path)) + sum(w["move"][a, b] for a, b in zip(path, path[1:]))

        best = max(itertools.product(range(3), repeat=int(n)), key=total)
        assert tuple(tagger.best_tags(score, lengths, w)[row, :n]) == best


def personal_rows(n=160, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [rng.choice("the road by river and stone light in wind".split()) for _ in range(40)]
        card = [rng.randint(0, 9) for _ in range(15)]
        card = next("".join(map(str, card)) + str(c) for c in range(10) if luhn("".join(map(str, card)) + str(c)))
        kind = [f"u{rng.randint(1, 99)}@mail{i % 9}.example.com", f"{rng.randint(1, 255)}.{rng.randint(0, 255)}.7.{rng.randint(0, 255)}", card]
        kind.append(f"+1 ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)}")
        words.insert(rng.randint(0, 40), kind[i % 4])
        rows.append((i, " ".join(words)))
    return rows


def test_tagger_finds_what_the_patterns_lose(table):
    model = train(table(personal_rows()))
    held = personal_rows(40, 9)
    for (_, text), tags in zip(held, model.tag([t for _, t in held])):
        kind, a, b = base_spans(text)[0]
        assert (tags[a:b] > 0).mean() > 0.5
    lost = [(1, "stone by the 98765432101234 4539148803436467 in the wind and road by river light")]
    row = find_personal_data(table(lost), model).first()
    assert row["n_card"] == 0 and row["base"] == ""
    clean = [(2, "no data by the road in 1999 with 12 stones and 345 lights or token cb1a9fee807a05366fcb8b6c95c7c565")]
    assert find_personal_data(table(clean), model).first()["spans"] == ""


def test_awkward_rows(table, awkward):
    rows = awkward + personal_rows(40) + [(400, "x 4539148803436467 " * 300), (401, "9" * 20_000)]
    model = train(table(rows))
    by_row = sorted((repr((r["doc_id"], r["base"])) for r in find_personal_data(table(rows), model).collect()))
    assert by_row == sorted(repr((d, line(plain(t)))) for d, t in rows)
    masked = mask_personal_data(table(rows), model)
    assert masked.columns == table(rows).columns
    texts = {r["doc_id"]: r["text"] for r in masked.collect() if r["doc_id"] is not None and r["doc_id"] >= 100}
    assert texts[400] == "x [CARD] " * 300 and "[EMAIL]" in "".join(t or "" for t in (r["text"] for r in masked.collect()))
    assert sum(r["text"] is None for r in masked.collect()) == 2


def test_without_training_or_rows(table):
    assert train(table([(1, "plain words only"), (2, None)])) is None
    assert find_personal_data(table([]), None).collect() == []
    row = find_personal_data(table([(1, "a@b.c")]), None).first()
    assert (row["n_email"], row["spans"]) == (1, "email:0:5")


def test_whole_table(spark, sf_dir):
    from railgauge.llm.queries import op8_personal_data

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op8_personal_data(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(line(base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s[0] == k for s in base) for k in KINDS]
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(r["spans"].split(",")) | {""}
