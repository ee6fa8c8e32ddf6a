import random

import numpy as np
import pyarrow as pa
from railgauge.llm import decontamination
from railgauge.llm.decontamination import common_words, confirm, drop_leaks, find_leaks, judge_leaks, words_in_order

WORDS = [f"{a}{b}" for a in "stone river light paper green wind road house".split() for b in "abcdefghijklmnopqrstuvwxyz"]
ITEMS = "item_id long, text string"


def longest(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(400):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 12))] for _ in range(2))
        held = common_words(a, b)
        rest = iter(b)
        assert len(held) == longest(a, b) and all(a[i] in rest for i in held)


def test_answer_is_asked_of_paraphrases():
    item = [f"w{i}" for i in range(20)]
    assert confirm(item, ["x", *item, "y"], 0.8, 0.6) == (20, True, True)
    assert confirm(item, item[:13], 0.8, 0.6)[1:] == (False, False)
    assert confirm(item, item[4:12] + ["x"] + item[14:], 0.8, 0.6)[1:] == (True, True)
    assert not confirm(item, item[::-1], 0.8, 0.6)[2]


def corpus(seed=0):
    """Items, documents, and the (doc, item) pairs that were planted whole, changed or reworded."""
    rng = random.Random(seed)

    def text(n):
        return [rng.choice(WORDS) for _ in range(n)]

    items = [(i, text(rng.randint(15, 45))) for i in range(40)]
    docs, planted = [], set()
    for d in range(200):
        body = text(rng.randint(0, 300))
        if d % 5 == 0:
            i, words = items[rng.randrange(len(items))]
            words = [w if d % 10 or rng.random() > 0.12 else rng.choice(WORDS) for w in words]
            words = [w.upper() + "," if rng.random() < 0.2 else w for w in words]
            at = rng.randint(0, len(body))
            body[at:at] = words
            planted.add((d, i))
        docs.append((d, " ".join(body)))
    return [(i, " ".join(w)) for i, w in items], docs, planted


def exact(items, docs):
    """Pairs that the check of order confirms on any stretch of a document."""
    out = set()
    for d, text in docs:
        words = words_in_order(text)
        for i, item in items:
            item = words_in_order(item)
            size = 40 + 2 * 45
            if any(confirm(item, words[a : a + size], 0.8, 0.6)[2] for a in range(0, max(len(words), 1), 20)):
                out.add((d, i))
    return out


def test_recall_against_all_pairs(spark, table):
    items, docs, planted = corpus()
    found = {(r["doc_id"], r["item_id"]) for r in find_leaks(table(docs), spark.createDataFrame(items, ITEMS)).collect()}
    true = exact(items, docs)
    assert planted <= true | found
    assert len(found & true) >= 0.95 * len(true) and found <= true
    in_blocks = find_leaks(table(docs), spark.createDataFrame(items, ITEMS), block=15)
    assert len({(r["doc_id"], r["item_id"]) for r in in_blocks.collect()} & true) >= 0.95 * len(true)


def test_whole_table(spark, sf_dir):
    from railgauge.llm.queries import op5_decontamination

    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    verbatim = {d for d, t in docs if any(i in t for _, i in items)}
    rows = op5_decontamination(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    marked = {r["doc_id"] for r in rows if r["contaminated"]}
    assert verbatim and verbatim <= marked and len(marked - verbatim) <= 0.01 * len(docs)


def test_awkward_rows(spark, table, awkward):
    items = [(1, awkward[3][1]), (2, None), (3, ""), (None, "x y z"), (4, "!!!"), (1, awkward[3][1])]
    bench = spark.createDataFrame(items, ITEMS)
    rows = {r["doc_id"]: list(r["item_ids"]) for r in judge_leaks(table(awkward), bench).collect()}
    assert set(rows) == {d for d, _ in awkward if d is not None} and rows[3] == [1] and rows[40] == []
    left = drop_leaks(table(awkward), bench)
    assert left.columns == table(awkward).columns
    gone = {d for d, ids in rows.items() if ids}
    assert sorted(map(repr, ((r["doc_id"], r["text"]) for r in left.collect()))) == sorted(repr(r) for r in awkward if r[0] not in gone)


def test_no_rows(spark, table):
    none, some = spark.createDataFrame([], ITEMS), spark.createDataFrame([(1, "a b c d")], ITEMS)
    assert find_leaks(table([(1, "a")]), none).collect() == []
    assert find_leaks(table([]), some).collect() == []
    assert not judge_leaks(table([(1, "a")]), none).first()["contaminated"]
    assert drop_leaks(table([(1, "a")]), none).count() == 1


def test_short_and_long_items(spark, table):
    rng = random.Random(8)
    vocabulary = [f"{w}{i}" for w in WORDS for i in range(6)]

    def text(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    sizes = [4] * 15 + [5] * 30 + [8] * 15 + [30] * 60 + [130] * 20 + [400] * 20
    items = [(i, text(n)) for i, n in enumerate(sizes)]
    docs, planted = [], set()
    for d, (i, words) in enumerate(items):
        body = text(150)
        at = rng.randint(0, len(body))
        # Long ones also with one word in six replaced.
        body[at:at] = [w if len(words) < 100 or d % 2 or rng.random() > 0.17 else rng.choice(vocabulary) for w in words]
        docs.append((d, " ".join(body)))
        planted.add((d, i))
    docs += [(len(items) + d, " ".join(text(200))) for d in range(60)]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], ITEMS)
    found = {(r["doc_id"], r["item_id"]) for r in find_leaks(table(docs), bench).collect()}
    brute, loose = set(), set()
    for d, doc in docs:
        words = words_in_order(doc)
        for i, item in items:
            n = len(item)
            width = min(2 * n, 21) if n < 12 else 40 + 2 * max(n, 60)
            some = [a for a, w in enumerate(words) if w in item] if n < 12 else range(0, len(words), 20)
            if any(confirm(item, words[a : a + width], 0.8, 0.6)[2] for a in some):
                brute.add((d, i))
            if n < 12 and any(confirm(item, words[max(0, a - 60) : a + 100], 0.8, 0.6)[2] for a in range(0, len(words), 20)):
                loose.add((d, i))
    assert planted <= brute and planted <= found
    assert {p for p in brute if sizes[p[1]] < 12} <= found <= brute | loose
    in_blocks = find_leaks(table(docs), bench, block=60)
    assert planted <= {(r["doc_id"], r["item_id"]) for r in in_blocks.collect()}


def test_sums_of_runs():
    rng = np.random.default_rng(5)
    for _ in range(20):
        runs = np.sort(rng.integers(0, 3000, rng.integers(0, 9000)))
        runs[: len(runs) // 3] = 0
        row, weight, table = rng.integers(0, 50, len(runs)), rng.random(len(runs)), rng.random((50, 3)).astype(np.float32)
        wanted = np.zeros((3000, 3))
        np.add.at(wanted, runs, table[row] * weight[:, None])
        starts = decontamination._starts(runs)
        assert np.allclose(decontamination._sums(starts, row, weight, table), wanted[runs[starts]], rtol=1e-3)


def test_range_sums_are_those_of_the_matrix():
    rng = random.Random(6)
    texts = [" ".join(rng.choice(WORDS[:60]) for _ in range(rng.choice([0, 3, 90, 700]))) for _ in range(60)]
    _, columns = decontamination.terms_of(pa.array([" ".join(WORDS)]))
    row_of = np.full(1 << decontamination.TERM_BITS, -1, np.int64)
    row_of[np.unique(columns)] = np.arange(len(np.unique(columns)))
    idf = np.random.default_rng(7).random(len(np.unique(columns)))
    start = np.random.default_rng(8).standard_normal((len(idf), 5)).astype(np.float32)
    passages = np.zeros((0, len(idf)))
    for text in texts:
        words = text.split()
        for a in range(0, len(words), 20):
            counts = np.zeros(len(idf))
            _, columns = decontamination.terms_of(pa.array([" ".join(words[a : a + 40])]))
            np.add.at(counts, row_of[columns], 1)
            passages = np.vstack([passages, np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0) * idf])
    sums = np.zeros(start.shape)
    for out in decontamination._range_sums(row_of, idf, start)(iter([pa.RecordBatch.from_pydict({"text": texts})])):
        for r in out.to_pylist():
            sums[r["row"]] = np.frombuffer(r["values"], np.float32)
    assert np.allclose(sums, passages.T @ (passages @ start), rtol=1e-3, atol=1e-3 * np.abs(sums).max())


def held_of_rare_passages(spark, folder, monkeypatch, stage):
    """The share of its length that the space holds of each document that is in the items' words.

    There are 90 of them, each a passage, among 100,000 that have no word of an item.
    """
    rng = random.Random(9)
    many = [f"{w}{i}" for w in WORDS for i in range(2)]
    rare = [" ".join(rng.sample(many, 15)) for _ in range(90)]
    items = [(i, " ".join(many[i * 20 : i * 20 + 20])) for i in range(len(many) // 20)]
    docs = spark.createDataFrame(list(enumerate(rare)), "doc_id long, text string").repartition(3)
    others = spark.range(1000, 101_000).selectExpr("id as doc_id", "'nothing of it' as text")
    docs.unionByName(others).selectExpr("*", "'en' as lang", "'x' as source", "cast(length(text) as long) as n_chars").write.parquet(
        f"{folder}/documents.parquet"
    )
    spark.createDataFrame(items, ITEMS).write.parquet(f"{folder}/benchmark.parquet")
    spaces, build = [], decontamination.build_space
    monkeypatch.setattr(decontamination, "build_space", lambda *a: spaces.append(build(*a)) or spaces[-1])
    assert stage(spark, str(folder)).count() == 100_090
    (space,) = spaces
    _, passage, row, weight, _, _ = decontamination._passages(pa.RecordBatch.from_pydict({"text": rare}), space.row_of, space.idf)
    found, product = decontamination._project(passage, row, weight, space.basis)
    assert list(found) == list(range(90)) and space.basis.shape[1] < space.basis.shape[0]
    return np.linalg.norm(product, axis=1) / np.sqrt(np.bincount(passage, weights=weight**2))


def test_space_is_fitted_on_every_document(spark, tmp_path, monkeypatch):
    from railgauge.llm.queries import op5_decontamination

    held = held_of_rare_passages(spark, tmp_path, monkeypatch, op5_decontamination)
    assert held.min() > 0.99


def test_space_of_the_pipeline_is_fitted_on_every_document(spark, tmp_path, monkeypatch):
    import corpus_pipeline

    def stage(spark, folder):
        return dict(corpus_pipeline.STAGES)["decontaminate"](spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)

    assert held_of_rare_passages(spark, tmp_path, monkeypatch, stage).min() > 0.99
