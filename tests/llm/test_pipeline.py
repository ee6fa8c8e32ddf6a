"""Each stage of the corpus pipeline against a plain version, on its own input."""

import zlib
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from railgauge.llm import personal, quality, tokenizing
from railgauge.llm.queries import tokenizer_path
from test_near_duplicates import plain as near_plain
from test_near_duplicates import shingles


@pytest.fixture(scope="module")
def outputs(spark, sf_dir, tmp_path_factory):
    """The rows that go into each stage, and the last stage's."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        out.append(docs)
    return out


def rows(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_columns_stay(outputs):
    assert all(df.columns == outputs[0].columns for df in outputs[:5])


def test_quality_goes_by_the_score(spark, sf_dir, outputs):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = {r["doc_id"]: r["predicted"] for r in quality.score_quality(outputs[0], labels).collect()}
    assert rows(outputs[1]) == [(d, t) for d, t in rows(outputs[0]) if scored[d]]
    marks = {r["doc_id"]: r["quality"] for r in labels.collect()}
    left = {d for d, _ in rows(outputs[1])}
    assert sum(d in left for d, q in marks.items() if q) >= 0.95 * sum(marks.values())
    assert sum(d in left for d, q in marks.items() if not q) <= 0.2 * sum(q == 0 for q in marks.values())


def test_one_of_each_group_stays(outputs):
    given = rows(outputs[1])
    kept = {d for d, _, _, k in near_plain(given, 5) if k}
    assert rows(outputs[2]) == [r for r in given if r[0] in kept]
    assert len(kept) < len(given) and all(shingles(t, 5) or d in kept for d, t in given)


def test_no_benchmark_item_stays(spark, sf_dir, outputs):
    items = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    given, left = rows(outputs[2]), rows(outputs[3])
    assert any(i in t for _, t in given for i in items) and not any(i in t for _, t in left for i in items)
    assert len(left) >= len(given) - 1.5 * sum(any(i in t for i in items) for _, t in given)


def test_personal_data_is_masked(outputs):
    given, left = dict(rows(outputs[3])), dict(rows(outputs[4]))
    assert given.keys() == left.keys()
    for doc_id, text in given.items():
        spans = personal.base_spans(text)
        if not spans:
            assert left[doc_id].count("[") >= text.count("[")
        assert not personal.base_spans(left[doc_id])
        if not personal.TRIGGER.search(text):
            assert left[doc_id] == text
    assert all(r["n_chars"] == len(r["text"]) for r in outputs[4].collect())


def test_packing_holds_every_id(outputs):
    library = tokenizing.load(tokenizer_path("word_bpe_49k.json"))
    pieces = defaultdict(list)
    for r in outputs[5].collect():
        pieces[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"]))
    texts = rows(outputs[4])
    assert set(pieces) == {d for d, _ in texts}
    for doc_id, text in texts:
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 2], "<u4")
        assert sorted(pieces[doc_id]) == [
            (a, len(ids[a : a + 4096]), zlib.crc32(ids[a : a + 4096].tobytes())) for a in range(0, len(ids), 4096)
        ]


def test_run_applies_all_stages(spark, sf_dir, outputs):
    found, expected = corpus_pipeline.run(spark, sf_dir), outputs[5]
    columns = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, found.select(columns).collect())) == sorted(map(tuple, expected.select(columns).collect()))


def test_awkward_rows_go_through(spark, sf_dir, table, awkward):
    docs = table(awkward, extra=False).selectExpr("*", "'en' as lang", "'s' as source", "cast(length(text) as long) as n_chars", "'x' as root", "1 as __key2")
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    assert docs.count() > 0
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, sf_dir)
    assert empty.count() == 0
