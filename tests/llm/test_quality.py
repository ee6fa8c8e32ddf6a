import zlib

import numpy as np
import pyarrow as pa

from railgauge.llm.quality import drop_poor, features_of, fit, score_quality

LABELS = "doc_id long, quality int"


def test_repeats_and_order_of_features():
    a, b, c = (set(f.tolist()) for f in features_of(pa.array(["ab cd", "ab cd", None])))
    assert a == b and c == set()
    once, twice = (set(f.tolist()) for f in features_of(pa.array(["wo wa", "wo wa wo wa"])))
    assert once <= twice


def test_fit_separates():
    rng = np.random.default_rng(1)
    rows = [np.unique(np.r_[rng.integers(0, 500, 30), [600 + label]]) for label in (0, 1) * 60]
    labels = np.array([False, True] * 60)
    model = fit(rows, labels)
    scores = np.array([model.score(r) for r in rows])
    assert (scores[labels] > 0.5).all() and (scores[~labels] < 0.5).all()


def test_held_out_accuracy(spark):
    from railgauge.llm.queries import op6_quality

    sf_dir = "/root/testdata/sf0.01"
    rows = op6_quality(spark, sf_dir).toPandas()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert (rows["held_out"] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in rows["doc_id"]]).all()
    assert rows["score"].between(0, 1).all() and (rows["predicted"] == (rows["score"] >= 0.5)).all()
    both = rows[rows["held_out"]].merge(labels, on="doc_id")
    assert (both["predicted"] == both["quality"]).mean() > 0.93


def test_awkward_rows(spark, table, awkward):
    labels = spark.createDataFrame([(i, int(i % 2)) for i in range(30)] + [(None, 1), (5, 0), (900, 1), (7, None), (8, 9)], LABELS)
    rows = score_quality(table(awkward), labels).collect()
    assert sorted((repr(r["doc_id"]) for r in rows)) == sorted(repr(d) for d, _ in awkward)
    assert len({r["score"] for r in rows if r["doc_id"] in (40, 41)}) == 1
    left = drop_poor(table(awkward), labels)
    assert left.columns == table(awkward).columns and left.count() == sum(r["predicted"] for r in rows)


def test_without_labels_or_rows(spark, table):
    none = spark.createDataFrame([], LABELS)
    assert [r["score"] for r in score_quality(table([(1, "a b"), (2, None)]), none).collect()] == [0.5, 0.5]
    assert score_quality(table([]), none).collect() == []
