import hashlib
import random

from pyspark.sql import functions as F

from railgauge.llm.fingerprints import edited_fingerprints, fingerprint, paragraphs, vector_sums


def pieces(text, words):
    out = []
    for line in text.split("\n"):
        found = line.split()
        out += [found[i : i + words] for i in range(0, len(found), words)]
    return out


def prints(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    each = rows.select("id", F.explode_outer(paragraphs(F.col("text"), 8)).alias("p"))
    sums = [s.alias(f"s{i}") for i, s in enumerate(vector_sums(F.col("p")))]
    names = F.array(*[f"s{i}" for i in range(len(sums))])
    found = each.groupBy("id").agg(*sums, F.count("p").alias("n")).select("id", names.alias("sums"), "n", fingerprint(names, F.col("n")).alias("print"))
    return {r["id"]: r for r in found.collect()}


def test_order_does_not_matter_and_paragraphs_add_up(spark):
    lines = ["one two", "three", "four five six", "one two"]
    found = prints(spark, ["\n".join(lines), "\n".join(reversed(lines)), "\n".join(lines[:3]), lines[3], "one two three"])
    assert found[0]["print"] == found[1]["print"] != found[2]["print"]
    assert [a + b for a, b in zip(found[2]["sums"], found[3]["sums"])] == found[0]["sums"]
    assert found[0]["n"] == found[2]["n"] + found[3]["n"]
    assert found[4]["print"] != found[3]["print"]


def test_paragraphs_are_bounded(spark):
    text = "a b  c\td e f g h i\n\n j"
    row = spark.createDataFrame([(text,)], "t string").select(paragraphs(F.col("t"), 4).alias("p")).first()
    assert [p.split() for p in row["p"]] == pieces(text, 4)


def edited(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for i, (doc_id, text) in enumerate(ordered):
        text, after = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        quarter = len(text) // 4
        out.append((doc_id, len(text), hashlib.sha256((text[: len(text) - quarter] + after[:quarter]).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_edits_follow_the_order(spark, table):
    rng = random.Random(2)
    ids = rng.sample(range(10_000), 150)
    rows = [(i, " ".join(rng.choice(["é", "東京", "ab\n", "xyz"]) for _ in range(rng.randint(0, 60)))) for i in ids] + [(None, None)]
    found = edited_fingerprints(table(rows)).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found), key=repr) == edited(rows)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in found)


def test_likeness_tells_edits_from_others(spark, sf_dir):
    from railgauge.llm.queries import op4_fingerprints

    rows = op4_fingerprints(spark, sf_dir).toPandas()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    first = {}
    for doc_id, printed in zip(rows["doc_id"], rows["fingerprint"]):
        assert first.setdefault(texts[doc_id], printed) == printed
    long = rows[rows["n_paragraphs"] >= 8]
    assert (long["near_edited"] > long["near_next"]).mean() > 0.95
    assert abs(long["near_edited"].mean() - 0.75) < 0.1


def test_awkward_rows(table, awkward):
    found = edited_fingerprints(table(awkward)).collect()
    assert len(found) == len(awkward)
    same = {}
    for r in found:
        if r["n_chars"] == 0:
            assert same.setdefault("", r["fingerprint"]) == r["fingerprint"] and r["near_edited"] == 1.0


def test_no_rows_and_one(table):
    assert edited_fingerprints(table([])).collect() == []
    row = edited_fingerprints(table([(1, "ab cd ef gh")])).first()
    assert row["edited_sha256"] == hashlib.sha256(b"ab cd ef ab").hexdigest()
