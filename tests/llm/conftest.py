"""Documents with every awkward case, beside ordinary text."""

import random

import pytest

WORDS = "the of and in to that for with stone river light paper green wind seven road house glass".split()
#: Columns that the operators use inside, as strangers in the input.
CLASHES = ["n", "node", "key", "score", "range", "place", "text_key", "doc_tokens", "batch", "set_id", "base"]


def prose(rng: random.Random, n: int, words=WORDS) -> str:
    return " ".join(rng.choice(words) + rng.choice(["", "", "", ".", ","]) for _ in range(n))


@pytest.fixture(scope="session")
def awkward():
    """(doc_id, text): nulls, empty and white-space texts, repeated rows and ids, a very long text, other scripts."""
    rng = random.Random(4)
    many = [f"w{i}" for i in range(400)]
    long = prose(rng, 30_000, many)
    shared = prose(rng, 60, many)
    rows = [(i, prose(rng, rng.randint(1, 120), many)) for i in range(30)]
    rows += [(40, None), (41, ""), (42, " \n\t "), (None, prose(rng, 50, many)), (None, None)]
    rows += [(50, shared), (51, shared), (51, shared), (52, "Ab " + shared + " zz"), (53, shared.upper())]
    rows += [(54, rows[0][1]), (54, rows[1][1]), (60, long), (61, "x"), (62, "X "), (63, "Er " * 90)]
    rows += [(70, "naïve 東京 ÅNGSTRÖM ǅ ΑΣ <|endoftext|> it's 'S   a b \x1c ²½"), (71, "<|startoftext|>x<|endoftext|>")]
    return rows


@pytest.fixture(scope="session")
def table(spark):
    """A DataFrame of (doc_id, text) rows with columns of clashing names."""

    def build(rows, extra=True):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        return df.selectExpr("*", *[f"'x' as {c}" for c in CLASHES]) if extra else df

    return build
