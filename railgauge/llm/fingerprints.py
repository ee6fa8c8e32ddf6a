"""Document fingerprints: a homomorphic multiset hash of paragraphs, in built-in functions only.

A paragraph is a line; a line of many words counts as pieces of `paragraph_words` words. Each paragraph is
hashed to a wide vector of zeros and ones, and a document's fingerprint is the sum of its paragraphs'
vectors, modulo 2**16 per coordinate, with their number. So the order of paragraphs does not matter,
and a paragraph is inserted or deleted by adding or subtracting its own fingerprint.

Read as signs (2 * sum - number), the coordinates estimate the squared length of a multiset and of the
difference of two; likeness is 1 minus the difference's over both documents' together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import in_ranges, order_in_range

#: Two hashes per paragraph, 62 bits of each: two bits share a sum, 32 places apart.
SEEDS, BITS = ("text", "paragraph"), 31
LANES = (1 << 32) | 1
LOW = (1 << 32) - 1
MODULUS_BITS = 16


def paragraphs(text: Column, paragraph_words: int) -> Column:
    """The lines of a text, cut after each `paragraph_words` words; white space around them is not part of them."""
    word = r"[^ \t-\r]++"
    return F.regexp_extract_all(text, F.lit(rf"{word}(?:[ \t\x0B\f\r]++{word}){{0,{paragraph_words - 1}}}+"), F.lit(0))


def vector_sums(paragraph: Column) -> list[Column]:
    """Sums of the paragraphs' vectors, two coordinates in each."""
    hashes = [F.xxhash64(F.lit(seed), paragraph) for seed in SEEDS]
    return [
        F.coalesce(F.sum(F.when(paragraph.isNotNull(), F.shiftrightunsigned(h, bit).bitwiseAND(LANES))), F.lit(0))
        for h in hashes
        for bit in range(BITS)
    ]


def signs(sums: Column, number: Column) -> Column:
    """The coordinates of a vector as sums of signs."""
    lanes = F.concat(
        F.transform(sums, lambda x: x.bitwiseAND(LOW)), F.transform(sums, lambda x: F.shiftrightunsigned(x, 32))
    )
    return F.transform(lanes, lambda x: (2 * x - number).cast("double"))


def fingerprint(sums: Column, number: Column) -> Column:
    """The vector and the number of paragraphs in hexadecimal digits."""
    mask = (1 << MODULUS_BITS) - 1

    def digits(x: Column) -> Column:
        both = F.shiftleft(F.shiftrightunsigned(x, 32).bitwiseAND(mask), MODULUS_BITS).bitwiseOR(x.bitwiseAND(mask))
        return F.lpad(F.hex(both), 2 * MODULUS_BITS // 4, "0")

    return F.lower(F.concat(F.array_join(F.transform(sums, digits), ""), F.lpad(F.hex(number), 16, "0")))


def _squares(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x * x)


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two sign vectors, 0 to 1; two empty documents are alike."""
    apart = F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda total, x: total + x)
    both = _squares(a) + _squares(b)
    return F.when(both == 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), 1 - apart / both))


def edited_fingerprints(docs: DataFrame, paragraph_words: int = 8) -> DataFrame:
    """Per row of docs (doc_id long, text): doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, n_paragraphs.

    The edited text has the last quarter of the characters (rounded down) replaced by the first as many
    (or all) of the next row's, by ascending doc_id; the last row is followed by the first. A null text
    counts as empty, a null doc_id comes first, rows that share a doc_id follow by the hash of their
    texts. An empty text has the fingerprint of no paragraphs. Other columns are ignored.

    Rows are dealt once, by ranges of doc_id. Each range also gets a copy of the next range's first row.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = in_ranges(texts.withColumn("tie", F.xxhash64("text")), "doc_id", "tie")
    following = order_in_range("doc_id", "tie")
    n_chars, quarter = F.length("text"), F.expr("cast(floor(length(text) / 4) as int)")
    ordered = rows.select(
        "*", F.row_number().over(following).alias("place"), F.lead("text").over(following).alias("next")
    )
    edited = F.when(~F.col("copy"), F.concat(F.substring("text", F.lit(1), n_chars - quarter), F.substring("next", F.lit(1), quarter)))
    both = ordered.select(
        "range", "place", "copy", "doc_id", n_chars.cast("long").alias("n_chars"), "text", edited.alias("edited")
    ).select(
        "range", "place", "copy", "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("body")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("body")))).alias("v"),
    )
    pieces = both.filter("v.body is not null").select(
        "range", "place", "copy", "doc_id", "n_chars", "edited_sha256", "v.which",
        F.explode_outer(paragraphs(F.col("v.body"), paragraph_words)).alias("paragraph"),
    )
    # Grouping by the range first keeps every step below in the one exchange.
    keys = ("range", "place", "copy", "doc_id", "n_chars", "edited_sha256", "which")
    columns = [s.alias(f"s{i}") for i, s in enumerate(vector_sums(F.col("paragraph")))]
    summed = pieces.groupBy(*keys).agg(*columns, F.count("paragraph").alias("number")).select(
        *keys, "number", F.array(*[f"s{i}" for i in range(len(columns))]).alias("sums")
    )
    prints = summed.select(
        *keys, F.struct("number", "sums").alias("print"),
        F.lead(F.struct("number", "sums"), 1).over(Window.partitionBy("range").orderBy("place", "which")).alias("after"),
        F.lead(F.struct("number", "sums"), 2).over(Window.partitionBy("range").orderBy("place", "which")).alias("next"),
    ).filter("which = 0 and not copy")
    vectors = {n: signs(F.col(f"{n}.sums"), F.col(f"{n}.number")) for n in ("print", "after", "next")}
    prints = prints.withColumns({f"{n}_signs": v for n, v in vectors.items()})
    return prints.select(
        "doc_id", "n_chars", "edited_sha256",
        fingerprint(F.col("print.sums"), F.col("print.number")).alias("fingerprint"),
        fingerprint(F.col("after.sums"), F.col("after.number")).alias("edited_fingerprint"),
        likeness(F.col("print_signs"), F.col("after_signs")).alias("near_edited"),
        likeness(F.col("print_signs"), F.col("next_signs")).alias("near_next"),
        F.col("print.number").alias("n_paragraphs"),
    )
