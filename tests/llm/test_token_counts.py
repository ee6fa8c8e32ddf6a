import random
from collections import defaultdict

from railgauge.llm import token_counts, tokenizing
from railgauge.llm.queries import op9_token_counts, tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")


def plain(rows):
    library = tokenizing.load(PATH)
    out = defaultdict(lambda: [0, 0])
    for doc_id, text in rows:
        out[doc_id][0] += len((text or "").encode())
        out[doc_id][1] += len(library.encode(text or "", add_special_tokens=False).ids)
    return {k: (b, n, n > 512) for k, (b, n) in out.items()}


def got(df):
    rows = df.collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r)[1:] for r in rows}


def test_pieces_are_the_library_s():
    byte, word = (tokenizing.load(tokenizer_path(n)) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
    usual = [chr(c) for c in (9, 10, 13, *range(32, 127), *range(0xA1, 0xAD), *range(0xAE, 0x100))]
    rng = random.Random(1)
    for _ in range(800):
        text = "".join(rng.choice(usual + ["'s ", " ", "\n", "  "] * 20) for _ in range(rng.randint(0, 60)))
        assert tokenizing.BYTE_LEVEL.findall(text) == [text[a:b] for _, (a, b) in byte.pre_tokenizer.pre_tokenize_str(text)]
        ids = [i for p in tokenizing.word_level_pieces(text) for i in word.encode(p, add_special_tokens=False).ids]
        assert ids == word.encode(text, add_special_tokens=False).ids


def test_awkward_rows(table, awkward):
    assert got(token_counts.count_tokens(table(awkward), PATH)) == plain(awkward)


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert got(op9_token_counts(spark, sf_dir)) == plain(rows)


def test_no_rows(table):
    assert got(token_counts.count_tokens(table([]), PATH)) == {}
