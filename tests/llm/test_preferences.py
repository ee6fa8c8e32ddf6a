import random

from railgauge.llm.preferences import CLOSE, OPEN, preference_pairs, request_pairs


def shown(turns):
    return "".join(f"{OPEN}{r}\n{t}{CLOSE}\n" for r, t in turns)


def mask(turns):
    at, spans = 0, []
    for role, text in turns:
        begin = at + len(f"{OPEN}{role}\n")
        at = begin + len(f"{text}{CLOSE}\n")
        if role == "assistant":
            spans.append((begin, at - 1))
    return spans


def plain(rows):
    whole = {}
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        whole.setdefault(conv, []).append((role or "", text or ""))
    kept = {}
    for conv in sorted(whole):
        kept.setdefault(tuple(whole[conv]), conv)
    groups = {}
    for turns, conv in kept.items():
        groups.setdefault(turns[0], []).append(conv)
    pairs = []
    for convs in groups.values():
        if len(convs) > 1:
            best = min(convs, key=lambda c: (-sum(len(t) for r, t in whole[c] if r == "assistant"), c))
            pairs += [(best, c, whole[best], whole[c]) for c in convs if c != best]
    alone = sorted(c for convs in groups.values() if len(convs) == 1 for c in convs if any(r == "assistant" for r, _ in whole[c]))
    for i, conv in enumerate(alone):
        other = alone[(i + 1) % len(alone)]
        last = max(n for n, (r, _) in enumerate(whole[conv]) if r == "assistant")
        answer = [t for t in whole[other] if t[0] == "assistant"][-1]
        if answer != whole[conv][last]:
            pairs.append((conv, other, whole[conv], whole[conv][:last] + [answer]))
    out = []
    for c, r, x, y in pairs:
        n = next((i for i, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))
        out.append((c, r, n, shown(x[:n]), shown(x[n:]), shown(y[n:]), mask(x[n:]), mask(y[n:])))
    return sorted(out)


def got(df):
    return sorted((*tuple(r)[:6], [tuple(m) for m in r[6]], [tuple(m) for m in r[7]]) for r in df.collect())


SCHEMA = "conv_id long, turn long, role string, text string"


def test_against_plain_python(spark):
    rng = random.Random(3)
    rows = []
    for conv in range(60):
        opening = rng.choice(["hi", "ho", f"own {conv}", f"own {conv}", None])
        rows.append((conv, 0, rng.choice(["user", "user", "system"]), opening))
        rows += [(conv, t, "assistant" if t % 2 else "user", rng.choice(["a", "bb", "ccc", "", None, "é東"])) for t in range(1, rng.randint(1, 6))]
    rows += [(None, 0, "user", "x"), (70, None, None, None), (71, 0, "user", "hi"), (71, 0, "user", "hi"), (72, 1, "assistant", "only")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).selectExpr("*", "1 as tie", "'z' as answer", "'y' as turns")
    expected = plain(rows)
    assert any(r[2] == 0 for r in expected) and any(r[2] > 1 for r in expected)
    assert got(preference_pairs(df)) == expected


def test_whole_table(spark, sf_dir):
    from railgauge.llm.queries import op3_preferences

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(op3_preferences(spark, sf_dir)) == plain(rows)


def test_no_rows_and_one(spark):
    assert got(preference_pairs(spark.createDataFrame([], SCHEMA))) == []
    assert got(preference_pairs(spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b")], SCHEMA))) == []


def plain_requests(whole):
    """(chosen, rejected) of conversations that share a request, and those that share none."""
    def length(c):
        return sum(len(t) for r, t in whole[c] if r == "assistant")

    kept = {}
    for conv in sorted(whole):
        kept.setdefault(tuple(whole[conv]), conv)
    groups = {}
    for turns, conv in kept.items():
        for n in range(1, len(turns) + 1):
            if (n == len(turns) or turns[n][0] == "assistant") and any(r not in ("system", "assistant") for r, _ in turns[:n]):
                groups.setdefault(turns[:n], []).append(conv)
    pairs, shared = {}, set()
    for prefix in sorted(groups, key=len):
        if len(groups[prefix]) > 1:
            best = min(groups[prefix], key=lambda c: (-length(c), c))
            pairs |= {c: best for c in groups[prefix] if c != best}
            shared |= set(groups[prefix])
    return {(c, r) for r, c in pairs.items()}, set(kept.values()) - shared


def rows_of(whole):
    return [(c, n, r, t) for c, turns in whole.items() for n, (r, t) in enumerate(turns)]


def query(spark, folder, whole):
    from railgauge.llm.queries import op3_preferences

    spark.createDataFrame(rows_of(whole), SCHEMA).write.parquet(f"{folder}/conversations.parquet")
    return op3_preferences(spark, str(folder)).collect()


def test_a_shared_system_prompt_is_no_request(spark, tmp_path):
    prompt = ("system", "Be kind.")
    whole = {c: [prompt, ("user", f"q{c // 3}"), ("assistant", "a" * (c + 1))] for c in range(12)}
    whole[20] = [prompt, ("assistant", "hello"), ("user", "own"), ("assistant", "b" * 50)]
    pairs = {(r["chosen_id"], r["rejected_id"]): r["n_common"] for r in query(spark, tmp_path, whole)}
    assert pairs == {(c // 3 * 3 + 2, c): 2 for c in range(12) if c % 3 < 2}


def test_longest_shared_request(spark):
    rng = random.Random(6)
    whole = {}
    for c in range(80):
        turns = [("system", rng.choice("st"))] if rng.random() < 0.5 else []
        for _ in range(rng.randint(1, 4)):
            turns += [("user", rng.choice("uv")), ("assistant", rng.choice(["a", "bb"]))]
        whole[c] = turns[: len(turns) - rng.randint(0, 1)]
    whole[90] = [("user", "only here"), ("assistant", "x")]
    got_pairs = {(r["chosen_id"], r["rejected_id"]) for r in request_pairs(spark.createDataFrame(rows_of(whole), SCHEMA)).collect()}
    pairs, alone = plain_requests(whole)
    assert got_pairs == pairs and alone == {90} and len(pairs) > 40


def test_a_canned_answer_loses_no_conversation(spark, tmp_path):
    rng = random.Random(7)
    answers = {c: "I cannot help." if 30 <= c < 90 or rng.random() < 0.4 else rng.choice("xyz") for c in range(150)}
    answers[0] = answers[149] = "I cannot help."
    whole = {c: [("user", f"own {c}"), ("assistant", a)] for c, a in answers.items()}
    expected = {}
    for c, a in answers.items():
        other = next(d for d in [*range(c + 1, 150), *range(c)] if answers[d] != a)
        expected[c] = (other, f"{OPEN}assistant\n{answers[other]}{CLOSE}\n")
    assert {r["chosen_id"]: (r["rejected_id"], r["rejected"]) for r in query(spark, tmp_path, whole)} == expected


def test_one_answer_for_all(spark, tmp_path):
    assert query(spark, tmp_path, {c: [("user", f"own {c}"), ("assistant", "no")] for c in range(20)}) == []
