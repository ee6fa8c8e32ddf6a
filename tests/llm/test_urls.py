import math
import random
import re
from collections import Counter

import regex

from railgauge.llm.queries import URL_RULES, op7_url_filter
from railgauge.llm.urls import judge_urls, segment_names, split_name

PAGES = "page_id long, url string, html string"


def plain(url):
    """host, path and the rule's name and verdict."""
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    rules = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(rules, key=lambda r: len(r.name), default=None)
    return host, path, best and best.name, best and best.verdict


def test_unigram_split():
    words = {"the": 50, "cat": 20, "sat": 20, "thecat": 1, "at": 30}
    assert split_name("thecatsat", words, 121) == ["the", "cat", "sat"]
    assert "".join(split_name("zzthezz", words, 121)) == "zzthezz" and "the" in split_name("zzthezz", words, 121)
    assert split_name("qqq", {}, 0) == ["qqq"] and split_name("", words, 121) == []


def check(rows, urls):
    assert len(rows) == len(urls)
    for r in rows:
        host, path, rule, verdict = plain(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if rule else r["verdict"] in ("allow", "block")


def test_whole_table(spark, sf_dir):
    rows = op7_url_filter(spark, sf_dir).collect()
    check(rows, {r["page_id"]: r["url"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()})


def test_awkward_urls(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://EXAMPLE.NET", "a://b://c/d", "https://X.Example.Net/en/a?b#c", "x://net/", "x://net"]
    urls += ["x://a.org/fr/", "x://org/fr", "x://evilnet/", "x://example.com/de/x\ny", "x://a.example.com?x=/de/", "x://é.ORG/FR/ü", "x://h" + "o" * 3000 + ".net/"]
    rows = list(enumerate(urls))
    df = spark.createDataFrame([(i, u, None if i % 2 else "<p>cheap pills the</p>") for i, u in rows], PAGES)
    check(judge_urls(df.selectExpr("*", "'q' as host", "1 as token"), URL_RULES).collect(), dict(rows))


def test_model_follows_the_rules(spark):
    rows = [(i, f"http://cheappills{i % 3}.example.net/fr/", "cheap pills cheap pills") for i in range(20)]
    rows += [(100 + i, f"http://greenriver{i % 3}.example.net/en/", "green river green river") for i in range(20)]
    rows += [(200, "http://pillscheap.info/x", None), (201, "http://rivergreen.info/x", None)]
    found = {r["page_id"]: r["verdict"] for r in judge_urls(spark.createDataFrame(rows, PAGES), URL_RULES).collect()}
    assert (found[200], found[201]) == ("block", "allow")


def test_repeated_and_no_rows(spark):
    rows = [(None, "x://a.net/", None), (1, "x://b.info/", None), (1, "x://b.info/", None)]
    found = judge_urls(spark.createDataFrame(rows, PAGES), URL_RULES).collect()
    assert sorted((repr(r["page_id"]), r["verdict"]) for r in found) == [("1", "allow"), ("1", "allow"), ("None", "block")]
    assert judge_urls(spark.createDataFrame([], PAGES), URL_RULES).collect() == []


def all_splits(name):
    if not name:
        yield []
    for n in range(1, len(name) + 1):
        for rest in all_splits(name[n:]):
            yield [name[:n], *rest]


def likelihood(split, words, total):
    each = (math.log(words[w]) if w in words else 1.0 - len(w) * math.log(10.0) for w in split)
    return sum(each) - len(split) * math.log(total + 10)


def test_split_against_all_splits():
    rng = random.Random(4)
    for _ in range(400):
        name = "".join(rng.choice("ab" if rng.random() < 0.5 else "abc") for _ in range(rng.randint(1, 10)))
        words = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 5))): rng.randint(1, 900) for _ in range(rng.randint(0, 9))}
        total = sum(words.values())
        best = max(likelihood(s, words, total) for s in all_splits(name))
        found = split_name(name, words, total)
        assert "".join(found) == name and abs(likelihood(found, words, total) - best) < 1e-9


def test_long_words_are_found_in_names(spark):
    """Words beyond the stem are looked up whole; a name that only shares the stem is not split there."""
    word, other = "donaudampfschifffahrtsgesellschaft", "donaudampfschifffahrtsgeselle"
    counts = spark.createDataFrame([(word, 50), ("cheap", 40), (other + "n", 7)], "word string, count long")
    names = spark.createDataFrame([(f"cheap{word}",), (f"{word}cheap{word}",), (f"cheap{other}",), ("x" * 2000,)], "name string")
    found = {r["name"]: r["words"] for r in segment_names(names, counts).collect()}
    assert found == {f"cheap{word}": ["cheap", word], f"{word}cheap{word}": [word, "cheap", word], f"cheap{other}": ["cheap", other], "x" * 2000: ["x" * 2000]}


def test_verdicts_against_a_plain_model(spark, sf_dir):
    """Counts, splits, naive Bayes and its sums worked out once more in plain Python over the whole table."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    visible = (regex.sub(r"(?s)<(script|style)[^>]*>.*?</\1>|<[^>]*>", " ", r["html"] or "").lower() for r in pages)
    counts = Counter(w for text in visible for w in regex.findall(r"\p{L}{2,}", text))
    total = sum(counts.values())

    def tokens(text):
        return [f"#{len(t)}" if regex.fullmatch(r"\p{N}+", t) else t for t in regex.findall(r"[\p{L}\p{N}]+", text.lower())]

    def host_tokens(host):
        return [w for name in tokens(host) for w in split_name(name, {k: v for k, v in counts.items() if k in name} if len(name) > 1 else {}, total)]

    split = {r["page_id"]: plain(r["url"]) for r in pages}
    seen = {"block": Counter(), "allow": Counter()}
    rows = Counter()
    for host, path, _, ruled in split.values():
        if ruled:
            rows[ruled] += 1
            seen[ruled].update(host_tokens(host) + tokens(path))
    kinds = len(seen["block"] | seen["allow"])
    n = {v: sum(c.values()) for v, c in seen.items()}

    def odds(token):
        return math.log((seen["block"][token] + 1) / (n["block"] + kinds + 1)) - math.log((seen["allow"][token] + 1) / (n["allow"] + kinds + 1))

    prior = math.log((rows["block"] + 1) / (rows["allow"] + 1))
    judged = 0
    for r in op7_url_filter(spark, sf_dir).collect():
        host, path, _, ruled = split[r["page_id"]]
        sum_of = prior + sum(map(odds, host_tokens(host))) + sum(map(odds, tokens(path)))
        judged += ruled is None
        assert r["verdict"] == (ruled or ("block" if sum_of > 0 else "allow")) or abs(sum_of) < 1e-6
    assert judged > 0
