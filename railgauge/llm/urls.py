"""URL filters: rules first, then naive Bayes over segmented host names and path tokens.

Host names are cut into words by a unigram Viterbi search: the words of the pages' own texts are
counted, every stretch of a distinct name is joined to those counts, and the likeliest split is taken.
A multinomial naive Bayes model learns from the pages that a rule decides and judges the others.
Hosts, names and paths are made distinct before each join, so a common host costs one row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"
#: Words up to this length are looked up by every stretch of a name, longer ones by their first letters.
STEM = 24


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with its subdomains, where the path starts with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self) -> Column:
        host = (F.col("host") == self.host) | F.col("host").endswith(f".{self.host}")
        return host & F.col("path").startswith(self.path)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both are empty for null or without ://."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"\A[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits; a number counts as its number of digits."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    return F.transform(runs, lambda x: F.when(x.rlike(r"\A\p{N}+\z"), F.concat(F.lit("#"), F.length(x))).otherwise(x))


def split_name(name: str, words: dict[str, int], total: int) -> list[str]:
    """The likeliest words of a name; an unknown stretch, of any length, gets a tenth as likely with each letter.

    Joining two unknown stretches saves the cost of a word, so one is carried on letter by letter
    (`loose`) and only known words are looked up: the work grows with the name and not with its square.
    """
    if not name:
        return []
    each, letter = math.log(total + 10), math.log(10.0)
    lengths = sorted({len(w) for w in words}, reverse=True)
    best, cut_at = [0.0] + [-math.inf] * len(name), [0] * (len(name) + 1)
    loose, opened = -math.inf, 0
    for end in range(1, len(name) + 1):
        begin_here = best[end - 1] + 1.0 - each
        if begin_here > loose:
            loose, opened = begin_here, end - 1
        loose -= letter
        for size in lengths:
            count = words.get(name[end - size : end]) if size <= end else None
            if count and (score := best[end - size] + math.log(count) - each) > best[end]:
                best[end], cut_at[end] = score, end - size
        if loose > best[end]:
            best[end], cut_at[end] = loose, opened
    out, end = [], len(name)
    while end:
        out.append(name[cut_at[end] : end])
        end = cut_at[end]
    return out[::-1]


def _segment(total: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, known = batch.column("name").to_pylist(), batch.column("known").to_pylist()
            words = [split_name(n, {k["stretch"]: k["count"] for k in ks or ()}, total) for n, ks in zip(names, known, strict=True)]
            yield pa.RecordBatch.from_pydict({"name": batch.column("name"), "words": pa.array(words, pa.list_(pa.string()))})

    return run


def word_counts(pages: DataFrame) -> DataFrame:
    """word, count over the visible text of all pages."""
    visible = F.lower(F.regexp_replace("html", r"(?s)<(script|style)[^>]*>.*?</\1>|<[^>]*>", " "))
    words = pages.select(F.explode(F.regexp_extract_all(visible, F.lit(r"\p{L}{2,}"), F.lit(0))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("count"))


def segment_names(names: DataFrame, counts: DataFrame) -> DataFrame:
    """name, words for distinct names.

    A name meets the counted words that it holds: those of up to STEM letters by equality with a stretch of it, longer
    ones by equality of their first STEM letters, and then whole. The pairs grow with the name's length.
    """
    total = counts.agg(F.sum("count")).first()[0] or 0
    stretches = F.expr(
        "flatten(transform(sequence(1, length(name)), i -> "
        f"transform(sequence(i, least(i + {STEM} - 1, length(name))), j -> substring(name, i, j - i + 1))))"
    )
    parts = names.filter(F.length("name") > 1).select("name", F.explode(F.array_distinct(stretches)).alias("stretch"))
    short = counts.filter(F.length("word") <= STEM).withColumn("stretch", F.col("word"))
    stems = counts.filter(F.length("word") > STEM).withColumn("stretch", F.substring("word", 1, STEM))
    found = parts.join(short.unionByName(stems), "stretch").filter(F.contains("name", "word"))
    known = found.groupBy("name").agg(F.collect_list(F.struct(F.col("word").alias("stretch"), "count")).alias("known"))
    return names.join(known, "name", "left").mapInArrow(_segment(total), "name string, words array<string>")


def judge_urls(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """Per row of pages (page_id, url, html): page_id, host, path, rule, verdict.

    The longest rule that fits decides. Other rows are blocked where naive Bayes, trained on the rows
    that a rule decides, finds block likelier than allow; a tie, and so any row where no rule decides
    anything, is allowed. A null url or one without :// has an empty host and path. Rows with null or
    repeated page_id are judged one by one. A null html adds no words. Other columns are ignored.
    """
    host, path = split_url(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, ruled = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.name)):
        rule, ruled = F.when(r.fits(), r.name).otherwise(rule), F.when(r.fits(), r.verdict).otherwise(ruled)
    rows = written(rows.withColumns({"rule": rule, "ruled": ruled}), "urls")

    hosts = rows.select("host").distinct()
    named = hosts.select("host", F.posexplode(tokens(F.col("host"))).alias("at", "name"))
    words = written(segment_names(named.select("name").distinct(), written(word_counts(pages), "word-counts")), "host-words")
    host_tokens = named.join(words, "name").select("host", F.explode("words").alias("token"))
    path_tokens = rows.select("path").distinct().select("path", F.explode(tokens(F.col("path"))).alias("token"))

    block, allow = (F.count_if(F.col("ruled") == v) for v in (BLOCK, ALLOW))
    decided = rows.filter("ruled is not null")
    by_host, by_path = (decided.groupBy(c).agg(block.alias("block"), allow.alias("allow")) for c in ("host", "path"))
    seen = host_tokens.join(by_host, "host").select("token", "block", "allow").unionByName(
        path_tokens.join(by_path, "path").select("token", "block", "allow")
    )
    model = written(seen.groupBy("token").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow")), "url-tokens")
    n_block, n_allow, kinds = (x or 0 for x in model.agg(F.sum("block"), F.sum("allow"), F.count("*")).first())
    rows_block, rows_allow = decided.agg(block, allow).first()
    prior = math.log((rows_block + 1) / (rows_allow + 1))
    odds = F.log((F.col("block") + 1) / (n_block + kinds + 1)) - F.log((F.col("allow") + 1) / (n_allow + kinds + 1))
    unseen = math.log((n_allow + kinds + 1) / (n_block + kinds + 1))
    model = model.select("token", odds.alias("odds"))

    def scores(parts: DataFrame, key: str) -> DataFrame:
        # Summed in a fixed order of magnitude, so that a repeated task gives the same verdict.
        each = F.coalesce(F.col("odds"), F.lit(unseen)).cast("decimal(20,9)")
        return parts.join(model, "token", "left").groupBy(key).agg(F.sum(each).cast("double").alias(f"{key}_odds"))

    judged = rows.join(scores(host_tokens, "host"), "host", "left").join(scores(path_tokens, "path"), "path", "left")
    total = F.lit(prior) + F.coalesce("host_odds", F.lit(0.0)) + F.coalesce("path_odds", F.lit(0.0))
    if rows_block == 0 or rows_allow == 0:
        total = F.lit(0.0)
    verdict = F.coalesce("ruled", F.when(total > 0, BLOCK).otherwise(ALLOW))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
