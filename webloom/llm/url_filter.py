"""URL verdicts: rules first, then naive Bayes over the words that hosts and paths are made of.

Host labels like ``therend`` are concatenated names. A unigram model of the pages' words
splits them (Viterbi); the split host and the tokens of the path are scored by
multinomial naive Bayes, trained on the URLs that the rules decide.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import map_arrow, stage
from webloom.operators.joins import hot_key_join

#: (rule, verdict): the host and all its subdomains, if the path starts with the rule's.
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
HEAD = 20  # letters that a lookup reads: longer words are met under their first so many
BUCKETS = 1 << 18  # hashed tokens of the naive Bayes model: its size, whatever the data
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, or null. ``rules`` is a short list."""
    known = []
    for rule, verdict in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(
            path, F.lit(slash + rest)
        )
        known.append(F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*known)


def word_counts(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(word, n): the words of all pages' text, tags left out, lower-cased."""
    tags, words = re.compile(r"(?s)<(?:script|style)\b.*?</(?:script|style)>|<[^>]*>"), re.compile(r"[^\W\d_]+")

    def body(part: pa.RecordBatch) -> dict:
        counts: Counter = Counter()
        for html in part.column(0).to_pylist():
            if html:
                counts.update(words.findall(tags.sub(" ", html).lower()))
        return {"word": pa.array(counts.keys(), pa.string()), "n": pa.array(counts.values(), pa.int64())}

    counted = map_arrow(pages, [html_col], body, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def segment(label: str, counts: dict[str, int], total: int) -> list[str]:
    """The most probable split of ``label`` into words of any length.

    ``counts`` holds those of its substrings that are words. Others are unknown words, which lose
    a digit's chance per letter: of those that end at a place the best one starts where the
    score so far, with that loss taken back, is largest, so only known words are tried one by one.
    """
    letter = math.log(10)
    sizes = sorted({len(word) for word in counts}, reverse=True)
    best, back = [0.0], [0]
    start, lead = 0, 0.0  # of the best unknown word so far: best[start] + start * letter
    for end in range(1, len(label) + 1):
        at = start
        score = lead - (end - 1) * letter - math.log(total) - 2
        for size in sizes:
            n = counts.get(label[end - size : end]) if size <= end else None
            if n and best[end - size] + math.log(n / total) > score:
                at, score = end - size, best[end - size] + math.log(n / total)
        best.append(score)
        back.append(at)
        if score + end * letter > lead:
            start, lead = end, score + end * letter
    out, end = [], len(label)
    while end:
        out.append(label[back[end] : end])
        end = back[end]
    return out[::-1]


def split_labels(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """(label, words) of distinct ``labels``, by the whole vocabulary ``counts`` (word, n).

    The vocabulary isn't broadcast: every substring of a label of up to ``HEAD`` letters looks
    up its own count; those of ``HEAD`` letters also meet the longer words that begin
    with them, of which the label keeps what it contains. So words of any length are found, and
    a label of n letters makes at most ``HEAD`` * n rows before it meets a word. It is
    split where its counts have come together.
    """
    total = int(counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    start = F.explode(F.sequence(F.lit(1), F.length("label"))).alias("start")
    size = F.explode(F.sequence(F.lit(1), F.least(F.lit(HEAD), F.length("label") - F.col("start") + 1)))
    parts = (
        labels.where("label <> ''").select("label", start).withColumn("size", size)
        .select("label", F.expr("substring(label, start, size)").alias("word"))
        .distinct()
    )
    short = hot_key_join(parts, counts, "word", spread="label", how="inner").select("label", "word", "n")
    heads = parts.where(F.length("word") == HEAD).withColumnRenamed("word", "head")
    longer = counts.where(F.length("word") > HEAD).withColumn("head", F.substring("word", 1, HEAD))
    long = hot_key_join(heads, longer, "head", spread="label", how="inner").where(
        F.contains("label", "word")
    )
    known = short.union(long.select("label", "word", "n")).groupBy("label").agg(
        F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("counts")
    )

    def body(part: pa.RecordBatch) -> dict:
        rows = zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)
        words = [segment(label, dict(counts or ()), max(total, 1)) for label, counts in rows]
        return {"label": part.column(0), "words": pa.array(words, pa.list_(pa.string()))}

    both = labels.join(known, "label", "left")
    return map_arrow(both, ["label", "counts"], body, "label string, words array<string>")


def tokens(words: list[str], path: str) -> list[int]:
    """Buckets of a URL's tokens: the host's words, and the path's runs of letters or digits.

    Numbers count by their length only.
    """
    named = ["h:" + word for word in words]
    for token in re.findall(r"[^\W\d_]+|\d+", path.lower()):
        named.append(f"p:{len(token)} digits" if token[0].isdigit() else "p:" + token)
    return [xxhash.xxh3_64_intdigest(name) % BUCKETS for name in named]


def judge_urls(
    pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(id, host, path, rule, verdict, score) of every row of ``pages``.

    A URL that a rule fits gets its verdict (score null); any other gets block if the
    log odds ``score`` of block are above zero, else allow. A null URL, or one without
    ``://``, has empty host and path and is allowed, as prior odds aren't used. A tie of the
    odds allows. Labels of hosts may have any length, as may the words they are split into.
    Repeated rows are judged alike and kept; an empty table gives no rows; other
    columns are not read.
    """
    url = F.col(url_col)
    rows = pages.select(
        F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path")
    ).withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    # Each distinct URL is scored once, so one frequent URL or host is no more work.
    seen = stage(
        rows.groupBy("host", "path").agg(F.first("fit").alias("fit"), F.count("*").alias("n")), "urls"
    )
    hosts = stage(seen.select("host").distinct(), "hosts")
    labels = hosts.select("host", F.posexplode(F.split("host", r"\.")).alias("at", "label"))
    split = stage(
        split_labels(labels.select("label").distinct(), stage(word_counts(pages, html_col), "words")),
        "labels",
    )
    named = hot_key_join(labels, split, "label", spread="host", how="left")
    words = stage(
        named.groupBy("host").agg(
            F.flatten(
                F.transform(F.array_sort(F.collect_list(F.struct("at", "words"))), lambda x: x["words"])
            ).alias("words")
        ),
        "host-words",
    )
    joined = stage(hot_key_join(seen, words, "host", spread="path", how="left"), "url-words")
    weights = _train(joined)
    shared = pages.sparkSession.sparkContext.broadcast(weights)

    def score(part: pa.RecordBatch) -> dict:
        odds = shared.value
        columns = [part.column(i).to_pylist() for i in range(3)]
        scores = [
            float(odds[tokens(words or [], path)].sum(dtype=np.float64))
            for _, path, words in zip(*columns, strict=True)
        ]
        return {"host": part.column(0), "path": part.column(1), "score": pa.array(scores, pa.float64())}

    scored = map_arrow(
        joined.where("fit IS NULL"), ["host", "path", "words"], score, "host string, path string, score double"
    )
    scored = stage(scored, "url-scores")
    return rows.join(scored, ["host", "path"], "left").select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"),
        "score",
    )


def _train(joined: DataFrame) -> np.ndarray:
    """Log odds of block against allow for every token bucket, from all URLs with a rule."""

    def body(part: pa.RecordBatch) -> dict:
        counts = np.zeros((2, BUCKETS), np.int64)
        rows = zip(*(part.column(i).to_pylist() for i in range(4)), strict=True)
        for path, words, verdict, n in rows:
            np.add.at(counts[int(verdict == "block")], tokens(words or [], path), n)
        at = np.flatnonzero(counts.any(axis=0))
        return {
            "bucket": pa.array(at.astype(np.int32)),
            "allow": pa.array(counts[0, at]),
            "block": pa.array(counts[1, at]),
        }

    ruled = joined.where("fit IS NOT NULL").select("path", "words", "fit.verdict", "n")
    counted = map_arrow(
        ruled, ["path", "words", "verdict", "n"], body, "bucket int, allow bigint, block bigint"
    )
    rows = counted.groupBy("bucket").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
    table = rows.toPandas()  # at most one row per bucket
    counts = np.ones((2, BUCKETS))
    counts[0, table["bucket"]] += table["allow"]
    counts[1, table["bucket"]] += table["block"]
    # Buckets that training never saw say nothing.
    share = counts / counts.sum(axis=1, keepdims=True)
    odds = np.log(share[1]) - np.log(share[0])
    odds[counts.sum(axis=0) == 2] = 0.0
    return odds.astype(np.float32)
