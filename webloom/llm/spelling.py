"""Spelling variants: words one edit apart, found by dense prefix-suffix tiles.

Words lie as rows of padded code-point matrices. A tile compares a block of words with
another: position by position from the front it counts how far each pair agrees, then
from the back. Two different words are one insertion, deletion or replacement apart
exactly if the common prefix and the common suffix together reach the longer length
minus one.

Only tiles that can hold such a pair are made. Of two words one edit apart, the
shorter of length L, the part before or the part after the edit has L // 2 code points
or more. So words of lengths L and L + 1 meet if they share their first or their last L // 2
code points; a pair that shares both belongs to the first. Buckets of more than ``BLOCK``
words are dealt to blocks and all pairs of its blocks make tiles, so no task holds a
large bucket. A tile returns one row per word that has a near word in it,
never the pairs.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import islice, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import in_pieces, stage, utf8, whole_groups
from webloom.operators.joins import hot_key_join

#: Words of a bucket that one side of a tile holds at most.
BLOCK = 1024
#: Counts that a task holds before it passes them on.
HELD = 200_000
RUNS_AT_ONCE = 100_000
MISSPELT = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3

# Letters a-z and U+00C0 to U+00FF in UTF-8, after A-Z became a-z.
_RUN = re.compile(rb"(?:[a-z]++|(?:\xC3[\x80-\xBF])++)++")


def _altered(run: bytes, crc: int) -> bytes:
    letters = run.decode()
    at = crc % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): how often each word of at least five letters occurs in all texts.

    Runs of letters of the whole texts, A-Z lower-cased; a run whose checksum with its doc_id
    is a multiple of 97 loses one letter first. Null texts have no words; a null doc_id is
    written as an empty one. Repeated rows count again. Tasks count in tables of ``HELD``
    words at most, before the shuffle.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}

        def passed_on() -> pa.RecordBatch:
            words = pa.array(counts.keys(), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_pydict({"word": words, "n": pa.array(counts.values(), pa.int64())})

        for piece in in_pieces(batches):
            for doc_id, text in zip(piece["doc_id"].to_pylist(), utf8(piece["text"]), strict=True):
                before = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                found = (match[0] for match in _RUN.finditer(text.lower()))
                while runs := list(islice(found, RUNS_AT_ONCE)):
                    for run in runs:
                        crc = zlib.crc32(run, before)
                        if crc % MISSPELT == 0:
                            run = _altered(run, crc)
                        # Every letter beyond ASCII has one byte 0xC3.
                        if len(run) - run.count(b"\xc3") >= LEAST_LENGTH:
                            counts[run] = counts.get(run, 0) + 1
                    if len(counts) >= HELD:
                        yield passed_on()
                        counts.clear()
        if counts:
            yield passed_on()

    read = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return (
        read.mapInArrow(counted, "word string, n bigint")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )


def _keyed(words: DataFrame) -> DataFrame:
    """Each word under the keys of the buckets that it takes part in.

    ``key`` is the shorter length, the side and the shared code points.
    """
    length = F.length("word")
    keys = []
    for shorter in (length, length - 1):
        half = F.floor(shorter / 2).cast("int")
        head = F.substr("word", F.lit(1), half)
        tail = F.substr("word", length - half + 1, half)
        keys += [
            F.concat_ws(":", shorter.cast("string"), F.lit("p"), head),
            F.concat_ws(":", shorter.cast("string"), F.lit("s"), tail),
        ]
    return words.withColumn("key", F.explode(F.array(*keys)))


def _dealt(words: DataFrame, block: int) -> DataFrame:
    """The words of every bucket, dealt to tiles: (key, low, high) tell them apart.

    A bucket of more than ``block`` words has several blocks, each pair of which is a tile.
    Buckets of a single word make none.
    """
    keyed = stage(_keyed(words), "spelling-keys")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("_n")).where("_n > 1")
    many = F.ceil(F.col("_n") / block).cast("int")
    sized = hot_key_join(keyed, stage(sizes, "spelling-buckets"), "key", "word", "inner", 100 * block)
    dealt = (
        sized.withColumn("_own", F.pmod(F.xxhash64("word"), many).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), many - 1)))
        .select(
            F.xxhash64("key").alias("key"), F.col("key").alias("bucket"),
            F.least("_own", "_other").alias("low"), F.greatest("_own", "_other").alias("high"),
            F.col("_own").alias("own"), "word", "n",
        )
    )
    group = ["key", "low", "high"]
    return dealt.repartition(*group).sortWithinPartitions(*group, F.desc("n"), "word")


def code_points(words: list[str]) -> np.ndarray:
    """A row per word, padded with zeros at the end."""
    width = max(map(len, words))
    data = "".join(word.ljust(width, "\0") for word in words).encode("utf-32-le")
    points = np.frombuffer(data, "<u4").reshape(len(words), width)
    return points.astype(np.uint8) if not points.size or points.max() < 256 else points


def agreement(a: np.ndarray, b: np.ndarray, upto: int) -> np.ndarray:
    """For every row of ``a`` and of ``b`` in how many first columns they agree, ``upto`` at most."""
    agree = np.ones((len(a), len(b)), bool)
    total = np.zeros((len(a), len(b)), np.uint32 if upto > 255 else np.uint8)
    for column in range(upto):
        agree &= a[:, column, None] == b[None, :, column]
        if not agree.any():
            break
        total += agree
    return total


def tile(a: list[str], b: list[str], shared: int, front: bool) -> np.ndarray:
    """Which words of ``a`` are one edit from which of ``b``.

    All words of ``a`` have one length, all of ``b`` the same or one more. They share their
    first (``front``) or else their last ``shared`` code points; in the latter case pairs
    that share as many first ones are left to the other bucket.
    """
    x, y = code_points(a), code_points(b)
    shorter, longer = len(a[0]), len(b[0])
    prefix = agreement(x, y, shorter)
    suffix = agreement(x[:, ::-1], y[:, ::-1], shorter)
    near = prefix.astype(np.uint32) + suffix >= longer - 1
    if longer == shorter:
        near &= prefix < longer  # not the word itself
    if not front:
        near &= prefix < shared
    return near


def _near_in_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n_near, best_n, best) of the words with near ones in a tile.

    Rows come sorted by count, largest first, and word.
    """
    for table, bounds in whole_groups(batches):
        words, counts = table["word"].to_pylist(), table["n"].to_pylist()
        buckets, owns = table["bucket"].to_pylist(), table["own"].to_pylist()
        lows, highs = table["low"].to_pylist(), table["high"].to_pylist()
        found: list[tuple[int, int, int]] = []
        for first, last in pairwise(bounds.tolist()):
            apart: dict[str, list[int]] = {}  # buckets whose hashes are equal share a group
            for i in range(first, last):
                apart.setdefault(buckets[i], []).append(i)
            for bucket, rows in apart.items():
                left = [i for i in rows if owns[i] == lows[first]]
                right = [i for i in rows if owns[i] == highs[first]]
                sides = [(left, right)] if lows[first] == highs[first] else [(left, right), (right, left)]
                shorter, side, _ = bucket.split(":", 2)
                for one, other in sides:
                    found += _near(words, one, other, int(shorter), side == "p")
        yield pa.RecordBatch.from_pydict(
            {
                "word": pa.array([words[i] for i, _, _ in found], pa.string()),
                "n_near": pa.array([n for _, n, _ in found], pa.int64()),
                "best_n": pa.array([counts[best] for _, _, best in found], pa.int64()),
                "best": pa.array([words[best] for _, _, best in found], pa.string()),
            }
        )


def _near(
    words: list[str], one: list[int], other: list[int], shorter: int, front: bool
) -> list[tuple[int, int, int]]:
    """(word, number of near words, first of them) of a tile, all as positions.

    The words of length ``shorter`` of ``one`` meet those of ``other`` that are as long or longer by one.
    """
    out = []
    short = [i for i in one if len(words[i]) == shorter]
    for length in (shorter, shorter + 1):
        long = [i for i in other if len(words[i]) == length]
        if not short or not long:
            continue
        near = tile([words[i] for i in short], [words[i] for i in long], shorter // 2, front)
        ways = [(short, long, near)] if length == shorter else [(short, long, near), (long, short, near.T)]
        for own, others, hits in ways:
            for i in np.flatnonzero(hits.any(axis=1)):
                out.append((own[i], int(hits[i].sum()), others[int(hits[i].argmax())]))
    return out


def variants(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of distinct words with their counts (word, n).

    Near words differ by one inserted, deleted or replaced code point. ``form`` is the near
    word of the largest count, the smallest of those by code points, if it occurs at least
    twice as often; null otherwise. ``root`` is where the chain of forms ends. An empty table
    gives no rows; rows of a null word are left out.
    """
    words = words.where(F.col("word").isNotNull()).select("word", "n")
    schema = "word string, n_near bigint, best_n bigint, best string"
    found = _dealt(words, block).mapInArrow(_near_in_tiles, schema)
    none = F.lit(None).cast("struct<less:bigint,best:string>")
    best = F.struct((-F.col("best_n")).alias("less"), F.col("best"))
    rows = found.select("word", F.lit(None).cast("bigint").alias("n"), "n_near", best.alias("b")).unionByName(
        words.select("word", "n", F.lit(0).cast("bigint").alias("n_near"), none.alias("b"))
    )
    formed = (
        rows.groupBy("word")
        .agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("b").alias("b"))
        .withColumn("_is", -F.col("b.less") >= 2 * F.col("n"))
        .select(
            "word", F.when(F.col("_is"), F.col("b.best")).alias("form"), "n", "n_near",
            F.when(F.col("_is"), -F.col("b.less")).alias("form_n"),
        )
    )
    formed = stage(formed, "spelling-forms")
    roots = _roots(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(steps: DataFrame) -> DataFrame:
    """(word, root) where (word, root) was one step: every round doubles the steps done.

    A form occurs twice as often as its word, so chains have no cycles and at most as many steps
    as the largest count has binary digits: a handful of rounds.
    """
    steps = stage(steps, "spelling-roots")
    while True:
        after = steps.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        joined = hot_key_join(steps, after, "root", "word")
        moved = stage(
            joined.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")),
            "spelling-roots",
        )
        steps = moved.select("word", "root")
        if moved.where("_moved").isEmpty():
            return steps


def group_variants(docs: DataFrame, least: int = LEAST_COUNT, block: int = BLOCK) -> DataFrame:
    """``variants`` of the words that occur at least ``least`` times in all texts of ``docs``."""
    words = stage(word_counts(docs).where(F.col("n") >= least), "spelling-words")
    return variants(words, block)
