"""Sharding, exact dedup, line dedup and token counts against plain versions."""

import hashlib
import json
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from compare import connect, difference
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm import brute
from webloom.llm import exact_dedup, line_dedup, sharding, token_count
from webloom.llm.oracles import ORACLES
from webloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    assert difference(spark, connect(SF), SF, QUERIES[name], ORACLES[name]) is None


def test_shards(spark, odd, odd_rows):
    got = sharding.assign_shards(odd, shards=4, seed=5).collect()
    n = len(odd_rows)
    keys = sharding.round_keys(5)
    places = [brute.feistel(i, n, 5, keys, *sharding.sides(n)) for i in range(n)]
    assert sorted(r.row_number for r in got) == list(range(n))
    for r in got:
        assert (r.shard, r.slot) == (places[r.row_number] % 4, places[r.row_number] // 4)
    ordered = [r.doc_id for r in sorted(got, key=lambda r: r.row_number)]
    assert ordered == sorted(ordered, key=lambda i: (i is not None, i))
    expected = sorted(
        (str(i), 1 + len((t or "").encode()), None if t is None else zlib.crc32(t.encode()))
        for i, t in odd_rows
    )
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in got) == expected


@pytest.mark.parametrize("n", [1, 2, 3, 5, 10, 97])
def test_permutation_and_inverse(spark, n):
    there = sharding.permute(spark.range(n), "id", "p", n, 3)
    back = sharding.permute(there, "p", "again", n, 3, inverse=True).collect()
    assert sorted(r.p for r in back) == list(range(n))
    assert all(r.id == r.again for r in back)


def test_rows_at(spark):
    docs = spark.range(50).selectExpr("id AS doc_id", "cast(id AS string) AS text")
    placed = sharding.assign_shards(docs, 7)
    again = sharding.rows_at(placed.withColumnRenamed("row_number", "want"), 50, 7).collect()
    assert all(r.row_number == r.want for r in again)


def test_frequent_row_is_numbered_whole(spark):
    docs = spark.range(25_000).selectExpr("cast(1 AS bigint) AS doc_id", "'x' AS text")
    got = sharding.assign_shards(docs).selectExpr("shard + 8 * slot AS p").collect()
    assert sorted(r.p for r in got) == list(range(25_000))


def test_exact_dedup(odd, odd_rows):
    groups = defaultdict(list)
    for i, text in odd_rows:
        plain = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups[hashlib.sha256(plain.encode()).hexdigest()].append((i, len(text or "")))
    best = {
        h: min(rows, key=lambda r: (-r[1], r[0] is None, r[0] or 0))[0] for h, rows in groups.items()
    }
    for deliveries in (1, 2, 5):
        got = exact_dedup.exact_dedup(odd, deliveries).collect()
        assert len(got) == len(odd_rows)
        for r in got:
            assert r.keep_id == best[r.text_sha256]
            assert r.group_size == len(groups[r.text_sha256])
            assert r.kept == (r.doc_id == r.keep_id)


@given(st.integers(0, 2**32), st.integers(0, 400))
@settings(max_examples=30, deadline=None)
def test_perfect_hash(seed, n):
    draw = np.random.default_rng(seed)
    held = draw.bytes(32 * n)
    sizes, bits, slots = exact_dedup.perfect_hash(held)
    assert sorted(slots) == list(range(n))  # minimal and perfect
    rows = np.frombuffer(held, np.uint8).reshape(-1, 32)[np.argsort(slots)].tobytes()
    assert (exact_dedup.find_slots(held, sizes, bits, rows) == slots).all()
    assert (exact_dedup.find_slots(draw.bytes(32 * 50), sizes, bits, rows) == -1).all()


def test_digests_alike_in_half_of_their_bits():
    # Two digests that every level sends to the same bit are told apart by their bytes.
    a, b = b"\0" * 32, b"\0" * 24 + b"\1" * 8
    held = a + b + b"\2" * 32
    sizes, bits, slots = exact_dedup.perfect_hash(held)
    assert sorted(slots) == [0, 1, 2]
    rows = np.frombuffer(held, np.uint8).reshape(-1, 32)[np.argsort(slots)].tobytes()
    assert (exact_dedup.find_slots(held, sizes, bits, rows) == slots).all()


@pytest.mark.parametrize("batches", [1, 3, 7])
def test_line_dedup(odd, odd_rows, batches):
    got = line_dedup.dedup_lines(odd, batches).collect()
    expected = sorted(
        (str(i), *row) for (i, _), row in zip(odd_rows, brute.kept_lines(odd_rows), strict=True)
    )
    assert sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept) for r in got) == expected


def test_runs_are_compacted(spark):
    runs = line_dedup.LineRuns(spark, 2)
    for batch in range(4):
        lines = spark.createDataFrame(
            [(str(batch), batch, bytes([i])) for i in range(batch, batch + 3)], "key string, id bigint, h binary"
        )
        lost = {r.h[0] for r in line_dedup.absorb(runs, lines).collect()}
        assert lost == (set() if not batch else {batch, batch + 1})
    assert {level: len(names) for level, names in runs.levels.items()} == {0: 2, 1: 1}
    known = {r.h[0]: r.first for name in runs.names() for r in spark.table(name).collect()}
    assert known == {0: 0, 1: 0, 2: 0, 3: 1, 4: 2, 5: 3}


def test_runs_are_neither_shuffled_nor_sorted(spark):
    """The plans of a batch that meets the runs, of its new hashes, and of a compaction."""
    runs = line_dedup.LineRuns(spark, 4)
    rows = [(i % 50 + 100 * batch, bytes([batch, i])) for batch in range(3) for i in range(200)]
    for batch in range(3):
        mine = [(h, i) for i, h in rows if i // 100 == batch]
        table = spark.createDataFrame(mine, "h binary, first bigint")
        runs.levels.setdefault(0, []).append(runs.write(runs.dealt(table)))
    batch = spark.table(runs.write(runs.dealt(spark.createDataFrame([(r[1], 1) for r in rows], "h binary, own bigint"))))
    with line_dedup.sorted_buckets(spark):
        both = runs.merged(*runs.names()[:2])
        for met, tables in ((runs.meet(batch), 4), (runs.meet(batch, "left_anti"), 4), (both, 2)):
            plan = met._jdf.queryExecution().executedPlan().toString()
            assert plan.count("SortMergeJoin") == tables - 1 and plan.count("Bucketed: true") == tables
            assert "Exchange" not in plan and "Sort [" not in plan
        name = runs.write(both)
        assert sorted(r.h for r in spark.table(name).collect()) == sorted(h for _, h in rows if h[0] < 2)
        assert len(spark.table(name).inputFiles()) == 4  # one a bucket, as they were
        assert runs.meet(batch, "left_anti").count() == 0
        assert {r.h: r.first for r in runs.meet(batch).collect()} == {h: i for i, h in rows}


def test_lines_at_the_ends_of_ids(spark):
    """No id comes after the largest one; rows without an id are one document."""
    shared, own = "a line that several documents share", "a line without an id"
    rows = [(2**63 - 1, shared), (None, shared), (None, f"{own}\n{shared}"), (-(2**63), own.upper()), (None, own)]
    rows += [(None, f"only here, twice over {i % 2}") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for batches in (1, 3):
        got = line_dedup.dedup_lines(docs, batches).collect()
        expected = sorted((str(i), *row) for (i, _), row in zip(rows, brute.kept_lines(rows), strict=True))
        assert sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept) for r in got) == expected


def test_copies_at_the_ends_of_ids(spark):
    rows = [(-(2**63), "a b"), (2**63 - 1, "ab"), (5, "a b"), (2**63 - 1, "c"), (None, "c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r.doc_id, r.text_sha256): r.keep_id for r in exact_dedup.exact_dedup(docs).collect()}
    ab, c = (hashlib.sha256(t).hexdigest() for t in (b"ab", b"c"))
    assert got == {
        (-(2**63), ab): -(2**63), (2**63 - 1, ab): -(2**63), (5, ab): -(2**63), (2**63 - 1, c): 2**63 - 1, (None, c): 2**63 - 1
    }


VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def test_token_counts(odd, odd_rows):
    library = Tokenizer.from_file(VOCABULARY)
    got = token_count.count_tokens(odd, VOCABULARY).collect()
    expected = sorted(
        (str(i), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids))
        for i, t in odd_rows
    )
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == expected
    assert all(r.over_limit == (r.n_tokens > 1024) for r in got)


def test_token_counts_of_random_texts():
    library = Tokenizer.from_file(VOCABULARY)
    with open(VOCABULARY, encoding="utf-8") as file:
        counter = token_count.Counter(token_count.MergeRules(json.load(file)))
    draw = random.Random(1)
    parts = [*"abc \n\tsTHEé12.,!\x1c\x85中😀", "'ll", "'S", "  ", "<|endoftext|>", "<|endo"]
    for _ in range(3000):
        text = "".join(
            draw.choice([draw.choice(parts), chr(draw.randrange(32, 0x3000))])
            for _ in range(draw.randrange(30))
        )
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), text


def test_empty_tables(empty):
    assert sharding.assign_shards(empty).collect() == []
    assert exact_dedup.exact_dedup(empty).collect() == []
    assert line_dedup.dedup_lines(empty).collect() == []
    assert token_count.count_tokens(empty, VOCABULARY).collect() == []
