"""The pipeline, stage by stage, each against a plain version of its own input."""

from collections import Counter

import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from tests.llm import brute
from webloom.llm import mixing
from webloom.llm.common import stage

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark):
    """The input and the output of every stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.limit(1).selectExpr("cast(null AS bigint) AS doc_id", "text", "lang", "source", "n_chars")
    odd = spark.createDataFrame(
        [(9000, None, "en", "s", 0), (9001, "", None, None, None), (9002, "12 34 !!", "en", "s", 8)],
        docs.schema,
    )
    out = [docs.union(extra).union(odd).union(docs.limit(2))]
    for name, function in corpus_pipeline.STAGES:
        out.append(stage(function(spark, out[-1], SF), name))
    return out


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_columns(results):
    assert all(df.columns == results[0].columns for df in results[:-1])


def test_language_stage(results):
    before, after = (Counter(rows(df)) for df in results[:2])
    assert not after - before
    gone = before - after
    assert sum(gone.values()) <= 0.02 * sum(before.values()) + 3
    assert {9000, 9001, 9002} <= {i for i, _ in gone}


def test_line_stage(results):
    before = rows(results[1])
    kept = brute.kept_lines(before)
    expected = Counter((i, text) for (i, _), (_, _, text) in zip(before, kept, strict=True))
    assert Counter(rows(results[2])) == expected
    assert all(r.n_chars == len(r.text) for r in results[2].collect())


def test_near_stage(results):
    """One row of each group, all groups as brute force finds them."""
    before, after = rows(results[2]), Counter(rows(results[3]))
    prints = [brute.simhash(t, 3) for _, t in before]
    roots = brute.components(
        list(range(len(before))), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2
    )
    groups = {}
    for at, root in enumerate(roots):
        groups.setdefault(root, []).append(before[at])
    first = [min((i is None, i or 0) for i, _ in members) for members in groups.values()]
    assert Counter((i is None, i or 0) for i, _ in after.elements()) == Counter(first)
    assert not after - Counter(before)


@pytest.mark.parametrize("stage_name", ["line_dedup", "near_dedup"])
def test_stages_of_an_empty_table_and_clashing_columns(spark, stage_name):
    function = dict(corpus_pipeline.STAGES)[stage_name]
    columns = "doc_id bigint, text string, lang string, source string, n_chars bigint, at int, fp string, _at int, key int"
    long_text = " ".join(f"word{i}" for i in range(200_000))
    docs = spark.createDataFrame(
        [(1, long_text, "en", "s", 1, 2, "f", 3, 4), (2, None, None, None, None, 2, None, 3, 4)], columns
    )
    out = function(spark, docs, SF)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: long_text, 2: None}
    assert all((r.at, r._at, r.key) == (2, 3, 4) for r in out.collect())
    assert function(spark, docs.limit(0), SF).collect() == []


def test_mixing_stage(spark, results):
    mixed = mixing.mix(results[3], spark.read.parquet(f"{SF}/labels.parquet")).collect()
    copies = {r.doc_id: r.copies for r in mixed if r.doc_id is not None}
    expected = Counter()
    for i, text in rows(results[3]):
        expected[i, text] += copies.get(i, 1)
    assert Counter(rows(results[4])) == +expected


def test_piece_stage(results):
    library = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path(corpus_pipeline.VOCABULARY)
    )
    texts = dict(rows(results[4]))
    got = results[5].collect()
    assert len(got) == results[4].count()
    for r in got:
        assert library.decode(list(r.ids)) == texts[r.doc_id].replace("▁", " ")
        assert r.n_pieces == len(r.ids) and r.round_trip
