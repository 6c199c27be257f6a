import pytest


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows, white space, many scripts."""
    long_text = " ".join(f"word{i % 977} and{i % 13}" for i in range(20_000))
    texts = [
        "The quick brown fox jumps over the lazy dog\nA shared line of text",
        "the quick brown fox jumps over the lazy dog\n\tA SHARED line of text \r\nand more words here",
        None, "", " \t\n\x0b\x0c\r ", "x", "1 2 3 !!", "été à l'école 中文 😀՘ <|endoftext|> don't",
        long_text, long_text + " end", "a b", "A B", "a\nb", "A shared line of text",
        "one two three four five six seven eight nine ten", "▁ mark ▁▁", "a" * 3000,
    ]
    rows = [(i * 3, text) for i, text in enumerate(texts)]
    return [*rows, rows[0], rows[0], (None, texts[0]), (None, None), (100, texts[1]), (101, texts[1])]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """``odd_rows`` as documents, with columns whose names clash with results."""
    schema = (
        "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, "
        "id string, n bigint, kept int, shard string, row_number int"
    )
    rows = [(i, t, "en" if t else None, None, None, "k", "x", 1, 2, "s", 3) for i, t in odd_rows]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


