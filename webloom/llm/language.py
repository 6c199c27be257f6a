"""Language identification by error-correcting output codes.

Each language has a codeword; one binary classifier per bit (naive Bayes over hashed byte
n-grams) says how strongly a text speaks for the bit being set. Decoding weighs each
bit's loss by how reliable its classifier was in training and takes the nearest
codeword; where the second is almost as near, the answer is flagged as ambiguous.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import in_pieces, map_arrow

UNKNOWN = "und"
ORDERS = (2, 3, 4)
BUCKETS = 1 << 16
SLICE = 1 << 16  # bytes of a text looked up at a time
LONG_CODE = 31
#: Training documents per language, at most in expectation: the sample's bound.
TRAIN_DOCS = 2_000
AMBIGUOUS = 0.05  # least lead of the nearest codeword, as a share of the largest possible loss gap
SHARPNESS = 4.0

_TO_SPACE = bytes(c if chr(c).isalpha() or c >= 0x80 else 0x20 for c in range(256))


def grams(text: str) -> np.ndarray:
    """Bucket numbers of all byte n-grams of the lower-cased text, other ASCII than letters as spaces."""
    raw = b" " + text.lower().encode("utf-8", "replace").translate(_TO_SPACE) + b" "
    x = np.frombuffer(raw, np.uint8).astype(np.uint64)
    out = []
    with np.errstate(over="ignore"):
        for order in ORDERS:
            if len(x) < order:
                continue
            h = np.full(len(x) - order + 1, order, np.uint64)
            for i in range(order):
                h = h * np.uint64(257) + x[i : len(x) - order + 1 + i]
            h *= np.uint64(0x9E3779B97F4A7C15)
            out.append((h >> np.uint64(48)).astype(np.int64))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def codewords(languages: int) -> np.ndarray:
    """One row of -1 and 1 per language: all splits for up to six, else words far apart."""
    if languages <= 6:
        splits = range(1, 2 ** max(languages - 1, 0))
        # The last language is always 0, so no split appears with its complement.
        words = np.array([[s >> k & 1 for s in splits] for k in range(languages)])
        return words.reshape(languages, len(splits)) * 2 - 1
    draw, rows = np.random.default_rng(7), []
    for _ in range(languages):
        tries = draw.integers(0, 2, (256, LONG_CODE)) * 2 - 1
        apart = [min(((t != r).sum() for r in rows), default=0) for t in tries]
        rows.append(tries[int(np.argmax(apart))])
    return np.array(rows)


@dataclass
class Model:
    languages: list[str]
    words: np.ndarray  # languages x bits
    weights: np.ndarray  # buckets x bits: log odds per n-gram
    trust: np.ndarray  # per bit, sums to 1

    def margins(self, text: str) -> np.ndarray:
        """How far each bit is set, from -1 to 1: the mean log odds, squashed."""
        found = grams(text)
        total = np.zeros(self.words.shape[1])
        for start in range(0, len(found), SLICE):
            total += self.weights[found[start : start + SLICE]].sum(axis=0, dtype=np.float64)
        return np.tanh(SHARPNESS * total / max(1, len(found)))

    def decode(self, margins: np.ndarray) -> tuple[int, float, bool]:
        """(language, score, ambiguous) of the codeword with the least weighted logistic loss."""
        losses = (np.logaddexp(0, -2 * self.words * margins) * self.trust).sum(axis=1)
        order = np.argsort(losses, kind="stable")
        gaps = 4 * (losses - losses[order[0]])
        score = float(1 / np.exp(-gaps).sum())
        if len(order) == 1:
            return 0, 1.0, False
        lead = (losses[order[1]] - losses[order[0]]) / 2
        return int(order[0]), score, bool(lead < AMBIGUOUS)


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def train(
    docs: DataFrame, labelled: Column, train_docs: int = TRAIN_DOCS,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> Model:
    """A model of the ``labelled`` rows with a language and a text.

    From each language a share of rows, chosen by the hash of the id, of ``train_docs`` in
    expectation. Counts of n-grams are summed by Spark; the driver gets one number per
    language and bucket, a fixed size.
    """
    known = docs.where(labelled & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    totals = {r[0]: r[1] for r in known.groupBy(lang_col).count().collect()}
    languages = sorted(totals)
    words = codewords(len(languages))
    if len(languages) < 2:
        return Model(languages, words, np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    chance = F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) / (1 << 30)
    wanted = F.lit(False)
    for language in languages:
        share = train_docs / totals[language]
        wanted = wanted | ((F.col(lang_col) == language) & (chance < share))
    sample = known.where(wanted).select(id_col, lang_col, text_col)

    def body(part: pa.RecordBatch) -> dict:
        counts: dict[str, np.ndarray] = {}
        for language, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
            held = counts.setdefault(language, np.zeros(BUCKETS, np.int64))
            held += np.bincount(grams(text), minlength=BUCKETS)
        langs, buckets, n = [], [], []
        for language, held in counts.items():
            at = np.flatnonzero(held)
            langs += [language] * len(at)
            buckets.append(at)
            n.append(held[at])
        return {
            "lang": pa.array(langs, pa.string()),
            "bucket": pa.array(np.concatenate(buckets).astype(np.int32)),
            "n": pa.array(np.concatenate(n)),
        }

    # By id and text, so that one text of many rows isn't one task's.
    spread = sample.repartition(F.xxhash64(id_col, text_col))
    counted = map_arrow(spread, [lang_col, text_col], body, "lang string, bucket int, n bigint")
    rows = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((len(languages), BUCKETS))
    index = {language: i for i, language in enumerate(languages)}
    counts[rows["lang"].map(index).to_numpy(int), rows["bucket"].to_numpy(int)] = rows["n"]
    share = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)  # languages weigh alike
    weights = np.stack(
        [
            np.log(share[column > 0].mean(axis=0)) - np.log(share[column < 0].mean(axis=0))
            for column in words.T
        ],
        axis=1,
    )
    # How well a bit parts the languages: the least margin of a language's own n-grams.
    own = np.stack([np.tanh(SHARPNESS * (s @ weights)) for s in share])
    trust = np.clip((own * words).min(axis=0), 0.05, None)
    return Model(languages, words, weights.astype(np.float32), trust / trust.sum())


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, ambiguous, bits) of every row, from its whole text alone.

    ``und`` with score 0 where the text is null or has no letter, or the model knows no
    language; bits are the signs that the classifiers saw.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def body(part: pa.RecordBatch) -> dict:
        m: Model = shared.value
        out = []
        for text in part.column(1).to_pylist():
            if not m.languages or text is None or not has_letter(text):
                out.append((UNKNOWN, 0.0, False, ""))
                continue
            margins = m.margins(text)
            language, score, ambiguous = m.decode(margins)
            bits = "".join("1" if x > 0 else "0" for x in margins)
            out.append((m.languages[language], score, ambiguous, bits))
        names, scores, flags, bits = zip(*out, strict=True)
        return {
            "id": part.column(0).cast(pa.int64()),
            "lang_pred": pa.array(names, pa.string()),
            "score": pa.array(scores, pa.float64()),
            "ambiguous": pa.array(flags, pa.bool_()),
            "bits": pa.array(bits, pa.string()),
        }

    schema = "id bigint, lang_pred string, score double, ambiguous boolean, bits string"
    return map_arrow(docs, [id_col, text_col], body, schema).withColumnRenamed("id", id_col)


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose language is known and not ambiguous."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def clear(text: str | None) -> bool:
        m: Model = shared.value
        if not m.languages or text is None or not has_letter(text):
            return False
        return not m.decode(m.margins(text))[2]

    def batches(parts):
        for part in in_pieces(parts):
            yield part.filter(pa.array(map(clear, part.column(at).to_pylist()), pa.bool_()))

    return docs.mapInArrow(batches, docs.schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept from training: crc32 of the id as text leaves 2 modulo 4."""
    remainder = F.crc32(F.col(id_col).cast("string").cast("binary")) % 4
    return F.coalesce(remainder == 2, F.lit(False))


def identify(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous, bits) of every row of ``docs``.

    Trained on a sample of the rows that are not held out. A null id is never held out.
    Repeated rows are answered alike, an empty table gives no rows, and columns other
    than doc_id, text and lang are not read; lang only in training.
    """
    model = train(docs, ~held_out(), train_docs)
    return predict(docs, model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous", "bits"
    )
