"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

Text gets a marker in front and one for each space; the best-scored sequence of pieces
is kept, and characters without a piece fall back to byte pieces. Decoding turns
markers into spaces and bytes into characters again.
"""

from __future__ import annotations

import math
import re
from array import array
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as formats

from webloom.llm.common import map_arrow, utf8

MARK = "▁"
REMEMBER = 250_000  # words whose pieces a task keeps at most, twice
REMEMBER_BYTES = 48


class DoubleArray:
    """A trie over bytes: the child of state s by byte c is base[s] + c + 1, if check says s."""

    def __init__(self, base: list[int], check: list[int], value: list[int]):
        self.base, self.check, self.value = base, check, value

    @classmethod
    def build(cls, keys: dict[bytes, int]) -> DoubleArray:
        tree: dict = {}
        for key, number in keys.items():
            node = tree
            for byte in key:
                node = node.setdefault(byte, {})
            node[None] = number
        size = 512 + 4 * sum(len(key) for key in keys)
        base, check, value = (np.full(size, fill, np.int32) for fill in (0, -1, -1))
        free = np.ones(size, bool)
        free[0] = False
        check[0], first = 0, 1
        todo = [(tree, 0)]
        while todo:
            node, state = todo.pop()
            value[state] = node.get(None, -1)
            children = np.array(sorted(byte for byte in node if byte is not None), np.int64)
            if not len(children):
                continue
            first += int(np.argmax(free[first:]))
            at, span = max(1, first - int(children[0]) - 1), 64
            while True:  # the first place where all children fit
                fits = np.ones(span, bool)
                for byte in children + 1:
                    fits &= free[at + byte : at + byte + span]
                if fits.any():
                    at += int(np.argmax(fits))
                    break
                at, span = at + span, min(2 * span, 8192)
            base[state] = at
            check[at + children + 1] = state
            free[at + children + 1] = False
            todo += [(node[byte], at + byte + 1) for byte in children.tolist()]
        used = int(np.flatnonzero(~free)[-1]) + 258  # any byte may be looked up from any state
        return cls(*(a[:used].tolist() for a in (base, check, value)))


@dataclass
class Pieces:
    """A model file's pieces in the form that tasks use."""

    texts: list[str]
    scores: list[float]
    kinds: list[int]
    unknown: int
    prefix: bool

    @classmethod
    def load(cls, path: str) -> Pieces:
        """The pieces of a ``.model`` file; ``log_scores`` says what becomes of their scores."""
        model = formats.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules = model.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces:
            raise ValueError("only models without normalisation rules are supported")
        if not model.trainer_spec.byte_fallback:
            raise ValueError("only models with byte fallback are supported")
        kinds = [piece.type for piece in model.pieces]
        scores = [piece.score for piece in model.pieces]
        if model.trainer_spec.model_type != formats.TrainerSpec.UNIGRAM:
            scores = log_scores(scores, kinds)
        unknown = kinds.index(formats.ModelProto.SentencePiece.UNKNOWN)
        texts = [piece.piece for piece in model.pieces]
        return cls(texts, scores, kinds, unknown, rules.add_dummy_prefix)

    def by_byte(self) -> dict[int, int]:
        """The piece that stands for each byte."""
        kind = formats.ModelProto.SentencePiece.BYTE
        return {int(self.texts[i][3:5], 16): i for i, k in enumerate(self.kinds) if k == kind}

    def raw(self) -> list[bytes]:
        """What each piece becomes in a decoded text."""
        kind = formats.ModelProto.SentencePiece
        raw = [t.replace(MARK, " ").encode() for t in self.texts]
        for byte, i in self.by_byte().items():
            raw[i] = bytes([byte])
        return [b"" if k in (kind.CONTROL, kind.UNKNOWN) else r for r, k in zip(raw, self.kinds, strict=True)]


def log_scores(scores: list[float], kinds: list[int]) -> list[float]:
    """Log-probabilities for pieces whose file holds merge priorities instead.

    By Zipf's law the piece of rank r has probability 1 / (r + 1) of the harmonic
    sum; ranks follow the file's priorities. Nothing is trained.
    """
    normal = [i for i, kind in enumerate(kinds) if kind == formats.ModelProto.SentencePiece.NORMAL]
    total = math.log(sum(1 / (r + 1) for r in range(len(normal))))
    out = [0.0] * len(scores)
    for rank, i in enumerate(sorted(normal, key=lambda i: (-scores[i], i))):
        # Single precision, as model files store scores.
        out[i] = float(np.float32(-math.log(rank + 1) - total))
    return out


class Codec:
    """Encodes and decodes whole texts."""

    def __init__(self, pieces: Pieces, trie: DoubleArray):
        self.pieces, self.trie = pieces, trie
        kind = formats.ModelProto.SentencePiece
        normal = [i for i, k in enumerate(pieces.kinds) if k == kind.NORMAL]
        self.unknown_score = min((pieces.scores[i] for i in normal), default=0.0) - 10.0
        self.bytes, self.raw = pieces.by_byte(), pieces.raw()
        # Where no piece has a marker after another character, words are independent. They are kept
        # with spaces for markers: most are ASCII then, a byte a character.
        apart = not any(MARK in t.lstrip(MARK) for t in (pieces.texts[i] for i in normal))
        self.words = re.compile(" *[^ ]+| +" if apart else r"[\s\S]+")
        self.code = "H" if len(pieces.texts) <= 1 << 16 else "i"
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.longest = max((len(pieces.texts[i].encode()) for i in normal), default=1)
        self.next = [b + 1 for b in trie.base]

    def viterbi(self, text: bytes) -> list[int]:
        """The pieces of the best-scored segmentation; of equal ones the longest first piece."""
        next_, check, value, scores = self.next, self.trie.check, self.trie.value, self.pieces.scores
        n, low, longest = len(text), -math.inf, self.longest
        best, back, piece = [low] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        unknown_score = self.unknown_score
        i = 0
        while i < n:
            lead = text[i]
            width = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            here, state, j, alone = best[i], 0, i, i + width
            single = False
            for byte in text[i : i + longest]:
                to = next_[state] + byte
                if check[to] != state:
                    break
                state = to
                j += 1
                found = value[state]
                if found >= 0:
                    if j == alone:
                        single = True
                    score = here + scores[found]
                    if score > best[j]:
                        best[j] = score
                        back[j] = i
                        piece[j] = found
            if not single and here + unknown_score > best[i + width]:
                best[i + width], back[i + width], piece[i + width] = here + unknown_score, i, -1
            i += width
        out, j = [], n
        while j:
            i = back[j]
            out += [piece[j]] if piece[j] >= 0 else [self.bytes[b] for b in reversed(text[i:j])]
            j = i
        return out[::-1]

    def packed(self, text: str) -> bytes:
        """The identifiers of ``text`` as integers of type ``code``."""
        if not text:
            return b""
        spaced = (" " if self.pieces.prefix else "") + text.replace(MARK, " ")
        get, look = self.known.get, self._word
        return b"".join([get(word) or look(word) for word in self.words.findall(spaced)])

    def _word(self, word: str) -> bytes:
        ids = self.older.get(word)
        raw = word.replace(" ", MARK).encode()
        if ids is None:
            ids = array(self.code, self.viterbi(raw)).tobytes()
        if len(raw) <= REMEMBER_BYTES:
            if len(self.known) >= REMEMBER:
                self.known, self.older = {}, self.known  # what is in use comes back from there
            self.known[word] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        return array(self.code, self.packed(text)).tolist()

    def decode(self, ids: list[int]) -> str:
        raw = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return raw[1:] if self.pieces.prefix and raw[:1] == " " else raw


_codecs: dict[str, Codec] = {}


def _codec(key: str, shared) -> Codec:
    """This worker's codec, kept from task to task."""
    if key not in _codecs:
        pieces, base, check, value = shared.value
        _codecs[key] = Codec(pieces, DoubleArray(base.tolist(), check.tolist(), value.tolist()))
    return _codecs[key]


class Model:
    """A model file, read by the driver and broadcast (pieces and trie: a fixed size)."""

    def __init__(self, spark, path: str):
        self.path, self.pieces = path, Pieces.load(path)
        pieces = self.pieces
        normal = formats.ModelProto.SentencePiece.NORMAL
        trie = DoubleArray.build(
            {t.encode(): i for i, t in enumerate(pieces.texts) if pieces.kinds[i] == normal}
        )
        arrays = (np.array(a, np.int32) for a in (trie.base, trie.check, trie.value))
        self.shared = spark.sparkContext.broadcast((pieces, *arrays))


def encode(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, ids) of every row: the piece identifiers of each whole text.

    Null and empty texts have no pieces (null ids for a null text). A marker
    character in a text counts as a space. Repeated rows are encoded each; an
    empty table gives no rows; other columns are not read.
    """
    shared, key = model.shared, model.path

    def body(part: pa.RecordBatch) -> dict:
        codec = _codec(key, shared)
        packed = [codec.packed(text.decode("utf-8", "replace")) for text in utf8(part.column(1))]
        flat = np.frombuffer(b"".join(packed), codec.code)
        sizes = np.cumsum([0, *map(len, packed)]) // flat.itemsize
        return {
            "id": part.column(0).cast(pa.int64()),
            "text": part.column(1),
            "ids": pa.ListArray.from_arrays(
                pa.array(sizes, pa.int32()), pa.array(flat.astype(np.int32)),
                mask=part.column(1).is_null() if part.column(1).null_count else None,
            ),
        }

    return map_arrow(docs, [id_col, text_col], body, "id bigint, text string, ids array<int>")


def decode(encoded: DataFrame, model: Model) -> DataFrame:
    """``encoded`` (id, text, ids) with ``decoded`` and ``n_byte_pieces``; null ids give a null text.

    Native, so a task has one Python process, that of ``encode``, and texts and identifiers
    don't go through a second one. The pieces are a literal of the plan, in hexadecimal digits: single
    byte pieces are no strings. Bytes that are no UTF-8 become U+FFFD; an identifier that
    the model doesn't have is an error.
    """
    raw = F.split(F.lit(",".join(piece.hex() for piece in model.pieces.raw())), ",")
    missing = F.raise_error(F.lit("an identifier has no piece"))
    joined = F.array_join(F.transform("ids", lambda i: F.coalesce(F.get(raw, i), missing)), "")
    text = F.make_valid_utf8(F.unhex(joined).cast("string"))
    singles = set(model.pieces.by_byte().values())
    starts = sorted(i for i in singles if i - 1 not in singles)
    ends = sorted(i for i in singles if i + 1 not in singles)

    def is_byte(i: Column) -> Column:
        runs = (i.between(low, high) for low, high in zip(starts, ends, strict=True))
        return reduce(Column.__or__, runs, F.lit(False))

    n_bytes = F.coalesce(F.size(F.filter("ids", is_byte)), F.lit(0)).cast("bigint")
    out = encoded.select("id", "text", "ids", text.alias("decoded"), n_bytes.alias("n_byte_pieces"))
    if not model.pieces.prefix:
        return out
    first = F.when(F.startswith("decoded", F.lit(" ")), 2).otherwise(1)
    return out.withColumn("decoded", F.substr("decoded", first))


def round_trips(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_pieces, n_byte_pieces, ids_hash, decoded_sha256, round_trip) of every row.

    ``round_trip``: the decoded text is the text (markers in it read as spaces); null
    where the text is null.
    """
    return checked(decode(encode(docs, model, id_col, text_col), model)).drop("ids").withColumnRenamed(
        "id", id_col
    )


def checked(decoded: DataFrame) -> DataFrame:
    """``decode``'s rows as (id, ids, n_pieces, n_byte_pieces, ids_hash, decoded_sha256, round_trip)."""
    return decoded.select(
        "id",
        "ids",
        F.coalesce(F.size("ids"), F.lit(0)).cast("bigint").alias("n_pieces"),
        F.coalesce("n_byte_pieces", F.lit(0)).cast("bigint").alias("n_byte_pieces"),
        F.xxhash64("ids").alias("ids_hash"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.translate("text", MARK, " ")).alias("round_trip"),
    )
