"""Mixing to target weights with soft domain membership.

A classifier trained on a labelled table gives every document a posterior over domains.
Nonnegative rates, one per document, are fitted by projected-gradient least squares, so
that the domains' expected token totals (tokens x rate x posterior) match their targets.
Every step is one Spark pass that sums a few numbers; a document's rate follows from
its posterior and the short history of those sums, so nothing is shuffled or kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import map_arrow, stage, utf8

BUCKETS = 1 << 20
PREFIX = 5
#: Labelled documents per domain used for training, at most in expectation.
TRAIN_DOCS = 1_500
#: Domains are (quality, toxic); weights are shares of the tokens of the mixture.
TARGETS = {(1, 0): 0.88, (0, 0): 0.10, (1, 1): 0.02}
#: The domain whose documents keep their tokens: it sets the size of the mixture.
ANCHOR = (1, 0)
FEATURES = 1_500
LEARNING_STEPS = 150
SHRINK = 1e-4
MARKS = b"!\"#$%&()*+,-./:;<=>?@[]^_|~"
STEPS = 60
TOLERANCE = 1e-4  # largest miss of a total, as a share of all tokens


def features(text: bytes) -> np.ndarray:
    """The distinct buckets of a text's traits.

    Its words and their beginnings without regard to case, marks at the ends of words, and
    the shares of distinct and of upper-case words in tenths.
    """
    words = text.split()
    if not words:
        return np.zeros(0, np.int64)
    named = {b"d%d" % (10 * len(set(words)) // len(words)), b"u%d" % (10 * sum(map(bytes.isupper, words)) // len(words))}
    for word in set(text.lower().split()):
        named.add(b"w" + word)
        named.add(b"p" + word[:PREFIX])
        bare = word.rstrip(MARKS)
        if len(bare) < len(word):
            named.add(b"m" + word[len(bare) :][:8])
    hash_ = xxhash.xxh3_64_intdigest
    return np.unique(np.array([hash_(name) % BUCKETS for name in named], np.int64))


@dataclass
class Domains:
    names: list[tuple[int, int]]
    chosen: np.ndarray  # ascending buckets of the features in use
    weights: np.ndarray  # chosen x domains
    prior: np.ndarray

    def posterior(self, found: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.chosen, found)
        known = at[at < len(self.chosen)]
        known = known[self.chosen[known] == found[: len(at)][at < len(self.chosen)]]
        logits = self.prior + self.weights[known].sum(axis=0)
        odds = np.exp(logits - logits.max())
        return odds / odds.sum()


def softmax_regression(x: np.ndarray, domain: np.ndarray, domains: int) -> tuple[np.ndarray, np.ndarray]:
    """(weights, bias) by accelerated gradient steps; classes weigh alike, weights are shrunk."""
    if not x.size:
        return np.zeros((x.shape[1], domains), np.float32), np.zeros(domains, np.float32)
    y = np.eye(domains, dtype=np.float32)[domain]
    weigh = (1 / np.maximum(1, y.sum(axis=0)))[domain][:, None] / domains
    w = ahead = np.zeros((x.shape[1], domains), np.float32)
    bias = np.zeros(domains, np.float32)
    step = 4.0 / max(1.0, float((x.sum(axis=1) + 1).mean()))
    for number in range(LEARNING_STEPS):
        z = x @ ahead + bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        off = (p - y) * weigh
        after = ahead - step * (x.T @ off + SHRINK * ahead)
        bias = bias - step * off.sum(axis=0)
        ahead = after + number / (number + 3) * (after - w)
        w = after
    return w, bias


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> Domains:
    """A classifier of documents into the domains of ``labels`` (doc_id, quality, toxic).

    Softmax regression on the presence of the ``FEATURES`` clearest traits. Of each domain
    ``train_docs`` labelled documents in expectation, chosen by the hash of the id;
    this bounded sample is all that the driver sees. Labels with a null are left out.
    """
    known = labels.select("doc_id", "quality", "toxic").dropna()
    totals = {(r[0], r[1]): r[2] for r in known.groupBy("quality", "toxic").count().collect()}
    names = sorted(totals)
    chance = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("mix")), F.lit(1 << 30)) / (1 << 30)
    wanted, number = F.lit(False), F.lit(-1)
    for i, (quality, toxic) in enumerate(names):
        here = (F.col("quality") == quality) & (F.col("toxic") == toxic)
        wanted = wanted | (here & (chance < train_docs / totals[quality, toxic]))
        number = F.when(here, i).otherwise(number)
    sample = known.where(wanted).select("doc_id", number.alias("domain")).dropDuplicates(["doc_id"])
    # Bounded by train_docs for each domain, so it may be broadcast.
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def body(part: pa.RecordBatch) -> dict:
        held = [features(text).astype("<i4").tobytes() for text in utf8(part.column(1))]
        return {"domain": part.column(0), "doc_id": part.column(2), "found": pa.array(held, pa.binary())}

    rows = stage(
        map_arrow(texts, ["domain", "text", "doc_id"], body, "domain int, doc_id bigint, found binary"),
        "mix-sample",
    )

    def count(part: pa.RecordBatch) -> dict:
        counts: dict[int, np.ndarray] = {}
        for domain, found in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
            counts.setdefault(domain, np.zeros(BUCKETS, np.int64))[np.frombuffer(found, "<i4")] += 1
        at = {domain: np.flatnonzero(n) for domain, n in counts.items()}
        return {
            "domain": pa.array(np.concatenate([np.full(len(v), d, np.int32) for d, v in at.items()])),
            "bucket": pa.array(np.concatenate([*at.values()]).astype(np.int32)),
            "n": pa.array(np.concatenate([counts[d][v] for d, v in at.items()])),
        }

    counted = map_arrow(rows, ["domain", "found"], count, "domain int, bucket int, n bigint")
    k, sizes = len(names), {r[0]: r[1] for r in rows.groupBy("domain").count().collect()}
    size = np.array([sizes.get(i, 0) for i in range(k)], float)
    table = counted.groupBy("domain", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((BUCKETS, k), np.float32)
    counts[table["bucket"].to_numpy(int), table["domain"].to_numpy(int)] = table["n"]
    # How far a feature's share in a domain lies from its share elsewhere, in standard errors.
    rest, others = counts.sum(axis=1, keepdims=True) - counts, size.sum() - size
    pooled = (counts + rest) / max(1.0, size.sum())
    error = np.sqrt(pooled * (1 - pooled) * (1 / np.maximum(1, size) + 1 / np.maximum(1, others))) + 1e-3
    clear = (np.abs(counts / np.maximum(1, size) - rest / np.maximum(1, others)) / error).max(axis=1, initial=0)
    chosen = np.sort(np.argsort(-clear, kind="stable")[:FEATURES])
    held = rows.select("domain", "found").toPandas()  # the bounded sample
    x = np.zeros((len(held), len(chosen)), np.float32)
    for i, found in enumerate(held["found"]):
        x[i] = np.isin(chosen, np.frombuffer(found, "<i4"), assume_unique=True)
    weights, bias = softmax_regression(x, held["domain"].to_numpy(int), k)
    # Training weighed domains alike; the prior brings their shares among the labels back.
    share = np.array([totals[n] for n in names], float)
    return Domains(names, chosen, weights.astype(float), bias + np.log(share * k / max(1.0, share.sum())))


def memberships(docs: DataFrame, model: Domains) -> DataFrame:
    """(doc_id, tokens, p) of every row: white-space words of the whole text, domain posteriors."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def body(part: pa.RecordBatch) -> dict:
        texts = utf8(part.column(1))
        p = [shared.value.posterior(features(text)).tolist() for text in texts]
        return {
            "doc_id": part.column(0).cast(pa.int64()),
            "tokens": pa.array([len(text.split()) for text in texts], pa.int64()),
            "p": pa.array(p, pa.list_(pa.float64())),
        }

    return map_arrow(docs, ["doc_id", "text"], body, "doc_id bigint, tokens bigint, p array<double>")


@dataclass
class Fit:
    """The steps of the fit: a rate follows from them and a posterior."""

    step: float
    history: list[np.ndarray]  # relative misses of the totals, one row per step
    miss: float = 0.0  # largest miss of a total that is left, as a share of all tokens

    def rates(self, p: np.ndarray) -> np.ndarray:
        """Accelerated projected gradient from rates of one, replayed for rows of ``p``."""
        rate = ahead = np.ones(len(p))
        for number, miss in enumerate(self.history):
            after = np.maximum(0.0, ahead - self.step * (p @ miss))
            ahead = after + number / (number + 3) * (after - rate)
            rate = after
        return rate

    def ahead(self, p: np.ndarray) -> np.ndarray:
        """The rates at which the next gradient is taken."""
        if not self.history:
            return np.ones(len(p))
        last = Fit(self.step, self.history[:-1]).rates(p)
        rate = self.rates(p)
        number = len(self.history) - 1
        return rate + number / (number + 3) * (rate - last)


def _matrix(column: pa.Array, domains: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, domains)


def _sums(members: DataFrame, domains: int, fit: Fit) -> tuple[np.ndarray, np.ndarray]:
    """Domain totals at the fit's rates, and at the rates ahead."""

    def body(part: pa.RecordBatch) -> dict:
        p, tokens = _matrix(part.column(1), domains), part.column(0).to_numpy()
        both = [(p * (tokens * r)[:, None]).sum(axis=0) for r in (fit.rates(p), fit.ahead(p))]
        return {
            "k": pa.array(np.arange(2 * domains, dtype=np.int32)),
            "s": pa.array(np.concatenate(both)),
        }

    rows = map_arrow(members, ["tokens", "p"], body, "k int, s double").groupBy("k").sum("s").collect()
    out = np.zeros(2 * domains)
    for k, s in rows:
        out[k] = s
    return out[:domains], out[domains:]


def fit_rates(
    members: DataFrame, names: list[tuple[int, int]], targets: dict, anchor: tuple[int, int]
) -> tuple[Fit, np.ndarray, np.ndarray]:
    """(fit, totals reached, totals wanted): least squares over nonnegative rates.

    The mixture's size is the anchor domain's expected tokens over its weight (of all
    tokens, if the anchor is unknown). The gradient is scaled by a document's tokens.
    """
    k = len(names)
    weights = np.array([targets.get(name, 0.0) for name in names])
    weights = weights / weights.sum() if weights.sum() else np.full(k, 1 / max(1, k))
    now, _ = _sums(members, k, Fit(1.0, []))
    total = now.sum()
    if not total:
        return Fit(1.0, []), now, now
    at = names.index(anchor) if anchor in names and weights[names.index(anchor)] else None
    wanted = weights * (total if at is None else now[at] / weights[at])
    # The scaled Hessian's largest eigenvalue is at most the largest domain's share.
    fit = Fit(float(total / now.max()), [])
    reached, ahead, change = now, now, total
    # Unreachable targets leave a miss; then the fit ends where totals stand still.
    while len(fit.history) < STEPS and min(np.abs(reached - wanted).max(), change) > TOLERANCE * total:
        fit.history.append(np.round((ahead - wanted) / total, 12))
        before, (reached, ahead) = reached, _sums(members, k, fit)
        change = 10 * np.abs(reached - before).max()
    fit.miss = float(np.abs(reached - wanted).max() / total)
    return fit, reached, wanted


def mix(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict = TARGETS,
    anchor: tuple[int, int] = ANCHOR,
    train_docs: int = TRAIN_DOCS,
) -> DataFrame:
    """(doc_id, tokens, p, domain, rate, copies, miss) of every row of ``docs``.

    ``p`` are the posteriors of the labelled domains in ascending order, ``domain`` the
    likeliest as ``quality,toxic``; ``copies`` is the rate rounded up or down by the hash
    of the id, so that its expectation is the rate. ``miss`` is the same in all rows: how far the
    domain total that is worst met lies from its target, as a share of all tokens. It is
    above ``TOLERANCE`` where no rates reach the targets or the fit ended at ``STEPS``
    steps, each one pass over the posteriors. Null and empty texts, however many, have no
    tokens and count for no total; a very long one counts with all its words. Of equal posteriors
    the domain that comes first is the likeliest. Without labels every rate is 1, domain and miss null.
    Repeated rows are treated alike; an empty table gives no rows; other columns
    are not read.
    """
    model = train(docs, labels, train_docs)
    names = model.names
    if not names:
        out = docs.select(
            "doc_id", F.size(F.split(F.trim(F.coalesce("text", F.lit(""))), r"\s+")).cast("bigint").alias("tokens")
        )
        return out.select(
            "doc_id", "tokens", F.array().cast("array<double>").alias("p"),
            F.lit(None).cast("string").alias("domain"), F.lit(1.0).alias("rate"), F.lit(1).alias("copies"),
            F.lit(None).cast("double").alias("miss"),
        )
    members = stage(memberships(docs, model), "members")
    fit, _, _ = fit_rates(members, names, targets, anchor)
    written = [f"{quality},{toxic}" for quality, toxic in names]

    def body(part: pa.RecordBatch) -> dict:
        p = _matrix(part.column(2), len(names))
        return {
            "doc_id": part.column(0),
            "tokens": part.column(1),
            "p": part.column(2),
            "domain": pa.array([written[i] for i in p.argmax(axis=1)], pa.string()),
            "rate": pa.array(np.round(fit.rates(p), 9)),
        }

    schema = "doc_id bigint, tokens bigint, p array<double>, domain string, rate double"
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("copies")), F.lit(1 << 30)) / (1 << 30)
    return map_arrow(members, ["doc_id", "tokens", "p"], body, schema).withColumns(
        {"copies": F.floor(F.col("rate") + draw).cast("int"), "miss": F.lit(round(fit.miss, 6))}
    )
