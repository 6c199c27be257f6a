"""Near-duplicate vectors by lattice hashing.

Each table projects unit vectors at random to 8 dimensions and decodes them to the nearest
point of the E8 lattice: its cell. A vector lies in its own cell and looks into the
nearest neighbouring ones too, so two close vectors meet even across a border. Where
they meet, rounded vectors rule out most pairs; the rest is decided by the cosine of
the full vectors in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import (
    GROUP,
    components,
    deal_buckets,
    map_arrow,
    stage,
    whole_groups,
)
from webloom.operators.joins import with_ids

TABLES = 8
PROBES = 4  # neighbouring cells looked into, of 240
WIDTH = 1.5  # scale of the lattice; a projected unit vector has length near sqrt(8)
SEED = 11
BLOCK = 2_000


def e8_roots() -> np.ndarray:
    """The 240 shortest vectors of E8: the steps from a cell to its neighbours."""
    rows = []
    for i, j in combinations(range(8), 2):
        for s, t in product((1, -1), repeat=2):
            rows.append([s if k == i else t if k == j else 0 for k in range(8)])
    halves = [h for h in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in h) % 2 == 0]
    return np.array(rows + halves, float)


def _nearest_even(y: np.ndarray) -> np.ndarray:
    """The nearest integer points whose coordinates have an even sum."""
    point = np.rint(y)
    off = y - point
    rows = np.flatnonzero(point.sum(axis=1) % 2)
    worst = np.abs(off[rows]).argmax(axis=1)
    point[rows, worst] += np.where(off[rows, worst] >= 0, 1, -1)
    return point


def e8_decode(y: np.ndarray) -> np.ndarray:
    """The nearest E8 points: the better of the even lattice and the same shifted by a half."""
    whole, half = _nearest_even(y), _nearest_even(y - 0.5) + 0.5
    better = ((y - whole) ** 2).sum(axis=1) <= ((y - half) ** 2).sum(axis=1)
    return np.where(better[:, None], whole, half)


def _key(cells: np.ndarray, table: int, dim: int) -> np.ndarray:
    # Cells with the same hash only meet needlessly.
    x = np.full(cells.shape[:-1], table * 65_537 + dim, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(8):
            x = (x ^ (2 * cells[..., i]).astype(np.int64).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(29)
    return x.astype(np.int64)


def cell_keys(units: np.ndarray, table: int) -> np.ndarray:
    """Keys of a table for unit vectors: the own cell's first, then the nearest neighbours'."""
    dim = units.shape[1]
    projection = np.random.default_rng([SEED, table, dim]).normal(size=(dim, 8))
    y = units @ projection / WIDTH
    own, roots = e8_decode(y), e8_roots()
    nearest = np.argsort(-((y - own) @ roots.T), axis=1, kind="stable")[:, :PROBES]
    cells = np.concatenate([own[:, None], own[:, None] + roots[nearest]], axis=1)
    return _key(cells, table, dim)


def vector_classes(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, DataFrame]:
    """The usable rows (vec, v), and equal ones together (v, least, n, id); v holds doubles as bytes.

    Usable: with an id, not null, not all zero, all components finite.
    """

    def body(part: pa.RecordBatch) -> dict:
        ids, packed = [], []
        for id_, values in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
            if id_ is None or not values or any(x is None for x in values):
                continue
            array = np.array(values, float) + 0.0  # -0.0 is 0.0
            if np.isfinite(array).all() and array.any():
                ids.append(id_)
                packed.append(array.tobytes())
        return {"vec": pa.array(ids, pa.int64()), "v": pa.array(packed, pa.binary())}

    rows = map_arrow(vectors, [id_col, vector_col], body, "vec bigint, v binary")
    rows = stage(rows, "vectors")
    classes = rows.groupBy("v").agg(F.min("vec").alias("least"), F.count("*").alias("n"))
    return rows, stage(with_ids(classes, "v"), "vector-classes")


def _units(packed: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(positions, unit vectors) for each length that occurs."""
    sizes = np.array([len(p) for p in packed])
    out = []
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        x = np.frombuffer(b"".join(packed[i] for i in at)).reshape(-1, size // 8)
        x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in squares
        out.append((at, x / np.linalg.norm(x, axis=1, keepdims=True)))
    return out


def candidates(classes: DataFrame, threshold: float, tables: int) -> DataFrame:
    """Distinct pairs (a < b) of classes that meet in a cell and may reach ``threshold``."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            ids = part.column(0).to_numpy()
            for at, units in _units(part.column(1).to_pylist()):
                rounded = np.rint(units * 127).astype(np.int8)
                bytes_ = [row.tobytes() for row in rounded]
                for table in range(tables):
                    keys = cell_keys(units, table)
                    width = keys.shape[1]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "key": pa.array(keys.ravel()),
                            "id": pa.array(np.repeat(ids[at], width)),
                            "own": pa.array(np.tile(np.arange(width) == 0, len(at))),
                            "r": pa.array([b for b in bytes_ for _ in range(width)], pa.binary()),
                        }
                    )

    keyed = classes.select("id", "v").mapInArrow(
        spread, "key bigint, id bigint, own boolean, r binary"
    )
    dealt = deal_buckets(keyed, "id", BLOCK, F.max("own"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches):
            ids, own = table["id"].to_numpy(), table["own"].to_numpy(zero_copy_only=False)
            packed = table["r"].to_pylist()
            for low, high in zip(bounds[:-1], bounds[1:], strict=True):
                for length in {len(p) for p in packed[low:high]}:
                    rows = np.array([i for i in range(low, high) if len(packed[i]) == length])
                    x = np.frombuffer(b"".join(packed[i] for i in rows), np.int8)
                    x = x.reshape(-1, length).astype(np.float32)
                    # Rounding moves a component by 1/254 at most, which bounds the error
                    # of the dot product of two unit vectors.
                    slack = 2 * np.sqrt(length) / 254 + length / 254**2
                    owners = np.flatnonzero(own[rows])
                    i, j = np.nonzero(x[owners] @ x.T >= (threshold - slack) * 127**2)
                    a, b = ids[rows[owners[i]]], ids[rows[j]]
                    ends = np.stack([np.minimum(a, b)[a != b], np.maximum(a, b)[a != b]], axis=1)
                    ends = np.unique(ends, axis=0)
                    yield pa.RecordBatch.from_pydict(
                        {"a": pa.array(ends[:, 0]), "b": pa.array(ends[:, 1])}
                    )

    return dealt.select(*GROUP, "id", "own", "r").mapInArrow(meet, "a bigint, b bigint").distinct()


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.9,
    tables: int = TABLES,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(id, n_links, component_id, kept) of every row of ``vectors``.

    Links are pairs with a cosine of at least ``threshold``, decided in double precision;
    lattice hashing may miss a few (the recall is measured in the tests), never adds one.
    Equal vectors are searched once and count as often as they occur. Vectors that
    are null, empty, zero or hold null or non-finite components, and rows with a null
    id, link with nothing and form components of their own; vectors of different
    lengths don't link. An empty table gives no rows; other columns are not read.
    """
    rows, classes = vector_classes(vectors, id_col, vector_col)
    pairs = stage(candidates(classes, threshold, tables), "pairs")
    first = classes.select(F.col("id").alias("a"), F.col("v").alias("va"), F.col("n").alias("na"))
    second = classes.select(F.col("id").alias("b"), F.col("v").alias("vb"), F.col("n").alias("nb"))
    met = pairs.join(first, "a").join(second, "b").select("a", "b", "na", "nb", "va", "vb")

    def body(part: pa.RecordBatch) -> dict:
        close = np.zeros(part.num_rows, bool)
        left, right = part.column(4).to_pylist(), part.column(5).to_pylist()
        for at, x in _units(left):
            y = np.concatenate([u for _, u in _units([right[i] for i in at])])
            close[at] = (x * y).sum(axis=1) >= threshold
        return {n: part.column(n).filter(pa.array(close)) for n in ("a", "b", "na", "nb")}

    links = map_arrow(
        met, ["a", "b", "na", "nb", "va", "vb"], body, "a bigint, b bigint, na bigint, nb bigint"
    )
    links = stage(links, "vector-links")
    ends = links.select(F.col("a").alias("id"), F.col("nb").alias("n")).union(
        links.select(F.col("b").alias("id"), F.col("na").alias("n"))
    )
    partners = ends.groupBy("id").agg(F.sum("n").alias("partners"))
    found = components(links.select("a", "b")).withColumnRenamed("node", "id")
    rooted = classes.join(partners, "id", "left").join(found, "id", "left").select(
        "v",
        "least",
        (F.col("n") - 1 + F.coalesce("partners", F.lit(0))).alias("n_links"),
        F.coalesce("root", "id").alias("root"),
    )
    rooted = stage(rooted, "rooted")
    roots = stage(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "roots")
    named = stage(rooted.join(roots, "root").select("v", "n_links", "component_id"), "named")
    judged = rows.join(named, "v").groupBy("vec").agg(
        F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id")
    )
    id_ = F.col("vec_id")
    return (
        vectors.select(F.col(id_col).alias("vec_id"))
        .join(judged.withColumnRenamed("vec", "vec_id"), "vec_id", "left")
        .select(
            id_.alias(id_col),
            F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
            F.coalesce("component_id", id_).alias("component_id"),
            F.coalesce("component_id", id_).eqNullSafe(id_).alias("kept"),
        )
    )
