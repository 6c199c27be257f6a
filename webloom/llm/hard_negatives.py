"""Hard negatives: for every anchor and positive the best rows of other labels within a window.

An inverted multi-index holds the rows. Each vector is cut into two halves and each half
goes to the nearest word of a codebook, so two words name a cell. A cell's scores with an
anchor are at most the sum of two half-bounds: the half's product with the word, plus its
length times the word's radius (the largest distance of any row from its word). A heap
walks the cells by that sum, the multi-sequence way: after words (i, j), in the order of
their half-bounds, come (i + 1, j) and (i, j + 1). Once the next sum is below what a window
still needs, no cell left can change its result: the window is certified, so results are
exact, whatever the codebooks.

Scores are inner products of floor(256 * x), exact integers up to 2^53.

The rows lie in blocks of neighbouring cells. An anchor first visits the blocks of its first
cells; what it finds there raises the lower ends of its windows, and only blocks with a cell
above them are visited after that. A task holds one block and one slice of the anchors, both
of bounded size, and returns five rows a window at most.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from webloom.llm.common import in_pieces, stage

#: Rows of which the codebooks are learned, as expected by a hash of the id, and numbers they hold at most.
SAMPLE_ROWS, SAMPLE_NUMBERS = 20_000, 2_000_000
MOST_WORDS = 64
"""words of a codebook at most: a cell table of 4,096 rows"""
ROUNDS = 8
#: Numbers in one block of rows, and in one slice of anchors.
TASK_NUMBERS = 1 << 20
LEAST_BLOCK = 512
#: Rows of the cells that an anchor visits first.
FIRST_ROWS = 512
WANTED = 5
INFINITE = float("inf")


def integer_vectors(table: DataFrame, relabelled_by: int = 7, labels: int = 10) -> DataFrame:
    """(vec_id, label, x) of the rows that take part, x as floor(256 * component).

    Rows with a null vec_id, label or vector or with a null or non-finite component don't.
    Where ``relabelled_by`` divides vec_id, the label moves on by one, modulo ``labels``. Of
    rows that share a vec_id the smallest by label and vector stays.
    """
    label = F.col("label").cast("bigint")
    moved = F.when(F.col("vec_id") % relabelled_by == 0, (label + 1) % labels).otherwise(label)
    x = F.col("embedding").cast("array<double>")
    read = table.select(F.col("vec_id").cast("bigint").alias("vec_id"), moved.alias("label"), x.alias("x"))

    def floored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in in_pieces(batches):
            rows = []
            for vec_id, own, vector in zip(*(piece[c].to_pylist() for c in ("vec_id", "label", "x")), strict=True):
                if vec_id is None or own is None or vector is None or None in vector:
                    continue
                values = np.floor(256 * np.array(vector, float))
                if np.isfinite(values).all():
                    rows.append((vec_id, own, values.tolist()))
            yield _batch(rows, ("vec_id", "label", "x"), (pa.int64(), pa.int64(), pa.list_(pa.float64())))

    valid = read.mapInArrow(floored, "vec_id bigint, label bigint, x array<double>")
    one = F.min(F.struct("label", "x")).alias("one")
    return valid.groupBy("vec_id").agg(one).select("vec_id", "one.label", "one.x")


def _batch(rows: list[tuple], names: tuple[str, ...], kinds: tuple[pa.DataType, ...]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=list(names)
    )


def codebook(points: np.ndarray, words: int) -> np.ndarray:
    """``words`` centres of ``points`` (fewer if fewer points differ), by Lloyd's rounds."""
    points = np.unique(points, axis=0)
    chosen = np.random.default_rng(0).choice(len(points), min(words, len(points)), replace=False)
    centres = points[np.sort(chosen)]
    for _ in range(ROUNDS):
        near = nearest(points, centres)[0]
        for word in range(len(centres)):
            members = points[near == word]
            if len(members):
                centres[word] = members.mean(axis=0)
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every point the nearest centre and the distance from it."""
    squares = (centres**2).sum(axis=1) - 2 * points @ centres.T
    word = squares.argmin(axis=1)
    return word, np.linalg.norm(points - centres[word], axis=1)


def padded(vectors: list[list[float]], dims: int) -> np.ndarray:
    """A row per vector, shorter ones filled up with zeros."""
    out = np.zeros((len(vectors), dims))
    for row, vector in zip(out, vectors, strict=True):
        row[: len(vector)] = vector
    return out


def halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    middle = x.shape[-1] // 2
    return x[..., :middle], x[..., middle:]


@dataclass(frozen=True)
class Index:
    """The multi-index: rows in blocks of cells, and what is needed to walk the cells."""

    rows: DataFrame | None
    """block, cell, vec_id, label, x"""
    books: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    cells: dict[tuple[int, int], tuple[int, int, int]]
    """by cell: rows, first block, number of blocks"""
    dims: int

    def walk(self, x: np.ndarray) -> Iterator[tuple[float, tuple[int, int]]]:
        """The cells that hold rows, with their bounds, highest bound first."""
        orders, bounds = [], []
        for half, book, radius in zip(halves(x), self.books, self.radii, strict=True):
            bound = book @ half + np.linalg.norm(half) * radius
            order = np.argsort(-bound, kind="stable")
            orders.append(order.tolist())
            bounds.append(bound[order].tolist())
        heap = [(-(bounds[0][0] + bounds[1][0]), 0, 0)]
        while heap:
            less, i, j = heapq.heappop(heap)
            cell = (orders[0][i], orders[1][j])
            if cell in self.cells:
                yield -less + abs(less) * 1e-12 + 1e-3, cell  # not below for rounding
            # (i, j + 1) comes after (i, j); (i + 1, 0) after (i, 0): every pair once.
            if j + 1 < len(orders[1]):
                heapq.heappush(heap, (-(bounds[0][i] + bounds[1][j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(orders[0]):
                heapq.heappush(heap, (-(bounds[0][i + 1] + bounds[1][0]), i + 1, 0))


def build_index(vectors: DataFrame) -> Index | None:
    """The index over all rows of ``vectors`` (vec_id, label, x); None if there are none.

    The codebooks are learned on a bounded sample by a hash of the id, so they don't depend on
    how rows are dealt. The driver gets that sample and one row per cell. Shorter vectors
    count as filled up with zeros.
    """
    total, dims = vectors.agg(F.count("*"), F.max(F.size("x"))).first()
    if not total:
        return None
    dims = max(2, dims)
    wanted = min(SAMPLE_ROWS, SAMPLE_NUMBERS // dims)
    share = min(1.0, wanted / total)
    picked = vectors.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 40)) < int((1 << 40) * share))
    sample = [r.x for r in sorted(picked.select("vec_id", "x").collect(), key=lambda r: r.vec_id)]
    words = int(np.clip((total / 16) ** 0.5, 1, MOST_WORDS))
    points = padded(sample, dims) if sample else np.zeros((1, dims))
    books = tuple(codebook(half, words) for half in halves(points))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in in_pieces(batches):
            x = padded(piece["x"].to_pylist(), dims)
            (c0, d0), (c1, d1) = (nearest(half, book) for half, book in zip(halves(x), books, strict=True))
            added = [pa.array(c.astype(np.int32)) for c in (c0, c1)] + [pa.array(d) for d in (d0, d1)]
            yield pa.RecordBatch.from_arrays(
                [*piece.columns, *added], names=[*piece.schema.names, "c0", "c1", "d0", "d1"]
            )

    schema = "vec_id bigint, label bigint, x array<double>, c0 int, c1 int, d0 double, d1 double"
    coded = stage(vectors.select("vec_id", "label", "x").mapInArrow(placed, schema), "index-rows")
    # MOST_WORDS squared rows at most.
    sizes = coded.groupBy("c0", "c1").agg(
        F.count("*").alias("n"), F.max("d0").alias("d0"), F.max("d1").alias("d1")
    ).collect()
    radii = tuple(np.zeros(len(book)) for book in books)
    for row in sizes:
        radii[0][row.c0] = max(radii[0][row.c0], row.d0)
        radii[1][row.c1] = max(radii[1][row.c1], row.d1)
    cells = _packed(sizes, dims, total)
    table = coded.sparkSession.createDataFrame(
        [(*cell, first, many) for cell, (_, first, many) in cells.items()],
        "c0 int, c1 int, first int, many int",
    )
    block = F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("many")).cast("int")
    rows = coded.join(F.broadcast(table), ["c0", "c1"]).select(
        block.alias("block"), (F.col("c0") * MOST_WORDS + F.col("c1")).alias("cell"), "vec_id", "label", "x"
    )
    return Index(rows, books, radii, cells, dims)


def _packed(sizes: list, dims: int, total: int) -> dict[tuple[int, int], tuple[int, int, int]]:
    """Blocks of neighbouring cells; a cell larger than a block gets several of its own.

    A sixteenth of all rows makes a block, within bounds, so small tables are spread as well.
    """
    most = max(1, TASK_NUMBERS // dims)
    size = min(most, max(LEAST_BLOCK, total // 16))
    cells, block, held = {}, 0, 0
    for row in sorted(sizes, key=lambda r: (r.c0, r.c1)):
        many = -(-row.n // size)
        if held and held + row.n > size:
            block, held = block + 1, 0
        cells[row.c0, row.c1] = (row.n, block, many)
        held += row.n
        if many > 1:
            block, held = block + many, 0
    return cells


ASK = "anchor_id bigint, label bigint, x array<double>, lows array<double>, highs array<double>"
FOUND = "anchor_id bigint, nth int, score bigint, vec_id bigint"


def _visits(asks: DataFrame, index: Index, first: bool) -> DataFrame:
    """The blocks that an ask visits, with the cells there in the order of the heap.

    First those of the cells that hold ``FIRST_ROWS`` rows; then all others whose bound is not
    below the lowest end of the ask's windows.
    """
    walker = Index(None, index.books, index.radii, index.cells, index.dims)

    def planned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in in_pieces(batches):
            for ask in piece.to_pylist():
                floor, rows = min(ask["lows"]), 0
                blocks: dict[int, tuple[list, list]] = {}
                for bound, cell in walker.walk(padded([ask["x"]], walker.dims)[0]):
                    # What lies below is not wanted, whichever part it belongs to.
                    if bound < floor or (first and rows >= FIRST_ROWS):
                        break
                    n, start, many = walker.cells[cell]
                    before, rows = rows, rows + n
                    if (before < FIRST_ROWS) == first:
                        for block in range(start, start + many):
                            cells, bounds = blocks.setdefault(block, ([], []))
                            cells.append(cell[0] * MOST_WORDS + cell[1])
                            bounds.append(bound)
                values = [ask | {"block": b, "cells": c, "bounds": d} for b, (c, d) in blocks.items()]
                if values:
                    yield pa.RecordBatch.from_pylist(values, _shape(piece.schema))

    def _shape(schema: pa.Schema) -> pa.Schema:
        added = [("block", pa.int32()), ("cells", pa.list_(pa.int32())), ("bounds", pa.list_(pa.float64()))]
        return pa.schema([*schema, *(pa.field(*f) for f in added)])

    columns = ["anchor_id", "label", "x", "lows", "highs"]
    return asks.select(*columns).mapInArrow(planned, f"{ASK}, block int, cells array<int>, bounds array<double>")


def _searched(asks: DataFrame, index: Index, slices: int, same: bool, first: bool) -> DataFrame:
    """What the asks find in the blocks they visit, ``WANTED`` rows a window and block at most."""
    dims = index.dims
    found_columns = (
        ("anchor_id", "nth", "score", "vec_id"), (pa.int64(), pa.int32(), pa.int64(), pa.int64())
    )

    def searched(rows: pa.Table, visits: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, int]] = []
        if not rows.num_rows or not visits.num_rows:
            return pa.Table.from_batches([_batch(out, *found_columns)])
        cell = rows["cell"].to_numpy()
        order = np.argsort(cell, kind="stable")
        cell, ids = cell[order], rows["vec_id"].to_numpy()[order]
        labels = rows["label"].to_numpy()[order]
        x = padded(rows["x"].to_pylist(), dims)[order]
        starts = {int(c): int(at) for c, at in zip(*np.unique(cell, return_index=True), strict=True)}
        ends = {int(c): starts[int(c)] + int(n) for c, n in zip(*np.unique(cell, return_counts=True), strict=True)}
        for batch in visits.to_batches(max_chunksize=256):
            for ask in batch.to_pylist():
                own = padded([ask["x"]], dims)[0]
                lows, highs = list(ask["lows"]), ask["highs"]
                best: list[list[tuple[float, int]]] = [[] for _ in lows]
                for place, bound in zip(ask["cells"], ask["bounds"], strict=True):
                    if bound < min(lows):
                        break  # certified: nothing left reaches a window's end
                    if place not in starts:
                        continue
                    at = slice(starts[place], ends[place])
                    scores = x[at] @ own
                    fits = (labels[at] == ask["label"]) == same
                    if same:
                        fits &= ids[at] != ask["anchor_id"]
                    fits &= scores >= min(lows)
                    if not fits.any():
                        continue
                    near, names = scores[fits], ids[at][fits]
                    for k, (low, high) in enumerate(zip(lows, highs, strict=True)):
                        into = (near >= low) & (near <= high)
                        if not into.any():
                            continue
                        some, some_ids = near[into], names[into]
                        top = np.lexsort((some_ids, -some))[:WANTED]
                        new = [(-some[t], int(some_ids[t])) for t in top]
                        best[k] = sorted(best[k] + new)[:WANTED]
                        if len(best[k]) == WANTED:
                            lows[k] = max(low, -best[k][-1][0])
                for k, found in enumerate(best):
                    out += [(ask["anchor_id"], k, int(-less), vec_id) for less, vec_id in found]
        return pa.Table.from_batches([_batch(out, *found_columns)])

    slice_of = F.pmod(F.xxhash64("anchor_id"), F.lit(slices)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))
    rows = index.rows.withColumn("slice", every).groupBy("block", "slice")
    visits = _visits(asks, index, first).withColumn("slice", slice_of).groupBy("block", "slice")
    return rows.cogroup(visits).applyInArrow(searched, FOUND)


def _best(found: DataFrame) -> DataFrame:
    """The best ``WANTED`` rows of every window, numbered from 1."""
    window = Window.partitionBy("anchor_id", "nth").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= WANTED)


def search(asks: DataFrame, index: Index, slices: int, same: bool) -> DataFrame:
    """(anchor_id, nth, score, vec_id, rank): the best rows of each window of each ask.

    ``asks`` (``ASK``) name windows of scores, both ends included; ``same`` looks for rows of the
    ask's label other than itself, else rows of other labels count.
    """
    early = stage(_best(_searched(asks, index, slices, same, True)), "early")
    full = early.where(F.col("rank") == WANTED).select(
        "anchor_id", F.struct("nth", F.col("score").cast("double").alias("score")).alias("end")
    )
    ends = full.groupBy("anchor_id").agg(F.collect_list("end").alias("ends"))  # a few windows each

    def raised(low, k):
        known = F.transform(F.filter("ends", lambda e: e["nth"] == k), lambda e: e["score"])
        return F.greatest(low, F.try_element_at(known, F.lit(1)))  # nulls are passed over

    higher = F.when(F.col("ends").isNull(), F.col("lows")).otherwise(F.transform("lows", raised))
    after = stage(asks.join(ends, "anchor_id", "left").withColumn("lows", higher).drop("ends"), "asks")
    late = _searched(after, index, slices, same, False)
    return stage(_best(early.drop("rank").unionByName(late)), "best")


def mine(
    table: DataFrame, anchors_by: int = 100, relabelled_by: int = 7, least: int = 80, of: int = 100
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from (vec_id, embedding, label).

    Anchors are the rows whose vec_id ``anchors_by`` divides; an anchor's positives its first five
    other rows of its label; negatives of a pair the first five rows of other labels with
    least * positive <= of * score <= of * positive. Rows go by score, highest first, ties by
    vec_id. Which rows take part: see ``integer_vectors``. Pairs without negatives (also
    those with a negative score, whose window is empty) and an empty table give no rows; further
    columns are left out.
    """
    spark = table.sparkSession
    schema = (
        "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
        "positive_score bigint, negative_score bigint"
    )
    vectors = stage(integer_vectors(table, relabelled_by), "vectors")
    index = build_index(vectors)
    if index is None:
        return spark.createDataFrame([], schema)
    anchors = vectors.where(F.col("vec_id") % anchors_by == 0).withColumnRenamed("vec_id", "anchor_id")
    anchors = stage(anchors, "anchors")
    slices = max(1, -(-anchors.count() * index.dims // TASK_NUMBERS))
    ends = {"lows": F.array(F.lit(-INFINITE)), "highs": F.array(F.lit(INFINITE))}
    positives = search(anchors.withColumns(ends), index, slices, same=True)
    positives = positives.select(
        "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
        (F.col("rank") - 1).alias("nth"),
    )

    def lowest(p):
        # The least whole number that fits; windows that hold none want nothing.
        low = F.ceil(p["positive_score"] * least / F.lit(of)).cast("double")
        return F.when(low <= p["positive_score"], low).otherwise(F.lit(INFINITE))

    windows = (
        positives.groupBy("anchor_id")
        .agg(F.array_sort(F.collect_list(F.struct("nth", "positive_score"))).alias("p"))  # five at most
        .withColumn("lows", F.transform("p", lowest))
        .withColumn("highs", F.transform("p", lambda p: p["positive_score"].cast("double")))
        .drop("p")
    )
    negatives = search(anchors.join(windows, "anchor_id"), index, slices, same=False)
    return negatives.join(positives, ["anchor_id", "nth"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )
