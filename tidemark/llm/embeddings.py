"""Near-duplicate embeddings by PCA-ordered, tiled comparison.

Vectors are scaled to unit length and turned into the axes of their principal components, the largest
first.  Two unit vectors with cosine t differ by sqrt(2 - 2t) at most along any axis, so vectors are
laid into cells of that width along the first axes, and only neighbouring cells meet.  A cell is cut
into blocks of bounded size; each pair of blocks is a task of its own.  Inside it the products of the
leading components are summed first; what the rest can add is bounded by the product of the norms of
the rest (Cauchy-Schwarz), and pairs that cannot reach the threshold are dropped before the next
components are read.  Survivors are confirmed on the given vectors in double precision.

Equal vectors are folded into one, with their number, before any comparison.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import components
from tidemark.operators.materialise import cut_lineage

THRESHOLD = 0.98
#: Vectors per block; two blocks and their products fit a task (2048 x 2048 doubles).
BLOCK = 2048
#: Axes that cells are laid along, and components added per step of the comparison.
CELL_AXES = 2
STEP = 16
#: Rounding allowed before a pair is confirmed.
SLACK = 1e-9


def covariance(vectors: DataFrame) -> np.ndarray | None:
    """Mean product matrix of all unit vectors, summed inside the tasks; d * d numbers reach the driver.

    Only vectors of the most frequent dimension are turned; there is one in a well-formed table.
    """

    def work(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for unit in _unit_groups(batch.column("embedding").to_pylist()):
                d = unit.shape[1]
                sums[d] = sums.get(d, 0) + unit.T @ unit
        for d, total in sums.items():
            # The upper triangle by rows keeps each message small.
            for i in range(d):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d] * d, pa.int32()), pa.array([i] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array(total[i])],
                    names=["d", "i", "j", "x"],
                )

    rows = (
        vectors.select("embedding").mapInArrow(work, "d int, i int, j int, x double")
        .groupBy("d", "i", "j").agg(F.sum("x").alias("x")).collect()
    )
    return {d: _square([r for r in rows if r["d"] == d], d) for d in {r["d"] for r in rows}}


def _square(rows, d: int) -> np.ndarray:
    out = np.zeros((d, d))
    for r in rows:
        out[r["i"], r["j"]] = r["x"]
    return (out + out.T) / 2


def _unit_groups(values: list) -> list[np.ndarray]:
    """Unit vectors, one matrix per dimension."""
    by_size: dict[int, list] = {}
    for v in values:
        by_size.setdefault(len(v), []).append(v)
    return [_unit(np.array(v, np.float64)) for v in by_size.values()]


def _unit(matrix: np.ndarray) -> np.ndarray:
    # The largest component first, so that squares neither overflow nor vanish.
    matrix = matrix / np.abs(matrix).max(1, keepdims=True)
    return matrix / np.sqrt((matrix * matrix).sum(1, keepdims=True))


def axes_of(square: np.ndarray) -> np.ndarray:
    """Columns are the principal axes, the one with the largest share first."""
    values, vectors = np.linalg.eigh(square)
    return vectors[:, np.argsort(-values, kind="stable")]


def close_pairs(left: np.ndarray, right: np.ndarray, threshold: float, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that may reach the threshold, for unit rows in PCA order.

    Sums ``step`` components at a time; a pair is left out once its sum plus the product of the norms
    of what remains is below the threshold.
    """
    d = left.shape[1]

    def rest(m: np.ndarray) -> np.ndarray:
        squares = np.cumsum((m * m)[:, ::-1], 1)[:, ::-1]
        return np.sqrt(np.hstack([squares, np.zeros((len(m), 1))]))

    rest_left, rest_right = rest(left), rest(right)
    at = min(step, d)
    partial = left[:, :at] @ right[:, :at].T
    i, j = np.nonzero(partial + np.outer(rest_left[:, at], rest_right[:, at]) >= threshold - SLACK)
    partial = partial[i, j]
    while at < d and len(i):
        end = min(at + step, d)
        # Row by row of what is left; bounded pieces keep the memory flat.
        for low in range(0, len(i), 1 << 18):
            part = slice(low, low + (1 << 18))
            partial[part] += np.einsum("nk,nk->n", left[i[part], at:end], right[j[part], at:end])
        at = end
        stay = partial + rest_left[i, at] * rest_right[j, at] >= threshold - SLACK
        i, j, partial = i[stay], j[stay], partial[stay]
    return i, j


def _compare(threshold: float, axes: dict[int, np.ndarray]):
    def work(key, table):
        side = table.column("side").to_numpy()
        node, weight = table.column("node").to_numpy(), table.column("weight").to_numpy()
        raw = np.array(table.column("embedding").to_pylist(), np.float64)
        unit = _unit(raw)
        turned = unit @ axes[raw.shape[1]]
        a, b = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        i, j = close_pairs(turned[a], turned[b], threshold)
        i, j = a[i], b[j]
        use = (side[i] != 2) | (i < j)  # inside one block each pair once
        i, j = i[use], j[use]
        cosine = np.empty(len(i))
        for low in range(0, len(i), 1 << 18):
            part = slice(low, low + (1 << 18))
            x, y = raw[i[part]], raw[j[part]]
            cosine[part] = (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))
        i, j = i[cosine >= threshold], j[cosine >= threshold]
        links = np.bincount(i, weight[j], len(node)) + np.bincount(j, weight[i], len(node))
        # The smallest node that links of this task reach stands for them: a star, not all pairs.
        root = node.copy()
        while True:
            low = root.copy()
            np.minimum.at(low, i, root[j])
            np.minimum.at(low, j, root[i])
            if (low == root).all():
                break
            root = low
        some = np.flatnonzero(links)
        return pa.table({"node": node[some], "links": links[some].astype(np.int64), "root": root[some]})

    return work


def _cells(axes: dict[int, np.ndarray], width: float, count: int):
    """Adds the cell (label aside) of each vector: its place along the first axes."""

    def work(batches):
        for batch in batches:
            values = batch.column("embedding").to_pylist()
            cells = np.zeros((len(values), count), np.int32)
            for d in {len(v) for v in values}:
                own = [k for k, v in enumerate(values) if len(v) == d]
                turned = _unit(np.array([values[k] for k in own], np.float64)) @ axes[d][:, :count]
                cells[own, : turned.shape[1]] = np.floor((turned + 1) / width).astype(np.int32)
            columns = [*batch.columns, *[pa.array(cells[:, k]) for k in range(count)]]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *[f"cell_{k}" for k in range(count)]])

    return work


def near_duplicate_vectors(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Vectors with equal, non-null labels and dimension are linked when their cosine, in double
    precision, is at least ``threshold``.  ``n_links`` counts the other vectors linked directly,
    ``component_id`` is the smallest vec_id that links reach, ``kept`` marks it.  Vectors that are
    null, empty, all zero or hold null or non-finite components, and rows without label, link with
    nothing; so do rows without vec_id, whose component is null and which are kept.
    """
    every = cut_lineage(vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    ))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    valid = every.filter(
        "vec_id is not null and label is not null and size(embedding) > 0"
    ).filter(F.forall("embedding", finite) & F.exists("embedding", lambda x: x != 0))
    groups = cut_lineage(
        valid.groupBy("label", "embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"))
    )
    squares = covariance(groups)
    axes = {d: axes_of(s) for d, s in squares.items()}
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept")
    if not axes:
        return every.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    width = float(np.sqrt(2 - 2 * threshold)) + SLACK
    names = [f"cell_{k}" for k in range(CELL_AXES)]
    celled = groups.select("label", "node", "weight", "embedding", F.size("embedding").alias("d")).mapInArrow(
        _cells(axes, width, CELL_AXES),
        f"label {dict(groups.dtypes)['label']}, node bigint, weight bigint, embedding array<double>, d int, "
        + ", ".join(f"{n} int" for n in names),
    )
    celled = cut_lineage(celled)
    cell = ["label", "d", *names]
    sizes = cut_lineage(celled.groupBy(*cell).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")))
    # Each cell meets itself and the half of its neighbours that come after it, so each pair of cells once.
    offsets = [o for o in itertools.product((-1, 0, 1), repeat=CELL_AXES) if o >= (0,) * CELL_AXES]
    shift = F.explode(F.array(*[F.struct(*[F.lit(x).alias(n) for x, n in zip(o, names)]) for o in offsets])).alias("o")
    own = sizes.select(*cell, F.col("blocks").alias("own_blocks"))
    met = (
        own.select(*cell, "own_blocks", shift)
        .select("label", "d", *[F.col(n).alias(f"own_{n}") for n in names], "own_blocks", *[(F.col(n) + F.col(f"o.{n}")).alias(n) for n in names])
        .join(sizes, cell)
    )
    same = F.lit(True)
    for n in names:
        same = same & (F.col(n) == F.col(f"own_{n}"))
    # All pairs of blocks of two cells; inside one cell those with the first block not after the second.
    tasks = (
        met.withColumn("a", F.explode(F.sequence(F.lit(0), F.col("own_blocks") - 1)))
        .withColumn("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("same", same).filter(~F.col("same") | (F.col("a") <= F.col("b")))
        .withColumn("task", F.xxhash64("label", "d", *[f"own_{n}" for n in names], *names, "a", "b"))
    )
    tasks = cut_lineage(tasks)
    both = F.col("same") & (F.col("a") == F.col("b"))
    left = tasks.select("label", "d", *[F.col(f"own_{n}").alias(n) for n in names], F.col("a").alias("block"), "task", F.when(both, 2).otherwise(0).alias("side"))
    right = tasks.filter(~both).select("label", "d", *names, F.col("b").alias("block"), "task", F.lit(1).alias("side"))
    seats = cut_lineage(left.union(right))
    placed = celled.join(sizes, cell).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks").cast("bigint")).cast("int"))
    dealt = cut_lineage(placed.drop("blocks")).join(seats, [*cell, "block"]).select("task", "side", "node", "weight", "embedding")
    found = cut_lineage(
        dealt.groupBy("task").applyInArrow(_compare(threshold, axes), "node bigint, links bigint, root bigint")
    )
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    edges = found.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")).distinct()
    judged = groups.join(links, "node", "left")
    if edges.isEmpty():
        judged = judged.withColumn("low", F.col("node"))
    else:
        judged = judged.join(components(edges).withColumnRenamed("label", "low"), "node", "left").withColumn(
            "low", F.coalesce("low", "node"))
    judged = cut_lineage(judged.select(
        "label", "embedding", "low", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    ))
    rest = every.join(judged, ["label", "embedding"], "left")
    known = F.col("vec_id").isNotNull()
    return rest.select(
        "vec_id", F.when(known, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("bigint").alias("n_links"),
        F.when(known, F.coalesce("low", "vec_id")).alias("component_id"),
    ).select("vec_id", "n_links", "component_id", kept)
