"""Embedding near-duplicates: spherical k-means cells, blocked cosine products, linked groups.

Equal vectors are first merged into a class with its smallest id. Centres are fitted on a bounded sample
(``SAMPLE`` classes by hash); every class has its nearest cell as home, and a cell's radius is the largest angle of a class at home
there. A cell is cut by hash into blocks of about ``BLOCK`` classes, each packed into one row of a written table, which is all that is ever
stored of the vectors: nothing is copied per visit. Every two blocks whose cells can hold a link of each other meet in one row of a nested loop, whose
tasks read two parts of that table each, and give one product of matrices in double precision; so disk grows with the table, a task holds two parts, and a hot
cell is many small products. A product gives per class the number of links and the first class of its linked set, never a row per pair.

With ``a = acos(threshold)``, a class can have a link in another cell only if that cell's centre is within the cell's radius plus ``a``, and it has no
more than ``a`` to that cell's side of the great circle between the two centres. By the triangle inequality on angles no link is lost,
whatever the number of cells and however spread the vectors are. A block reaches the cells that any of its classes can, and a product leaves out the classes of
either block that cannot reach the other cell.

Links are exact (cosine of at least ``threshold`` in double precision). Vectors without any clusters visit most cells, and
the work then nears that of all pairs.

Defined results: a vector that is null, empty, zero, or holds null or non-finite components links with nothing and is kept;
so is a row with a null id. Vectors of different lengths never link. Equal vectors link with each other; rows with
the same id and vector are one vector. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import in_small_batches
from broadsheet.llm.components import components
from broadsheet.session import cut

SAMPLE, BLOCK = 20_000, 1_000
#: Slack of angles, far above rounding.
_SLACK = 1e-6
#: Blocks in a written file, and blocks whose unit vectors a worker keeps.
_PER_FILE, _KEPT = 16, 64


def fit_centres(vectors: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means on unit rows: directions of the cell sums; an empty cell takes the worst served row."""
    centres = vectors[np.linspace(0, len(vectors) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = vectors @ centres.T
        cell, best = near.argmax(axis=1), near.max(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, vectors)
        empty = np.flatnonzero(np.bincount(cell, minlength=k) == 0)
        sums[empty] = vectors[np.argsort(best)[: len(empty)]]
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 0, sums / np.where(norms > 0, norms, 1), centres)
    return centres


def _units(column: pa.Array, dims: int) -> np.ndarray:
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    return unit_rows(rows)


def unit_rows(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by their largest component first, so squares of huge or tiny ones stay finite."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _homes(classes: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """dims, home, angle, id, n, v: the nearest cell of every class and the angle to its centre."""
    shared = classes.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(2).value_lengths().to_numpy()
            for dims in np.unique(lengths):
                part = batch.filter(pa.array(lengths == dims))
                known = shared.value.get(int(dims))
                rows = part.num_rows
                home, angle = np.zeros(rows, dtype=np.int32), np.zeros(rows)
                if known is not None:  # a length too rare for the sample has one cell
                    units = _units(part.column(2), int(dims))
                    for at in range(0, rows, 500):
                        near = units[at : at + 500] @ known.T
                        home[at : at + 500] = near.argmax(axis=1)
                        angle[at : at + 500] = np.arccos(np.clip(near.max(axis=1), -1, 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(rows, dims, dtype=np.int32)), pa.array(home), pa.array(angle), part.column(0), part.column(1), part.column(2)],
                    ["dims", "home", "angle", "id", "n", "v"],
                )

    return classes.select("id", "n", "embedding").mapInArrow(run, f"dims int, home int, angle double, id long, n long, v {dict(classes.dtypes)['embedding']}")


def reaching(units: np.ndarray, own: np.ndarray, others: np.ndarray, radii: np.ndarray, threshold: float) -> np.ndarray:
    """Whether each row (of the cell with centre ``own``) may have a link in each of the cells with centres ``others`` and ``radii``."""
    most = np.arccos(np.clip(threshold, -1, 1)) + _SLACK
    near = units @ others.T
    apart = np.linalg.norm(others - own, axis=1)
    side = np.where((apart < 1e-6) | (most >= np.pi / 2), np.inf, np.sin(min(most, np.pi / 2)) * apart)
    least = np.where(radii < 0, 2, np.cos(np.minimum(np.pi, radii + most)))
    return (near >= least) & ((units @ own)[:, None] - near <= side)


def _packed(homes: DataFrame, centres: dict[int, np.ndarray], radii: dict[int, np.ndarray], threshold: float, block: int) -> DataFrame:
    """One row per block: dims, cell, part, the later cells it reaches, and ids, weights and vectors as plain bytes."""
    sizes = homes.groupBy("dims", "home").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("_parts"))
    # One row per cell, of which there are as many as centres (under SAMPLE).
    dealt = homes.join(F.broadcast(sizes), ["dims", "home"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("_parts")).cast("int"))
    shared = homes.sparkSession.sparkContext.broadcast((centres, radii))
    single = dict(homes.dtypes)["v"] == "array<float>"

    def pack(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        dims, cell = table["dims"][0].as_py(), table["home"][0].as_py()
        rows = table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float32 if single else np.float64)
        known, reach = shared.value[0].get(dims), []
        if known is not None:
            units = unit_rows(rows.reshape(-1, dims).astype(np.float64))
            later = np.arange(cell + 1, len(known))
            reach = later[reaching(units, known[cell], known[later], shared.value[1][dims][later], threshold).any(axis=0)].tolist()
        return pa.table({
            "dims": pa.array([dims], pa.int32()), "cell": pa.array([cell], pa.int32()), "part": pa.array([table["part"][0].as_py()], pa.int32()),
            "reach": pa.array([reach], pa.list_(pa.int32())), "ids": pa.array([table["id"].to_numpy().tobytes()], pa.binary()),
            "ns": pa.array([table["n"].to_numpy().tobytes()], pa.binary()), "v": pa.array([rows.tobytes()], pa.binary()),
        })

    return dealt.select("dims", "home", "part", "id", "n", "v").groupBy("dims", "home", "part").applyInArrow(
        pack, "dims int, cell int, part int, reach array<int>, ids binary, ns binary, v binary"
    )


def linked_rows(links: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of weights linked to and first row of the linked set per row; ``links`` is symmetric."""
    first, rest = np.arange(len(links)), links.any(axis=1)
    for seed in np.flatnonzero(rest):
        if not rest[seed]:
            continue
        front, rest[seed] = np.array([seed]), False
        while len(front):
            front = np.flatnonzero(links[front].any(axis=0) & rest)
            rest[front] = False
            first[front] = seed
    return links @ weights, first


def _products(blocks: DataFrame, centres: dict[int, np.ndarray], radii: dict[int, np.ndarray], threshold: float, single: bool) -> DataFrame:
    """id, links, first: partial link counts and spanning links of every pair of blocks that may hold a link."""
    shared = blocks.sparkSession.sparkContext.broadcast((centres, radii))
    names = ["dims", "cell", "part", "ids", "ns", "v"]
    left = blocks.select("reach", *[F.col(c).alias(f"a_{c}") for c in names])
    right = blocks.select(*[F.col(c).alias(f"b_{c}") for c in names])
    # No equal key, which would gather a cell's blocks: every task pairs one part of the table with another.
    same = (F.col("a_cell") <= F.col("b_cell")) & (F.col("a_cell") >= F.col("b_cell")) & (F.col("a_part") <= F.col("b_part"))
    meet = (F.col("a_dims") <= F.col("b_dims")) & (F.col("a_dims") >= F.col("b_dims")) & (same | F.array_contains("reach", F.col("b_cell")))
    paired = left.join(right.hint("shuffle_replicate_nl"), meet).drop("reach", "b_dims")
    kind = np.float32 if single else np.float64

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, reach = shared.value
        kept: dict[tuple, np.ndarray] = {}

        def units_of(row: dict, side: str) -> np.ndarray:
            key = (row["a_dims"], row[f"{side}_cell"], row[f"{side}_part"])
            if key not in kept:
                if len(kept) >= _KEPT:
                    kept.clear()
                kept[key] = unit_rows(np.frombuffer(row[f"{side}_v"].as_buffer(), kind).reshape(-1, row["a_dims"]).astype(np.float64))
            return kept[key]

        for batch in batches:
            held = {c: batch.column(c) for c in batch.schema.names}
            for i in range(batch.num_rows):
                row = {c: column[i] if c[2:] in ("ids", "ns", "v") else column[i].as_py() for c, column in held.items()}
                one, two = units_of(row, "a"), units_of(row, "b")
                ids, weights = ([np.frombuffer(row[f"{side}_{c}"].as_buffer(), np.int64) for side in "ab"] for c in ("ids", "ns"))
                if (row["a_cell"], row["a_part"]) == (row["b_cell"], row["b_part"]):
                    links, ids, weights = one @ one.T >= threshold, ids[0], weights[0]
                    np.fill_diagonal(links, False)
                else:
                    a, b = np.arange(len(one)), np.arange(len(two))
                    if row["a_cell"] != row["b_cell"]:
                        cells, bounds = known[row["a_dims"]], reach[row["a_dims"]]
                        to, back = slice(row["b_cell"], row["b_cell"] + 1), slice(row["a_cell"], row["a_cell"] + 1)
                        a = np.flatnonzero(reaching(one, cells[row["a_cell"]], cells[to], bounds[to], threshold))
                        b = np.flatnonzero(reaching(two, cells[row["b_cell"]], cells[back], bounds[back], threshold))
                    across = (one[a] @ two[b].T) >= threshold
                    rows, columns = across.any(axis=1), across.any(axis=0)
                    if not rows.any():
                        continue
                    n, across = rows.sum(), across[np.ix_(rows, columns)]
                    links = np.zeros((n + columns.sum(),) * 2, dtype=bool)
                    links[:n, n:], links[n:, :n] = across, across.T
                    ids, weights = (np.concatenate([x[a[rows]], y[b[columns]]]) for x, y in (ids, weights))
                counts, first = linked_rows(links, weights)
                some = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(counts[some]), pa.array(ids[first[some]])], ["id", "links", "first"])

    return paired.mapInArrow(product, "id long, links long, first long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, block: int = BLOCK, sample: int = SAMPLE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    # Components keep their precision: floats stay floats on the way, all others are doubles; products are in doubles.
    kind = "array<float>" if dict(vectors.dtypes)["embedding"] == "array<float>" else "array<double>"
    source = in_small_batches(vectors).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"))
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    nonzero = F.exists("embedding", lambda x: x != 0)
    valid = F.coalesce(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & finite & nonzero, F.lit(False))
    good = source.filter(valid)
    classes = cut(
        good.distinct().groupBy("embedding").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n")), "classes"
    )
    n_classes = classes.count()
    centres: dict[int, np.ndarray] = {}
    picked = classes.orderBy(F.xxhash64("id"), "id").limit(sample).select("embedding").toPandas()["embedding"].tolist()
    by_length: dict[int, list] = {}
    for v in picked:
        by_length.setdefault(len(v), []).append(v)
    for dims, members in by_length.items():
        rows = np.array(members, dtype=np.float64)
        k = max(1, min(int(np.ceil(np.sqrt(n_classes * len(rows) / len(picked)))), len(rows) // 5))
        centres[dims] = fit_centres(unit_rows(rows), k)
    homes = cut(_homes(classes, centres), "homes")
    radii = {dims: np.full(len(c), -10.0) for dims, c in centres.items()}  # nothing visits a cell without classes
    for r in homes.groupBy("dims", "home").agg(F.max("angle").alias("radius")).collect():
        if r["dims"] in radii:
            radii[r["dims"]][r["home"]] = r["radius"]
    most = n_classes // block + sum(len(c) for c in centres.values()) + 1
    blocks = cut(_packed(homes, centres, radii, threshold, block).repartition(-(-most // _PER_FILE)), "blocks")
    found = cut(_products(blocks, centres, radii, threshold, kind == "array<float>"), "links")
    counted = found.groupBy("id").agg(F.sum("links").alias("_links")).withColumnRenamed("id", "_id")
    linked = components(found.filter("id <> first"), "id", "first")
    known = (
        classes.join(counted, F.col("id") == F.col("_id"), "left").join(linked, F.col("id") == F.col("node"), "left")
        .select(
            F.col("embedding").alias("_embedding"),
            (F.coalesce("_links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"),
        )
    )
    judged = good.join(known, F.col("embedding") == F.col("_embedding")).select("vec_id", "n_links", "component_id")
    alone = source.filter(~valid).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return judged.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
