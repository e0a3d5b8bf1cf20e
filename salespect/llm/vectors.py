"""Near-duplicate vectors by spherical k-means cells and blocked cosine products.

1. Equal vectors are one class, keyed by a hash of their bytes, so copies are
   compared once and counted by weight.
2. Spherical k-means is fitted on at most SAMPLE different vectors taken by
   hash; there are about 2 * sqrt(classes) cells. Every class is indexed: it
   lives in its nearest cell and visits the cells whose border is close. The
   borders of two cells' centres are planes; two linked vectors on both sides
   of one are at most 2 * sin(angle / 2) apart, so one of them is within
   sin(angle / 2) of the plane and visiting that far finds every link. Along
   a given direction few differences are as long as that where they spread
   over many dimensions: there SPREAD standard deviations are visited.
3. A cell is cut into blocks of BLOCK members by hash; every pair of blocks is
   a task of its own, so a cell that holds most rows is spread. Products run in
   single precision with a margin, and pairs above it are measured again in
   double precision. A pair that meets in two cells counts in one, by rule.
4. A block pair gives link counts per class and a spanning forest of its
   links, never the pairs themselves; components follow from the forests.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salespect.functions.staging import staged
from salespect.llm.components import connected_components

SAMPLE = 60_000  # most vectors k-means is fitted on
MOST_CELLS = 20_000
BLOCK = 2048
SPREAD = 4.0  # deviations of a link's difference along one direction that visits cover
ROUNDS = 8
_SLACK = 1e-4


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = np.asarray(vectors, float)
    with np.errstate(over="ignore"):
        vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True).clip(1e-300)
        return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def spherical_kmeans(vectors: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centres. Starts from evenly spaced rows; an empty cell keeps its centre."""
    vectors = vectors.astype(np.float32)
    centres = vectors[np.linspace(0, len(vectors) - 1, cells).astype(int)].copy()
    for _ in range(rounds):
        nearest = np.concatenate([np.argmax(vectors[a : a + 4096] @ centres.T, axis=1) for a in range(0, len(vectors), 4096)])
        order = np.argsort(nearest, kind="stable")
        kinds, first = np.unique(nearest[order], return_index=True)
        sums = np.add.reduceat(vectors[order], first, axis=0)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres[kinds] = np.where(norms > 1e-6, sums / np.maximum(norms, 1e-6), centres[kinds])
    return centres


def _vectors(batches):
    """Rows with a usable vector get its bytes as doubles; others null."""
    for batch in batches:
        out = []
        for vector in batch.column(1):
            values = vector.values.to_numpy(zero_copy_only=False).astype("<f8") if vector.is_valid else np.zeros(0)
            out.append((values + 0.0).tobytes() if len(values) and np.isfinite(values).all() and values.any() else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["id", "data"])


def _matrix(column) -> np.ndarray:
    rows = [np.frombuffer(x, "<f8") for x in column]
    return np.stack(rows) if rows else np.zeros((0, 1))


def directions(vectors: np.ndarray, centres: np.ndarray) -> float:
    """In how many dimensions vectors spread around their centres: the participation ratio, 1 to their width."""
    part = vectors[:: max(1, len(vectors) // 10_000)]
    apart = part - centres[(part.astype(np.float32) @ centres.T).argmax(axis=1)]
    power = np.linalg.svd(apart - apart.mean(axis=0), compute_uv=False) ** 2
    return float(power.sum() ** 2 / (power**2).sum()) if power.sum() > 1e-12 else 1.0


def visit_reach(least: float, dimensions: float, exact: bool) -> float:
    """How far from a border between cells a vector visits the other cell."""
    return float(np.sqrt(max(0.0, 1 - least) / 2)) * (1.0 if exact else min(1.0, SPREAD / dimensions**0.5))


def _visits(batches, centres, reach: float):
    """Per class and cell: key, cell, its home, all cells it visits."""
    fixed = centres.value
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            data = part.column("data").to_pylist()
            cosine = np.clip(unit(_matrix(data)).astype(np.float32) @ fixed.T, -1, 1)
            home = cosine.argmax(axis=1)
            # The distance to a border is the difference of the cosines over that of the centres.
            apart = np.sqrt(np.clip(2 - 2 * (fixed[home] @ fixed.T), 0, None))
            nearest = cosine[np.arange(len(data)), home][:, None]
            row, cell = np.nonzero((nearest - cosine <= reach * apart + _SLACK) | (np.arange(len(fixed)) == home[:, None]))
            visits = np.split(cell, np.flatnonzero(np.diff(row)) + 1)
            yield pa.RecordBatch.from_arrays(
                [part.column("key").take(pa.array(row)), part.column("weight").take(pa.array(row)), part.column("data").take(pa.array(row)), pa.array(cell.astype(np.int32)), pa.array(home[row].astype(np.int32)), pa.array([visits[r].astype(np.int32) for r in row], pa.list_(pa.int32()))],
                ["key", "weight", "data", "cell", "home", "visits"],
            )


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the links join two trees when taken in order."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = up = parent.get(up, up)
            x = up
        return x

    keep = np.zeros(len(a), bool)
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        x, y = root(x), root(y)
        if x != y:
            parent[x] = y
            keep[k] = True
    return keep


def _near(x: np.ndarray, y: np.ndarray, rows: np.ndarray, here_x: np.ndarray, here_y: np.ndarray, least: float):
    """Pairs of single precision cosine near enough; two visitors are not compared."""
    live, guest, hosts = rows[here_x[rows]], rows[~here_x[rows]], np.flatnonzero(here_y)
    i, j = np.nonzero(x[live] @ y.T >= least - _SLACK)
    k, m = np.nonzero(x[guest] @ y[hosts].T >= least - _SLACK)
    return np.concatenate((live[i], guest[k])), np.concatenate((j, hosts[m]))


def _compared(key, frame: pd.DataFrame, least: float) -> pd.DataFrame:
    """Links of one pair of blocks of a cell: rows (a, null, copies linked to a) and forest rows (a, b, 0)."""
    cell, low, high = key[0], key[1], key[2]
    frame = frame.sort_values("key", kind="stable")
    left, right = frame[frame["block"] == low], frame[frame["block"] == high]
    x, y = unit(_matrix(left["data"])), unit(_matrix(right["data"])) if low != high else None
    y = x if y is None else y
    visited = [set(v) for v in right["visits"]]
    visited_left = [set(v) for v in left["visits"]]
    names_x, names_y = left["key"].to_numpy(), right["key"].to_numpy()
    home_x, home_y = left["home"].to_numpy(), right["home"].to_numpy()
    weight_x, weight_y = left["weight"].to_numpy(), right["weight"].to_numpy()
    here_x, here_y = home_x == cell, home_y == cell
    count_x, count_y = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
    x32, y32, kept = x.astype(np.float32), y.astype(np.float32), []
    for at in range(0, len(x), 256):
        i, j = _near(x32, y32, np.arange(at, min(at + 256, len(x))), here_x, here_y, least)
        if low == high:
            i, j = i[i < j], j[i < j]
        # A pair of different homes can meet in both; the smaller of the two cells has it.
        mixed = np.flatnonzero(home_x[i] != home_y[j])
        drop = np.zeros(len(i), bool)
        for k in mixed:
            other, guest_visits = (home_y[j[k]], visited_left[i[k]]) if here_x[i[k]] else (home_x[i[k]], visited[j[k]])
            # The partner that lives here must also visit the other's home for the pair to meet there.
            drop[k] = other < cell and other in guest_visits
        i, j = i[~drop], j[~drop]
        exact = np.einsum("nd,nd->n", x[i], y[j]) >= least
        i, j = i[exact], j[exact]
        np.add.at(count_x, i, weight_y[j])
        np.add.at(count_y, j, weight_x[i])
        tree = _forest(names_x[i], names_y[j])
        kept.append(np.stack((names_x[i][tree], names_y[j][tree])))
    links = np.concatenate(kept, axis=1) if kept else np.zeros((2, 0), np.int64)
    links = links[:, _forest(*links)]
    some_x, some_y = count_x > 0, count_y > 0
    a = np.concatenate((names_x[some_x], names_y[some_y], links[0]))
    n = np.concatenate((count_x[some_x], count_y[some_y], np.zeros(links.shape[1], np.int64)))
    b = pd.array(np.concatenate((names_x[some_x], names_y[some_y], links[1])), dtype="Int64")
    b[: len(a) - links.shape[1]] = pd.NA
    return pd.DataFrame({"a": a, "b": b, "n": n})


def near_vectors(table: DataFrame, least: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding", exact: bool = False) -> DataFrame:
    """One row per row of table: (id, n_links, component_id, kept).

    exact visits so far that no link can be lost; else that holds where vectors
    spread over at most SPREAD ** 2 dimensions, and nearly so over more.
    n_links counts the other rows linked directly, component_id is the smallest
    id reachable. Vectors that are null, empty, zero or hold null or non-finite
    components link with nothing, nor do vectors of different widths. A null id
    is a row of its own with a null component, not kept. An empty table gives
    an empty result; other columns are ignored.
    """
    spark = table.sparkSession
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    read = rows.mapInArrow(_vectors, "id long, data binary")
    vectors = staged(read.withColumn("key", F.xxhash64("data")).withColumn("other", F.xxhash64("data", F.lit(1))), "vectors")
    good = vectors.where("data is not null")
    grouped = good.groupBy("key").agg(F.count("*").alias("weight"), F.min("id").alias("least"), F.min("other").alias("o"), F.max("other").alias("p"), F.first("data").alias("data"))
    classes = staged(grouped, "vector-classes")
    if classes.where("o <> p").limit(1).count():
        raise ValueError("two different vectors share a 64-bit key")
    parts = []
    for row in classes.groupBy(F.octet_length("data").alias("width")).count().collect():  # one per width of vectors
        same = classes.where(F.octet_length("data") == row["width"])
        parts.append(_links(same, row["count"], least, exact))
    if parts:
        found = parts[0]
        for more in parts[1:]:
            found = found.unionByName(more)
        found = staged(found, "vector-links")
    else:
        found = spark.createDataFrame([], "a long, b long, n long")
    counts = found.groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("links"))
    component = connected_components(found.where("b is not null").select("a", "b"))
    named = classes.join(component.withColumnRenamed("node", "key"), "key", "left").withColumn("c", F.coalesce("component", "key"))
    smallest = named.groupBy("c").agg(F.min("least").alias("component_id"))
    facts = named.join(smallest, "c").join(counts, "key", "left").select("key", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    linked = good.select("id", "key").join(facts, "key").select("id", "n_links", "component_id")
    alone = vectors.where("data is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def _links(classes: DataFrame, count: int, least: float, exact: bool) -> DataFrame:
    spark = classes.sparkSession
    cells = int(min(MOST_CELLS, max(1, 2 * count**0.5), count))
    # xxhash64 keys are spread evenly, so a range of them is a sample of the classes.
    share = min(1.0, SAMPLE / count)
    cut = min(int(-(1 << 63) + share * ((1 << 64) - 1)), (1 << 63) - 1)
    sample = classes.where(F.col("key") <= cut).select("key", "data").orderBy("key").limit(SAMPLE).collect()
    sample = sample or classes.select("key", "data").limit(1).collect()
    fitted = unit(_matrix([r["data"] for r in sample]))
    found = spherical_kmeans(fitted, min(cells, len(sample)))
    reach = visit_reach(least, directions(fitted, found), exact)
    centres = spark.sparkContext.broadcast(found)
    schema = "key long, weight long, data binary, cell int, home int, visits array<int>"
    placed = staged(classes.select("key", "weight", "data").mapInArrow(partial(_visits, centres=centres, reach=reach), schema), "cells")
    sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    member = placed.join(F.broadcast(sizes), "cell").withColumn("block", F.pmod(F.xxhash64("key", F.lit(7)), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tasks = member.withColumn("with", other).select("cell", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"), "block", "key", "weight", "data", "home", "visits")
    return tasks.groupBy("cell", "low", "high").applyInPandas(lambda key, frame: _compared(key, frame, least), "a long, b long, n long")
