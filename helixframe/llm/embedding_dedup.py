"""Near-duplicate embeddings: spherical k-means cells, blocked cosine products within cells.

Cells are fitted on a bounded sample and every vector is assigned to its
nearest. A vector also visits other cells that can hold a linked one. If the
pair x, y is linked, the step from x to y is at most ``reach = sqrt(2 - 2 t)``
long, so along the line between their two centres it is at most ``reach``. The border
lies between them, so the two gaps to it add up to at most that. If x is nearer than a share of it, x
visits the later cell; otherwise y is nearer than the rest and visits the earlier one. The sample tells which share makes fewer visits. The angle from x to the other centre is at most that of a linked pair plus the
widest angle in the other cell. Both bounds hold for every pair, so no link is
missed. Where both visit each other, the pair counts in the later cell: vectors carry the set of
cells that they visit. (A number for ``z`` asks for an estimate instead: a margin of ``z``
deviations of a step in no special direction, which real vectors do not
follow.) Equal vectors are one from the start. Cells and their visitors are cut
into blocks of ``block`` vectors, so that a task holds two blocks whatever the
size of a cell. Blocks give each vector's number of links and a spanning set of
edges, never all pairs.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; vectors of different lengths never link; rows with
equal vec_id are counted as separate vectors of one node; rows with a null
vec_id link with nothing; a representative is the smallest vec_id of its group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, arrow_batch, components, fresh_name, map_arrow

SAMPLE, PER_CELL, MOST_CELLS, BLOCK = 16_384, 1_000, 1_024, 1_024
#: Shares of the margin that are tried; results are the same with all.
SHARES = (0.5, 0.75, 1.0)


def unit(values: list) -> np.ndarray | None:
    """A vector at length one in double precision, or nothing if it cannot be."""
    if not values or any(v is None for v in values):
        return None
    x = np.array(values, np.float64)
    if not np.isfinite(x).all() or not (m := np.abs(x).max()):
        return None
    x = x / m
    return x / math.sqrt(float(x @ x))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Unit centres of ``k`` cells."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = (x @ c.T).argmax(1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        size = np.linalg.norm(total, axis=1)
        lost = size < 1e-12
        total[lost], size[lost] = x[rng.choice(len(x), int(lost.sum()))], 1
        c = total / size[:, None]
    return c


def _vectors(table: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, v) of the usable vectors, at length one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("vec_id", pa.int64()), ("v", pa.list_(pa.float64()))])
        for b in batches:
            got = [(i, u) for i, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) if i is not None and (u := unit(x)) is not None]
            yield arrow_batch(schema, [i for i, _ in got], [u for _, u in got])

    return map_arrow(table.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")), run, "vec_id long, v array<double>")


def _by_length(vs: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dim, places, matrix) of the vectors of each length in a column."""
    sizes = np.diff(vs.offsets.to_numpy())
    for dim in np.unique(sizes).tolist():
        own = np.flatnonzero(sizes == dim)
        yield dim, own, vs.take(pa.array(own)).flatten().to_numpy().reshape(-1, dim)


def _widths(reps: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """The widest angle between a centre and a vector of its cell; 0 for empty cells."""
    shared = reps.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("dim", pa.int32()), ("cell", pa.int32()), ("width", pa.float64())])
        for b in batches:
            for dim, _, x in _by_length(b.column(0)):
                near = x @ shared.value.get(dim, np.eye(1, dim)).T
                home, width = near.argmax(1), np.zeros(near.shape[1])
                np.maximum.at(width, home, np.arccos(np.clip(near.max(1), -1, 1)))
                cells = np.unique(home)
                yield arrow_batch(schema, np.full(len(cells), dim), cells, width[cells])

    found = map_arrow(reps.select("v"), run, "dim int, cell int, width double").groupBy("dim", "cell").agg(F.max("width").alias("width"))
    out = {dim: np.zeros(len(c)) for dim, c in centres.items()}
    for dim, cell, width in found.collect():  # a row for each cell
        out.setdefault(dim, np.zeros(1))[cell] = width
    return out


def _near_border(near: np.ndarray, home: np.ndarray, c: np.ndarray, margin: float, share: float) -> np.ndarray:
    """Which cells each vector is near enough to, by its products with all centres."""
    between = np.sqrt(np.maximum(0, 2 - 2 * (c @ c.T)))
    gap = near[np.arange(len(near)), home][:, None] - near
    part = np.where(np.arange(len(c)) > home[:, None], share, 1 - share)
    return gap <= margin * part * between[home] + 1e-9


def _best_share(x: np.ndarray, c: np.ndarray, margin: float) -> float:
    """The share of the margin for later cells that makes the fewest visits."""
    near = x @ c.T
    home = near.argmax(1)
    return min(SHARES, key=lambda share: int(_near_border(near, home, c, margin, share).sum()))


def _margin(dim: int, threshold: float, z: float | None) -> float:
    """How long the step of a linked pair is along the line between two centres, or is estimated to be."""
    return math.sqrt(max(0.0, 2 - 2 * threshold)) * (1.0 if z is None else min(1.0, z / math.sqrt(dim)))


def _cells(reps: DataFrame, centres: dict[int, np.ndarray], shares: dict[int, float], threshold: float, z: float | None) -> DataFrame:
    """(dim, cell, origin, goes, vec_id, n, v): each vector in its cell and in those that it visits, a bit for each of these at home."""
    shared = reps.sparkSession.sparkContext.broadcast((centres, _widths(reps, centres)))  # MOST_CELLS centres for each length
    angle = math.acos(min(1.0, max(-1.0, threshold)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("dim", pa.int32()), ("cell", pa.int32()), ("origin", pa.int32()), ("goes", pa.binary()), ("vec_id", pa.int64()), ("n", pa.int64()), ("v", pa.list_(pa.float64()))])
        for b in batches:
            ids, ns = b.column(0).to_numpy(), b.column(1).to_numpy()
            for dim, own, x in _by_length(b.column(2)):
                c, width = shared.value[0].get(dim), shared.value[1][dim]
                if c is None:
                    c = np.eye(1, dim)
                near = x @ c.T
                home = near.argmax(1)
                close = near >= np.cos(np.minimum(math.pi, angle + width)) - 1e-6
                close[np.arange(len(x)), home] = True
                goes = close & _near_border(near, home, c, _margin(dim, threshold, z), shares.get(dim, SHARES[0]))
                bits = np.packbits(goes, axis=1)
                row, cell = np.nonzero(goes)
                for i in range(0, len(row), 4096):
                    r, k = row[i : i + 4096], cell[i : i + 4096]
                    flat = pa.ListArray.from_arrays(pa.array(np.arange(len(r) + 1, dtype=np.int32) * dim), pa.array(x[r].ravel()))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(r), dim, np.int32)), pa.array(k.astype(np.int32)), pa.array(home[r].astype(np.int32)), pa.array([bits[x].tobytes() if home[x] == y else None for x, y in zip(r, k, strict=True)], pa.binary()), pa.array(ids[own][r]), pa.array(ns[own][r]), flat], schema=schema)

    return map_arrow(reps.select("vec_id", "n", "v"), run, "dim int, cell int, origin int, goes binary, vec_id long, n long, v array<double>")


def _block_links(threshold: float, rows: int = 512):
    """The links between the two blocks of a group: counts and a spanning set of edges."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        left, right = group[group.side != 1], group[group.side != 0]
        same = bool(len(left)) and bool((group.side == 2).all())
        if not len(left) or not len(right):
            return pd.DataFrame({"vec_id": pd.Series(dtype="int64"), "links": pd.Series(dtype="int64"), "least": pd.Series(dtype="int64")})
        a, b = np.stack(left.v.to_numpy()), np.stack(right.v.to_numpy())
        ia, ib, na, nb = left.vec_id.to_numpy(), right.vec_id.to_numpy(), left.n.to_numpy(), right.n.to_numpy()
        ca, cb = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        big = np.iinfo(np.int64).max
        la, lb = np.full(len(a), big), np.full(len(b), big)
        edges: list[np.ndarray] = []
        # Of visitors from later cells, those that their partner visits too are compared there.
        later = np.zeros(len(a), bool) if same else (left.origin > left.cell).to_numpy()
        goes = np.stack([np.unpackbits(np.frombuffer(x, np.uint8)) for x in right.goes]).astype(bool) if later.any() else None
        origin = left.origin.to_numpy()
        for i in range(0, len(a), rows):
            hit = a[i : i + rows] @ b.T >= threshold
            if same:
                hit[np.arange(len(hit)), np.arange(i, i + len(hit))] = False
            if goes is not None:
                hit &= ~(later[i : i + rows, None] & goes.T[origin[i : i + rows]])
            x, y = np.nonzero(hit)
            x += i
            ca += np.bincount(x, nb[y], len(a)).astype(np.int64)
            np.minimum.at(la, x, ib[y])
            if not same:
                cb += np.bincount(y, na[x], len(b)).astype(np.int64)
                np.minimum.at(lb, y, ia[x])
            # An edge to the least partner joins x to it; the others of x's partners reach it by x.
            first = la[x]
            other = ib[y] != first
            edges.append(np.unique(np.stack([ib[y][other], first[other]], 1), axis=0))
        parts = [(ia, ca, la)] if same else [(ia, ca, la), (ib, cb, lb)]
        out = [pd.DataFrame({"vec_id": k, "links": c, "least": m})[m < big] for k, c, m in parts]
        e = np.concatenate(edges)
        if len(e):
            # Within a group most partners repeat: keep one edge for each, and those that connect different leasts.
            e = _spanning(e)
            out.append(pd.DataFrame({"vec_id": e[:, 0], "links": np.zeros(len(e), np.int64), "least": e[:, 1]}))
        return pd.concat(out)

    return run


def _spanning(edges: np.ndarray) -> np.ndarray:
    """Edges (node, least node of its part) that connect the same nodes."""
    nodes, flat = np.unique(edges, return_inverse=True)
    u, v = flat.reshape(edges.shape).T
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return np.stack([nodes[moved], nodes[label[moved]]], 1)


def near_duplicates(
    table: DataFrame, scratch: Scratch, threshold: float = 0.95, key: str = "vec_id", vector: str = "embedding",
    z: float | None = None, sample: int = SAMPLE, per_cell: int = PER_CELL, block: int = BLOCK,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row for each row of ``table``."""
    with scratch.temporary() as own:
        return scratch.save(_near_duplicates(table, own, threshold, key, vector, z, sample, per_cell, block))


def _near_duplicates(table: DataFrame, scratch: Scratch, threshold: float, key: str, vector: str, z: float | None, sample: int, per_cell: int, block: int) -> DataFrame:
    vectors = _vectors(table, key, vector).withColumn("h", F.xxhash64("v")).withColumn("g", F.hash("v"))
    vectors = scratch.save(vectors)
    # Equal vectors: one representative with their number. Partial sums make a hot vector one row for each task.
    reps = scratch.save(vectors.groupBy("h", "g").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("n"), F.first("v").alias("v")).select("h", "g", "vec_id", "n", "v"))

    total = reps.count()
    some = reps.select("vec_id", "v").where(F.pmod(F.xxhash64("vec_id"), F.lit(max(1, total // sample))) == 0).limit(2 * sample)
    by_dim: dict[int, list] = {}
    for v in some.toArrow()["v"]:
        by_dim.setdefault(len(v), []).append(np.asarray(v.values))
    centres, shares = {}, {}
    for dim, xs in by_dim.items():
        k = min(MOST_CELLS, max(1, round(total * len(xs) / sum(map(len, by_dim.values())) / per_cell)))
        centres[dim] = spherical_kmeans(np.stack(xs), k)
        shares[dim] = _best_share(np.stack(xs), centres[dim], _margin(dim, threshold, z))

    stored = scratch.save(_cells(reps, centres, shares, threshold, z))
    cells = stored.withColumn("home", F.col("cell") == F.col("origin"))
    sizes = cells.groupBy("dim", "cell", "home").agg(F.count("*").alias("size"))
    blocks = lambda home, name: F.max(F.when(F.col("home") == home, F.ceil(F.col("size") / block))).alias(name)
    sizes = sizes.groupBy("dim", "cell").agg(blocks(True, "homes"), blocks(False, "visits")).na.fill(0)
    sized = cells.join(F.broadcast(sizes), ["dim", "cell"])  # a row for each cell, at most MOST_CELLS for each length
    spread = sized.withColumn("b", F.pmod(F.xxhash64("vec_id"), F.when(F.col("home"), F.col("homes")).otherwise(F.col("visits"))).cast("int"))
    at = lambda kind, i, j, side: F.struct(F.lit(kind).alias("kind"), i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(side).alias("side"))
    b = F.col("b")
    upto = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(0), (F.col(n) - 1).cast("int"))).otherwise(F.array().cast("array<int>"))
    seats_home = F.concat(
        F.transform(F.filter(upto("homes"), lambda j: j > b), lambda j: at(0, b, j, 0)),
        F.transform(F.filter(upto("homes"), lambda i: i < b), lambda i: at(0, i, b, 1)),
        F.array(at(0, b, b, 2)),
        F.transform(upto("visits"), lambda i: at(1, i, b, 1)),
    )
    seats = F.when(F.col("home"), seats_home).otherwise(F.transform(upto("homes"), lambda j: at(1, b, j, 0)))
    seated = spread.select("dim", "cell", "origin", "goes", "vec_id", "n", "v", F.explode(seats).alias("s")).select("dim", "cell", "s.*", "origin", "goes", "vec_id", "n", "v")
    links = seated.groupBy("dim", "cell", "kind", "i", "j").applyInPandas(_block_links(threshold), "vec_id long, links long, least long")
    links = scratch.save(links)
    scratch.drop(stored)

    between = links.groupBy("vec_id").agg(F.sum("links").alias("links"))
    label = scratch.save(components(links.select(F.col("vec_id").alias("u"), F.col("least").alias("v")), scratch))
    rep = reps.select("h", "g", F.col("vec_id").alias("rep"), "n").join(between.withColumnRenamed("vec_id", "rep"), "rep", "left").join(label.withColumnRenamed("node", "rep"), "rep", "left")
    rep = rep.select("h", "g", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    member = vectors.select("vec_id", "h", "g").join(rep, ["h", "g"]).select("vec_id", "n_links", "component")
    # Rows of one vec_id are one node of the graph.
    clash = member.groupBy("vec_id").agg(F.min("component").alias("component"), F.max("component").alias("other"), F.sum("n_links").alias("n_links"))
    clash = clash.select("vec_id", "n_links", "component")
    out = table.select(F.col(key).cast("long").alias("vec_id")).join(clash, "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))


def keep_representatives(table: DataFrame, scratch: Scratch, threshold: float = 0.95, key: str = "vec_id", vector: str = "embedding", **options) -> DataFrame:
    """The rows of ``table`` that represent their group, with their own columns."""
    gone = fresh_name("__gone", table)
    others = near_duplicates(table, scratch, threshold, key, vector, **options).where("not kept").select(F.col("vec_id").alias(gone)).distinct()
    return table.join(others, F.col(f"`{key}`").cast("long") == F.col(gone), "left_anti")
