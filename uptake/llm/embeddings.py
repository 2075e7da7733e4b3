"""Cosine near-duplicates by a subspace pigeonhole join.

Unit vectors at cosine ``c`` or more lie within squared distance ``2 - 2c``. After a fixed rotation, coordinates are
split into ``blocks`` blocks; if two vectors are that near, at least one block's squared distance is within its
proportional share of the budget. Each block is range-joined on a grid over its first coordinates, whose cells are as
wide as the block's radius, so a vector meets its own and the adjoining cells. Pairs within the share are verified with
the cosine of the original vectors in double precision. A pair counts in the first block that finds it.

Few wide blocks: the wider a block, the more rarely a pair that is far apart is near in it, so nearly all pairs that
pass the share are links. Rotated coordinates are rounded to multiples of 2**-20, whose products and sums are exact in
doubles, so every task decides alike which block comes first; the budget is widened by the rounding.

Equal vectors are joined as one. Cells are cut into chunks of ``CHUNK`` rows that meet chunk by chunk, so a hot cell is
spread over tasks, and a task compares them tile by tile. A vector travels as bytes of its own precision, once for each
chunk that it meets. Tasks return counts and one label per row of a tile, never all pairs.

Where vectors fill all directions evenly, cells of a grid in few coordinates hold a fixed share of the table, and what
is sent grows faster than the table; no grid that keeps every link prevents this.

Defined results: a vector that is null, empty, zero or holds null or non-finite components is alone; vectors of each
length are compared among themselves; rows with equal ids are one node in components; empty tables give no rows; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uptake.llm.components import components
from uptake.session import materialize

BLOCKS = 4
GRID = 2  #: coordinates of a block that its grid is laid over
CHUNK = 8000  #: rows of a cell that meet those of another in one task
TILE = 1000  #: rows of a chunk that are compared in one go
UNIT = float(1 << 20)
ROUNDING = 1e-4  #: more than rounding can add to a distance


def _rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(7).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _units(v: np.ndarray) -> np.ndarray:
    """Vectors of length one, in double precision."""
    v = v.astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _rotated(units: np.ndarray) -> np.ndarray:
    """Rotated coordinates in whole units."""
    return np.rint(units @ _rotation(units.shape[1]) * UNIT)


def _parts(dim: int, blocks: int) -> list[slice]:
    edges = [round(i * dim / blocks) for i in range(blocks + 1)]
    return [slice(a, b) for a, b in zip(edges, edges[1:])]


def _settle(i: np.ndarray, j: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id that each row of two sides reaches over the links ``(i, j)`` between them (its own if it has none)."""
    while True:
        r, l2 = right.copy(), left.copy()
        np.minimum.at(r, j, left[i])
        np.minimum.at(l2, i, r[j])
        if (r == right).all() and (l2 == left).all():
            return left, right
        left, right = l2, r


def near_duplicates(rows: DataFrame, threshold: float = 0.95, blocks: int = BLOCKS) -> DataFrame:
    """Rows ``(vec_id, n_links, component_id, kept)``, one per row of ``rows`` (``vec_id``, ``embedding``)."""
    single = rows.schema["embedding"].dataType.simpleString() == "array<float>"
    kind = "array<float>" if single else "array<double>"
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("v"))
    usable = F.coalesce(
        (F.size("v") > 0) & F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
        & F.exists("v", lambda x: x != 0), F.lit(False))
    # -0.0 and 0.0 are the same component
    rows = rows.withColumn("v", F.when(usable, F.transform("v", lambda x: x + F.lit(0.0).cast(kind[6:-1])))).withColumn("dim", F.size("v"))
    rows = rows.withColumn("h", F.when(F.col("v").isNotNull(), F.sha2(F.concat_ws(",", F.transform("v", lambda x: x.cast("string"))), 256)))
    rows = materialize(rows, "vectors")
    reps = materialize(rows.where("h is not null").groupBy("h").agg(
        F.count("*").alias("n"), F.min("vec_id").alias("id"), F.first("v").alias("v"), F.first("dim").alias("dim"))
        .withColumn("key", F.xxhash64("h")), "vector-classes")
    found = []
    for r in reps.select("dim").distinct().collect():  # one or a few lengths
        found.append(_links(reps.where(F.col("dim") == r["dim"]), r["dim"], threshold, blocks))
    if not found:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))
    got = found[0]
    for f in found[1:]:
        got = got.union(f)
    got = materialize(got, "vector-links")
    counts = got.groupBy("key").agg(F.sum("links").alias("links"))
    ids = reps.select("key", "id")
    edges = (got.where("label <> key").select("key", "label").distinct()
             .join(ids.withColumnRenamed("id", "a"), "key")
             .join(ids.select(F.col("key").alias("label"), F.col("id").alias("b")), "label"))
    comp = components(edges, "a", "b")
    full = reps.select("h", "n", "id", "key").join(counts, "key", "left")
    full = full.join(comp, full["id"] == comp["node"], "left").select(
        "h", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).cast("long").alias("links"), F.coalesce("component", "id").alias("c"))
    out = rows.select("vec_id", "h").join(full, "h", "left").select(
        "vec_id", F.coalesce("links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("c", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _links(reps: DataFrame, dim: int, threshold: float, blocks: int) -> DataFrame:
    """Per vector and tile: ``(key, links, label)``, the linked rows there and the smallest key reached there."""
    blocks = max(1, min(blocks, dim))
    share = ((2 - 2 * threshold) ** 0.5 + ROUNDING) ** 2 / blocks * UNIT * UNIT
    width = float(np.ceil(share ** 0.5)) + 1
    parts = _parts(dim, blocks)
    steps = [(0, 0), (0, 1), (1, -1), (1, 0), (1, 1)]  # a cell meets itself and half of its neighbours
    kind = np.float32 if reps.schema["v"].dataType.elementType.typeName() == "float" else np.float64

    def cells(batches):
        for f in batches:
            if not f.num_rows:
                continue
            v = f.column("v").flatten().to_numpy().reshape(-1, dim)
            rot = _rotated(_units(v))
            at = np.zeros((len(v), blocks, 2), np.int64)
            for b, p in enumerate(parts):
                c = np.floor(rot[:, p][:, :GRID] / width).astype(np.int64)
                at[:, b, :c.shape[1]] = c
            yield pa.RecordBatch.from_arrays(
                [f.column("key"), f.column("n"), pa.array([r.tobytes() for r in v.astype(kind)], pa.binary()),
                 pa.array(list(at[:, :, 0]), pa.list_(pa.int64())), pa.array(list(at[:, :, 1]), pa.list_(pa.int64()))],
                names=["key", "n", "raw", "xs", "ys"])

    placed = materialize(reps.select("key", "n", "v").mapInArrow(
        cells, "key long, n long, raw binary, xs array<long>, ys array<long>"), "vector-cells")
    cell = F.posexplode(F.arrays_zip("xs", "ys")).alias("b", "c")

    def in_cells(*cols):
        return placed.select(*cols, cell).select(*cols, "b", F.col("c.xs").alias("x"), F.col("c.ys").alias("y"))

    move = F.explode(F.array(*[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy")) for i, j in steps])).alias("m")

    def moved(df: DataFrame, *cols) -> DataFrame:
        return df.select("*", move).select(
            *cols, "b", (F.col("x") - F.col("m.dx")).alias("x"), (F.col("y") - F.col("m.dy")).alias("y"),
            ((F.col("m.dx") == 0) & (F.col("m.dy") == 0)).alias("own"))

    # chunks per cell, of hosts and of guests; a cell without hosts is left out by the join
    def chunks(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("b", "x", "y").agg(F.ceil(F.sum("rows") / CHUNK).cast("int").alias(name))

    counted = materialize(in_cells("key").groupBy("b", "x", "y").agg(F.count("*").alias("rows")), "cell-rows")
    sizes = materialize(chunks(counted, "hosts").join(chunks(moved(counted, "rows"), "guests"), ["b", "x", "y"]), "cell-sizes")

    def spread(df: DataFrame, mine: str, other: str, c: str, d: str) -> DataFrame:
        return (df.join(sizes, ["b", "x", "y"])
                .withColumn(c, F.pmod(F.xxhash64("key"), F.col(mine)).cast("int"))
                .withColumn(d, F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop("hosts", "guests"))

    hosts = in_cells("key", "n", "raw")
    host = spread(hosts.withColumn("own", F.lit(True)).withColumn("guest", F.lit(False)), "hosts", "guests", "i", "j")
    guest = spread(moved(hosts, "key", "n", "raw").withColumn("guest", F.lit(True)), "guests", "hosts", "j", "i")
    cols = ["b", "x", "y", "i", "j", "guest", "own", "key", "n", "raw"]

    def meet(f: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"key": [], "links": [], "label": []}).astype("int64")
        left, right = f[~f["guest"]], f[f["guest"]]
        if not len(left) or not len(right):
            return none
        b = int(f["b"].iloc[0])
        vectors = lambda g: _units(np.frombuffer(b"".join(g["raw"]), dtype=kind).reshape(-1, dim))
        lv, rv = vectors(left), vectors(right)
        lr, rr = _rotated(lv), _rotated(rv)
        lk, rk, own = left["key"].to_numpy(), right["key"].to_numpy(), right["own"].to_numpy()
        ln, rn = left["n"].to_numpy(), right["n"].to_numpy()

        def sides(p: slice) -> tuple[np.ndarray, np.ndarray]:
            # the product of these is minus half the squared distance, exactly
            a, c = lr[:, p], rr[:, p]
            return (np.c_[a, -(a * a).sum(1) / 2, np.ones(len(a))], np.c_[c, np.ones(len(c)), -(c * c).sum(1) / 2])

        la, ra = sides(parts[b])
        out = []
        for lo in range(0, len(lv), TILE):
            at = slice(lo, lo + TILE)
            i, j = np.nonzero(la[at] @ ra.T >= -share / 2)
            i += lo
            fresh = ~own[j] | (lk[i] < rk[j])
            i, j = i[fresh], j[fresh]
            linked = np.zeros(len(i), bool)
            for s in range(0, len(i), 1 << 15):  # the exact cosine, the same arithmetic for a pair wherever it meets
                u, w = i[s:s + (1 << 15)], j[s:s + (1 << 15)]
                ok = (lv[u] * rv[w]).sum(1) >= threshold
                for p in parts[:b]:  # an earlier block has counted it
                    d = lr[u][:, p] - rr[w][:, p]
                    ok &= (d * d).sum(1) > share
                linked[s:s + (1 << 15)] = ok
            i, j = i[linked], j[linked]
            if not len(i):
                continue
            rows, li = np.unique(i, return_inverse=True)
            guests, rj = np.unique(j, return_inverse=True)
            ll, rl = _settle(li, rj, lk[rows], rk[guests])
            out.append(pd.DataFrame({
                "key": np.r_[lk[rows], rk[guests]],
                "links": np.r_[np.bincount(li, rn[j]), np.bincount(rj, ln[i])].astype(np.int64), "label": np.r_[ll, rl]}))
        return pd.concat(out) if out else none

    return (host.select(cols).union(guest.select(cols)).groupBy("b", "x", "y", "i", "j")
            .applyInPandas(meet, "key long, links long, label long"))
