"""Exact k nearest neighbours by pivot partitions.

1. *Distinct vectors.* Rows with equal features become one vector with its ``k + 1``
   smallest ids (a group limit before the shuffle), so a hot vector is searched once.
2. *Cells.* ``PIVOTS`` or fewer vectors, those with the smallest hash of their id, are
   pivots; every vector belongs to its nearest one (Voronoi cell). Cells are dealt
   into blocks of about ``BLOCK`` vectors by hash, so no task holds a large cell.
3. *Radius.* The k-th distance inside a vector's own block bounds its true one.
4. *Pruned search.* A cell c is visited only if its lower bound is within the radius:
   the distance to the plane between the own pivot p and c's,
   ``(|xc|^2 - |xp|^2) / (2 |pc|)``, and the triangle inequality against the cell's ring,
   ``|xc| - max`` and ``min - |xc|``. Visits are rows ``(vector, block)``; a block's visits
   stream past its vectors and are dealt into parts, so neither side is ever collected
   beyond a block.
5. *Pruned pairs.* Inside a block a pair's full distance is only formed if two cheaper
   lower bounds are within the radius: ``| |xc| - |yc| |``, and the exact distance in
   the two-valued features plus that in ``LEADING`` principal directions of the others (an
   orthogonal projection). ``pairs`` of the result counts the distances formed.
6. *Merge.* Each visit gives at most k candidates within the radius; a vector's
   candidates are merged to the k first by (distance, id) and copied to its rows.

Every bound only ever drops pairs beyond a radius that holds k real neighbours, so
the result is that of all pairs, ties by the smaller id. The pivots and the sample of
``SAMPLE`` vectors that gives the directions change the cost alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnspark.functions.hashing import hash_key

DIST_DIGITS = 9
PIVOTS, SAMPLE, BLOCK, VISITS, LEADING = 4096, 1024, 2048, 65_536, 4
SLACK = 1e-6     # above the rounding of distances
TILE = 256       # visits compared with a block at once


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Rounded distances of paired rows, summed feature by feature as SQL would."""
    total = np.zeros(len(x))
    for j in range(x.shape[1]):
        gap = x[:, j] - y[:, j]
        total += gap * gap
    return np.round(np.sqrt(total), DIST_DIGITS)


def _square(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``x`` and ``y`` (for bounds: never above the true ones by more than rounding)."""
    return np.maximum(0.0, (x * x).sum(1)[:, None] - 2.0 * (x @ y.T) + (y * y).sum(1)[None])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


class _Bounds:
    """Lower bounds of squared distances between visits and a block's vectors."""

    def __init__(self, members: np.ndarray, two_valued: np.ndarray, directions: np.ndarray):
        self.two_valued, self.directions = two_valued, directions
        self.codes, self.code = np.unique(members[:, two_valued], axis=0, return_inverse=True)
        self.code = self.code.reshape(-1)
        self.leading = members[:, ~two_valued] @ directions

    def __call__(self, visits: np.ndarray) -> np.ndarray:
        return (_square(visits[:, self.two_valued], self.codes)[:, self.code]
                + _square(visits[:, ~self.two_valued] @ self.directions, self.leading))


def _search(x: np.ndarray, name: np.ndarray, ring: np.ndarray, radius: np.ndarray, members: np.ndarray, names: np.ndarray,
            ids: list[list[int]], rings: np.ndarray, bounds: _Bounds, k: int) -> tuple[list[list[dict]], int]:
    """For each visit its first k ids in the block by (distance, id), itself left out, within the radius; and pairs formed."""
    out: list[list[dict]] = []
    formed = 0
    for lo in range(0, len(x), TILE):
        part = slice(lo, lo + TILE)
        r = radius[part, None]
        near = (np.abs(ring[part, None] - rings[None]) <= r) & (bounds(x[part]) <= r * r + SLACK * (1.0 + np.where(np.isfinite(r), r, 0.0)))
        near &= name[part, None] != names[None]
        a, b = np.nonzero(near)
        formed += len(a)
        d = _distances(x[part][a], members[b])
        within = d <= radius[part][a]
        a, b, d = a[within], b[within], d[within]
        order = np.lexsort((names[b], d, a))
        a, b, d = a[order], b[order], d[order]
        ends = np.searchsorted(a, np.arange(len(x[part]) + 1))
        for s, e in zip(ends[:-1].tolist(), ends[1:].tolist()):
            found: list[tuple[float, int]] = []
            for t in range(s, e):
                if len(found) >= k and d[t] > found[k - 1][0]:
                    break
                found += [(float(d[t]), i) for i in ids[b[t]]]
                found = sorted(found)[:k]
            out.append([{"d": dd, "o": o} for dd, o in found])
    return out, formed


def _shape(sample: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which features have at most two values, and the leading principal directions of the others.

    Any columns and any orthonormal directions give valid bounds, so a sample may decide."""
    two_valued = np.array([len(np.unique(c)) <= 2 for c in sample.T], bool)
    rest = sample[:, ~two_valued]
    return two_valued, np.linalg.svd(rest - rest.mean(0), full_matrices=False)[2][:LEADING].T


def _first_by_hash(vectors: DataFrame, n: int, want: int) -> list:
    """The ``want`` of the ``n`` vectors with the smallest hash of their id, in that order.

    Every task sends its own first ``want`` rows to the driver, so rows whose hash is beyond twice the wanted share are
    left out before; if too few remain, all are ordered."""
    h = hash_key("pivot", F.col("q"))
    ordered = vectors.orderBy(h, "q").limit(want).select("x")
    if 2 * want >= n:
        return ordered.collect()
    low = vectors.filter(F.substring(h, 1, 8) < f"{2 * want * 16 ** 8 // n:08x}")
    found = low.orderBy(h, "q").limit(want).select("x").collect()
    return found if len(found) == want else ordered.collect()


def nearest(df: DataFrame, features: list[str], k: int = 5, key: str = "id", rows_per_cell: int = 256,
            stats: dict | None = None) -> DataFrame:
    """``(key, nbr_rank, nbr_id, dist)``: the ``k`` nearest other rows, Euclidean, ties by the smaller id.

    ``stats``, if given, gets ``vectors`` (how many) and ``pairs`` (a DataFrame: distances formed)."""
    spark, width = df.sparkSession, len(features)
    pts = df.select(F.col(key).cast("long").alias("i"), F.array(*[F.col(c).cast("double") + 0.0 for c in features]).alias("x"))
    first = Window.partitionBy("x").orderBy("i")
    vectors = (pts.withColumn("t", F.row_number().over(first)).filter(F.col("t") <= k + 1)
               .groupBy("x").agg(F.sort_array(F.collect_list("i")).alias("ids"))
               .select(F.col("ids")[0].alias("q"), "ids", "x").persist(StorageLevel.MEMORY_AND_DISK))
    seen = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("ids")).alias("copies")).first()
    n = seen["n"]
    empty = spark.createDataFrame([], f"`{key}` long, nbr_rank int, nbr_id long, dist double")
    if n == 0:
        return empty
    p = min(PIVOTS, max(1, n // rows_per_cell))
    sample = np.array([r["x"] for r in _first_by_hash(vectors, n, max(p, SAMPLE))])
    pivots, (two_valued, directions) = sample[:p], _shape(sample)
    apart = np.sqrt(_square(pivots, pivots))

    def to_pivots(x: np.ndarray) -> np.ndarray:
        return np.sqrt(_square(x, pivots))

    def in_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                d = to_pivots(_matrix(b.column(2), width))
                cell = d.argmin(1)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell, pa.int32()), pa.array(d[np.arange(len(d)), cell])],
                                                 names=["q", "ids", "x", "cell", "ring"])

    celled = vectors.mapInArrow(in_cells, "q long, ids array<bigint>, x array<double>, cell int, ring double")
    cells = celled.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("ring").alias("lo"), F.max("ring").alias("hi")).collect()
    size, low, high = np.zeros(p, np.int64), np.full(p, np.inf), np.full(p, -np.inf)
    for r in cells:
        size[r["cell"]], low[r["cell"]], high[r["cell"]] = r["n"], r["lo"], r["hi"]
    blocks = np.maximum(1, -(-size // BLOCK))
    deal = F.element_at(F.array(*[F.lit(int(b)) for b in blocks]), F.col("cell") + 1)
    celled = celled.withColumn("block", F.pmod(F.xxhash64("q"), deal).cast("int"))

    def home(table: pa.Table) -> pa.Table:
        """A block's vectors with the k-th distance to others of the block."""
        x = _matrix(table.column("x"), width)
        radius = np.full(len(x), np.inf)
        if len(x) > k:
            for lo in range(0, len(x), TILE):
                d = _square(x[lo:lo + TILE], x)
                d[np.arange(len(d)), np.arange(lo, lo + len(d))] = np.inf
                best = np.argpartition(d, k - 1, axis=1)[:, :k]
                rows = np.repeat(np.arange(lo, lo + len(d)), k)
                radius[lo:lo + TILE] = _distances(x[rows], x[best.ravel()]).reshape(-1, k).max(1) + SLACK
        return table.append_column("radius", pa.array(radius))

    members = celled.groupBy("cell", "block").applyInArrow(
        home, "q long, ids array<bigint>, x array<double>, cell int, ring double, block int, radius double").persist(
        StorageLevel.MEMORY_AND_DISK)

    def visited(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Vectors (as rows of the batch) and the cells that may hold one of their neighbours; all distances to pivots."""
        own, radius = b.column("cell").to_numpy(), b.column("radius").to_numpy()
        d = to_pivots(_matrix(b.column("x"), width))
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = (d * d - (d[np.arange(len(d)), own] ** 2)[:, None]) / (2.0 * apart[own])
        plane = np.where(np.isfinite(plane), plane, 0.0)
        bound = np.maximum(np.maximum(plane, d - high), low - d)
        return *np.nonzero((bound <= radius[:, None] + SLACK) & (size > 0)), d

    def count_visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(p, np.int64)
        for b in batches:
            if b.num_rows:
                total += np.bincount(visited(b)[1], minlength=p)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(p), pa.int32()), pa.array(total)], names=["cell", "n"])

    load = members.mapInArrow(count_visits, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    parts = np.ones(p, np.int64)
    for r in load:
        parts[r["cell"]] = max(1, -(-r["n"] // VISITS))

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row for each vector and block that may hold one of its neighbours."""
        for b in batches:
            if not b.num_rows:
                continue
            row, cell, d = visited(b)
            copies = blocks[cell]
            row, cell = np.repeat(row, copies), np.repeat(cell, copies)
            block = np.arange(len(cell)) - np.repeat(np.cumsum(copies) - copies, copies)
            part = b.column("q").to_numpy()[row] % parts[cell]
            for lo in range(0, len(row), 8192):
                s = slice(lo, lo + 8192)
                taken = b.select(["q", "ids", "x"]).take(pa.array(row[s]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell[s], pa.int32()), pa.array(block[s], pa.int32()), pa.array(part[s], pa.int32()),
                     pa.array(np.ones(len(row[s])), pa.int32()), *taken.columns, pa.array(d[row[s], cell[s]]),
                     b.column("radius").take(pa.array(row[s]))], names=["cell", "block", "part", "kind", "q", "ids", "x", "ring", "radius"])

    asked = members.mapInArrow(visits, "cell int, block int, part int, kind int, q long, ids array<bigint>, x array<double>, "
                                       "ring double, radius double")
    copies = F.element_at(F.array(*[F.lit(int(c)) for c in parts]), F.col("cell") + 1)
    held = members.select("cell", "block", F.explode(F.sequence(F.lit(0), copies - 1)).alias("part"), F.lit(0).alias("kind"),
                          "q", "ids", "x", "ring", F.lit(0.0).alias("radius"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = held.unionByName(asked).repartition(tasks, "cell", "block", "part").sortWithinPartitions("cell", "block", "part", "kind")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows, state = None, [], None
        for b in batches:
            keys = np.stack([b.column(i).to_numpy() for i in range(4)], 1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                piece, here = b.slice(lo, hi - lo), tuple(keys[lo][:3]) if len(keys) else None
                if here is None:
                    continue
                if here != at:
                    at, rows, state = here, [], None
                if keys[lo][3] == 0:
                    rows.append(piece)
                    continue
                if state is None:
                    table = pa.Table.from_batches(rows)
                    x = _matrix(table.column("x"), width)
                    state = (x, table.column("q").to_numpy(), table.column("ids").to_pylist(), table.column("ring").to_numpy(),
                             _Bounds(x, two_valued, directions))
                x, names, ids, rings, bounds = state
                found, formed = _search(_matrix(piece.column("x"), width), piece.column("q").to_numpy(), piece.column("ring").to_numpy(),
                                        piece.column("radius").to_numpy(), x, names, ids, rings, bounds, k)
                counts = [formed] + [0] * (piece.num_rows - 1)
                keep = [i for i, f in enumerate(found) if f or counts[i]]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("q").take(pa.array(keep, pa.int64())),
                     pa.array([found[i] for i in keep], pa.list_(pa.struct([("d", pa.float64()), ("o", pa.int64())]))),
                     pa.array([counts[i] for i in keep], pa.int64())], names=["q", "near", "pairs"])

    found = met.mapInArrow(compare, "q long, near array<struct<d:double,o:bigint>>, pairs long")
    if stats is not None:
        stats.update(vectors=n, pairs=found.agg(F.sum("pairs").alias("pairs")))
    merged = found.groupBy("q").agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k).alias("near"))
    own = F.transform("ids", lambda i: F.struct(F.lit(0.0).alias("d"), i.alias("o")))
    none_near = F.array().cast("array<struct<d:double,o:bigint>>")
    lists = vectors.join(merged.hint("merge"), "q", "left").select("q", "x", F.array_sort(F.concat(own, F.coalesce("near", none_near))).alias("near"))
    rows = pts.join(lists, "x") if seen["copies"] > 1 else lists.withColumn("i", F.col("q"))
    out = rows.select("i", F.posexplode(F.slice(F.filter("near", lambda s: s["o"] != F.col("i")), 1, k)).alias("t", "s"))
    return out.select(F.col("i").alias(key), (F.col("t") + 1).cast("int").alias("nbr_rank"), F.col("s.o").alias("nbr_id"),
                      F.col("s.d").alias("dist"))
