"""Exact nearest neighbours without comparing all pairs, and what is built on them.

Points are collapsed to distinct positions with a weight, so any number of copies is one point. A
tree of cells is grown as tables: every cell that holds more than its bound is cut again at
quantiles of its widest coordinate that divides it well, until none is left, whatever the number of points. Borders come
from a sample of bounded size per cell; they shape the work and never the result. A first
round searches the own cell and yields an upper bound of each point's k-distance; a second round
walks the tree down to the cells that bound can reach.

NULL coordinates are handled by pattern: rows are searched in the coordinates that they and the donors
share, and distances are scaled to the full number of coordinates.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerlens.session import cut
from ledgerlens.sources import files

from . import cleaning, ordered, skew

INF = float("inf")

#: Most queries one task searches a cell for.
VISITORS = 20_000

#: Most children of a cell, and about how many of its positions their borders are taken from.
FAN = 8
BORDER_SAMPLE = 4096

#: Name of the cell that holds everything; children add a dot and their number.
ROOT = "c"


def borders(sample: pd.DataFrame, coords: Sequence[str], fan: int) -> tuple[int, list[float]]:
    """Coordinate and borders of the children; a child starts at its border.

    Of the coordinates that divide about as well as the best (by the largest child) the widest is cut: a ball reaches
    few cells that are about as long as wide, but many thin ones.
    """
    cuts = []
    for axis, c in enumerate(coords):
        v = np.sort(sample[c].to_numpy(dtype=float))
        edges = np.unique(v[[len(v) * i // fan for i in range(1, fan)]])
        edges = edges[edges > v[0]]
        if not len(edges):
            edges = v[v > v[0]][:1]
        if len(edges):
            largest = int(np.bincount(np.searchsorted(edges, v, side="right")).max())
            wide = v[-1 - len(v) // 16] - v[len(v) // 16]
            cuts.append((largest, -wide, axis, [float(e) for e in edges]))
    if not cuts:
        return 0, []
    least = min(cuts)[0]
    return min((c for c in cuts if c[0] <= 2 * least), key=lambda c: c[1:3])[2:]


@dataclass
class Cells:
    """The tree as a table (cell, axis, edges) of the cells that were cut, and its depth."""

    table: DataFrame | None
    depth: int
    coords: list[str]

    def step(self, rows: DataFrame, table: DataFrame) -> DataFrame:
        """Move rows whose cell was cut into the child that holds them."""
        x = F.element_at(F.array(*[F.col(c) for c in self.coords]), F.col("axis") + 1)
        child = F.concat(F.col("cell"), F.lit("."), F.size(F.filter("edges", lambda e: e <= x)).cast("string"))
        return rows.join(table, "cell", "left").withColumn("cell", F.when(F.col("axis").isNull(), F.col("cell")).otherwise(child)).drop("axis", "edges")

    def place(self, rows: DataFrame) -> DataFrame:
        """Attach the cell of every position."""
        out = rows.withColumn("cell", F.lit(ROOT))
        for _ in range(self.depth):
            out = self.step(out, self.table)
        return out

    def reach(self, rows: DataFrame, radius: str) -> DataFrame:
        """One row for every cell that the ball of ``radius`` around a row can touch."""
        x = F.element_at(F.array(*[F.col(c) for c in self.coords]), F.col("axis") + 1)
        first = F.size(F.filter("edges", lambda e: e < x - F.col(radius)))
        last = F.size(F.filter("edges", lambda e: e <= x + F.col(radius)))
        inner = F.transform(F.sequence(first, last), lambda i: F.concat(F.col("cell"), F.lit("."), i.cast("string")))
        out = rows.withColumn("cell", F.lit(ROOT))
        for _ in range(self.depth):
            met = out.join(self.table, "cell", "left")
            out = met.withColumn("cell", F.explode(F.when(F.col("axis").isNull(), F.array("cell")).otherwise(inner))).drop("axis", "edges")
        return out


def build_cells(points: DataFrame, coords: list[str], per_cell: int) -> Cells:
    """Cut cells until none holds more than ``per_cell`` positions (three small jobs per level)."""
    cells = Cells(None, 0, list(coords))
    placed = points.select("pid", *coords).withColumn("cell", F.lit(ROOT))
    kind = "cell string, axis int, edges array<double>"

    def split(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        # children of about half the bound: many small ones would each be visited by most queries around them
        axis, edges = borders(part, coords, min(FAN, max(2, -(-2 * int(part["n"].iloc[0]) // per_cell))))
        return pd.DataFrame({"cell": [key[0]], "axis": [axis], "edges": [edges]}).iloc[: 1 if edges else 0]

    while True:
        crowded = cut(placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > per_cell))
        if crowded.isEmpty():
            return cells
        # about BORDER_SAMPLE positions of each crowded cell
        unit = F.pmod(F.xxhash64("pid", F.lit(cells.depth)), F.lit(1 << 40)) / F.lit(float(1 << 40))
        drawn = placed.join(crowded, "cell").where(unit * F.col("n") < F.lit(float(BORDER_SAMPLE))).drop("pid")
        new = cut(drawn.groupBy("cell").applyInPandas(split, kind))
        if new.isEmpty():
            return cells
        placed = cut(cells.step(placed, new))
        cells.table = new if cells.table is None else cells.table.unionByName(new)
        cells.depth += 1


def _within(row: np.ndarray, w: np.ndarray, k: int) -> np.ndarray:
    """How much of each weight falls within the first ``k`` of its row; equal rows are together."""
    before = np.cumsum(w) - w
    first = np.flatnonzero(np.diff(row, prepend=-1))
    return np.minimum(w, np.maximum(0, k - (before - np.repeat(before[first], np.diff(first, append=len(row))))))


def _search(q: np.ndarray, p: np.ndarray, weight: np.ndarray, ids: np.ndarray, own: np.ndarray | None, k: int, radius: np.ndarray | None = None):
    """Nearest weighted points of all query rows, none beyond a row's ``radius``: arrays of row, id, distance and weight used."""
    out = []
    # so many nearest points hold k: each counts once at least, but for the row itself and points without weight
    most = k + 1 + int((weight <= 0).sum())
    for start in range(0, len(q), 512):
        block = q[start : start + 512]
        d = np.zeros((len(block), len(p)))
        for axis in range(p.shape[1]):
            d += (block[:, axis, None] - p[None, :, axis]) ** 2
        d = np.sqrt(d)
        limit = np.full(len(block), INF) if radius is None else radius[start : start + 512]
        if len(p) > most:
            limit = np.minimum(limit, np.partition(d, most - 1, axis=1)[:, most - 1])
        # equal distances at the limit all stay, the order among them is settled below
        row, col = np.nonzero(d <= limit[:, None])
        # a point is not its own neighbour, its copies are
        w = weight[col] if own is None else weight[col] - (ids[col] == own[start + row])
        row, col, w = row[w > 0], col[w > 0], w[w > 0]
        order = np.lexsort((*p[col].T[::-1], d[row, col], row))
        row, col, w = row[order], col[order], w[order]
        used = _within(row, w, k)
        row, col, used = row[used > 0], col[used > 0], used[used > 0]
        out.append((start + row, ids[col], d[row, col], used))
    return tuple(np.concatenate(part) for part in zip(*out))


#: Hits of a query, packed into one row: a row for each would be several times as large wherever it is written or dealt out.
LISTS = "distance array<double>, pid array<bigint>, used array<int>"
HITS = f"qid bigint, {LISTS}"


def _written(df: DataFrame) -> DataFrame:
    """The rows as a file: unlike a checkpoint, the search is done once for it."""
    path = files.write(df, files.scratch(df.sparkSession, "neighbours"), "parquet")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _tasks(asked: DataFrame) -> int:
    """Tasks of a search: some for every core, and more as there are more queries."""
    return max(2 * asked.sparkSession.sparkContext.defaultParallelism, -(-asked.count() // VISITORS))


def _lists(n: int, row: np.ndarray, distance: np.ndarray, ids: np.ndarray, used: np.ndarray) -> list[pa.Array]:
    """Hits, ordered by row, as the lists of ``n`` rows."""
    ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))]), pa.int32())
    return [pa.ListArray.from_arrays(ends, pa.array(v, t)) for v, t in ((distance, pa.float64()), (ids, pa.int64()), (used, pa.int32()))]


def _merged(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The first ``k`` of each query's hits from all cells it visited; ``used`` of a cell is at least what is left of it here."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [batch.column(batch.schema.get_field_index(c)) for c in ("distance", "pid", "used")]
            cells = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists[0]).to_numpy())
            row = np.repeat(cells, pc.list_value_length(lists[0].flatten()).to_numpy())
            distance, ids, used = (v.flatten().flatten().to_numpy() for v in lists)
            order = np.lexsort((ids, distance, row))
            row, distance, ids, used = row[order], distance[order], ids[order], _within(row[order], used[order], k)
            kept = used > 0
            made = _lists(batch.num_rows, row[kept], distance[kept], ids[kept], used[kept])
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("qid")), *made], names=["qid", "distance", "pid", "used"])

    return merge


def gather(points: DataFrame, queries: DataFrame, coords: list[str], k: int, *, same: bool, per_cell: int = 2000) -> DataFrame:
    """``nearest`` with one row per query: ``(qid, distance, pid, used)``, the last three as lists in order."""
    cells = build_cells(points, coords, per_cell)
    kind = ", ".join(f"`{c}` double" for c in coords)
    placed = _anew(cut(cells.place(points.select("pid", F.col("weight").cast("bigint").alias("weight"), *coords))))
    asked = _anew(cut(cells.place(queries.select("qid", *coords))))
    tasks = _tasks(asked)

    def matrix(t: pa.Table) -> np.ndarray:
        return np.column_stack([t.column(c).to_numpy() for c in coords]).astype(float)

    def found(q: pa.Table, p: pa.Table) -> tuple:
        if not q.num_rows or not p.num_rows:
            return tuple(np.empty(0, t) for t in (np.int64, np.int64, float, np.int64))
        bound = q.column("radius").to_numpy() if "radius" in q.column_names else None
        qids, ids = q.column("qid").to_numpy(), p.column("pid").to_numpy()
        return _search(matrix(q), matrix(p), p.column("weight").to_numpy(), ids, qids if same else None, k, bound)

    def at_home(q: pa.Table, p: pa.Table) -> pa.Table:
        """Every query with its place, what its cell holds for it and the bound that follows."""
        row, ids, distance, used = found(q, p)
        farthest = np.zeros(q.num_rows)
        np.maximum.at(farthest, row, distance)
        radius = np.where(np.bincount(row, used, q.num_rows) >= k, farthest, INF)
        columns = [q.column(c).combine_chunks() for c in ("qid", *coords, "cell")]
        return pa.Table.from_arrays([*columns, pa.array(radius), *_lists(q.num_rows, row, distance, ids, used)], names=["qid", *coords, "home", "radius", "distance", "pid", "used"])

    def as_guest(q: pa.Table, p: pa.Table) -> pa.Table:
        """The queries that hit something."""
        row, ids, distance, used = found(q, p)
        hit, row = np.unique(row, return_inverse=True)
        return pa.Table.from_arrays([pa.array(q.column("qid").to_numpy()[hit], pa.int64()), *_lists(len(hit), row, distance, ids, used)], names=["qid", "distance", "pid", "used"])

    def search(visitors: DataFrame, look: Callable[[pa.Table, pa.Table], pa.Table], out: str) -> DataFrame:
        """Search each visitor's cell. A cell holds ``per_cell`` positions at most; its
        visitors are dealt to as many tasks as they need, each with a copy of those positions."""
        sizes = visitors.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(VISITORS)).cast("int").alias("parts"))
        # one row for every VISITORS visitors at most
        crowded = F.broadcast(sizes.where(F.col("parts") > 1))
        parts = F.coalesce("parts", F.lit(1))
        dealt = visitors.join(crowded, "cell", "left").withColumn("part", F.pmod(F.xxhash64("qid"), parts).cast("int")).drop("parts")
        copies = placed.join(crowded, "cell", "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
        # a fixed number of partitions: the rows are few bytes but much work, and by their bytes they would be put into few tasks
        meet = lambda df: df.repartition(tasks, "cell", "part").groupBy("cell", "part")
        return meet(dealt).cogroup(meet(copies)).applyInArrow(look, out)

    first = _written(search(asked, at_home, f"qid bigint, {kind}, home string, radius double, {LISTS}"))
    if not cells.depth:
        return first.select("qid", "distance", "pid", "used")
    # a fixed number of points: the distance to the k-th of them bounds the distance to the k-th of all
    some = placed.orderBy(F.xxhash64(*coords)).limit(max(1000, k + 1)).toPandas()
    some_x, some_w, some_ids = some[coords].to_numpy(float), some["weight"].to_numpy(), some["pid"].to_numpy()

    def bounded(batches):
        for pdf in batches:
            r, qids = pdf["radius"].to_numpy().copy(), pdf["qid"].to_numpy()
            open_rows = np.flatnonzero(np.isinf(r))
            if len(open_rows):
                x = pdf[coords].to_numpy(dtype=float)[open_rows]
                row, _, distance, used = _search(x, some_x, some_w, some_ids, qids[open_rows] if same else None, k)
                held, farthest = np.bincount(row, used, len(x)), np.zeros(len(x))
                np.maximum.at(farthest, row, distance)
                r[open_rows] = np.where(held >= k, farthest, INF)
            yield pdf.assign(radius=r)

    # the bound is widened by a hair, so that a point at exactly its distance beyond a border counts
    reach = first.select("qid", *coords, "home", "radius").repartition(tasks, "qid")
    reach = reach.mapInPandas(bounded, f"qid bigint, {kind}, home string, radius double").withColumn("radius", F.col("radius") * (1 + 1e-9))
    guests = _written(cells.reach(reach, "radius").where(F.col("cell") != F.col("home")).select("qid", *coords, "radius", "cell"))
    met = first.select("qid", "distance", "pid", "used").unionByName(search(guests, as_guest, HITS))
    by_query = met.repartition(tasks, "qid").groupBy("qid").agg(*[F.collect_list(c).alias(c) for c in ("distance", "pid", "used")])
    return _written(by_query.mapInArrow(_merged(k), HITS))


def nearest(points: DataFrame, queries: DataFrame, coords: list[str], k: int, *, same: bool, per_cell: int = 2000) -> DataFrame:
    """``(qid, pid, distance, used)``: the ``k`` nearest points of each query, counted with weights.

    ``points`` has ``pid, weight`` and the coordinates, ``queries`` has ``qid`` and the coordinates.
    ``same`` says that both are one table (equal ids), so a point does not count itself. ``used`` is
    how much of a point's weight falls within the ``k``; ties go to the smaller ``pid``, which is the one
    with the smaller coordinates where ``_positions`` gave them.
    """
    return _apart(gather(points, queries, coords, k, same=same, per_cell=per_cell))


def _apart(packed: DataFrame) -> DataFrame:
    return packed.select("qid", F.inline(F.arrays_zip("pid", "distance", F.col("used").cast("array<bigint>").alias("used"))))


def _anew(df: DataFrame) -> DataFrame:
    """The same columns under identities of their own, so that the table can meet what it was made from."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def _first_k(found: DataFrame, k: int, order: Sequence[str | Column]) -> DataFrame:
    """Of each query's candidates (at most ``k`` for each cell it visited), the first ``k`` by weight ``own``."""
    w = W.partitionBy("qid").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    counted = found.withColumn("before", F.coalesce(F.sum("own").over(w), F.lit(0)))
    used = F.least(F.col("own"), F.lit(k) - F.col("before"))
    return counted.withColumn("used", used.cast("bigint")).where(F.col("used") > 0).drop("before", "own")


def _positions(df: DataFrame, coords: list[str], extra: list | None = None) -> DataFrame:
    """Distinct positions with their weight and a unique id that ascends with the coordinates, written once so that the ids stay."""
    g = df.groupBy(*coords).agg(F.count(F.lit(1)).alias("weight"), *(extra or [])).orderBy(*coords)
    return cut(g.withColumn("pid", F.monotonically_increasing_id()))


def _standard(df: DataFrame, cols: list[str]) -> tuple[DataFrame, list[str]]:
    """Scaled copies of the columns under new names; a NULL stays NULL."""
    params = cleaning.fit_scaler(df, cols)
    names = [f"z{i}" for i in range(len(cols))]
    made = {n: (F.col(c) - F.lit(float(params[c][0] or 0.0))) / F.lit(float(params[c][1])) for n, c in zip(names, cols)}
    return df.withColumns(made), names


def filled_with_means(df: DataFrame, cols: list[str]) -> DataFrame:
    """The columns as doubles with their mean in place of NULL or NaN (0 where there is no value)."""
    plain = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in cols}
    means = df.select(*[v.alias(c) for c, v in plain.items()]).agg(*[F.avg(c).alias(c) for c in cols]).first()
    return df.withColumns({c: F.coalesce(v, F.lit(0.0 if means[c] is None else float(means[c]))) for c, v in plain.items()})


def local_outlier_factor(df: DataFrame, key: str, cols: list[str], k: int = 20, contamination: float = 0.1, per_cell: int = 2000) -> DataFrame:
    """Local outlier factor on standardised columns of every row; the top ``contamination`` share is flagged.

    A missing value counts as its column's mean.
    """
    rows, coords = _standard(filled_with_means(df.select(key, *cols), cols), cols)
    points = _positions(rows, coords)
    packed = gather(points, points.select(F.col("pid").alias("qid"), *coords), coords, k, same=True, per_cell=per_cell)
    near = _apart(packed)
    k_distance = packed.select(F.col("qid").alias("pid"), F.array_max("distance").alias("kd"))
    reach = near.join(k_distance, "pid")
    mean_reach = F.sum(F.greatest("distance", "kd") * F.col("used")) / F.sum("used")
    density = reach.groupBy("qid").agg((1.0 / (mean_reach + F.lit(1e-10))).alias("lrd"))
    density = cut(density)
    around = near.join(density.withColumnsRenamed({"qid": "pid", "lrd": "their"}), "pid")
    lof = (
        around.groupBy("qid")
        .agg((F.sum(F.col("their") * F.col("used")) / F.sum("used")).alias("mean_their"))
        .join(density, "qid")
        .select(F.col("qid").alias("pid"), (F.col("mean_their") / F.col("lrd")).alias("lof"))
    )
    at = points.join(lof, "pid").select(*coords, "lof")
    scored = cut(skew.lookup(rows, at, coords, "inner").select(key, "lof"))
    limit = ordered.quantile_values(scored, ["lof"], [1 - contamination])["lof"][0]
    return scored.withColumn("is_outlier", F.col("lof") > F.lit(limit))


def knn_impute(df: DataFrame, key: str, target: str, cols: list[str], k: int = 5, per_cell: int = 2000) -> DataFrame:
    """Fill NULLs of ``target`` with the mean of the ``k`` nearest donors in the other columns; every row comes back.

    Where coordinates are missing, the distance of two rows is taken over those both have and scaled by
    the share that is. Rows are therefore searched per pattern: one index over the donors for every set
    of coordinates that a pattern of gaps shares with a pattern of donors. A row that shares none with any donor takes
    the mean of all donors. Donors at one position stand for their mean; a position that only partly
    fits into ``k`` counts with that part. Equal distances: more shared coordinates first, then smaller ones.
    """
    rows, coords = _standard(df.withColumns({c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in cols}), cols)
    mask = F.lit(0)
    for i, c in enumerate(coords):
        mask = mask + F.when(F.col(c).isNotNull(), F.lit(1 << i)).otherwise(F.lit(0))
    rows = cut(rows.withColumn("known", mask))
    donors = rows.where(F.col(target).isNotNull()).select(target, "known", *coords)
    asking = rows.where(F.col(target).isNull()).select("known", *coords).distinct()
    asking = cut(asking.withColumn("qid", F.monotonically_increasing_id()))
    # at most two to the number of coordinates, each
    gaps = sorted(r[0] for r in asking.select("known").distinct().collect())
    given = sorted(r[0] for r in donors.select("known").distinct().collect())
    found = None
    for a in gaps:
        for shared in sorted({a & d for d in given} - {0}):
            axes = [c for i, c in enumerate(coords) if shared >> i & 1]
            mine = donors.where(F.col("known").bitwiseAND(F.lit(a)) == shared)
            points = _positions(mine, axes, [F.avg(target).alias("mean")])
            near = nearest(points, asking.where(F.col("known") == a), axes, k, same=False, per_cell=per_cell)
            wide = float(np.sqrt(len(coords) / len(axes)))
            hits = near.join(points.select("pid", "mean", *axes), "pid").select(
                "qid",
                (F.col("distance") * F.lit(wide)).alias("distance"),
                F.lit(-len(axes)).alias("fewer"),
                F.lit(shared).alias("shared"),
                F.array(*axes).alias("at"),
                F.col("used").alias("own"),
                "mean",
            )
            found = hits if found is None else found.unionByName(hits)
    overall = F.coalesce(F.lit(donors.agg(F.avg(target)).first()[0]).cast("double"), F.lit(None).cast("double"))
    if found is None:
        return rows.withColumn(target, F.coalesce(F.col(target).cast("double"), overall)).drop("known", *coords)
    best = _first_k(found, k, ["distance", "fewer", "shared", "at"])
    fills = best.groupBy("qid").agg((F.sum(F.col("mean") * F.col("used")) / F.sum("used")).alias("fill"))
    at = asking.join(fills, "qid").select("known", *coords, "fill")
    # a missing coordinate is no key, so it meets as 0 next to the pattern
    keys = {c: F.coalesce(c, F.lit(0.0)) for c in coords}
    joined = skew.lookup(rows.withColumns(keys), at.withColumns(keys), ["known", *coords])
    return joined.withColumn(target, F.coalesce(F.col(target).cast("double"), "fill", overall)).drop("fill", "known", *coords)
