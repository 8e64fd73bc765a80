"""INT-4 on grids past one task: the kernel matrix inverted panel by panel, fills from rows of the inverse.

All timestamps share the grid, so the kernel ``A = phi(|x_i - x_j|) - smooth I`` over all G nodes is
inverted once.  The matrix lies in the shared folder as row panels of ``block`` rows, one file each.
Block Gauss-Jordan takes one step per panel: a task inverts the pivot block and scales its panel,
then every other panel is updated by a task of its own, from its file and the pivot panel, into
the next version.  Newton steps ``B + (I - B A) B`` take out the rounding errors of the
elimination, again panel by panel, with ``A`` made from the coordinates where it is needed.  A task
holds a few panels, block x G numbers, never the matrix; a file appears whole or not at all, so a
task that fails is run again from the version before.  No pivoting is needed: the multiquadric
matrix of distinct points less a positive shift has one positive and otherwise negative eigenvalues, in
every principal part, so no pivot block is singular.

With ``B`` the inverse, known nodes K and missing nodes U, the interpolant through the known values
has at U the values ``-B_UU^-1 B_UK y_K`` (the block form of ``A_UK A_KK^-1 y_K``).  A timestamp
so costs a solve of its missing nodes only, and reads their rows of ``B`` by byte range.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators.interp import guarded, split_by_need
from gridloom.operators.joins import dimension_join
from gridloom.operators.scan import prefix_sums
from gridloom.session import cut_lineage, scratch_path
from gridloom.sources.storage import filesystem, qualified

#: bytes of inverse rows that a worker keeps
CACHED_BYTES = 256 << 20
#: largest entry of ``I - B A`` that is good enough, and Newton steps at most
RESIDUAL, _ROUNDS = 1e-8, 6


@dataclass(frozen=True)
class KernelInverse:
    """Row panels ``<i>.f64`` of ``block`` rows each in ``folder``; ``nodes`` maps a node to its row."""

    folder: str
    size: int
    block: int
    nodes: DataFrame
    node: str


def _multiquadric(a: np.ndarray, b: np.ndarray, epsilon: float) -> np.ndarray:
    r2 = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(r2, 0.0) / (epsilon * epsilon) + 1.0)


class _Panels:
    """Row panels of one version of a matrix in a folder; ``points`` are the scaled coordinates of its nodes."""

    def __init__(self, folder: str, size: int, block: int):
        self.fs, self.root = filesystem(folder)
        self.size, self.block = size, block

    def span(self, k: int) -> slice:
        return slice(k * self.block, min(self.size, (k + 1) * self.block))

    def read(self, version: str, k: int) -> np.ndarray:
        with self.fs.open_input_file(f"{self.root}/{version}/{k}.f64") as f:
            return np.frombuffer(f.read(), np.float64).reshape(-1, self.size)

    def write(self, version: str, k: int, panel: np.ndarray) -> None:
        self.fs.create_dir(f"{self.root}/{version}", recursive=True)
        pending = f"{self.root}/{version}/{k}.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(pending) as out:
            out.write(np.ascontiguousarray(panel).tobytes())
        self.fs.move(pending, f"{self.root}/{version}/{k}.f64")

    def points(self) -> np.ndarray:
        with self.fs.open_input_file(f"{self.root}/points.f64") as f:
            return np.frombuffer(f.read(), np.float64).reshape(-1, 2)


def _kernel(points: np.ndarray, rows: slice, epsilon: float, smooth: float) -> np.ndarray:
    """Rows of the kernel matrix."""
    a = _multiquadric(points[rows], points, epsilon)
    k = np.arange(rows.start, rows.stop)
    a[k - rows.start, k] = 1.0 - smooth  # exact, where the squared distance may be off by rounding
    return a


def _each(spark: SparkSession, panels: list[int], work: Callable[[int], float]) -> float:
    """``work`` for every panel, one task each; the largest of the numbers it gives."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column("panel").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([float(work(k))])], ["top"])

    if not panels:
        return 0.0
    todo = spark.createDataFrame([(k,) for k in panels], "panel long").repartition(len(panels), "panel")
    return todo.mapInArrow(run, "top double").agg(F.max("top")).first()[0]


def _invert(spark: SparkSession, folder: str, size: int, block: int, epsilon: float, smooth: float) -> str:
    """The inverse's version: elimination over all panels, then Newton steps."""
    n = -(-size // block)

    def start(k: int) -> float:
        p = _Panels(folder, size, block)
        p.write("0", k, _kernel(p.points(), p.span(k), epsilon, smooth))
        return 0.0

    _each(spark, list(range(n)), start)
    for step in range(n):
        def pivot(k: int) -> float:
            p = _Panels(folder, size, block)
            panel = p.read(str(k), k)
            inverse = np.linalg.inv(panel[:, p.span(k)])
            scaled = inverse @ panel
            scaled[:, p.span(k)] = inverse
            p.write(str(k + 1), k, scaled)
            return 0.0

        def update(k: int, step: int = step) -> float:
            p = _Panels(folder, size, block)
            panel, row, at = p.read(str(step), k).copy(), p.read(str(step + 1), step), p.span(step)
            left = panel[:, at].copy()
            panel[:, at] = 0.0
            p.write(str(step + 1), k, panel - left @ row)
            return 0.0

        _each(spark, [step], pivot)
        _each(spark, [k for k in range(n) if k != step], update)

    version, last = str(n), np.inf
    for _ in range(_ROUNDS):
        def refine(k: int, version: str = version) -> float:
            p = _Panels(folder, size, block)
            points, own = p.points(), p.read(version, k)
            defect = np.zeros_like(own)
            for j in range(n):  # columns j of A are its rows j, turned
                defect[:, p.span(j)] = -(own @ _kernel(points, p.span(j), epsilon, smooth).T)
            rows = np.arange(p.span(k).start, p.span(k).stop)
            defect[rows - rows[0], rows] += 1.0
            better = own.copy()
            for j in range(n):
                better += defect[:, p.span(j)] @ p.read(version, j)
            p.write(f"{version}r", k, better)
            return np.abs(defect).max()

        top = _each(spark, list(range(n)), refine)
        if top >= last:
            break  # the version before is as good as it gets
        version, last = f"{version}r", top
        if top <= RESIDUAL:
            break
    return version


def kernel_inverse(grid: DataFrame, node: str = "grid_id", lon: str = "lon_center", lat: str = "lat_center",
                   epsilon: float = 2.0, smooth: float = 1e-6, block: int = 256) -> KernelInverse:
    """Invert the kernel of a grid (one row per node); coordinates are z-scored over the nodes as in the dense form.

    The coordinates of all nodes, 16 bytes each, are one small file that every task reads.
    """
    spark = grid.sparkSession
    n, mx, my, sx, sy = grid.agg(F.count(F.lit(1)), F.avg(lon), F.avg(lat), F.stddev_pop(lon), F.stddev_pop(lat)).first()  # five numbers
    nodes = cut_lineage(prefix_sums(grid.select(F.col(node).alias("node"), F.col(lon).alias("x"), F.col(lat).alias("y"),
                                                F.lit(1).alias("one")), ["node"], "one", "row"))
    scaled = nodes.select("row", ((F.col("x") - mx) / (sx or 1.0)).alias("x"), ((F.col("y") - my) / (sy or 1.0)).alias("y"))
    folder = qualified(spark, scratch_path(spark, "kernel"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = np.empty((n, 2))
        for batch in batches:
            points[batch.column("row").to_numpy()] = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("x", "y")])
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        pending = f"{root}/points.{uuid.uuid4().hex}"
        with fs.open_output_stream(pending) as out:
            out.write(points.tobytes())
        fs.move(pending, f"{root}/points.f64")
        yield pa.RecordBatch.from_arrays([pa.array([len(points)], pa.int64())], ["n"])

    scaled.coalesce(1).mapInArrow(place, "n long").first()
    version = _invert(spark, folder, n, block, epsilon, smooth)
    return KernelInverse(f"{folder}/{version}", n, block, nodes.select(F.col("node").alias(node), F.col("row").alias("__row")), node)


class _Rows:
    """Rows of the inverse, read by byte range and kept up to ``CACHED_BYTES``."""

    def __init__(self, folder: str, size: int, block: int):
        self.fs, self.root = filesystem(folder)
        self.size, self.block = size, block
        self.kept: OrderedDict[int, np.ndarray] = OrderedDict()

    def take(self, rows: np.ndarray) -> np.ndarray:
        out = np.empty((len(rows), self.size))
        by_panel: dict[int, list[int]] = {}
        for k, row in enumerate(rows.tolist()):
            if row in self.kept:
                self.kept.move_to_end(row)
                out[k] = self.kept[row]
            else:
                by_panel.setdefault(row // self.block, []).append(k)
        for panel, places in by_panel.items():
            with self.fs.open_input_file(f"{self.root}/{panel}.f64") as f:
                for k in places:
                    row = int(rows[k])
                    f.seek((row - panel * self.block) * self.size * 8)
                    out[k] = np.frombuffer(f.read(self.size * 8), np.float64)
                    self.kept[row] = out[k].copy()
        while len(self.kept) * self.size * 8 > CACHED_BYTES and len(self.kept) > 1:
            self.kept.popitem(last=False)
        return out


@lru_cache(maxsize=4)
def _rows(folder: str, size: int, block: int) -> _Rows:
    return _Rows(folder, size, block)


def fill_from_inverse(values: np.ndarray, rows_of) -> np.ndarray:
    """Fill the NaN rows (the same in every column) of ``values`` [nodes, columns]; ``rows_of`` gives rows of the inverse."""
    nan = np.isnan(values[:, 0])
    missing = np.flatnonzero(nan)
    b = rows_of(missing)
    out = values.copy()
    out[missing] = -np.linalg.solve(b[:, missing], b[:, ~nan] @ values[~nan])
    return out


def spatial_pass_tiled(df: DataFrame, columns: list[str], inverse: KernelInverse, ts: str = "ts", threshold: float = 0.2,
                       error_col: str | None = None) -> DataFrame:
    """INT-4 with a tiled inverse: as ``interp.spatial_pass``, for timestamps that hold every node once.

    A timestamp with gaps that lacks a node or holds one twice can't be solved; it raises, or with
    ``error_col`` it comes back unchanged with the reason in that column.
    """
    schema, size, block, folder = df.schema, inverse.size, inverse.block, inverse.folder

    def per_time(pdf: pd.DataFrame) -> pd.DataFrame:
        vals = pdf[columns].to_numpy(dtype=float, na_value=np.nan)
        nan = np.isnan(vals)
        share = nan.mean(axis=0)
        todo = [j for j in range(len(columns)) if 0 < share[j] <= threshold and not nan[:, j].all()]
        if not todo:
            return pdf.drop(columns="__row")
        row = pdf["__row"].to_numpy(dtype=float, na_value=-1.0).astype(np.int64)
        if len(row) != size or not np.array_equal(np.sort(row), np.arange(size)):
            raise ValueError(f"{len(np.unique(row[row >= 0]))} of {size} nodes in {len(row)} rows")
        order = np.argsort(row)
        patterns: dict[bytes, list[int]] = {}
        for j in todo:
            patterns.setdefault(nan[:, j].tobytes(), []).append(j)
        for cols in patterns.values():
            filled = np.empty((size, len(cols)))
            filled[order] = fill_from_inverse(vals[order][:, cols], _rows(folder, size, block).take)
            if not np.isfinite(filled[nan[:, cols[0]]]).all():
                raise ValueError("the solution is not finite")
            vals[:, cols] = filled
        out = pdf.drop(columns="__row").copy()
        for j, c in enumerate(columns):
            out[c] = vals[:, j]
        return out

    numbered = dimension_join(df, inverse.nodes, inverse.node, "left").select(*df.columns, "__row")
    todo, done = split_by_need(numbered, [ts], columns, threshold)
    return guarded(todo, [ts], per_time, schema, done.drop("__row"), error_col)
