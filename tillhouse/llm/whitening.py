"""Whitening of vectors along the leading principal components of their covariance.

Entries are whole numbers, so that sums and centred entries are exact. The covariance
is never formed: `jacobi_davidson` finds its eigenvectors from centred products, each a pass over
the written vectors in which a task adds up C'(C W) of its rows. The driver holds
vectors of one width only, never rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.llm import jacobi_davidson
from tillhouse.llm.common import cut, ship

#: Rows worked on at a time.
ROWS = 4096


@dataclass
class Whitening:
    """A fit. Components with no variance but rounding have no whitened values."""

    n: int
    sums: np.ndarray
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    passes: int
    identity_error: float | None = None

    @property
    def scales(self) -> np.ndarray:
        """One over the deviation along each component; NaN where there is none."""
        top = self.values.max(initial=0)
        some = self.values > len(self.sums) * jacobi_davidson.EPS * top
        return np.where(some, 1 / np.sqrt(np.where(some, self.values, 1)), np.nan)


def whole(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", factor: int = 1024, shift: int = 100_000) -> DataFrame:
    """`id, x` with x = floor(factor * entry) + shift of the vectors without null or non-finite entries.

    Vectors of another width than most rows have (of equally many: the larger) cannot share their covariance;
    they are left out like vectors with non-finite entries, and so are vectors without entries.
    """
    vector = F.col(vector_col).cast("array<double>")
    finite = F.forall(vector, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    good = rows.where(F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & finite)
    x = F.transform(vector, lambda e: F.floor(e * factor) + F.lit(shift).cast("long"))
    widths = good.groupBy(F.size(vector_col).alias("width")).agg(F.count(F.lit(1)).alias("n"))
    width = widths.agg(F.max(F.struct("n", "width"))["width"]).first()[0]
    return good.where(F.size(vector_col) == F.lit(width)).select(F.col(id_col).alias("id"), x.alias("x"))


def _matrix(batch: pa.RecordBatch, at: int) -> np.ndarray:
    """The vectors of a batch as rows."""
    flat = batch.column(at).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1)


def _blocks(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            part = batch.slice(first, ROWS)
            yield part, _matrix(part, at)


def _add_up(x: DataFrame, of: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """The sum over all rows of `of`(rows of a block), added per task, then by place.

    Its size must not depend on the number of rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, block in _blocks(batches, 0):
            part = of(block)
            total = part if total is None else total + part
        if total is not None:
            places = pa.array(np.arange(total.size, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([places, pa.array(total.ravel())], names=["place", "part"])

    parts = x.select("x").mapInArrow(run, f"place int, part {kind}")
    rows = parts.groupBy("place").agg(F.sum("part").alias("part")).collect()
    return np.array([r.part for r in sorted(rows, key=lambda r: r.place)])


def _centred(block: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n; the difference is taken in whole numbers, so only its size is rounded."""
    return (block * n - sums) / n


def fit(x: DataFrame, components: int = 8) -> Whitening | None:
    """The leading components of the vectors `x` (a written table); None without rows.

    n * entry must fit in 63 bits.
    """
    ship(x.sparkSession)
    head = _add_up(x, lambda b: np.append(b.sum(axis=0), len(b)), "long")
    if not len(head):
        return None
    sums, n = head[:-1], int(head[-1])
    width = len(sums)

    def product(block: np.ndarray) -> np.ndarray:
        def of(b: np.ndarray) -> np.ndarray:
            c = _centred(b, n, sums)
            return c.T @ (c @ block)

        return _add_up(x, of, "double").reshape(width, -1) / n

    found = jacobi_davidson.leading(product, width, components)
    trace = float(_add_up(x, lambda b: np.array([(_centred(b, n, sums) ** 2).sum()]), "double")[0]) / n
    # Either sign will do: the largest entry is positive.
    sign = np.sign(found.vectors[np.abs(found.vectors).argmax(axis=0), np.arange(found.vectors.shape[1])])
    model = Whitening(n, sums, trace, np.maximum(found.values, 0), found.vectors * sign, found.residuals, found.products)
    model.identity_error = _identity_error(x, model)
    return model


def _identity_error(x: DataFrame, model: Whitening) -> float | None:
    """Largest entry of the whitened values' covariance minus the identity, centred before multiplying."""
    some = ~np.isnan(model.scales)
    if not some.any():
        return None
    n, sums, turn = model.n, model.sums, (model.vectors * model.scales)[:, some]
    mean = _add_up(x, lambda b: (_centred(b, n, sums) @ turn).sum(axis=0), "double") / n

    def of(b: np.ndarray) -> np.ndarray:
        z = _centred(b, n, sums) @ turn - mean
        return z.T @ z

    covariance = _add_up(x, of, "double").reshape(len(mean), -1) / n
    return float(np.abs(covariance - np.eye(len(mean))).max())


def _deviation(block: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum of (n * x - sums)^2 of each row, exactly; None where it does not fit in 64 bits."""
    centred = block * n - sums
    if np.abs(centred.astype(float)).max(initial=0) ** 2 * block.shape[1] < 2.0**62:
        return (centred * centred).sum(axis=1).tolist()
    exact = [sum(v * v for v in row) for row in centred.tolist()]
    return [v if v < 2**63 else None for v in exact]


def whiten(x: DataFrame, model: Whitening | None) -> DataFrame:
    """`id, component, n, deviation, whitened, explained, identity_error`: a row per vector and component."""
    result = T.StructType(
        [T.StructField("id", x.schema["id"].dataType)]
        + [T.StructField(c, t()) for c, t in (("component", T.IntegerType), ("n", T.LongType), ("deviation", T.LongType))]
        + [T.StructField(c, T.DoubleType()) for c in ("whitened", "explained", "identity_error")]
    )
    if model is None:
        return x.sparkSession.createDataFrame([], result)
    ship(x.sparkSession)
    n, sums, scales = model.n, model.sums, model.scales
    k = len(scales)
    explained = model.values / model.trace if model.trace > 0 else np.full(k, np.nan)
    error = model.identity_error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, block in _blocks(batches, 1):
            rows = len(block)
            z = (_centred(block, n, sums) @ model.vectors) * scales
            deviation = pa.array(_deviation(block, n, sums), pa.int64())
            each = pa.array(np.repeat(np.arange(rows), k))
            columns = [
                part.column(0).take(each),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, n)),
                deviation.take(each),
                pa.array(z.ravel(), from_pandas=True),
                pa.array(np.tile(explained, rows), from_pandas=True),
                pa.array([error] * (rows * k), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=result.names)

    return x.select("id", "x").mapInArrow(run, result)


def whiten_rows(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 8) -> DataFrame:
    """All usable rows whitened; see `whole` for which are, and `whiten` for the result.

    Rows that repeat an id are rows of their own; a null id is kept. Other columns are ignored. A table without
    usable rows gives none; vectors without variance along a component have null `whitened` there.
    """
    x = cut(whole(rows, id_col, vector_col), "whole_vectors")
    return whiten(x, fit(x, components)).withColumnRenamed("id", id_col)
