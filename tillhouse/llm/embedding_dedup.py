"""Near-duplicate vectors by PCA-ordered tiled comparison.

Vectors are scaled to unit length and turned to the principal axes of all of them, the
axes of most spread first. Two vectors whose cosine reaches the threshold are at most
`r = sqrt(2 - 2 * threshold)` apart, so also along every axis: a grid of width r over the
first axes puts them in the same or in neighbouring cells. Cells are cut into blocks
of bounded size and blocks of neighbouring cells make the tiles.

In a tile, products are summed over leading axes first. What the remaining axes can still
add is at most the product of the two remainders' norms; where even that cannot reach the
threshold the pair is settled. Tiles hand on counts and a spanning forest, never all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.common import cut, ship
from tillhouse.llm.components import components

#: Axes of the grid, vectors in a block, and axes summed between two tests.
GRID_AXES, BLOCK, STRIDE = 2, 4096, 16


def _rows(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Row numbers and rows, as doubles, by width. Lists are whole and finite."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    found = {}
    for width in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == width)
        flat = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        found[width] = at, flat.reshape(-1, width)
    return found


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1; zeros stay. Scaling by the largest entry first avoids overflow."""
    largest = np.abs(rows).max(axis=1, keepdims=True, initial=0.0)
    rows = rows / np.where(largest > 0, largest, 1.0)
    norm = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(norm > 0, norm, 1.0)


def principal_axes(vectors: DataFrame, width: int) -> np.ndarray:
    """Columns: the axes of all unit vectors by falling spread.

    Each task sums up products; one matrix of width x width comes to the driver. Sums are rounded, so
    that the order in which they were added does not show in the axes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for _, rows in _rows(batch.column(0)).values():
                rows = _unit(rows)
                total += rows.T @ rows
        cells = [pa.array(np.repeat(np.arange(width), width)), pa.array(np.tile(np.arange(width), width)), pa.array(total.ravel())]
        yield pa.RecordBatch.from_arrays(cells, names=["i", "j", "x"])

    sums = vectors.select("embedding").mapInArrow(run, "i long, j long, x double").groupBy("i", "j").agg(F.sum("x").alias("x"))
    gram = np.zeros((width, width))
    for row in sums.collect():
        gram[row.i, row.j] = row.x
    gram = np.round((gram + gram.T) / (2 * max(np.trace(gram), 1.0)), 8)
    return np.linalg.eigh(gram)[1][:, ::-1]


def _tails(rows: np.ndarray) -> np.ndarray:
    """Norms of what is left of each row after 0, STRIDE, 2 * STRIDE ... axes."""
    squares = (rows * rows)[:, ::-1].cumsum(axis=1)[:, ::-1]
    starts = range(0, rows.shape[1], STRIDE)
    return np.sqrt(np.stack([squares[:, s] for s in starts] + [np.zeros(len(rows))], axis=1))


def linked_pairs(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of pairs with cosine >= threshold, rows turned to the axes.

    Rounding of the running sums is allowed for; the caller makes the final test.
    """
    slack = 1e-9
    ta, tb = _tails(a), _tails(b)
    width = a.shape[1]
    # The first sums and the bound on the rest in one product: the norms stand as one more axis.
    bounds = np.hstack([a[:, :STRIDE], ta[:, 1:2]]) @ np.hstack([b[:, :STRIDE], tb[:, 1:2]]).T
    ia, ib = np.nonzero(bounds >= threshold - slack)
    left = bounds[ia, ib] - ta[ia, 1] * tb[ib, 1]
    for step, start in enumerate(range(STRIDE, width, STRIDE), 1):
        if not len(ia):
            break
        left = left + np.einsum("ij,ij->i", a[ia, start : start + STRIDE], b[ib, start : start + STRIDE])
        open_ = left + ta[ia, step + 1] * tb[ib, step + 1] >= threshold - slack
        ia, ib, left = ia[open_], ib[open_], left[open_]
    return ia, ib


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest row number each row is connected to."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """`vec_id, n_links, component_id, kept` per row.

    Vectors of one width with cosine >= `threshold`, in double precision, are linked; those of
    different widths have none. The axes are those of the most frequent width (of equally many: the
    larger); vectors of other widths are compared as they are. Vectors that are null, zero, or hold null
    or non-finite values link with nothing, as do rows with a null id. Equal vectors are compared once and
    counted as often as they occur. Other columns are not read.
    """
    spark = vectors.sparkSession
    ship(spark)
    own = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"))
    sound = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == math.inf)) & F.exists("embedding", lambda x: x != 0)
    usable = own.where(F.col("vec_id").isNotNull() & F.coalesce(sound, F.lit(False)))
    # Equal vectors: one of them is compared, with their number as its weight.
    classes = cut(usable.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight")), "vector_classes")
    widths = classes.groupBy(F.size("embedding").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    width = widths.agg(F.max(F.struct("n", "width"))["width"]).first()[0] or 0
    axes = principal_axes(classes.where(F.size("embedding") == F.lit(width)), width)
    tiles = _tiles(classes, axes, threshold)
    cut_tiles = cut(_compare(tiles, threshold), "vector_links")
    others = cut_tiles.where("weight > 0").groupBy("rep").agg(F.sum("weight").alias("others"))
    forest = cut_tiles.where("root is not null").select(F.col("rep").alias("a"), F.col("root").alias("b")).distinct()
    found = components(forest).select(F.col("node").alias("rep"), "component")
    named = classes.join(others, "rep", "left").join(found, "rep", "left").select(
        "embedding", (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component")
    )
    out = own.join(named, "embedding", "left")
    usable_id = F.col("vec_id").isNotNull()
    component = F.when(usable_id, F.coalesce("component", "vec_id"))
    return out.select(
        "vec_id", F.when(usable_id, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )


def _tiles(classes: DataFrame, axes: np.ndarray, threshold: float) -> DataFrame:
    """`tile, side, rep, weight, x`: every block of a cell against those of the cell itself
    and of its later neighbours. Side 0 and 1 are compared; 2 is both."""
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, (at, rows) in _rows(batch.column(0)).items():
                x = _unit(rows)
                if width == len(axes):
                    x = x @ axes
                # A cell's name begins with its width; one axis too few stands as zeros.
                cells = np.zeros((len(x), GRID_AXES + 1), np.int64)
                cells[:, 0] = width
                dims = min(GRID_AXES, width)
                cells[:, 1 : dims + 1] = np.floor(x[:, :dims] / reach)
                lists = [pa.FixedSizeListArray.from_arrays(pa.array(m.ravel()), m.shape[1]).cast(pa.list_(t)) for m, t in ((x, pa.float64()), (cells, pa.int64()))]
                place = pa.array(at)
                yield pa.RecordBatch.from_arrays([batch.column(1).take(place), batch.column(2).take(place), *lists], names=["rep", "weight", "x", "cell"])

    placed = cut(classes.select("embedding", "rep", "weight").mapInArrow(turn, "rep long, weight long, x array<double>, cell array<long>"), "turned")
    # Blocks: as many per cell as its size asks for, members spread over them by hash.
    sizes = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    block = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    placed = placed.join(sizes, "cell").withColumn("block", block)
    # Neighbours that are there: each cell names the later ones among the 3^d around it.
    steps = [[0]]
    for _ in range(GRID_AXES):
        steps = [[*s, d] for s in steps for d in (-1, 0, 1)]
    later = [s for s in steps if s > [0] * (GRID_AXES + 1)]
    offsets = F.array(*[F.array(*[F.lit(int(d)) for d in s]) for s in later])
    near = sizes.select(F.col("cell").alias("c0"), F.col("blocks").alias("b0"), F.explode(F.transform(offsets, lambda o: F.zip_with("cell", o, lambda c, d: c + d))).alias("c1"))
    near = near.join(sizes.select(F.col("cell").alias("c1"), F.col("blocks").alias("b1")), "c1").select("c0", "b0", "c1", "b1")
    same = sizes.select(F.col("cell").alias("c0"), F.col("blocks").alias("b0"), F.col("cell").alias("c1"), F.col("blocks").alias("b1"))
    name = lambda c, b: F.concat_ws(",", F.col(c).cast("array<string>"), F.col(b).cast("string"))
    pairs = near.unionByName(same).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("b0") - 1)))
    pairs = pairs.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("b1") - 1))).where((F.col("c0") != F.col("c1")) | (F.col("i") <= F.col("j")))
    pairs = pairs.select(name("c0", "i").alias("left"), name("c1", "j").alias("right"))
    tile = F.concat_ws("|", "left", "right")
    sides = pairs.where("left = right").select(F.col("left").alias("at"), tile.alias("tile"), F.lit(2).alias("side"))
    apart = pairs.where("left != right")
    sides = sides.unionByName(apart.select(F.col("left").alias("at"), tile.alias("tile"), F.lit(0).alias("side")))
    sides = sides.unionByName(apart.select(F.col("right").alias("at"), tile.alias("tile"), F.lit(1).alias("side")))
    members = placed.select(F.concat_ws(",", F.col("cell").cast("array<string>"), F.col("block").cast("string")).alias("at"), "rep", "weight", "x")
    return members.join(sides, "at").select("tile", "side", "rep", "weight", "x")


def _compare(tiles: DataFrame, threshold: float) -> DataFrame:
    """`rep, weight, root`: what each vector of a tile is linked with there, in number, and
    the root it hangs on. A tile has at most some BLOCKs of vectors, all of one width."""

    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        ids, weight = table.column("rep").to_numpy(), table.column("weight").to_numpy()
        x = table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        one, two = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        counts = np.zeros(len(ids), np.int64)
        tree: tuple[list, list] = ([], [])
        for a in range(0, len(one), 256):
            ia, ib = linked_pairs(x[one[a : a + 256]], x[two], threshold)
            i, j = one[a + ia], two[ib]
            if len(i):
                exact = np.einsum("ij,ij->i", x[i], x[j])
                keep = (exact >= threshold) & (i != j)
                i, j = i[keep], j[keep]
            np.add.at(counts, i, weight[j])
            cross = side[j] == 1
            np.add.at(counts, j[cross], weight[i[cross]])
            # The forest so far and the new links, reduced to a forest again.
            root = _forest(len(ids), np.concatenate([*tree[0][-1:], i]), np.concatenate([*tree[1][-1:], j]))
            hang = np.flatnonzero(root != np.arange(len(ids)))
            tree = ([hang], [root[hang]])
        hang, root = (tree[0][0], tree[1][0]) if tree[0] else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        roots = np.full(len(ids), -1, np.int64)
        roots[hang] = root
        used = np.flatnonzero((counts > 0) | (roots >= 0))
        out_root = pa.array(np.where(roots[used] >= 0, ids[roots[used]], 0), mask=roots[used] < 0)
        return pa.table({"rep": pa.array(ids[used], pa.int64()), "weight": pa.array(counts[used], pa.int64()), "root": out_root})

    return tiles.groupBy("tile").applyInArrow(run, "rep long, weight long, root long")
