"""Near-duplicate documents by min-max hashing.

A document is the set of its word shingles. Under each of the permutations both the
smallest and the largest value are kept, so a signature of 2k entries costs k hash
evaluations per shingle; each entry agrees for two sets with the probability of their
Jaccard similarity, and a minimum and a maximum are less alike than two minima. Bands of
entries propose pairs, and full sets confirm them.

Documents with the same set are one class and only its smallest member is banded. Within a
bucket every class is compared with a few centers first; what that leaves in more
than one component is compared in full, the links found so far saving the rest. So a
large group of copies costs rows in proportion to its size. Of the pairs that the bands propose, those
compared in full pass exact bounds and a test of sketches first; the sketches turn a pair at the threshold
away with a probability of 1e-6.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.common import cut, ship
from tillhouse.llm.components import components
from tillhouse.llm.rolling import mix, shingles

#: Permutations, and entries per band: 240 entries in 40 bands of 6. A pair at
#: similarity 0.8 shares a band with probability 1 - 5e-6, one at 0.5 with 0.47.
PERMUTATIONS, ROWS = 120, 6
BANDS = 2 * PERMUTATIONS // ROWS
#: Places of a filter of ids, a power of two.
FILTER = 1 << 21
#: Classes of shingles in a profile, a power of two.
CLASSES = 64
_RNG = np.random.Generator(np.random.PCG64(7))
FACTORS = _RNG.integers(0, 2**64, PERMUTATIONS, dtype=np.uint64) | np.uint64(1)
OFFSETS = _RNG.integers(0, 2**64, PERMUTATIONS, dtype=np.uint64)


def signature(values: np.ndarray) -> np.ndarray:
    """Minima and maxima in turn of the shingles' values under each permutation."""
    low = np.full(PERMUTATIONS, 2**64 - 1, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for a in range(0, len(values), 512):
        permuted = values[a : a + 512, None] * FACTORS + OFFSETS
        np.minimum(low, permuted.min(axis=0), out=low)
        np.maximum(high, permuted.max(axis=0), out=high)
    return np.stack([low, high], axis=1).ravel()


def sketch(values: np.ndarray) -> np.ndarray:
    """Four bits of each entry of the signature, 16 entries to a value."""
    bits = mix(signature(values)).reshape(-1, 16) & np.uint64(15)
    return np.bitwise_or.reduce(bits << (np.arange(16, dtype=np.uint64) * np.uint64(4)), axis=1)


def bands(values: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; keys of different bands differ."""
    entries = signature(values).reshape(BANDS, ROWS)
    keys = np.arange(BANDS, dtype=np.uint64)
    for i in range(ROWS):
        keys = mix(keys + entries[:, i])
    return keys


def shingle_sets(docs: DataFrame, size: int, id_col: str = "doc_id", text_col: str = "text", banded: bool = True, only: np.ndarray | None = None) -> DataFrame:
    """`doc_id, n_shingles, set_hi, set_lo, shingles`, and `bands` or else `sketch`, of each whole text.

    `set_hi, set_lo` name the set. A null text, or one without words, has the empty set.
    `only` is a filter of ids, see `_id_filter`.
    """
    ship(docs.sparkSession)
    chosen = None if only is None else docs.sparkSession.sparkContext.broadcast(only)
    fields = "doc_id long, n_shingles long, set_hi long, set_lo long, shingles array<long>, " + ("bands array<long>" if banded else "sketch array<long>")

    def as_lists(arrays: list[np.ndarray]) -> pa.ListArray:
        ends = np.zeros(len(arrays) + 1, np.int32)
        np.cumsum([len(x) for x in arrays], out=ends[1:])
        flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if chosen is not None:
                at = _filter_place(batch.column(0).to_numpy())
                batch = batch.filter(pa.array(chosen.value[at]))
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                sets = [shingles((t or "").encode(), size) for t in part.column(1).to_pylist()]
                hi = [int(mix(s + np.uint64(1)).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0 for s in sets]
                lo = [int(np.bitwise_xor.reduce(mix(s * np.uint64(0x9E3779B97F4A7C15))).view(np.int64)) if len(s) else 0 for s in sets]
                columns = [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), as_lists(sets)]
                columns.append(as_lists([(bands if banded else sketch)(s) if len(s) else s for s in sets]))
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in fields.split(", ")])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col).mapInArrow(run, fields)


def _filter_place(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64)) & np.uint64(FILTER - 1)).astype(np.int64)


def _id_filter(ids: DataFrame) -> np.ndarray:
    """Marks the places that the ids hash to, to spare most other texts from being moved.

    Some more ids may pass, more of them the fuller it is: an exact join has to
    follow. At most FILTER places come to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.zeros(FILTER, bool)
        for batch in batches:
            marks[_filter_place(batch.column(0).to_numpy())] = True
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(marks))], names=["place"])

    out = np.zeros(FILTER, bool)
    out[ids.mapInArrow(run, "place long").distinct().toArrow().column(0).to_numpy()] = True
    return out


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The `a, b` pairs whose sets are as alike as `percent` asks, by exact counts."""
    one = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("s"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("t"))
    both = F.size(F.array_intersect("s", "t"))
    return pairs.join(one, "a").join(two, "b").where(100 * both >= percent * (F.size("s") + F.size("t") - both)).select("a", "b")


def _unlike(a: str, b: str) -> Column:
    """How many entries of two sketches differ."""

    def differing(i: int) -> Column:
        x = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        return F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))

    return sum((differing(i) for i in range(1, 2 * PERMUTATIONS // 16)), differing(0))


def _most_unlike(percent: int) -> int:
    n, p = 2 * PERMUTATIONS, (1 - percent / 100) * 15 / 16
    return math.ceil(n * p + 4.75 * math.sqrt(n * p * (1 - p)))


def _enough(shared: Column, percent: int) -> Column:
    return 100 * shared >= percent * (F.col("n_a") + F.col("n_b") - shared)


def _profiles(known: DataFrame) -> DataFrame:
    """`rep, n, sketch, common, profile` of sets: how many of their shingles another of
    these sets has too, in all and by class of shingles."""
    each = known.select(F.col("doc_id").alias("rep"), F.explode("shingles").alias("shingle"))
    shared = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("shingle")
    own = each.join(shared, "shingle").groupBy("rep").agg(F.collect_list("shingle").alias("held"))
    rows = known.select(F.col("doc_id").alias("rep"), F.size("shingles").alias("n"), "sketch").join(own, "rep", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [np.array(x or [], np.int64) for x in batch.column(3).to_pylist()]
            profiles = [np.bincount(h & (CLASSES - 1), minlength=CLASSES).tolist() for h in held]
            columns = [*batch.columns[:3], pa.array([len(h) for h in held], pa.int32()), pa.array(profiles, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["rep", "n", "sketch", "common", "profile"])

    return rows.mapInArrow(run, "rep long, n int, sketch array<long>, common int, profile array<int>")


def _with_component(reps: DataFrame, found: DataFrame) -> DataFrame:
    return reps.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id, n_shingles, component_id, kept` per row.

    Documents whose Jaccard similarity is at least `percent` are linked; a component
    is named by its smallest id, and that document is the one kept. Documents without words
    are linked with nothing. Rows with a null id have no component, are compared with
    nothing and kept. Rows that repeat an id with the same text stay, as copies; ids
    are taken to name one text. Other columns are not read.
    """
    rows = shingle_sets(docs, size, id_col, text_col).drop("shingles")
    rows = cut(rows, "signatures")
    filled = rows.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    # Copies: one class per set, banded by its smallest member only.
    classes = cut(filled.groupBy("set_hi", "set_lo").agg(F.min("doc_id").alias("rep")), "classes")
    own = filled.select("doc_id", "set_hi", "set_lo", "bands")
    reps = own.join(classes.withColumnRenamed("rep", "doc_id"), ["doc_id", "set_hi", "set_lo"]).dropDuplicates(["doc_id"])
    banded = reps.select(F.col("doc_id").alias("rep"), F.explode("bands").alias("band"))
    sizes = banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = cut(banded.join(sizes, "band"), "members")
    # Centers of a bucket: the class that meets most others over all its buckets, which
    # is what variants of one text have in common, the smallest, and one by hash.
    met = members.groupBy("rep").agg(F.sum("n").alias("met"))
    members = cut(members.join(met, "rep"), "buckets")
    centers = members.groupBy("band").agg(F.max(F.struct("met", -F.col("rep"))).alias("most"), F.min("rep").alias("least"), F.max(F.struct(F.xxhash64("rep"), "rep")).alias("any"))
    centers = centers.select("band", F.explode(F.array_distinct(F.array(-F.col("most")["col2"], "least", "any.rep"))).alias("center"))
    star = members.join(centers, "band").where(F.col("rep") != F.col("center"))
    star = cut(star.select(F.least("center", "rep").alias("a"), F.greatest("center", "rep").alias("b")).distinct(), "star_pairs")
    # Whole sets of the documents in shared buckets only, from the texts once more.
    wanted = members.select(F.col("rep").alias("doc_id")).distinct()
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    sets = shingle_sets(texts, size, banded=False, only=_id_filter(wanted)).select("doc_id", "shingles", "sketch")
    sets = cut(sets.join(wanted, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "sets")
    links = cut(_confirmed(star, sets, percent), "star_links")
    found = components(links)
    # What a bucket still holds of different components is compared in full.
    placed = _with_component(members.select("band", "rep"), found)
    mixed = placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("band")
    open_ = cut(placed.join(mixed, "band").select("band", "rep", "component"), "open_buckets")
    if not open_.isEmpty():
        # Tests before a pair is formed, cheapest first. Shingles that no other open class has
        # cannot be shared; sketches may differ in no more entries than a pair at the
        # threshold does with probability 1 - 1e-6; and no more can be shared
        # than class by class of shingles.
        known = sets.join(open_.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
        open_ = open_.join(_profiles(known), "rep")
        one, two = (open_.select("band", F.col("rep").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("component", "n", "common", "sketch", "profile")]) for x in "ab")
        may = (F.col("a") < F.col("b")) & (F.col("component_a") != F.col("component_b"))
        may = may & _enough(F.least("common_a", "common_b"), percent) & (_unlike("sketch_a", "sketch_b") <= _most_unlike(percent))
        overlap = F.aggregate(F.zip_with("profile_a", "profile_b", lambda x, y: F.least(x, y)), F.lit(0), lambda total, x: total + x)
        may = may & _enough(overlap, percent)
        rest = one.join(two, (one.band == two.band) & may).select("a", "b").distinct()
        rest = rest.join(star, ["a", "b"], "left_anti")
        more = cut(_confirmed(rest, sets, percent), "more_links")
        if not more.isEmpty():
            # What was found before goes in as stars, not as its links again.
            found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
    named = classes.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left")
    named = named.select("set_hi", "set_lo", F.coalesce("component", "rep").alias("found_id"), F.lit(True).alias("named"))
    out = rows.select("doc_id", "n_shingles", "set_hi", "set_lo").join(named, ["set_hi", "set_lo"], "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("found_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
