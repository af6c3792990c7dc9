"""A side table of a fact's keys, so that a load reads only the files that may hold its own.

Keys are dealt to a fixed number of buckets by their hash and sorted. What one load adds to
a bucket is a unit: a folder of files with keys, and one row in the table of units with the least and
greatest hash and a Bloom filter. A batch is held against the units of its buckets
first; only the folders that may hold one of its keys are read.

The filter is an array of 64-bit words. A key sets four bits in each of two words; with half a
word per key about one key in 10^5 is taken for one that is there. Choose the number of buckets so
that a unit has some million keys at most.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.session import DROP_SHUFFLES, settings

BUCKETS = 16
#: Bits of the filter per key.
BITS_PER_KEY = 32
#: Words of a filter that are sorted at once.
PART = 1 << 14
#: Of a batch with at least so many rows, one key in `SHOWN` is held against the units first.
MANY, SHOWN = 1 << 20, 1 << 14
#: A larger batch is inserted bucket by bucket, so that what its joins shuffle is not on disk all at once.
ROWS_AT_ONCE = 1 << 26
COMPRESSION = "zstd"

UNITS = "load string, bucket int, n_keys long, n_words int, least long, greatest long, words array<long>"


def hashes(keys: list[str]) -> tuple[Column, Column]:
    """Two hashes of a key that do not follow from each other."""
    columns = [F.col(k) for k in keys]
    return F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)


def _bits(hash_: Column) -> Column:
    """A word with four bits set."""
    one = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(hash_, 6 * i).bitwiseAND(63).cast("int"))
    return one(0).bitwiseOR(one(1)).bitwiseOR(one(2)).bitwiseOR(one(3))


def _places(n_words: Column) -> list[tuple[Column, Column]]:
    """Which word a key uses and the bits it sets there, twice."""
    h, g = F.col("hash"), F.col("hash2")
    place = lambda v: F.pmod(F.shiftright(v, 24), n_words.cast("long")).cast("int")
    return [(place(h), _bits(g)), (place(g), _bits(h))]


def bucket_of(hash_: Column, buckets: int) -> Column:
    return F.pmod(hash_, F.lit(buckets)).cast("int")


def with_hashes(rows: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """The keys, repeated ones too, with `hash, hash2, bucket`."""
    first, second = hashes(keys)
    found = rows.select(*keys).withColumns({"hash": first, "hash2": second})
    return found.withColumn("bucket", bucket_of(F.col("hash"), buckets))


def units_of(keys: DataFrame, load: str) -> DataFrame:
    """A row per bucket of one load's keys (a written table), in the shape of `UNITS`."""
    counted = keys.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n_keys"), F.min("hash").alias("least"), F.max("hash").alias("greatest")
    )
    # One row per bucket, of which there is a fixed number.
    sized = F.broadcast(counted.withColumn("n_words", F.ceil(F.col("n_keys") * BITS_PER_KEY / 64).cast("int")))
    sizes = sized.select("bucket", "n_words")
    set_bits = keys.join(sizes, "bucket").select(
        "bucket", F.explode(F.array(*[F.struct(w.alias("word"), b.alias("bits")) for w, b in _places(F.col("n_words"))])).alias("p")
    )
    unset = sizes.select("bucket", F.explode(F.sequence(F.lit(0), F.col("n_words") - 1)).alias("word"), F.lit(0).cast("long").alias("bits"))
    words = set_bits.select("bucket", "p.word", "p.bits").unionByName(unset).groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))
    # Put together part by part, so that no task sorts all words of a bucket.
    part = F.expr(f"word div {PART}").alias("part")
    parts = words.groupBy("bucket", part).agg(F.array_sort(F.collect_list(F.struct("word", "bits")))["bits"].alias("bits"))
    filters = parts.groupBy("bucket").agg(F.flatten(F.array_sort(F.collect_list(F.struct("part", "bits")))["bits"]).alias("words"))
    return sized.join(filters, "bucket").select(F.lit(load).alias("load"), "bucket", "n_keys", "n_words", "least", "greatest", "words")


def may_hold() -> Column:
    """Whether the unit beside a key may hold it."""
    def set_in(place: Column, bits: Column) -> Column:
        return F.get("words", place).bitwiseAND(bits) == bits

    (a, in_a), (b, in_b) = _places(F.col("n_words"))
    return F.col("hash").between(F.col("least"), F.col("greatest")) & set_in(a, in_a) & set_in(b, in_b)


@dataclass(frozen=True)
class KeyIndex:
    """The index of one fact: folders of keys and of units, by load."""

    spark: SparkSession
    keys: tuple[str, ...]
    keys_root: str
    units_root: str
    buckets: int = BUCKETS

    def write(self, load: str, rows: DataFrame) -> None:
        """Writes the keys of a load's rows (a written table) and their units. Nothing is visible yet.

        Hashes are random bytes, so they are not kept: the units are made of hashes worked out again.
        """
        keys = list(self.keys)
        found = with_hashes(rows, keys, self.buckets).select(*keys, "bucket")
        laid_out = found.hint("rebalance", "bucket").sortWithinPartitions("bucket", *keys)
        with settings(self.spark, DROP_SHUFFLES):
            laid_out.write.partitionBy("bucket").parquet(f"{self.keys_root}/{load}", compression=COMPRESSION)
            written = self._open([f"{self.keys_root}/{load}"], rows)
            units_of(with_hashes(written, keys, self.buckets), load).write.parquet(f"{self.units_root}/{load}")

    def _open(self, paths: list[str], like: DataFrame) -> DataFrame:
        fields = ", ".join(f"`{k}` {like.schema[k].dataType.simpleString()}" for k in self.keys)
        schema = f"{fields}, bucket int"
        return self.spark.read.schema(schema).option("basePath", self.keys_root).parquet(*paths)

    def units(self, loads: list[str]) -> DataFrame:
        return self.spark.read.schema(UNITS).parquet(*[f"{self.units_root}/{load}" for load in loads])

    def holding(self, loads: list[str], batch: DataFrame, n_rows: int = 0) -> set[tuple[str, int]]:
        """Load and bucket of the units that may hold a key of the batch.

        They are brought to the driver: names of folders, at most buckets times loads. In a batch
        known to be large a few keys find most units that hold a good part of it; all keys are held against
        the others only.
        """
        if not loads:
            return set()
        # Only hashes are moved.
        probes, units = with_hashes(batch, list(self.keys), self.buckets).select("hash", "hash2", "bucket"), self.units(loads)
        hits: set[tuple[str, int]] = set()
        if n_rows >= MANY:
            few = probes.where(F.pmod("hash2", F.lit(SHOWN)) == 0)
            hits = self._holding(units.join(F.broadcast(few), "bucket"))
            found = self.spark.createDataFrame([*hits], "load string, bucket int")
            units = units.join(F.broadcast(found), ["load", "bucket"], "left_anti")
        if not hits or not units.select("load").isEmpty():
            hits |= self._holding(probes.distinct().join(units, "bucket"))
        return hits

    def read(self, units: set[tuple[str, int]], like: DataFrame) -> DataFrame | None:
        """The keys of some units; None of none."""
        paths = [f"{self.keys_root}/{load}/bucket={bucket}" for load, bucket in sorted(units)]
        return self._open(paths, like).select(*self.keys) if paths else None

    def rounds(self, n_rows: int) -> list[set[int]]:
        """The buckets in as many parts as a batch of so many rows is taken in."""
        n = max(1, min(self.buckets, -(-n_rows // ROWS_AT_ONCE)))
        return [{b for b in range(self.buckets) if b * n // self.buckets == i} for i in range(n)]

    def of_buckets(self, rows: DataFrame, buckets: set[int]) -> DataFrame:
        """Rows whose key belongs to some of the buckets."""
        if len(buckets) == self.buckets:
            return rows
        return rows.where(bucket_of(hashes(list(self.keys))[0], self.buckets).isin(*buckets))

    @staticmethod
    def _holding(pairs: DataFrame) -> set[tuple[str, int]]:
        """Load and bucket of the units that may hold the key beside them."""
        return {(r["load"], r["bucket"]) for r in pairs.where(may_hold()).select("load", "bucket").distinct().collect()}
