"""What several operators of this package need."""

import gc
import io
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.session import shared_folder

MASK = (1 << 64) - 1


def shared_file(spark: SparkSession, content: bytes, label: str, suffix: str) -> str:
    """Path of a new file in the shared folder, which any Hadoop file system may hold."""
    path = spark._jvm.org.apache.hadoop.fs.Path(
        f"{shared_folder(spark, label)}/{label}-{uuid.uuid4().hex}{suffix}"
    )
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    stream.write(content)
    stream.close()
    return path.toString()


def ship(spark: SparkSession) -> None:
    """Gives the package to the executors, once for each application."""
    _ship(spark, spark.sparkContext.applicationId)


@cache
def _ship(spark: SparkSession, _application: str) -> None:
    package, content = Path(__file__).resolve().parent.parent, io.BytesIO()
    with zipfile.ZipFile(content, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(shared_file(spark, content.getvalue(), "repopulse", ".zip"))


def materialised(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the cluster's shared folder: computed once, lineage cut.

    An executor that is lost later costs nothing, since all readers go to the table.
    """
    path = shared_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column of ``df`` is called so."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def discard(df: DataFrame) -> None:
    """Deletes the folder of a ``materialised`` table that no later table is read from."""
    for folder in {str(Path(file).parent) for file in df.inputFiles()}:
        discard_folder(df.sparkSession, folder.replace("file:/", "file:///", 1))


def discard_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner delete the shuffles of tables that nothing refers to any more."""
    gc.collect()
    spark._jvm.System.gc()


#: Bits of a ``KeyFilter``: 8 MB, whatever is put in.
FILTER_BITS = 1 << 26


class KeyFilter:
    """A filter of fixed size over a column of 64-bit keys: it may pass others, and loses none.

    Of far fewer keys than ``FILTER_BITS`` it passes hardly any others; of many more it
    passes everything, and what follows does all the work. At most 2,048 bitmaps of 4 KB
    reach the driver, and the executors get them as one array.
    """

    def __init__(self, keys: DataFrame, key: str):
        spark = keys.sparkSession
        place = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS).cast("long"))
        places = keys.select(place.alias("place"))
        bucket, position = F.bitmap_bucket_number("place"), F.bitmap_bit_position("place")
        maps = places.groupBy(bucket.alias("bucket")).agg(F.bitmap_construct_agg(position).alias("bits"))
        bits = np.zeros((FILTER_BITS // 32768 + 1, 4096), np.uint8)
        for row in maps.collect():
            bits[row["bucket"]] = np.frombuffer(row["bits"], np.uint8)
        self.bits = spark.sparkContext.broadcast(bits)

    def passes(self, key: Column) -> Column:
        bits = self.bits

        @F.arrow_udf("boolean")
        def found(places: pa.Array) -> pa.Array:
            at = places.to_numpy(zero_copy_only=False)
            # As Spark numbers bitmaps: 1 to 32768 are in the first.
            bucket, position = np.where(at > 0, 1 + (at - 1) // 32768, 0), np.where(at > 0, (at - 1) % 32768, 0)
            return pa.array((bits.value[bucket, position // 8] >> (position % 8).astype(np.uint8)) & 1 == 1)

        return found(F.pmod(F.xxhash64(key), F.lit(FILTER_BITS).cast("long")))


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = values.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & MASK)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Remembered(dict):
    """A function's results by argument, in bounded memory.

    Two generations: when the young one is full it becomes the old one, and what was
    old and not asked for since is forgotten. Long arguments aren't kept.
    """

    def __init__(self, function: Callable, size: int = 250_000, longest: int = 64):
        super().__init__()
        self.function, self.size, self.longest, self.old = function, size, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.function(key)
        if len(key) <= self.longest:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value

    def all(self, keys: Iterable) -> Iterator:
        return map(self.__getitem__, keys)
