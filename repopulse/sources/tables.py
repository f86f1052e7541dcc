"""Reading a table that may not have been written yet."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_ASIDE = "-replaced"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system that ``path`` is on, and the path as it knows it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def move_files(spark: SparkSession, source: str, target: str) -> None:
    """Move the data files below ``source`` to the same folders below ``target``.

    A folder that ``target`` lacks moves as a whole. File names are unique, so a call that
    was interrupted is finished by another one.
    """
    files, base = file_system(spark, source)
    if not files.exists(base):
        return
    _, goal = file_system(spark, target)

    def move(place, goal) -> None:
        if not files.exists(goal):
            files.mkdirs(goal.getParent())
            if files.rename(place, goal):
                return
        for found in files.listStatus(place):
            name = found.getPath().getName()
            if name.startswith(("_", ".")):
                continue
            below = spark._jvm.org.apache.hadoop.fs.Path(goal, name)
            if found.isDirectory():
                move(found.getPath(), below)
            elif not files.rename(found.getPath(), below):
                raise OSError(f"could not move {found.getPath()} to {below}")

    files.mkdirs(goal)
    move(base, goal)
    files.delete(base, True)


def replace_table(spark: SparkSession, new: str, path: str) -> None:
    """Put the table at ``new`` in the place of the one at ``path``.

    The old table can be read until the new one, which is complete, takes its name. What
    finds no table between the two renames can tell from ``set_aside`` that there was one.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    source, aside = hadoop.Path(new), hadoop.Path(f"{new}{_ASIDE}")
    files, target = file_system(spark, path)
    if files.exists(target) and not files.rename(target, aside):
        raise OSError(f"could not move {path}")
    if not files.rename(source, target):
        raise OSError(f"could not move {new}; the old table is at {aside}")
    if files.exists(aside):
        files.delete(aside, True)


def set_aside(spark: SparkSession, path: str) -> list[str]:
    """Old tables that stand beside ``path`` because their replacement isn't complete."""
    files, place = file_system(spark, f"{path.rstrip('/')}-*{_ASIDE}")
    return [found.getPath().toString() for found in files.globStatus(place) or []]


def read_or_empty(spark: SparkSession, path: str, schema: StructType, **options: str) -> DataFrame:
    """The Parquet table at ``path``, or an empty frame if nothing is there."""
    try:
        return spark.read.options(**options).schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        # The filter tells Catalyst that there are no rows, so it drops joins with them.
        return spark.createDataFrame([], schema).where(F.lit(False))
