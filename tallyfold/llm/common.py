"""Words, names and staging shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of characters other than space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words, 0 for null.

    Every word is shrunk to one letter and every gap to nothing, so no array of words is made.
    """
    return F.coalesce(F.length(F.regexp_replace(text, rf"{WORD}[\x20\x09-\x0D]*|[\x20\x09-\x0D]+", "w")), F.lit(0)).cast(
        "long"
    ) - F.coalesce(text.rlike(r"^[\x20\x09-\x0D]").cast("long"), F.lit(0).cast("long"))


def fresh_name(name: str, *frames: DataFrame) -> str:
    """`name`, lengthened until no column of the frames has it."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def unstage(*staged: DataFrame) -> None:
    """Removes staged tables that nothing is read from any more."""
    for df in staged:
        spark = df.sparkSession
        for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
