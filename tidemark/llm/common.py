"""Small helpers that the text operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.files import delete
from tidemark.session import workdir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


#: Makes Spark delete the shuffle files of a job when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows read back from a table in the shared folder, so that lineage ends there.

    Lost executors then cost a read, not a recomputation. Nothing reads the shuffles of a job whose
    rows are written, so their files go at once and not when the driver next collects its garbage.
    """
    spark = df.sparkSession
    folder, before = workdir(spark, purpose), spark.conf.get(CLEANUP, None)
    if before is not None:
        spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(folder)
    finally:
        if before is not None:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(folder)


def discard(settled: DataFrame) -> None:
    """Delete the files of a table that ``settle`` wrote and nothing reads any more."""
    for folder in {f.rpartition("/")[0] for f in settled.inputFiles()}:
        delete(settled.sparkSession, folder)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for columns of one's own that the table does not have, in any case of letters."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def kind_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else, as the word rules ask for."""
    plain = ~text.rlike("[^\\x00-\\x7F]")
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once per row, not once per array element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def held_out(doc_id: Column, of: int = 4, fold: int = 2) -> Column:
    """Whether a document belongs to the fold that no label may be learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % of == fold
