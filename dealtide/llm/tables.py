"""What the operators share: input tables, tables written between steps, small expressions."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealtide.session import shared_folder


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/dealtide-llm/{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete an intermediate table that no plan reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def keep(df: DataFrame) -> DataFrame:
    """Write an intermediate table to the folder that all executors share, and read it back.

    Cuts the lineage: a lost executor costs the tasks it ran, not the steps before this one.
    """
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def source_key(source: Column) -> Column:
    """A source as a text that is never NULL; sorts by code point, NULL last."""
    return F.coalesce(F.concat(F.lit("0"), source.cast("string")), F.lit("1"))


def shuffle_key(seed: str, identity: Column) -> Column:
    """Seeded pseudo-random text of a row: the order of the shuffle."""
    return F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(identity.cast("string"), F.lit(""))))


def fraction(key: Column) -> Column:
    """Place of a :func:`shuffle_key` in the order of all possible keys, from 0 to below 1."""
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def words_in(text: Column) -> Column:
    """Number of words, with ASCII white space as the only separator; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def plain_columns(df: DataFrame) -> list[str]:
    """Columns that can be hashed: all but those that are, or hold, maps or variants."""
    return [f"`{name}`" for name, kind in df.dtypes if "map<" not in kind and "variant" not in kind]


def prepare_python(spark: SparkSession) -> None:
    """Before Python tasks: give the executors this package, and bound what a task holds of its
    input at once, however long the texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 * 1024 * 1024))
    context = spark.sparkContext
    if getattr(context, "_dealtide_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    # The driver serves this file to the executors as long as the session lives.
    archive = Path(tempfile.mkdtemp(prefix="dealtide-")) / "dealtide.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for path in sorted(package.rglob("*.py")):
            packed.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._dealtide_shipped = True
