"""What the operators share: word rules, cut lineage, whole-number arithmetic."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.session import shared_folder

# Fixed: the white space that separates words.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Applications that have this package on their executors.
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors' Python, wherever the session was started."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    if package.is_dir():
        target = Path(tempfile.mkdtemp(prefix="tillhouse-")) / "tillhouse.zip"
        with zipfile.ZipFile(target, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(target))
    _SHIPPED.add(context.applicationId)


def cut(frame: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Writes rows to the folder all executors share and reads them back.

    Later steps start from the written table, also after an executor is lost.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}_{uuid.uuid4().hex}"
    frame.write.parquet(path, compression=compression)
    return spark.read.schema(frame.schema).parquet(path)


def words(text: Column) -> Column:
    """The words of a text; none for a null or blank one."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANK_RUN), lambda w: w != "")


def n_words(text: Column) -> Column:
    """How many words a text has, without keeping them."""
    blank = F.lit(BLANKS)
    trimmed = F.btrim(F.coalesce(text, F.lit("")), blank)
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, BLANK_RUN))).cast("long")


def to_lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
