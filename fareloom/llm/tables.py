"""Input tables of a folder, and the library's way to the tasks."""

from __future__ import annotations

import tempfile
import zipfile
from functools import cache
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession


#: Rows that go to a Python worker at once, at most. Texts are long: Spark's 10,000 rows of them fill
#: hundreds of megabytes of every task, outside the heap and again in the worker.
ROWS_AT_ONCE = 1_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of a folder, in a session made ready for it."""
    prepare(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Bound what a task hands to Python at once, and send this library to the tasks."""
    _ship(spark.sparkContext)
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= ROWS_AT_ONCE:
        spark.conf.set(setting, ROWS_AT_ONCE)


@cache
def _ship(context: SparkContext) -> None:
    """As ``--py-files`` does at submission, for sessions that were started without it."""
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="fareloom-")) / "fareloom.zip"
    with zipfile.ZipFile(archive, "w") as to:
        for file in sorted(package.rglob("*.py")):
            to.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
