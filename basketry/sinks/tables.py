"""Tables a run replaces or adds to."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from basketry.sources.tables import POINTERS, pointers, table_exists


def replace_table(df: DataFrame, path: str, sort: Sequence[str] = (), keep: int = 1) -> None:
    """Replace the table. ``sort`` orders the rows of each file, with no shuffle for it.

    The rows are written to a folder of their own below ``path``. Then an empty file is made whose name is a number and
    that folder's name: whoever reads the table (``read_table``) takes the folder with the greatest number, so the table
    changes from the old rows to the new ones in that one step, and no data is renamed or copied. A write that breaks
    off leaves the old table. Of the older versions ``keep`` stay, for those who are reading them.
    """
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root, hadoop = path.rstrip("/"), jvm.org.apache.hadoop.fs.Path
    data = f"_rows-{uuid.uuid4().hex}"
    (df.sortWithinPartitions(*sort) if sort else df).write.parquet(f"{root}/{data}")
    earlier = pointers(spark, root)
    number = earlier[-1][0] + 1 if earlier else 1
    files = hadoop(root).getFileSystem(conf)
    files.mkdirs(hadoop(f"{root}/{POINTERS}"))
    name = f"{number:012d}.{data}"
    if not files.createNewFile(hadoop(f"{root}/{POINTERS}/{name}")):
        raise OSError(f"{path} could not be replaced; the new rows are in {data}")
    # From here on the new table stands. A pointer goes before its rows, so none leads to a folder that is gone.
    for at, old in earlier[: len(earlier) - keep]:
        files.delete(hadoop(f"{root}/{POINTERS}/{at:012d}.{old}"), False)
        files.delete(hadoop(f"{root}/{old}"), True)


def write_if_nonempty(df: DataFrame, path: str) -> bool:
    """Replace the table unless there is nothing to replace it with; tells whether it did.

    Pass a written frame (``Workspace.save``): the test is then a look at one file.
    """
    if df.isEmpty():
        return False
    replace_table(df, path)
    return True


def upsert_history(pairs: DataFrame, path: str, run_date: dt.date) -> None:
    """Put the pairs into the history as the rows of ``run_date``, replacing those it had.

    Only that date's partition is rewritten, so running a date again leaves one copy of it.
    """
    (
        pairs.withColumn("audit_date", F.lit(run_date))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("audit_date")
        .parquet(path)
    )


def read_history(spark: SparkSession, path: str, pairs: StructType) -> DataFrame:
    """The pairs of all dates, and their ``audit_date``.

    ``pairs`` are the columns of the pairs: a history without a row has no file that tells them.
    """
    columns = StructType([*pairs, StructField("audit_date", DateType())])
    return spark.read.schema(columns).parquet(path) if table_exists(spark, path) else spark.createDataFrame([], columns)
