"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import tempfile
import uuid
import weakref

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share (``spark.checkpoint.dir``). Where it is unset, one process can
    do with a temporary folder; on a cluster that would break every table written, so it is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="spark-shared-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back, so that later steps survive lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _written[out] = path
    return out


#: Where each staged table lies.
_written: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def discard(df: DataFrame) -> None:
    """Delete a staged table that nothing reads any more."""
    if path := _written.pop(df, None):
        jvm = df.sparkSession.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Keep Arrow batches small: texts can be long, and a batch is held whole by a Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, str(rows))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text; other columns, whatever their names, never get in the way. Null text counts as empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` for a join that shuffles both sides. For tables that grow with the input: Spark takes a table for as large as its
    compressed files, and an array for one element even after it is exploded, so that left alone it broadcasts, through the
    driver, what takes many times its threshold."""
    return df.hint("merge")


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def kept_rows(docs: DataFrame, decided: DataFrame, digest: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``decided`` (doc_id, text_sha256, kept) keeps; of each id and text the row that is least by
    its other columns. Id and digest are one column, so that the join and the choice need one shuffle."""
    place, number = free_name(docs, "_place"), free_name(docs, "_number")

    def joint(doc_id: Column, sha: Column) -> Column:
        return F.concat_ws(" ", sha, doc_id.cast("long").cast("string"))

    keep = decided.where("kept").select(joint(F.col("doc_id"), F.col("text_sha256")).alias(place))
    rows = docs.withColumn(place, joint(docs[id_col], digest)).join(shuffled(keep), place, "left_semi")
    rest = [docs[c] for c in docs.columns if c not in (id_col, text_col)]
    first = F.row_number().over(Window.partitionBy(place).orderBy(F.to_json(F.struct(*rest)) if rest else F.lit(0)))
    return rows.withColumn(number, first).where(F.col(number) == 1).select(*docs.columns)
