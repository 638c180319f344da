"""What the training-data operators share: table access, scratch tables, exact ids."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters that separate words and that are stripped from lines.
SPACE = " \t\n\x0b\f\r"
#: One word, as a regular expression that Java and RE2 read alike.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows whose values are Python objects at one time.
ROWS_AT_ONCE = 1000
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table of that name in the folder, read by Spark (any file system)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; one of our own only where that is unset and all tasks
    run in this process. A cluster without such a folder is refused: its machines would not see each other's tables."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='terrapack-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def scratch_dir(spark: SparkSession) -> str:
    """This application's folder for its tables, in the shared one. It goes when the application ends."""
    path = f"{shared_dir(spark)}/terrapack/{spark.sparkContext.applicationId}"
    if path not in _OPEN:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        files.mkdirs(where)
        files.deleteOnExit(where)
        _OPEN.add(path)
    return path


_OPEN: set[str] = set()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes the rows as a table in the shared folder and reads it back.

    It cuts the lineage: a lost executor costs its running tasks only, as the table stays where all executors read it.
    The shuffle files of the write go when it ends, since nothing reads them again; the table goes with the application.
    """
    path, conf = f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}", df.sparkSession.conf
    before = conf.get(CLEAN_UP, None)
    conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(CLEAN_UP) if before is None else conf.set(CLEAN_UP, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._tp_path = path
    return out


def forget(table_: DataFrame) -> None:
    """Deletes a stored table that nothing reads any more."""
    where = table_.sparkSession._jvm.org.apache.hadoop.fs.Path(table_._tp_path)
    where.getFileSystem(table_.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def small_table(spark: SparkSession, columns: dict[str, tuple[list, pa.DataType]]) -> DataFrame:
    """A table from the driver. Only for rows whose number a parameter bounds."""
    return spark.createDataFrame(pa.table({k: pa.array(v, type=kind) for k, (v, kind) in columns.items()}))


def text_or_empty(text: str | Column = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def content_id(text: Column) -> Column:
    """16 bytes that stand for the whole text; rows with equal texts share them, and doc_id may be null or repeated."""
    return F.unhex(F.md5(text.cast("binary")))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def add_in_arrow(df: DataFrame, read: list[str], made: dict[str, str], work) -> DataFrame:
    """`df` with the columns `made` (name: DDL type), which replace columns of those names.

    `work()` is called once in each task and gives a function from lists of the `read` columns to lists of the made
    ones, batch by batch. All other columns pass by as Arrow arrays, whatever their types.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out = StructType.fromDDL(", ".join(f"__tp_made{k} {kind}" for k, kind in enumerate(made.values())))
    types = [f.type for f in to_arrow_schema(out)]

    def run(batches):
        of = work()
        for b in (whole.slice(at, ROWS_AT_ONCE) for whole in batches for at in range(0, whole.num_rows, ROWS_AT_ONCE)):
            new = of(*(b.column(c).to_pylist() for c in read))
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(v, type=t) for v, t in zip(new, types, strict=True))], names=[*b.schema.names, *out.names])

    rows = df.mapInArrow(run, StructType([*df.schema.fields, *out.fields]))
    return rows.withColumns({c: F.col(f"__tp_made{k}") for k, c in enumerate(made)}).drop(*out.names)
