"""Intermediate tables in the folder that all executors share, and the memory that a session's tasks take."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes of an Arrow batch of whole texts.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches by BATCH_BYTES, or less if it says so.

    By default a batch holds 10,000 rows of up to 64 MB together, once in the executor beside its heap and several
    times in the Python worker, and workers keep what memory they once had from one stage to the next.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    # The Java side reads sizes with units, such as 64m, as bytes.
    given = spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch()
    if given <= 0 or given > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def folder(spark: SparkSession) -> str:
    """The shared scratch folder: ``spark.checkpoint.dir``, or a temporary one of a local master.

    Raises ValueError on a cluster without the setting, where a local folder would lose rows.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = tempfile.mkdtemp(prefix="scratch-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def saved(df: DataFrame, group_rows: int | None = None) -> DataFrame:
    """df written once as Parquet and read back: cuts its lineage, survives lost executors.

    A row group has at most ``group_rows`` rows. Give it for rows of megabytes: a writer looks at their size only after
    a hundred rows, and a reader decodes up to 4,096 rows of a group at once.
    """
    spark = df.sparkSession
    path = f"{folder(spark)}/{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    if group_rows:
        writer = writer.option("parquet.block.row.count.limit", str(group_rows))
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free(docs: DataFrame, *names: str) -> list[str]:
    """Each name with as many underscores after it as it takes to be no column of docs, whatever its case."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes tables that ``saved`` wrote, once all that is read from them is written."""
    for table in tables:
        spark = table.sparkSession
        jvm = spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(table.inputFiles()[0]).getParent()
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
