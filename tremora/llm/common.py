"""Small helpers that the operators of this package share."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes per Arrow batch: a batch of very long texts must fit into a Python worker.
BATCH_ROWS = 256
BATCH_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Lower (never raise) the rows and bytes that Spark hands to Python at once."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key)
    if not now.removesuffix("b").isdigit() or int(now.removesuffix("b")) > BATCH_BYTES:
        spark.conf.set(key, f"{BATCH_BYTES}b")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text`` only, so that no other column can clash; a null text is empty."""
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def row_key(*columns: str) -> Column:
    """A key of the row's content: equal for repeated rows, the same in every attempt of a task."""
    return F.xxhash64(*columns)


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the decimal id, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def shuffle_parts(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")),
               spark.sparkContext.defaultParallelism)


class Memo(dict):
    """Results by key, in two generations of bounded size, so frequent keys outlive a clearing.

    Keys longer than ``longest`` (text without spaces, say) are worked out each time and not kept,
    so the limit on entries bounds the bytes as well."""

    def __init__(self, compute: Callable, limit: int = 150_000, longest: int = 256) -> None:
        super().__init__()
        self.compute, self.limit, self.longest, self.old = compute, limit, longest, {}

    def __missing__(self, key):
        if len(key) > self.longest:
            return self.compute(key)
        value = self.old[key] if key in self.old else self.compute(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value
