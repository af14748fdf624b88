"""Exact de-duplication with an extendible-hash index on shared files; DataFrame functions only.

Every text gets a 64-bit hash. The directory is grown from the counts of its leading bits: while a
bucket is overfull, its range is halved by one more bit, and the directory doubles with the
deepest bucket. It has at most 2**MAX_DEPTH entries, whatever the input. The byte comparison is a
grouping by (bucket, hash, text), combined within each task first, so a text with a third of all
rows reaches the shuffle once per task. Entries then go to the owners of ascending key ranges, who
write them, ordered by hash, as the index; entries of one hash with different bytes stand in a chain
and are told apart by the digest of their bytes. Rows are looked up by hash and digest without
moving their texts; Spark splits the partitions of a hot key in that join.

Defined cases: a null text counts as empty; rows that repeat the same id and text count each, and
share their verdict, as they cannot be told apart; a null id is smaller than any other, and in a
group with null ids only all rows stay; further columns are not read; an empty table gives an
empty one.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremora.llm.common import shuffle_parts, texts
from tremora.session import new_folder

#: Bits of the deepest directory: 65,536 entries of two numbers are collected and broadcast.
MAX_DEPTH = 16
#: Rows of a bucket before it splits.
BUCKET_ROWS = 4096


def text_hash(text: Column, bits: int = 64) -> Column:
    """``bits`` < 64 is for tests: it makes different texts meet."""
    return F.shiftleft(F.xxhash64(text), 64 - bits)


def _slot(key: Column, depth: int = MAX_DEPTH) -> Column:
    return F.shiftrightunsigned(key, 64 - depth)


def grow_directory(counts: dict[int, int], bucket_rows: int,
                   max_depth: int = MAX_DEPTH) -> list[tuple[int, int, int]]:
    """``(slot, bucket, depth)`` for all slots; counts are rows by the ``max_depth`` leading bits."""
    sums = [[0] * (1 << d) for d in range(max_depth + 1)]
    for slot, n in counts.items():
        for d in range(max_depth + 1):
            sums[d][slot >> (max_depth - d)] += n
    directory, open_buckets = [], [(0, 0)]
    while open_buckets:
        depth, prefix = open_buckets.pop()
        if depth < max_depth and sums[depth][prefix] > bucket_rows:
            open_buckets += [(depth + 1, 2 * prefix + 1), (depth + 1, 2 * prefix)]
            continue
        width = max_depth - depth
        first = prefix << width
        directory += [(slot, first, depth) for slot in range(first, first + (1 << width))]
    return directory


def build_index(docs: DataFrame, bucket_rows: int = BUCKET_ROWS, bits: int = 64,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One entry per distinct text, written to shared files in the order of the directory:
    ``bucket, depth, hash, chain, digest, keep_id, group_size``."""
    spark = docs.sparkSession
    rows = texts(docs, id_col, text_col).withColumn("hash", text_hash(F.col("text"), bits))
    counts = {r.slot: r["count"] for r in
              rows.select(_slot(F.col("hash")).alias("slot")).groupBy("slot").count().collect()}
    directory = spark.createDataFrame(grow_directory(counts, bucket_rows),
                                      "slot bigint, bucket int, depth int")
    entries = (rows.join(F.broadcast(directory), _slot(F.col("hash")) == F.col("slot"))
               .groupBy("bucket", "depth", "hash", "text")
               .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
               .select("bucket", "depth", "hash", F.sha2("text", 256).alias("digest"), "keep_id",
                       "group_size"))
    path = new_folder(spark, "exact-index")
    (entries.repartitionByRange(shuffle_parts(spark), "bucket", "hash")
     .sortWithinPartitions("bucket", "hash", "digest").write.parquet(path))
    return spark.read.schema(entries.schema).parquet(path)


def chains(index: DataFrame) -> DataFrame:
    """Hashes whose bucket entries hold different texts, and how many."""
    return index.groupBy("bucket", "hash").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1")


def _looked_up(rows: DataFrame, index: DataFrame) -> DataFrame:
    found = index.select(F.col("hash").alias("__h"), F.col("digest").alias("__d"), "keep_id",
                         "group_size")
    return rows.join(found, (F.col("__hash") == F.col("__h")) &
                     (F.col("__digest") == F.col("__d")))


def duplicates(docs: DataFrame, bucket_rows: int = BUCKET_ROWS, bits: int = 64,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    index = build_index(docs, bucket_rows, bits, id_col, text_col)
    rows = texts(docs, id_col, text_col).select(
        "doc_id", text_hash(F.col("text"), bits).alias("__hash"),
        F.sha2("text", 256).alias("__digest"))
    return _looked_up(rows, index).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("__digest").alias("text_sha256"))


def deduplicated(docs: DataFrame, bucket_rows: int = BUCKET_ROWS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    index = build_index(docs, bucket_rows, 64, id_col, text_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.struct("*").alias("__row"), F.col(id_col).alias("__id"),
                       text_hash(text).alias("__hash"), F.sha2(text, 256).alias("__digest"))
    return _looked_up(rows, index).where(
        F.col("__id").eqNullSafe(F.col("keep_id"))).select("__row.*")
