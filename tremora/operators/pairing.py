"""Joins without an equality: broadcast where a count proves it safe, blocks where not."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremora import fixed
from tremora.session import task_count


def numbers(count: int) -> Column:
    """0 .. count - 1 as an array, to list a row under every part."""
    return F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))


def fits_broadcast(df: DataFrame, rows: int = fixed.BROADCAST_ROWS) -> bool:
    """Counts the side (for a Parquet table that reads footers only)."""
    return df.count() <= rows


def theta_join(big: DataFrame, small: DataFrame, condition: Column | None,
               big_key: str, small_keys: list[str], rows: int = fixed.BROADCAST_ROWS
               ) -> DataFrame:
    """All (big, small) pairs that meet ``condition``.

    If ``small`` is counted to fit, it is broadcast: no shuffle, and the partitioning of ``big``
    survives. If not, both sides are cut into hashed pieces and every piece pair becomes one task
    of an equi-join; pieces are hashed on unique keys, so no key can make one of them hot.
    """
    count = small.count()
    everything = F.lit(True) if condition is None else condition
    if count <= rows:
        return big.join(F.broadcast(small), everything, "inner")
    blocks = -(-count // rows)
    slices = task_count(big.sparkSession)
    big = big.withColumns({
        "_slice": F.pmod(F.xxhash64(big_key), F.lit(slices)),
        "_block": F.explode(numbers(blocks)),
    })
    small = small.withColumns({
        "_block_of": F.pmod(F.xxhash64(*small_keys), F.lit(blocks)),
        "_slice_of": F.explode(numbers(slices)),
    })
    same = (F.col("_slice") == F.col("_slice_of")) & (F.col("_block") == F.col("_block_of"))
    return (big.join(small.hint("shuffle_hash"), same & everything, "inner")
            .drop("_slice", "_slice_of", "_block", "_block_of"))
