"""Bloom filters of a join's smaller side: rows of the larger one whose key it surely lacks need not be moved to it."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, StringType, TimestampType

#: Bits for each key, positions of a key, bits of a block (one bitmap of Spark's), blocks at most: 64 MB go to every executor.
BITS, HASHES, BLOCK, MOST = 8, 4, 32_768, 16_384


def flag_by_key(df: DataFrame, lookup: DataFrame, keys: Sequence[str], n: int, flag: str) -> DataFrame | None:
    """``df`` with a column ``flag``: false where the row's key surely is not among those of ``lookup``.

    ``n``: at least the number of distinct keys in ``lookup``; repeated ones do no harm. A key with a NULL is
    in neither. None if the lookup is too large for a filter, or has keys whose equal values may be stored
    otherwise (other types, floats).
    """
    same = all(df.schema[k].dataType == lookup.schema[k].dataType and isinstance(df.schema[k].dataType, (IntegralType, StringType, DateType, TimestampType))
               for k in keys)
    blocks = -(-max(n, 1) * BITS // BLOCK)
    if not same or blocks > MOST:
        return None
    block = F.pmod(F.xxhash64(*keys), F.lit(blocks))
    # all positions of a key lie in one block, so that a row meets one row of the filter
    places = F.xxhash64(F.lit(1), *keys)

    def position(hashed: Column, i: int) -> Column:
        return F.shiftrightunsigned(hashed, 15 * i).bitwiseAND(F.lit(BLOCK - 1))

    # the keys of a block meet before their bitmap is built: one for each task and block would be far more than the keys
    dealt = lookup.dropna(subset=list(keys)).select(block.alias("_block"), places.alias("_places")).repartition("_block")
    at = dealt.select("_block", F.explode(F.array(*[position(F.col("_places"), i) for i in range(HASHES)])).alias("_at"))
    blooms = at.groupBy("_block").agg(F.bitmap_construct_agg("_at").alias("_bits"))
    found = df.withColumn("_block", block).withColumn("_places", places).join(F.broadcast(blooms), "_block", "left")
    may = F.lit(True)
    for k in keys:
        may &= F.col(k).isNotNull()
    for i in range(HASHES):
        where = position(F.col("_places"), i)
        byte = F.conv(F.hex(F.substring("_bits", F.shiftright(where, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        may &= F.getbit(byte, where.bitwiseAND(F.lit(7)).cast("int")) == 1
    return found.select(*df.columns, F.coalesce(may, F.lit(False)).alias(flag))


def split_by_key(df: DataFrame, lookup: DataFrame, keys: Sequence[str], n: int) -> tuple[DataFrame, DataFrame]:
    """(rows whose key may be among those of ``lookup``, rows whose key surely is not); together the rows of ``df``.

    Without a filter (see ``flag_by_key``) every row is in the first part.
    """
    found = flag_by_key(df, lookup, keys, n, "_may")
    if found is None:
        return df, df.filter(F.lit(False))
    return found.filter("_may").drop("_may"), found.filter("not _may").drop("_may")
