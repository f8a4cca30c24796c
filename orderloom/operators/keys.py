"""Key-set helpers for merges and incremental scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.session import materialize

#: Bits of one bitmap, as ``bitmap_construct_agg`` builds them: 2 to the power of ``SHIFT``.
SHIFT = 15
BITS = 1 << SHIFT


def has_bit(bitmap: Column, place: Column) -> Column:
    """Whether the bit at ``place``, an int from 0, is set; NULL without a bitmap."""
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.bit_get(byte, place % 8) == 1


def within_key_range(big: DataFrame, big_key: str, small: DataFrame, small_key: str) -> DataFrame:
    """Rows of ``big`` whose key lies between the smallest and largest key of ``small``.

    For an equi-join with ``small`` this drops nothing that could match. The bounds reach the scan
    as literals, so Parquet row groups outside them are never read. Runs one min/max over ``small``.
    """
    low, high = small.agg(F.min(small_key), F.max(small_key)).first()
    if low is None:
        return big.filter(F.lit(False))
    return big.filter(F.col(big_key).between(F.lit(low), F.lit(high)))


def with_keys_of(big: DataFrame, big_key: str, small: DataFrame, small_key: str) -> DataFrame:
    """Rows of ``big`` whose key is a key of ``small``, in its key range.

    The distinct keys are written first, so that the optimiser knows their real size: few are broadcast, and no row of
    ``big`` is shuffled before it is known to be wanted.
    """
    wanted = materialize(small.select(F.col(small_key).alias(big_key)).na.drop("any").distinct(), "wanted-keys")
    return within_key_range(big, big_key, wanted, big_key).join(wanted, big_key, "left_semi")


def found_keys(new: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct keys of ``new`` that are in ``target``; a NULL key never is.

    The target contributes its key columns only, cut to the key range of ``new``. They are looked up with a semi
    join: ``new`` is its build side, so a small ``new`` is broadcast and a huge target is scanned without a shuffle.
    Both sides are reduced to distinct keys, which combine map-side, so a key with very many copies is one row there.
    """
    candidates = within_key_range(target.select(*keys), keys[0], new, keys[0])
    wanted = new.select(*keys).na.drop("any").distinct()
    return candidates.join(wanted, list(keys), "left_semi").distinct()


def unmatched(new: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new``, a frame read from Parquet files, whose key is not in ``target``; a NULL key never matches.

    ``new`` is read four times, of which only the last one reads more than its keys.
    """
    return without_keys(new, found_keys(new, target, keys), keys)


def without_keys(new: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new``, a frame read from Parquet files, whose key is not in ``found``.

    Only keys are shuffled: they are joined together with their rows' places in the files. What is found becomes a
    bit for its row, in a bitmap for every ``BITS`` rows of a file, and the rows are filtered by these where they are
    read. The bitmaps are broadcast: one bit for a row, 12 MB for 100 million.
    """
    place = new.metadataColumn("_metadata")
    paths = [r[0] for r in new.select(place["file_path"]).distinct().collect()]  # one for each file
    numbers = new.sparkSession.createDataFrame(list(enumerate(paths)), "_file int, _path string")
    placed = new.select("*", place["file_path"].alias("_path"), place["row_index"].alias("_row"))
    rows = placed.join(F.broadcast(numbers), "_path").drop("_path")
    marks = (
        rows.select(*keys, "_file", "_row")
        .join(found.select(*keys), list(keys), "left_semi")
        .groupBy("_file", F.shiftright("_row", SHIFT).alias("_block"))
        .agg(F.bitmap_construct_agg(F.pmod("_row", F.lit(BITS))).alias("_marks"))
    )
    blocks = rows.withColumn("_block", F.shiftright("_row", SHIFT))
    marked = blocks.join(F.broadcast(marks), ["_file", "_block"], "left")
    known = has_bit(F.col("_marks"), F.pmod("_row", F.lit(BITS)).cast("int"))
    return marked.filter(~F.coalesce(known, F.lit(False))).select(*new.columns)
