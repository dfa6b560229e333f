"""Joins against lookup tables whose keys may be heavily skewed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The largest table that is copied to every executor, in bytes of its values.
BROADCAST_BYTES = 64 << 20
# The same in rows, for tables of a few plain columns.
BROADCAST_ROWS = 200_000
# A key with more rows than this is cut into pieces of about so many. At most ``MOST_SPLIT`` keys
# are cut: beyond that the limit rises with the table.
SPLIT_ROWS = 1_000_000
MOST_SPLIT = 100_000


def fits(rows: int, limit: int = BROADCAST_ROWS) -> bool:
    """Whether ``rows`` rows of a few plain columns are small enough to be copied to every executor."""
    return rows <= limit


def broadcast_if(df: DataFrame, small: bool) -> DataFrame:
    """Hint a broadcast only where the caller has proven the size."""
    return F.broadcast(df) if small else df


def value_bytes(name: str, kind: T.DataType) -> Column:
    """About how many bytes a value takes."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(name)
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType):
        size = 8 * F.size(name)
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        size = F.octet_length(F.to_json(F.struct(name)))
    else:
        size = F.lit(8)
    return F.coalesce(size, F.lit(0)) + 8


def small_table(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the values of ``df`` take at most ``limit`` bytes; one aggregate over it."""
    row = sum((value_bytes(f.name, f.dataType) for f in df.schema.fields), F.lit(0))
    return (df.agg(F.sum(row.cast("long"))).first()[0] or 0) <= limit


def fitting_from(df: DataFrame, columns: list[str], rows: str, limit: int | None = None) -> int:
    """The least power of two such that ``columns`` of all rows with at least so many ``rows`` can be broadcast.

    In skewed tables few keys have most rows: these keys are broadcast, and only the rest is shuffled.
    """
    size = sum((value_bytes(c, df.schema[c].dataType) for c in columns), F.lit(0)).cast("long")
    levels = df.groupBy(F.floor(F.log2(rows)).cast("int").alias("level")).agg(F.sum(size).alias("bytes")).collect()
    left, least = BROADCAST_BYTES if limit is None else limit, 1 << 62
    for level, taken in sorted(levels, reverse=True):
        left -= taken
        if left < 0:
            break
        least = 1 << level
    return least


def split_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    spread_by: str | Column = "doc_id",
    counts: DataFrame | None = None,
) -> DataFrame:
    """Shuffle join that cuts the frequent keys of ``left``, and only those, into pieces.

    ``counts(*on, rows)`` says how many rows of ``left`` each key has; without it they are counted.
    A frequent key has as many pieces as its rows need; a row's piece follows the hash of
    ``spread_by``, and ``right`` repeats that key once for each piece. The table of frequent keys is
    bounded by ``MOST_SPLIT`` and broadcast. Correct for inner, left, left_semi and left_anti joins.
    """
    if counts is None:
        counts = left.groupBy(*on).agg(F.count("*").alias("rows"))
    limit = F.greatest(F.lit(SPLIT_ROWS), F.coalesce((counts.agg(F.sum("rows")).scalar() / MOST_SPLIT).cast("long"), F.lit(0)))
    frequent = F.broadcast(
        counts.where(F.col("rows") > limit).select(*on, F.ceil(F.col("rows") / limit).cast("int").alias("_pieces"))
    )
    cut = left.join(frequent, on, "left").withColumn(
        "_piece", F.coalesce(F.pmod(F.xxhash64(spread_by), F.col("_pieces")).cast("int"), F.lit(0))
    )
    repeated = right.join(frequent, on, "left").withColumn(
        "_piece", F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1))
    )
    return cut.drop("_pieces").join(repeated.drop("_pieces"), [*on, "_piece"], how).drop("_piece")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    spread_by: str | Column = "doc_id",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join a large table with a lookup table that is normally small.

    The lookup table is measured first. Up to ``max_bytes`` it is broadcast and ``left`` is not
    shuffled; beyond that frequent keys are cut into pieces (:func:`split_join`).
    """
    if small_table(right, max_bytes):
        return left.join(F.broadcast(right), on, how)
    return split_join(left, right, on, how, spread_by)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal the rows of a file scan out by ``key`` if it has fewer files than the cluster has cores.

    A large table arrives in many files and is left alone. A table in one file, and one row group,
    would run on one core; dealing it by ``key`` also spares later shuffles on that key.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if len(df.inputFiles()) < cores else df
