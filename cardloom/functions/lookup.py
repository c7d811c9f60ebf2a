"""Joining and laying out logs by a key, balanced also when one key is hot."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.sources.staging import staged

# A table of at most this many rows and bytes is sent to every executor.
SMALL_ROWS = 10_000
SMALL_BYTES = 8 << 20
SPREAD = 4_096


def pulled(
    table: DataFrame, max_rows: int = SMALL_ROWS, max_bytes: int = SMALL_BYTES
) -> DataFrame | None:
    """The same rows as a local table when there are at most ``max_rows`` of at most
    ``max_bytes``, else None. Never fetches more rows than the limit."""
    rows = table.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows or rows.nbytes > max_bytes:
        return None
    return table.sparkSession.createDataFrame(rows, table.schema)


def lookup(
    rows: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    max_rows: int = SMALL_ROWS,
) -> DataFrame:
    """Left join; ``table`` has one row per key. It is computed once, as a stage. A
    small one is broadcast, a larger one joined by shuffle with its hot keys apart."""
    table = staged(table, "lookup")
    small = pulled(table, max_rows)
    if small is not None:
        return rows.join(F.broadcast(small), list(on), "left")
    return hot_split_lookup(rows, table, on)


def hot(rows: DataFrame, keys: Sequence[str], parts: int | None = None) -> DataFrame:
    """The non-null keys with more than 1/``parts`` of these rows each, so fewer than
    ``parts`` of them however the rows are spread; any other key fits into a
    shuffle partition of mean size. ``parts`` is the number of shuffle partitions if
    not given. Counts are combined before the shuffle."""
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [F.col(f"`{c}`") for c in keys]
    counts = rows.select(*names).dropna().groupBy(*names).agg(F.count(F.lit(1)).alias("__n"))
    share = counts.agg(F.sum("__n") / F.lit(parts)).scalar()
    return counts.where(F.col("__n") > share).drop("__n")


def crowded(rows: DataFrame, key: str, parts: int | None = None) -> DataFrame | None:
    """The ``hot`` keys as a local table, or None where there are none. Keys are first counted by
    the bucket of their hash, a few per shuffle partition, so a log of many keys shuffles none of
    them; only those of a bucket that could hold a hot one are counted themselves."""
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    name = F.col(f"`{key}`")
    keys = rows.select(name).where(name.isNotNull())
    bucket = F.pmod(F.xxhash64(name), F.lit(16 * parts))
    sizes = keys.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
    share = sum(r["n"] for r in sizes) / parts
    full = [r["b"] for r in sizes if r["n"] > share]  # fewer than parts
    if not full:
        return None
    counts = keys.where(bucket.isin(full)).groupBy(name).agg(F.count(F.lit(1)).alias("__n"))
    found = counts.where(F.col("__n") > share).drop("__n").toArrow()  # fewer than parts
    return rows.sparkSession.createDataFrame(found, keys.schema) if found.num_rows else None


def together(
    rows: DataFrame,
    key: str,
    make: Callable[..., DataFrame],
    count_in: DataFrame | None = None,
    beside: DataFrame | None = None,
) -> DataFrame:
    """What ``make`` makes of the rows, where it aggregates them by ``key``; rows without a key
    are left out. With a table ``beside`` them, which it joins by ``key``, its third argument are the
    rows of that table for the same keys; those without a key, or of no row, come with the first call.

    The rows are shuffled by key before ``make`` widens them, so its aggregates, distinct counts
    and joins by key shuffle no buffers; it is told so by its second argument. The rows of hot
    keys stay spread out and go through ``make`` apart, combined by it from partial results.
    """
    rows = rows.where(F.col(f"`{key}`").isNotNull())
    few = crowded(rows if count_in is None else count_in, key)
    with_it = () if beside is None else (beside,)
    if few is None:
        return make(rows.repartition(F.col(f"`{key}`")), True, *with_it)
    apart = F.broadcast(few)
    cold = [x.join(apart, key, "left_anti") for x in (rows, *with_it)]
    warm = [x.join(apart, key, "left_semi") for x in (rows, *with_it)]
    cold[0] = cold[0].repartition(F.col(f"`{key}`"))
    return make(cold[0], True, *cold[1:]).unionByName(make(warm[0], False, *warm[1:]))


def row_spread(rows: DataFrame) -> Column:
    """0..SPREAD-1 from the row's content, the same when a task is run again."""
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.lit(SPREAD))


def clustered(
    rows: DataFrame, key: str, parts: int | None = None, count_in: DataFrame | None = None
) -> DataFrame:
    """The rows shuffled so that a key's rows lie together, except that those of
    every hot key, and null keys, are spread over all partitions.

    A wide aggregate by ``key`` over this layout combines nearly everything
    before its own shuffle. Over rows in arrival order the map side would find
    one row per key and ship a buffer many times wider than the row. Key counts
    come from ``count_in`` where a plainer table has the same keys.
    """
    source = rows if count_in is None else count_in
    # Fewer keys than partitions are sent.
    apart = hot(source, [key], parts).withColumn("__hot", F.lit(1))
    marked = rows.join(F.broadcast(apart), key, "left")
    apart = F.col("__hot").isNotNull() | F.col(f"`{key}`").isNull()
    spread = F.when(apart, row_spread(rows)).otherwise(F.lit(0).cast("long"))
    return (
        marked.withColumn("__spread", spread)
        .repartition(F.col(f"`{key}`"), F.col("__spread"))
        .sortWithinPartitions(key)
        .select(*[F.col(f"`{c}`") for c in rows.columns])
    )


def hot_split_lookup(
    rows: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    parts: int | None = None,
) -> DataFrame:
    """Left join by shuffle, exact for any key distribution.

    The ``hot`` keys meet a broadcast slice of the table (fewer rows than there
    are partitions). All other rows are shuffled on the key;
    hot rows and rows with a null key pass through that shuffle spread over
    many partitions instead of piling up in one.
    """
    on = list(on)
    values = [c for c in table.columns if c not in on]
    out = list(rows.columns) + values

    some_null = F.lit(False)
    for c in on:
        some_null = some_null | F.col(f"`{c}`").isNull()

    frequent = hot(rows, on, parts)
    few = table.join(F.broadcast(frequent), on, "left_semi").select(
        *[F.col(f"`{c}`") for c in on],
        F.struct(F.lit(1).alias("__hit"), *[F.col(f"`{c}`") for c in values]).alias("__hot"),
    )
    marked = rows.join(F.broadcast(few), on, "left")

    # Spread value 0 can match; every other value matches nothing on purpose.
    apart = some_null | F.col("__hot").isNotNull()
    marked = marked.withColumn(
        "__spread", F.when(apart, row_spread(rows) + F.lit(1)).otherwise(F.lit(0)).cast("long")
    )
    cold = table.select(
        *[F.col(f"`{c}`") for c in on],
        F.lit(0).cast("long").alias("__spread"),
        F.struct(*[F.col(f"`{c}`") for c in values]).alias("__cold"),
    )
    joined = marked.join(cold, on + ["__spread"], "left")
    picked = [
        F.when(F.col("__hot").isNotNull(), F.col(f"__hot.`{c}`"))
        .otherwise(F.col(f"__cold.`{c}`"))
        .alias(c)
        for c in values
    ]
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], *picked).select(
        *[F.col(f"`{c}`") for c in out]
    )
