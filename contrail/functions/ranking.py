"""Global ranks that scale past one task.

``RANK/DENSE_RANK/ROW_NUMBER() OVER (ORDER BY ...)`` without PARTITION BY puts
every row into a single task. ``rank_rows`` gives the same numbers at any size:

1. the input is written once, so that the order keys and the rows that they are
   joined back to are the same values (a written table is taken as it is);
2. rows collapse to distinct order keys with their multiplicity (partial
   aggregation, so one hot key costs one row, not a third of the data);
   which are written, as several steps read them;
3. the edges of the ranges are drawn once from these keys and become literals, so that
   a key's range depends on the key alone, whatever Spark recomputes; it is found by halving;
4. keys are numbered inside their range by a window over the range, and the
   numbers of keys and rows in the ranges before are added (a #ranges-row table);
5. positions are joined back on the order keys (null-safe).

Where the number of rows has been counted and is ``WINDOW_ROWS`` at most (the members of
a small dimension), the window over all of them is bounded and is used as it is. Both
ways give the same numbers (tests hold one against the other).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.session import scratch_path

WINDOW_ROWS = 50_000  # counted rows up to which one task ranks all
DRAWN = 40  # keys drawn for each edge of a range


def _sort_exprs(order) -> list[Column]:
    out = []
    for o in order:
        name, asc = (o, True) if isinstance(o, str) else o
        out.append(F.col(name).asc_nulls_first() if asc else F.col(name).desc_nulls_last())
    return out


def _names(order) -> list[str]:
    return [o if isinstance(o, str) else o[0] for o in order]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table under the shared work folder."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _after(sort: list[tuple[str, bool]], edge: Column) -> Column:
    """Is a key at or behind an edge (a struct) in the order? Both orders put NULLs at the low end of values."""
    later = F.lit(True)  # equal in all columns
    for name, asc in reversed(sort):
        key, at = F.col(name), edge[name]
        same = key.eqNullSafe(at)
        beyond = (key.isNotNull() & at.isNull() | (key > at)) if asc else (key.isNull() & at.isNotNull() | (key < at))
        later = F.coalesce(beyond, F.lit(False)) | (same & later)
    return later


def _edges(located: DataFrame, sort: list[tuple[str, bool]], ranges: int) -> list:
    """Keys that part the distinct keys into about equal ranges, from ``DRAWN`` of them for each range."""
    if ranges < 2:
        return []
    names = [n for n, _ in sort]
    drawn = (located.select(*names).withColumn("_draw", F.xxhash64(*names)).orderBy("_draw").limit(DRAWN * ranges)
             .orderBy(*_sort_exprs(sort)).collect())  # DRAWN x ranges rows at most
    return [drawn[i * len(drawn) // ranges] for i in range(1, ranges)] if len(drawn) >= ranges else []


def _place(located: DataFrame, sort: list[tuple[str, bool]], edges: list) -> Column:
    """The number of edges that a key is at or behind. Edges are in order, so it is found by halving."""
    if not edges:
        return F.lit(0)
    kinds = {n: located.schema[n].dataType for n, _ in sort}
    table = F.array(*[F.struct(*[F.lit(e[n]).cast(k).alias(n) for n, k in kinds.items()]) for e in edges])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(edges).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= len(edges)) & _after(sort, F.get(table, at + step - 1)), at + step).otherwise(at))


def rank_rows(df: DataFrame, order, kind: str = "rank", out: str = "rank",
              partitions: int | None = None, bound: int | None = None, is_table: bool = False) -> DataFrame:
    """Add ``out`` = rank / dense_rank / row_number over the global ``order``.

    ``order``: list of column names (ascending, NULLS FIRST) or
    ``(name, ascending)`` pairs (descending puts NULLS LAST), as SQLite/Spark
    default. ``row_number`` refuses an order that is not unique per row
    (``ValueError``). The result column is BIGINT. Writes its steps under the
    shared work folder. ``bound``: the number of rows at most, if it has been counted. ``is_table``:
    ``df`` reads a written table, so that its rows are the same each time.
    """
    if kind not in ("rank", "dense_rank", "row_number"):
        raise ValueError(f"unknown rank kind {kind!r}")
    keys, sort = _names(order), _sort_exprs(order)
    if not is_table and (bound is None or bound > WINDOW_ROWS):
        df = written(df, "rank-rows")
    if kind == "row_number" and not df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").isEmpty():
        raise ValueError(f"row_number needs an order that is unique per row; {keys} has ties")
    if bound is not None and bound <= WINDOW_ROWS:
        number = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}[kind]()
        return df.withColumn(out, number.over(Window.orderBy(*sort)).cast("bigint"))  # counted rows
    pos = prefix_counts(written(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "rank-keys"), order, partitions)
    value = {"rank": F.col("_rows_before"), "dense_rank": F.col("_keys_before"), "row_number": F.col("_rows_before")}[kind] + 1
    pos = pos.select(*[F.col(k).alias(f"_rk_{k}") for k in keys], value.cast("bigint").alias(out))
    cond = [df[k].eqNullSafe(pos[f"_rk_{k}"]) for k in keys]
    return df.join(pos, cond, "inner").drop(*[f"_rk_{k}" for k in keys])


def prefix_counts(located: DataFrame, order, partitions: int | None = None) -> DataFrame:
    """``located`` (distinct order keys with ``_n``, how many rows hold each) with ``_keys_before`` and ``_rows_before``,
    the numbers of keys and rows that come before a key in the global ``order``.

    Keys are dealt to ranges by edges that are drawn once; a window numbers them inside their range, and the
    totals of the ranges before are added. No task sees more than a range. ``located`` is read several times: a
    written table is best.
    """
    by, sort = [(o, True) if isinstance(o, str) else o for o in order], _sort_exprs(order)
    ranges = partitions or int(located.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    located = located.withColumn("_range", _place(located, by, _edges(located, by, ranges)))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    offsets = (located.groupBy("_range").agg(F.count(F.lit(1)).alias("_k"), F.sum("_n").alias("_m"))
               .select("_range", F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_k0"), F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_m0")))
    inside = Window.partitionBy("_range").orderBy(*sort)
    above = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (located.join(F.broadcast(offsets), "_range")  # a row a range
            .withColumn("_keys_before", F.col("_k0") + F.row_number().over(inside) - 1)
            .withColumn("_rows_before", F.col("_m0") + F.coalesce(F.sum("_n").over(above), F.lit(0)))
            .drop("_range", "_k0", "_m0"))


def dense_keys(members: DataFrame, code: str, key: str) -> DataFrame:
    """Surrogate keys 1..n by code order (C8): deterministic, unlike arrival order."""
    return rank_rows(members, [code], kind="row_number", out=key).withColumn(key, F.col(key).cast("int"))
