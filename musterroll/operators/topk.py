"""Last N per measure, limited listings with their full count, ranked tops."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.internal import InternalFunction  # Spark's bounded heap as an aggregate

from musterroll.functions.periods import normalize_period

# Default and largest number of rows of a limited listing.
DEFAULT_LIMIT, MAX_LIMIT = 50, 10_000

# Tops meet in this many groups before they are merged.
MERGE_GROUPS = 256


def check_limit(limit: object, largest: int | None = MAX_LIMIT) -> int:
    if isinstance(limit, bool) or not isinstance(limit, int):
        raise ValueError(f"limit must be a positive integer, got {limit!r}")
    if limit < 1 or (largest is not None and limit > largest):
        upto = "" if largest is None else f" and at most {largest}"
        raise ValueError(f"limit must be at least 1{upto}, got {limit}")
    return limit


def _keep_last(observations: DataFrame, n: int, tiebreak: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(F.coalesce("measure", F.lit(""))).orderBy(
        F.coalesce(normalize_period(F.col("period")), F.lit("")).desc(),
        F.col("period").desc_nulls_last(),
        *tiebreak,
    )
    # rank <= n lets Spark keep n rows per measure in every task before the shuffle
    ranked = observations.withColumn("_rank", F.row_number().over(window))
    return ranked.where(F.col("_rank") <= n).drop("_rank")


#: Above this many rows per measure a cut is found by counting instead of ranking; it is the
#: largest rank that the session's ``windowGroupLimitThreshold`` lets tasks cut at.
GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def _newest_by_count(observations: DataFrame, n: int, tiebreak: Sequence[Column]) -> DataFrame:
    """The N newest per measure without sorting any measure.

    Counts per measure and period, added up from the newest on, find the period in which
    the N-th row falls.  Newer periods pass whole; only rows of that period are ranked.
    A measure has a cut only if it has N rows, so the cuts go to the rows, however large
    their counts look, and a measure is never gathered.  Of a period with more rows than
    are wanted tasks keep the first of theirs in a fixed number of groups per measure.
    """
    names = observations.columns
    rows = observations.withColumns(
        {"_m": F.coalesce("measure", F.lit("")), "_p": F.coalesce(normalize_period(F.col("period")), F.lit(""))}
    )
    newer_first = [F.col("_p").desc(), F.col("period").desc_nulls_last()]
    upto = Window.partitionBy("_m").orderBy(*newer_first).rowsBetween(Window.unboundedPreceding, 0)
    counts = rows.groupBy("_m", "_p", "period").agg(F.count("*").alias("_n"))
    cuts = (
        counts.withColumn("_upto", F.sum("_n").over(upto))
        .where((F.col("_upto") >= n) & (F.col("_upto") - F.col("_n") < n))
        .select(F.col("_m").alias("_cm"), F.col("_p").alias("_cp"), F.col("period").alias("_cperiod"), (n - F.col("_upto") + F.col("_n")).alias("_room"))
    )
    placed = rows.join(F.broadcast(cuts), F.col("_m") == F.col("_cm"), "left")
    there = F.struct("_p", "period")  # null sorts before every text, as the oldest period does
    cut = F.struct(F.col("_cp").alias("_p"), F.col("_cperiod").alias("period"))
    whole = placed.where(F.col("_cm").isNull() | (there > cut)).select(*names)
    tied = placed.where(F.col("_cm").isNotNull() & there.eqNullSafe(cut))
    tied = tied.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)))
    for together in (["_m", "_group"], ["_m"]):
        ranked = tied.withColumn("_rank", F.row_number().over(Window.partitionBy(*together).orderBy(*tiebreak)))
        tied = ranked.where(F.col("_rank") <= F.col("_room"))
    return whole.unionByName(tied.select(*names))


def _newest(observations: DataFrame, n: int, tiebreak: Sequence[Column]) -> DataFrame:
    cut_in_tasks = int(observations.sparkSession.conf.get(GROUP_LIMIT, "1000"))
    return (_keep_last if n <= cut_in_tasks else _newest_by_count)(observations, n, tiebreak)


def last_n(
    observations: DataFrame,
    n: int,
    tiebreak: Sequence[Column] | None = None,
    has_periods: bool | None = None,
) -> DataFrame:
    """The N newest observations per measure, by normalised period.

    Up to the session's group limit every task cuts to N before the shuffle; beyond it
    counts per period find where to cut, whatever N.  When every period is null nothing is cut.  ``has_periods`` says so at plan
    time where the layout tells; left at None it is looked up in the data by a
    one-row subquery.
    """
    if n < 1:
        raise ValueError(f"n must be at least 1, got {n}")
    if tiebreak is None:
        tiebreak = [F.to_json("dimensions"), F.col("value")]
    if has_periods is not None:
        return _newest(observations, n, tiebreak) if has_periods else observations
    dated = observations.agg(F.coalesce(F.bool_or(F.col("period").isNotNull()), F.lit(False)))
    trimmed = _newest(observations.where(dated.scalar()), n, tiebreak)
    return trimmed.unionByName(observations.where(~dated.scalar()))


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _upward(df: DataFrame, order: str | Falling) -> list[str] | None:
    """SQL sort keys that order rows upwards, nulls first, as an order does; None if there are none.

    A column is its own key; a :class:`Falling` number is turned round.
    """
    if isinstance(order, str):
        return [_name(order)]
    dtype, col = df.schema[order.name].dataType, _name(order.name)
    # the number first: what tells null and NaN from the outermost numbers rarely counts
    if isinstance(dtype, T.IntegralType):
        return [f"coalesce(~cast({col} AS bigint), {(1 << 63) - 1}L)", f"{col} IS NULL"]
    if isinstance(dtype, T.DoubleType | T.FloatType):
        number = f"CASE WHEN isnan({col}) THEN double('-infinity') ELSE -cast({col} AS double) END"
        return [f"coalesce({number}, double('infinity'))", f"CASE WHEN {col} IS NULL THEN 2 WHEN isnan({col}) THEN 0 ELSE 1 END"]
    if isinstance(dtype, T.DecimalType):
        return [f"{col} IS NULL", f"-{col}"]
    return None


def _is_sort(order: object) -> bool:
    return isinstance(order, Column) and str(order).endswith(("NULLS FIRST'>", "NULLS LAST'>"))


@dataclass(frozen=True)
class Falling:
    """A column whose largest values come first and nulls last."""

    name: str

    def order(self) -> Column:
        return F.col(f"`{self.name}`").desc_nulls_last()


def _heaped(df: DataFrame, names: list[str], keys: list[str], limit: int) -> DataFrame:
    """One row: ``_rows``, the first ``limit`` rows by the keys, and ``_total``, how many there are.

    A bounded heap per task keeps its first rows and counts in the same pass.  Tasks meet
    in a fixed number of groups, and those groups in one, so no step takes in the rows of
    more than :data:`MERGE_GROUPS` heaps.
    """
    maps = {f.name for f in df.schema.fields if isinstance(f.dataType, T.MapType)}
    # keys and row side by side: nested structs compare several times slower; maps have no order, their entries do
    fields = [f"{k} AS _key_{i}" for i, k in enumerate(keys)]
    fields += [f"{f'map_entries({_name(n)})' if n in maps else _name(n)} AS _row_{i}" for i, n in enumerate(names)]
    first = InternalFunction.collect_top_k(F.col("_row"), limit, True).alias("_rows")
    rows = df.selectExpr(f"pmod(spark_partition_id(), {MERGE_GROUPS}) AS _group", f"struct({', '.join(fields)}) AS _row")
    parts = rows.groupBy("_group").agg(first, F.expr("count(*) AS _n"))
    return parts.selectExpr("_n", "posexplode(_rows) AS (_place, _row)").agg(first, F.expr("sum(CASE WHEN _place = 0 THEN _n END) AS _total"))


def _ordered(order: str | Column | Falling) -> str | Column:
    return order.order() if isinstance(order, Falling) else order


def _sortable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _sortable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_sortable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, T.MapType | T.VariantType)


def _first(df: DataFrame, order_by: Sequence[str | Column | Falling], limit: int, count: bool) -> DataFrame:
    fields = df.schema.fields
    kinds = [f.dataType for f in fields]
    kinds = [T.StructType().add("k", k.keyType).add("v", k.valueType) if isinstance(k, T.MapType) else k for k in kinds]
    worked_out = {f"_order_{i}": o for i, o in enumerate(order_by) if isinstance(o, Column)}
    keys = [None]
    if all(map(_sortable, kinds)) and not any(map(_is_sort, worked_out.values())):
        orders = [f"_order_{i}" if isinstance(o, Column) else o for i, o in enumerate(order_by)]
        keys = [_upward(df, o) for o in orders]
    if None in keys:
        listed = _merged(df, list(map(_ordered, order_by)), limit)
        if not count:
            return listed
        total = df.agg(F.count("*")).scalar()
        return listed.withColumn("truncated_at", F.when(total > limit, total))
    found = _heaped(df.withColumns(worked_out) if worked_out else df, df.columns, [k for ks in keys for k in ks], limit)
    columns = [
        f"{f'map_from_entries(_row._row_{i})' if isinstance(f.dataType, T.MapType) else f'_row._row_{i}'} AS {_name(f.name)}"
        for i, f in enumerate(fields)
    ]
    total = [f"CASE WHEN _total > {limit} THEN _total END AS truncated_at"] if count else []
    return found.selectExpr("_total", "explode(_rows) AS _row").selectExpr(*columns, *total)


def _merged(df: DataFrame, order_by: Sequence[str | Column], limit: int) -> DataFrame:
    """The first rows in any order that Spark sorts by, in two steps."""
    group = F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS))
    window = Window.partitionBy("_group").orderBy(*order_by)
    ranked = df.withColumn("_group", group).withColumn("_rank", F.row_number().over(window))
    df = ranked.where(F.col("_rank") <= limit).drop("_group", "_rank")
    return df.orderBy(*order_by).limit(limit)


def first_in_order(df: DataFrame, order_by: Sequence[str | Column | Falling], limit: int) -> DataFrame:
    """The first ``limit`` rows in a total order, in that order.

    Tasks keep their first rows in a bounded heap and meet in a fixed number of groups
    that do the same, so the last step merges few groups however many tasks there are.
    Every column of ``df`` is read and goes through the heaps.  Orders with a sort direction of their own are ranked by windows instead of heaps.
    """
    return _first(df, order_by, limit, count=False)


def limited(
    df: DataFrame,
    order_by: Sequence[str | Column | Falling],
    limit: int = DEFAULT_LIMIT,
    with_count: bool = True,
) -> DataFrame:
    """The first rows in a given order, with the full count where rows were cut.

    ``truncated_at`` is the count of all rows if there are more than ``limit``, else
    null; it is counted while the rows are found.  Without it there is no such column.
    """
    check_limit(limit)
    return _first(df, order_by, limit, with_count)


def top_n(df: DataFrame, measure: str, n: int, tiebreak: Sequence[str]) -> DataFrame:
    """Rows with the largest measure, ties broken by the given columns.

    Rows pass the heaps whole: select the columns in use first.
    """
    check_limit(n, None)
    return first_in_order(df, [Falling(measure), *tiebreak], n)
