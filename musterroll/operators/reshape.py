"""Wide and transposed tables to observations, and observations to output forms.

An observation is ``period, measure, value, unit, dimensions``.
"""

from __future__ import annotations

import dataclasses
from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from musterroll.functions.cleaning import strip_text, to_double
from musterroll.functions.periods import normalize_period, period_text_in_range
from musterroll.operators.lookup import label_column
from musterroll.operators.project import quoted
from musterroll.specs.model import TableSpec

OBSERVATION = ("period", "measure", "value", "unit", "dimensions")



def named(column: str) -> str:
    """A column in SQL text: one expression is parsed faster than many are built."""
    return "`" + column.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A text literal in SQL text."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def no_text() -> Column:
    return F.lit(None).cast("string")


def dimension_map(keys: list[str]) -> Column:
    """Map of the filled dimension values of a row, as text, in key order."""
    pairs = ", ".join(f"{literal(k)}, CAST({named(k)} AS string)" for k in keys)
    return F.expr(f"map_filter(map({pairs}), (k, v) -> v IS NOT NULL)")


def unit_column(spec: TableSpec, measures: list[str]) -> Column:
    units = {m: spec.column(m).unit for m in measures if spec.column(m).unit}
    if not units:
        return no_text()
    pairs = chain.from_iterable((F.lit(k), F.lit(v)) for k, v in units.items())
    return F.try_element_at(F.create_map(*pairs), F.col("measure"))


def wide_flat(
    df: DataFrame, spec: TableSpec, measures: list[str] | None = None, filled: bool = False
) -> DataFrame:
    """One row per (row, measure) with a filled value, dimensions as columns.

    Without measures every row yields one observation that carries only its
    dimensions; rows with no filled dimension are dropped, unless ``filled`` says
    that there are none (the test would read every dimension).
    """
    measures = spec.resolve_measures(measures)
    dims = spec.dimension_keys
    if not measures:
        rows = df if filled else df.na.drop(how="all", subset=dims)
        return rows.select(
            no_text().alias("period"),
            no_text().alias("measure"),
            F.lit(None).cast("double").alias("value"),
            no_text().alias("unit"),
            *[quoted(k).cast("string").alias(k) for k in dims],
        )
    cells = df.selectExpr(
        *[f"CAST({named(k)} AS string) AS {named(k)}" for k in dims],
        *[f"CAST({named(m)} AS double) AS {named(m)}" for m in measures],
    )
    return (
        cells.unpivot([quoted(k) for k in dims], [quoted(m) for m in measures], "measure", "value")
        .where(F.col("value").isNotNull())
        .select(
            no_text().alias("period"),
            "measure",
            "value",
            unit_column(spec, measures).alias("unit"),
            *[quoted(k) for k in dims],
        )
    )


def wide_observations(
    df: DataFrame, spec: TableSpec, measures: list[str] | None = None, filled: bool = False
) -> DataFrame:
    """Like :func:`wide_flat`, with the dimensions in one map column."""
    dims = spec.dimension_keys
    if not set(dims) & set(OBSERVATION):
        return mapped(wide_flat(df, spec, measures, filled), dims)
    other = {k: f"_dimension_{i}" for i, k in enumerate(dims)}  # a dimension may be called "unit"
    renamed = dataclasses.replace(
        spec,
        columns=tuple(dataclasses.replace(c, key=other.get(c.key, c.key)) for c in spec.columns),
        enums={}, natural_key=(), truncate={},
    )
    flat = wide_flat(df.withColumnsRenamed(other), renamed, measures, filled)
    return mapped(flat, dims, other)


def mapped(flat: DataFrame, dims: list[str], held: dict[str, str] | None = None) -> DataFrame:
    """Flat observations with their dimension columns gathered in one map.

    Best done last: grouping, ordering and cutting are cheaper on flat columns.
    """
    held = held or {k: k for k in dims}
    pairs = chain.from_iterable((F.lit(k), quoted(held[k])) for k in dims)
    filled = F.map_filter(F.create_map(*pairs), lambda _, value: value.isNotNull())
    rest = [c for c in flat.columns if c not in {*OBSERVATION, *held.values()}]
    return flat.select("period", "measure", "value", "unit", filled.alias("dimensions"), *rest)


def transposed_observations(
    df: DataFrame,
    spec: TableSpec,
    measures: list[str] | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Metric-by-period table to observations.

    Every column but label and unit is a period; the period bounds choose columns
    before the unpivot.  Asked-for measures (or all declared labels) choose rows.
    """
    label = spec.key_of(spec.metric_label)
    unit = spec.key_of(spec.unit_column) if spec.unit_column else None
    enum = spec.metric_enum()
    measures = spec.resolve_measures(measures)
    periods = [
        n for n in df.columns if n not in (label, unit) and period_text_in_range(n, start, end)
    ]
    if not periods:
        return df.sparkSession.createDataFrame([], observation_schema())

    rows = df.withColumn("_label", strip_text(quoted(label).cast("string")))
    rows = rows.where(F.col("_label").isNotNull())
    if measures:
        rows = rows.where(F.col("_label").isin(*sorted({(enum or {}).get(m, m) for m in measures})))
    types = {f.name: f.dataType for f in df.schema.fields}
    text = all(isinstance(types[p], T.StringType) for p in periods)
    cells = rows.select(
        F.col("_label"),
        (quoted(unit).cast("string") if unit else no_text()).alias("_unit"),
        *[
            quoted(p) if text else to_double(quoted(p)).alias(p)
            if isinstance(types[p], T.StringType)
            else F.when(~F.isnan(quoted(p).cast("double")), quoted(p).cast("double")).alias(p)
            for p in periods
        ],
    )
    long = cells.unpivot(["_label", "_unit"], [quoted(p) for p in periods], "period", "value")
    if text:  # one cast over the long column instead of one per period
        long = long.where(F.col("value").isNotNull()).withColumn("value", to_double(F.col("value")))
    return (
        long.where(F.col("value").isNotNull())
        .select(
            "period",
            label_column(F.col("_label"), enum).alias("measure"),
            "value",
            F.col("_unit").alias("unit"),
            F.create_map(F.lit("metric_source_label"), F.col("_label")).alias("dimensions"),
        )
    )


def with_labels(observations: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """Observations whose source label occurs in a table of labels."""
    label = F.try_element_at("dimensions", F.lit("metric_source_label"))
    wanted = labels.select(F.col(column).alias("_wanted")).distinct()
    return observations.join(wanted, label == F.col("_wanted"), "left_semi")


def observation_schema() -> T.StructType:
    text = T.StringType()
    return T.StructType(
        [
            T.StructField("period", text),
            T.StructField("measure", text),
            T.StructField("value", T.DoubleType()),
            T.StructField("unit", text),
            T.StructField("dimensions", T.MapType(text, text)),
        ]
    )


def flatten(observations: DataFrame, keys: list[str]) -> DataFrame:
    """Observations with one column per dimension key, in the given order."""
    return observations.select(
        "period",
        "measure",
        "value",
        "unit",
        *[F.try_element_at("dimensions", F.lit(k)).alias(k) for k in keys],
    )


def csv_lines(flat: DataFrame) -> DataFrame:
    """Every row of a flat table as one line of CSV text."""
    return flat.select(F.to_csv(F.struct(*[quoted(c) for c in flat.columns])).alias("line"))


def dimension_names(observations: DataFrame) -> DataFrame:
    """Every dimension key that occurs (combined map-side before the shuffle)."""
    return observations.select(F.explode(F.map_keys("dimensions")).alias("name")).distinct()


def dimension_order(observations: DataFrame, row: Column | None = None) -> DataFrame:
    """(name, place): every dimension key, numbered in the order in which rows first have it.

    Rows count in the order in which they come, or by ``row``; the first row of a key is
    found in every task before the shuffle, and what is numbered is one row per key.
    """
    row = F.monotonically_increasing_id() if row is None else row
    held = observations.select(row.alias("_row"), F.posexplode(F.map_keys("dimensions")).alias("_at", "name"))
    first = held.groupBy("name").agg(F.min(F.struct("_row", "_at")).alias("_first"))
    return first.select("name", F.row_number().over(Window.orderBy("_first", "name")).alias("place"))


def flatten_as_seen(observations: DataFrame, row: Column | None = None) -> DataFrame:
    """Flat observations whose header has every dimension key that occurs, as first seen.

    The keys are looked up first, in a pass of its own; they are names of columns.
    """
    names = dimension_order(observations, row).orderBy("place").select("name").collect()
    return flatten(observations, [r["name"] for r in names])


def _chunk_layout(rows: DataFrame, chunk_rows: int) -> DataFrame:
    """Per measure and month the first and last chunk its rows belong to.

    As small as measures times months; counted in every task first.  Counting per
    unit too keeps the big aggregate a hash aggregate.
    """
    by_month = Window.partitionBy("_m").orderBy(F.col("_p").asc_nulls_first())
    size = F.lit(chunk_rows)
    upto = F.sum("_n").over(by_month.rowsBetween(Window.unboundedPreceding, 0))
    first = F.floor((upto - F.col("_n")) / size)
    return (
        rows.groupBy(F.col("measure").alias("_m"), F.col("_month").alias("_p"), "unit")
        .agg(F.count("*").alias("_n"))
        .groupBy("_m", "_p")
        .agg(F.sum("_n").alias("_n"), F.min("unit").alias("_u"))
        .select(
            "_m",
            "_p",
            F.min("_u").over(Window.partitionBy("_m")).alias("_u"),
            first.alias("_first"),
            F.when(F.col("_n") > size, F.floor((upto - 1) / size)).otherwise(first).alias("_last"),
        )
    )


def series(observations: DataFrame, chunk_rows: int = 10_000) -> DataFrame:
    """Observations grouped into series per measure, in bounded chunks.

    One row per ``(measure, chunk)``; reading the chunks of a measure in order
    gives its whole series by period.  A measure may hold most of a table, so no
    task ever gathers one: chunk borders come from a count per (measure, month),
    and a month larger than a chunk is spread over several.  The spread depends
    on the row and on the task that read it, so copies of one row part ways too
    and a recomputed task repeats its choice.

    The plan is lazy: how the borders meet the rows is left to Spark, which broadcasts
    them by their measured size and splits a hot month of a larger join.
    """
    rows = observations.select(
        F.coalesce(F.nullif("measure", F.lit("")), F.lit("value")).alias("measure"),
        "unit",
        normalize_period(F.col("period")).alias("_month"),
        F.struct("period", "value", "dimensions").alias("_o"),
        F.xxhash64(
            "period", "value", F.map_entries("dimensions"), F.spark_partition_id()
        ).alias("_spread"),
    )
    layout = _chunk_layout(rows, chunk_rows)

    same_month = (F.col("measure") == F.col("_m")) & F.col("_month").eqNullSafe(F.col("_p"))
    chunk = F.col("_first") + F.pmod("_spread", F.col("_last") - F.col("_first") + 1)
    order = F.struct(
        F.col("_o.period").alias("period"),
        F.col("_o.value").alias("value"),
        F.map_entries("_o.dimensions").alias("dims"),
    )
    return (
        rows.join(layout, same_month)
        .select(
            "measure",
            F.col("_u").alias("unit"),
            chunk.alias("chunk"),
            F.struct("_month", order.alias("o")).alias("_row"),
        )
        # lists do not shrink inside a task: bring the rows together first
        .repartition("measure", "chunk")
        .groupBy("measure", "unit", "chunk")
        .agg(F.sort_array(F.collect_list("_row")).alias("_list"))
        .select(
            "measure",
            "unit",
            "chunk",
            F.transform(
                "_list",
                lambda x: F.struct(
                    x["o"]["period"].alias("period"),
                    x["o"]["value"].alias("value"),
                    F.map_from_entries(x["o"]["dims"]).alias("dimensions"),
                ),
            ).alias("observations"),
        )
    )
