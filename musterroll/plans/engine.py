"""The query entry: one lazy plan from a table to the asked-for form."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from musterroll.functions.cleaning import truncate_text
from musterroll.functions.periods import check_period_range
from musterroll.operators import filters as flt
from musterroll.operators import reshape, snapshots, summaries, topk
from musterroll.operators.topk import check_limit
from musterroll.operators.project import project, quoted
from musterroll.operators.search import closest_by_edits
from musterroll.plans import catalog as cat
from musterroll.sources import text_index
from musterroll.sources.signatures import file_changes, file_signatures
from musterroll.sources.carve import carve, with_row_number
from musterroll.sources.delimited import read_delimited, read_grid
from musterroll.sources.tables import materialise, materialise_many
from musterroll.specs.model import Catalog, TableSpec
from musterroll.specs.registers import TRUNCATION_SUFFIX

# The output forms of a query.
FORMATS = ("records", "series", "csv")


class Engine:
    """Queries over the tables of a catalogue.

    ``bind`` ties a table id to a DataFrame, a Parquet path or a function that
    returns a DataFrame; ``ingest`` converts raw files once and binds the result.
    Every query method returns a lazy DataFrame.
    """

    def __init__(self, spark: SparkSession, catalog: Catalog):
        self.spark = spark
        self.catalog = catalog
        self._bound: dict[str, DataFrame | str | Callable[[], DataFrame]] = {}
        self._clean: set[str] = set()
        self._snapshots: dict[str, tuple[str, str]] = {}

    def bind(
        self,
        table_id: str,
        source: DataFrame | str | Callable[[], DataFrame],
        materialised: bool = False,
    ) -> Engine:
        """Tie a table to its data.

        ``materialised`` data is what :meth:`ingest` writes: clean, under friendly names
        and without blank rows, so filters reach its scan.
        """
        key = self.catalog.get(table_id).id
        self._bound[key] = source
        (self._clean.add if materialised else self._clean.discard)(key)
        return self

    def read_files(
        self, table_id: str, paths: str | Sequence[str], encoding: str = "auto"
    ) -> DataFrame:
        """The raw files of a register as a text table, carved where its spec says so."""
        spec = self.catalog.get(table_id)
        first = spec.header_row + 1
        if spec.header_row == 1 and spec.max_rows is None and spec.data_start_row in (None, first):
            # missing-value texts are dropped when the columns are cleaned
            return read_delimited(
                self.spark, paths, encoding=encoding, multiline=spec.multiline,
                drop_null_tokens=False,
            )
        grid = read_grid(self.spark, paths, encoding=encoding, multiline=spec.multiline)
        return carve(with_row_number(grid), spec.header_row, spec.data_start_row, spec.max_rows)

    def ingest(
        self,
        table_id: str,
        paths: str | Sequence[str],
        target: str,
        encoding: str = "auto",
        cluster_by: Sequence[str] = (),
        text_index: Sequence[str] = (),
    ) -> int:
        """Convert the raw files of a register to clean Parquet and bind it; returns its rows.

        Substring filters on the columns of ``text_index`` then read only blocks that can match.
        """
        spec = self.catalog.get(table_id)
        raw = self.read_files(table_id, paths, encoding)
        rows = materialise(raw, target, spec=spec, cluster_by=cluster_by, text_index=text_index)
        self.bind(spec.id, target, materialised=True)
        return rows

    def refresh(
        self,
        resources: DataFrame,
        as_of: str,
        target: Callable[[TableSpec], str],
        ids: Sequence[str] | None = None,
        host: str | None = None,
        signatures: Callable[[TableSpec], str] | None = None,
    ) -> DataFrame:
        """Convert and bind the current file of every table, as a portal listing names it.

        ``resources`` lists what a portal offers: package, name, format, url and listing
        order (``ordinal``).  A table's resource is the newest of its declared name on the
        allowed host; a table with a file template takes the newest day within its
        look-back that the listing has; where nothing is listed the table's default
        address is taken.  With ``signatures``, a place per table, files that are as they
        were when last converted are not converted again.  Returns id, url, status and
        rows per table.
        """
        specs = [self.catalog.get(i) for i in (ids or self.catalog.ids())]
        rows = []
        for spec in specs:  # tables of a catalogue, not data
            url = None
            try:
                url = self._current(spec, resources, as_of, host)
                if url is None:
                    rows.append((spec.id, None, "error: no resource is listed", None))
                elif signatures is not None and self._unchanged(spec, url, signatures):
                    self.bind(spec.id, target(spec), materialised=True)
                    rows.append((spec.id, url, "unchanged", None))
                    self._snapshots[spec.id] = (url, as_of)
                else:
                    rows.append((spec.id, url, "ok", self.ingest(spec.id, url, target(spec))))
                    if signatures is not None:  # only once the table stands
                        file_signatures(self.spark, url).write.mode("overwrite").parquet(signatures(spec))
                    self._snapshots[spec.id] = (url, as_of)
            except Exception as error:  # noqa: BLE001 - reported per table
                rows.append((spec.id, url, f"error: {type(error).__name__}: {error}", None))
        return self.spark.createDataFrame(rows, "id string, url string, status string, rows long")

    def _unchanged(self, spec: TableSpec, url: str, signatures: Callable[[TableSpec], str]) -> bool:
        """Has the file of a table the content it had when it was last converted?"""
        try:
            before = self.spark.read.parquet(signatures(spec))
        except AnalysisException:  # never converted
            return False
        after = file_signatures(self.spark, url, before)
        return file_changes(before, after).where(F.col("status") != "same").isEmpty()

    def _current(self, spec: TableSpec, resources: DataFrame, as_of: str, host: str | None) -> str | None:
        """Address of the newest listed file of a table, if there is one."""
        listed = resources
        if host is not None:
            listed = listed.where(snapshots.host_allowed(F.col("url"), host))
        if spec.file_template:
            name = re.split(r"\{date[^}]*\}", spec.file_template.rsplit("/", 1)[-1])
            pattern = "([0-9]{8})".join(map(re.escape, name))
            day = F.try_to_date(F.regexp_extract("url", f"{pattern}$", 1), "yyyyMMdd")
            today = F.lit(as_of).cast("date")
            inside = listed.withColumn("day", day).where(
                F.col("day").between(F.date_sub(today, spec.lookback_days), today)
            )
            row = inside.orderBy(F.col("day").desc(), "url").select("url").head()
        elif spec.discovery:
            rule = spec.discovery
            own = listed
            if rule.get("package"):
                own = own.where(F.col("package").isin(*self.catalog.packages(spec)))
            if rule.get("package_id_pattern"):  # of several years' packages the newest
                offered = own.withColumn("portal", F.lit(rule.get("organization_id") or ""))
                if rule.get("organization_id") and "organization" in own.columns:
                    offered = offered.where(F.col("organization") == rule["organization_id"])
                newest = snapshots.latest_package(offered, "portal", "package", "ordinal", rule["package_id_pattern"])
                own = own.join(newest.select("package"), "package", "left_semi")
            if rule.get("resource_name") or rule.get("resource_name_pattern"):
                found = snapshots.latest_resource(
                    own, "package", "name", "ordinal", exact=rule.get("resource_name"),
                    pattern=None if rule.get("resource_name") else rule["resource_name_pattern"],
                    fmt=rule.get("resource_format", "csv"),
                )
                row = found.orderBy(F.col("year").desc(), "package").select("url").head()
            else:
                row = None
        else:
            row = None
        return row["url"] if row else spec.default_url

    def spec(self, table_id: str) -> TableSpec:
        """The spec of a table in the form its bound data has."""
        spec = self.catalog.get(table_id)
        return spec.materialised() if spec.id in self._clean else spec

    def table(self, table_id: str) -> DataFrame:
        """The bound table as it is stored."""
        key = self.catalog.get(table_id).id
        if key not in self._bound:
            raise ValueError(f"no data is bound to table {key!r}")
        source = self._bound[key]
        if isinstance(source, str):
            return self.spark.read.parquet(source)
        return source() if callable(source) else source

    def _narrowed(self, spec: TableSpec, wanted: dict) -> DataFrame:
        """The stored rows of a table; where its text is indexed, without blocks that cannot match."""
        table, source = self.table(spec.id), self._bound[spec.id]
        if not isinstance(source, str) or text_index.BLOCK not in table.columns:
            return table
        substring = spec.substring_keys()
        needles = {k: flt.needle_of(str(v).strip(), k) for k, v in wanted.items() if k in substring and not isinstance(v, list)}
        return text_index.narrowed(table, source, needles)

    def rows(
        self,
        table_id: str,
        filters: object = None,
        start_period: object = None,
        end_period: object = None,
        date_column: str | None = None,
        cut_text: int | None = None,
    ) -> DataFrame:
        """Friendly, typed, filtered rows of a table, before any reshaping.

        On a wide table period bounds need a date column to act on; they are never
        ignored.  ``cut_text`` shortens the long text columns of the spec to so many
        characters; filters see the whole text.
        """
        spec = self.spec(table_id)
        start, end = check_period_range(start_period, end_period)
        wanted = flt.parse_filters(filters)
        bounded = spec.layout == "wide" and bool(start or end)
        if bounded and date_column not in [c.key for c in spec.columns]:
            raise ValueError(f"name the date column of {spec.id!r} the period bounds apply to")
        df = project(self._narrowed(spec, wanted), spec)
        dimensions = [c.key for c in spec.with_role("dimension")]
        asked = [*wanted, date_column if bounded else None]
        if spec.id not in self._clean and not any(k in dimensions for k in asked):
            # a filter on a dimension keeps no blank row anyway, and then the other
            # dimensions need not be read
            df = flt.drop_blank_rows(df, dimensions)
        df = flt.apply_filters(df, spec, wanted)
        if bounded:
            declared = self.catalog.get(spec.id).column(date_column)
            df = flt.date_range(df, date_column, start, end, iso=declared.dtype == "date")
        if cut_text is None or not spec.truncate:
            return df
        check_limit(cut_text, None)
        return df.withColumns(
            {k: truncate_text(quoted(k), cut_text, TRUNCATION_SUFFIX) for k in spec.truncate}
        )

    def _observations(
        self,
        spec: TableSpec,
        rows: DataFrame,
        measures: str | list[str] | None,
        start: str | None,
        end: str | None,
    ) -> DataFrame:
        if spec.layout == "transposed":
            return reshape.transposed_observations(rows, spec, measures, start, end)
        return reshape.wide_observations(rows, spec, measures, filled=self._filled(spec))

    @staticmethod
    def _filled(spec: TableSpec) -> bool:
        """Rows have a filled dimension: blank ones are gone if there is any dimension."""
        return bool(spec.with_role("dimension"))

    def query(
        self,
        table_id: str,
        filters: object = None,
        start_period: object = None,
        end_period: object = None,
        measures: str | list[str] | None = None,
        format: str | None = "records",
        date_column: str | None = None,
        cut_text: int | None = None,
        last_n: int | None = None,
    ) -> DataFrame:
        """Observations of a table as records, as series, or flat for CSV."""
        if format is not None and not isinstance(format, str):
            raise ValueError(f"format must be a string, got {type(format).__name__}")
        form = (format or "records").lower()
        if form not in FORMATS:
            raise ValueError(f"Unknown format {format!r}. Valid options: {FORMATS}")
        spec = self.spec(table_id)
        start, end = check_period_range(start_period, end_period)
        if last_n is not None:
            check_limit(last_n, None)
        rows = self.rows(table_id, filters, start, end, date_column, cut_text)
        if form == "csv" and spec.layout == "wide":
            return reshape.wide_flat(rows, spec, measures, filled=self._filled(spec))
        out = self._observations(spec, rows, measures, start, end)
        if last_n is not None:
            out = topk.last_n(out, last_n, has_periods=spec.layout == "transposed")
        if form == "series":
            return reshape.series(out)
        if form == "csv":
            return reshape.flatten(out, ["metric_source_label"])
        return out

    def latest(
        self,
        table_id: str,
        filters: object = None,
        limit: int = topk.DEFAULT_LIMIT,
        order_by: Sequence[str | Column] | None = None,
        cut_text: int | None = None,
        with_count: bool = True,
    ) -> DataFrame:
        """The newest observation per measure, at most ``limit`` rows in a stated order.

        ``truncated_at`` holds the full count where rows were cut, counted in the same
        pass.  The order defaults to the id columns of the table.
        """
        spec = self.catalog.get(table_id)
        topk.check_limit(limit)
        dims, bound = spec.dimension_keys, self.spec(table_id)
        ids = [c.key for c in spec.with_role("id")] or dims
        if order_by is None and spec.layout == "wide" and not set(dims) & set(reshape.OBSERVATION):
            # ordered on flat columns, which compare faster than a map's entries
            rows = self.rows(table_id, filters, cut_text=cut_text)
            flat = reshape.wide_flat(rows, bound, None, filled=self._filled(bound))
            order = [*ids, "measure", *[k for k in dims if k not in ids]]
            page = topk.limited(flat, order, limit, with_count)
            page = page.withColumn("dimensions", reshape.dimension_map(dims))
            return page.select(*reshape.OBSERVATION, *(["truncated_at"] if with_count else []))
        out = self.query(table_id, filters, cut_text=cut_text, last_n=1)
        if order_by is None:
            order_by = [F.try_element_at("dimensions", F.lit(k)) for k in ids]
            order_by += [F.col("measure"), F.col("period"), F.to_json("dimensions")]
        return topk.limited(out, order_by, limit, with_count)

    def summary(
        self,
        table_id: str,
        as_of: str | None = None,
        snapshot_date: str | None = None,
        **arguments: object,
    ) -> DataFrame:
        """One row that describes the result of a query, and echoes what was asked.

        With ``as_of`` it says whether the snapshot is stale; the snapshot's date is that
        of the last :meth:`refresh` unless given.
        """
        spec = self.catalog.get(table_id)
        start, end = arguments.get("start_period"), arguments.get("end_period")
        if snapshot_date is None and spec.id in self._snapshots:
            snapshot_date = self._snapshots[spec.id][1]
        source = self._snapshots.get(spec.id, ("",))[0]
        row = summaries.summary(
            self.query(table_id, **arguments), spec, start, end, source,
            snapshot_date=snapshot_date, as_of=as_of,
        )
        asked = dict(arguments, filters=flt.parse_filters(arguments.get("filters")))
        asked = {k: v for k, v in asked.items() if v not in (None, {})}
        return row.withColumn("query", F.lit(json.dumps(asked, sort_keys=True)))

    def suggest(self, table_id: str, key: str, value: str) -> DataFrame:
        """Help for a filter value that finds nothing: near values, or the range of years.

        A job of its own, so that a query never has to run twice to explain itself.
        """
        spec = self.spec(table_id)
        rows = project(self.table(table_id), spec).select(quoted(spec.check_filter_key(key)))
        if re.fullmatch("[0-9]{4}", value.strip()) and key not in spec.enums:
            return summaries.year_hint(rows, key, int(value))
        return closest_by_edits(rows, key, value.strip())

    def materialise_all(
        self,
        load: Callable[[TableSpec], DataFrame],
        target: Callable[[TableSpec], str],
        ids: Sequence[str] | None = None,
        max_concurrency: int = 2,
    ) -> DataFrame:
        """Convert many tables and bind those that succeed; status and rows per table."""
        status = materialise_many(self.spark, self.catalog, load, target, ids, max_concurrency)
        for row in status.collect():
            if row["status"] == "ok":
                self.bind(row["id"], target(self.catalog.get(row["id"])), materialised=True)
        return status

    def values(self, table_id: str) -> DataFrame:
        """Accepted values of a table's enum columns: alias and source value."""
        return cat.enum_values(self.spark, [self.catalog.get(table_id)])

    def search(self, query: str, limit: int = 10) -> DataFrame:
        return cat.search(self.spark, self.catalog, query, limit)

    def describe(self, table_id: str) -> DataFrame:
        """Columns of a table: filterable dimensions and measures."""
        return cat.column_details(self.spark, [self.catalog.get(table_id)])

    def tables(self) -> DataFrame:
        return cat.tables(self.spark, self.catalog)

    def ids(self) -> list[str]:
        return self.catalog.ids()
