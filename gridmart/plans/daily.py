"""The daily run: landed files to raw tables, silver merges, gold marts and checks."""

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from gridmart import schemas, session
from gridmart.functions import trailing_period
from gridmart.operators import merge, quality
from gridmart.operators.audit import AuditLog, current_state
from gridmart.operators.loads import append_load
from gridmart.plans import gold, partials, reports, silver
from gridmart.sources import landing, ledger, versions
from gridmart.sources.raw import BRONZE_VIEWS, bronze, column_names, facets, read_raw
from gridmart.sources.sinks import append_table, refresh_table, write_reports

PARTS = ("load", "silver", "gold", "check")
INCREMENTAL_MODES = ("replace_delta", "recompute_touched", "merge_partials")


class Lake:
    """Paths of one set of tables: ``raw``, ``staging`` (silver) and ``analytics`` (gold)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.raw = f"{self.root}/raw"
        self.staging = f"{self.root}/staging"
        self.analytics = f"{self.root}/analytics"
        self.rejected = f"{self.root}/rejected"
        self.audit = AuditLog(spark, self.raw)

    # ---- raw -----------------------------------------------------------------------------

    def load_generation(self, records: DataFrame, run_id: str = "manual", **options) -> int:
        normalised = landing.normalise_generation(records, request_id=run_id)
        return self._load_keyed(schemas.GENERATION, normalised, run_id, **options)

    def load_prices(self, records: DataFrame, run_id: str = "manual", **options) -> int:
        normalised = landing.normalise_prices(records, request_id=run_id)
        return self._load_keyed(schemas.PRICES, normalised, run_id, **options)

    def load_readings(self, table: str, readings: DataFrame, run_id: str = "manual", **options) -> int:
        """Append weather, carbon or market readings."""
        return self._load_appended(table, landing.normalise_readings(readings, table), run_id, **options)

    def load_forecasts(self, forecasts: DataFrame, run_id: str = "manual", **options) -> int:
        """Append the points of nested demand forecasts."""
        normalised = landing.normalise_demand_forecast(forecasts)
        return self._load_appended(schemas.FORECAST, normalised, run_id, **options)

    def load_landed(self, table: str, path: str, run_id: str = "manual", **options) -> int:
        """Load the files of a landing of readings or forecasts that no load has taken yet."""
        listed = ledger.new_files(self.spark, path, f"{self.raw}/{table}")
        files = self.spark.createDataFrame(listed.collect(), listed.schema)
        paths = ledger.paths(files)
        if not paths:
            return 0
        if table == schemas.FORECAST:
            return self.load_forecasts(landing.read_forecasts(self.spark, paths), run_id, files=files, **options)
        readings = landing.read_readings(self.spark, table, paths)
        return self.load_readings(table, readings, run_id, files=files, **options)

    def _load_keyed(
        self,
        table: str,
        normalised: DataFrame,
        run_id: str,
        since: str | None = None,
        until: str | None = None,
        states: Sequence[str] | None = None,
        ingested_at=None,
        strict: bool = False,
    ) -> int:
        def load(good: DataFrame, key: str) -> int:
            wanted = facets(good, since, until, list(states) if states else None)
            rows = landing.stamped(wanted, ingested_at)
            order = [name for name in landing.ARRIVAL if name in rows.columns]
            return merge.insert_into_table(self.spark, table, self.raw, rows, order, key)

        return self._load(table, normalised, run_id, "eia_api", load, strict)

    def _load_appended(
        self,
        table: str,
        normalised: DataFrame,
        run_id: str,
        ingested_at=None,
        strict: bool = False,
        files: DataFrame | None = None,
    ) -> int:
        def load(good: DataFrame, key: str) -> int:
            names = [name for name in column_names(table) if name != "id"]
            rows = landing.stamped(good, ingested_at).select(*names)
            schemas.check_contract(rows, table, without=("id",))
            return append_load(self.spark, f"{self.raw}/{table}", rows, key)

        return self._load(table, normalised, run_id, "enrichment_api", load, strict, files)

    def _load(
        self,
        table: str,
        normalised: DataFrame,
        run_id: str,
        source: str,
        load: Callable[[DataFrame, str], int],
        strict: bool,
        files: DataFrame | None = None,
    ) -> int:
        """Stage the parsed rows, set the rejected ones aside, load the others.

        ``files`` are the landed files they come from, taken with the load.
        """
        path = f"{self.raw}/{table}"
        if normalised.isEmpty():
            if files is not None:
                key = f"none-{uuid.uuid4().hex}"
                ledger.record(files, path, key)
                ledger.record_empty(self.spark, path, key)
            return 0

        def run(number: int) -> int:
            folder = session.scratch_path(self.spark, f"parsed-{table}")
            try:
                normalised.write.parquet(folder)
                parsed = self.spark.read.schema(normalised.schema).parquet(folder)
                if strict:
                    landing.strict(parsed).write.format("noop").mode("overwrite").save()
                bad = landing.rejected(parsed)
                if not bad.isEmpty():
                    append_table(bad, f"{self.rejected}/{table}")
                key = f"batch-{number}"
                if files is not None:
                    ledger.record(files, path, key)
                added = load(landing.accepted(parsed), key)
                if files is not None and not added:
                    ledger.record_empty(self.spark, path, key)
                return added
            finally:
                session.remove_folder(self.spark, folder)

        return self.audit.track(run_id, table, source, run)

    def raw_table(self, table: str) -> DataFrame:
        """A raw table; one that nothing was loaded into yet has no rows."""
        if not session.path_exists(self.spark, f"{self.raw}/{table}"):
            return self.spark.createDataFrame([], schemas.RAW_TABLES[table])
        return read_raw(self.spark, table, self.raw)

    def view(self, view: str) -> DataFrame:
        return bronze(self.raw_table(BRONZE_VIEWS[view]), view)

    # ---- silver --------------------------------------------------------------------------

    def staged(self, name: str) -> DataFrame:
        """A silver table; one that was not built yet has no rows."""
        stored = merge.existing_table(self.spark, self._target(name))
        if stored is None:
            model = silver.MODELS[name]
            return model.build(self.view(model.source)).limit(0)
        return stored

    def _target(self, name: str) -> merge.MergeTarget:
        model = silver.MODELS[name]
        return merge.MergeTarget(f"{self.staging}/{name}", model.keys, model.order, model.partition_by)

    def refresh_silver(
        self,
        name: str,
        full_refresh: bool = False,
        incremental_mode: str = "recompute_touched",
        lookback_days: int = 0,
    ) -> int:
        """Bring one silver table up to date; returns the number of keys written.

        ``recompute_touched`` aggregates every touched day again from all of its readings and
        equals a full refresh. ``replace_delta`` aggregates the new readings alone, as published:
        a day that gets late readings is replaced by their aggregate. ``merge_partials`` adds them
        to the stored sums of their days: equal to a full refresh without reading any reading twice.
        """
        if incremental_mode not in INCREMENTAL_MODES:
            raise ValueError(f"unknown incremental_mode: {incremental_mode}")
        model, target = silver.MODELS[name], self._target(name)
        if not session.path_exists(self.spark, f"{self.raw}/{BRONZE_VIEWS[model.source]}"):
            return 0
        source = self.view(model.source)
        if full_refresh:
            built = merge.last_per_key(model.build(source), model.keys, model.order)
            partitions = [model.partition_by] if model.partition_by else []
            refresh_table(built, target.path, partitions)
            return self.staged(name).count()
        if incremental_mode == "merge_partials" and model.time_column:
            return self._merge_partials(name, source)
        mark = merge.watermark(self.spark, target)
        delta = merge.since_watermark(source, mark, lookback_days=lookback_days)
        if mark is not None and model.time_column and incremental_mode == "recompute_touched":
            built = merge.recompute_touched(source, delta, model.build, model.keys, model.time_column)
        else:
            built = model.build(delta)
        return merge.merge_table(self.spark, target, built)

    def _merge_partials(self, name: str, source: DataFrame) -> int:
        kept, path = partials.models()[name], f"{self.staging}/_partials/{name}"
        delta = merge.since_watermark(source, partials.watermark(self.spark, path))
        touched = partials.take_in(self.spark, kept, path, delta)
        partials.show(self.spark, kept, path, self._target(name).path)
        return touched

    # ---- gold ----------------------------------------------------------------------------

    def mart(self, name: str, ordered: bool = False) -> DataFrame:
        """A stored mart, without rows if it was not built yet; ``ordered`` sorts it the way it is published."""
        stored = versions.read(self.spark, f"{self.analytics}/{name}")
        if stored is None:
            stored = self._planned(name).limit(0)
        return gold.in_published_order(stored, name) if ordered else stored

    def _planned(
        self,
        name: str,
        carbon_join: str = "reference",
        co2_divisor: int = gold.PARITY_DIVISOR,
        dedupe_dims: bool = False,
        calendar: bool = False,
    ) -> DataFrame:
        """A mart from the stored tables it depends on."""
        if name == "gold_generation_by_fuel_monthly":
            generation, carbon = self.staged("silver_generation_cleaned"), self.staged("silver_carbon_reference")
            return gold.generation_by_fuel(generation, carbon, carbon_join, co2_divisor)
        if name == "gold_price_trends":
            prices, market = self.staged("silver_prices_cleaned"), self.staged("silver_market_aggregated")
            return gold.price_trends(prices, market, calendar)
        if name == "gold_carbon_footprint":
            return gold.carbon_footprint(self.mart("gold_generation_by_fuel_monthly"))
        footprint, trends = self.mart("gold_carbon_footprint"), self.mart("gold_price_trends")
        market, weather = self.staged("silver_market_aggregated"), self.staged("silver_weather_aggregated")
        return gold.executive_summary(footprint, trends, market, weather, dedupe_dims)

    def refresh_gold(self, **options) -> None:
        """Rebuild the four marts, each from stored tables only; see ``_planned`` for the options."""
        for name in quality.GOLD_CHECKS:
            refresh_table(self._planned(name, **options), f"{self.analytics}/{name}")

    # ---- checks and reports --------------------------------------------------------------

    def quality_report(self) -> DataFrame:
        """All declared checks. A bronze view is checked in the scan of its raw table."""
        views = {table: view for view, table in BRONZE_VIEWS.items()}
        parts = []
        for table, checks in quality.RAW_CHECKS.items():
            declared = {table: checks}
            if table in views:
                declared[views[table]] = quality.BRONZE_CHECKS[views[table]]
            parts.append(quality.run_checks_together(self.raw_table(table), declared, stored_ids=True))
        refined = {name: self.staged(name) for name in quality.SILVER_CHECKS}
        refined |= {name: self.mart(name) for name in quality.GOLD_CHECKS}
        return reduce(DataFrame.unionByName, [*parts, quality.quality_report(refined)])

    def reports(self, as_of_year: int, **since) -> dict[str, DataFrame]:
        return reports.all_reports(
            self.mart("gold_generation_by_fuel_monthly"),
            self.mart("gold_price_trends"),
            self.mart("gold_carbon_footprint"),
            self.mart("gold_executive_summary"),
            self.staged("silver_market_aggregated"),
            current_state(self.audit.read()),
            as_of_year,
            **since,
        )


def run_daily(
    spark: SparkSession,
    landed: dict[str, str],
    root: str,
    as_of: dt.datetime,
    run_id: str,
    window_days: int | None = 90,
    incremental_mode: str = "recompute_touched",
    report_root: str | None = None,
    parts: Sequence[str] = PARTS,
    **mart_options,
) -> DataFrame | None:
    """Load every landed table, refresh silver and gold, check all layers.

    ``landed`` maps raw table names to landing paths; tables that are not in it stay as they are. Of
    readings and forecasts only files that no earlier run has taken are loaded; of keyed tables only
    records whose key is new. ``parts`` names what is run, of "load", "silver", "gold" and "check".
    ``as_of`` chooses the window of periods alone: rows are stamped with the time of the load, so
    a rerun or a back-fill reaches the silver tables like any other load. Returns the quality
    report after raising on failed error-level checks.
    """
    if unknown := set(parts) - set(PARTS):
        raise ValueError(f"unknown parts: {sorted(unknown)}")
    lake = Lake(spark, root)
    if "load" in parts:
        _load_all(lake, landed, as_of, run_id, window_days)
    if "silver" in parts:
        for name in silver.MODELS:
            lake.refresh_silver(name, incremental_mode=incremental_mode)
    if "gold" in parts:
        lake.refresh_gold(**mart_options)
    if report_root:
        write_reports(lake.reports(as_of.year), report_root)
    return quality.enforce(lake.quality_report()) if "check" in parts else None


def _load_all(lake: Lake, landed: dict[str, str], as_of: dt.datetime, run_id: str, window_days: int | None) -> None:
    since = trailing_period(as_of, window_days) if window_days is not None else None
    keyed = {schemas.GENERATION: lake.load_generation, schemas.PRICES: lake.load_prices}
    for table, load in keyed.items():
        if table in landed:
            records = landing.read_pages(lake.spark, landed[table])
            load(records, run_id, since=since, until=f"{as_of:%Y-%m}")
    for table in (*landing.READING_SCHEMAS, schemas.FORECAST):
        if table in landed:
            lake.load_landed(table, landed[table], run_id)
