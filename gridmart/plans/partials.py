"""Daily aggregates from partial rows that add up, so that a late reading never asks for old ones.

Of each region and day the sums, counts, squares, extremes and latest readings are stored, by month.
New readings become such rows, are added to those of their days, and the months they touch are written
anew in the partial table and in the silver table. Sums are exact decimals, so the order in which loads
come changes nothing. What was taken in is recorded with the version it made, so that a run that is
repeated after a failure adds nothing twice; the silver table knows the version it shows, and catches
up by the months that differ from the current one.
"""

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.functions import ratio, rounded
from gridmart.plans import silver
from gridmart.sources import versions

MONTH = "reading_month"
TIME = "ingested_at"


@dataclass(frozen=True)
class PartialModel:
    """How the readings of a daily model become partial rows, and these the model's rows."""

    readings: Callable[[DataFrame], DataFrame]
    keys: tuple[str, ...]
    #: Column of a partial row: what it is of readings, and how two of it make one.
    columns: dict[str, tuple[Column, str]] = field(default_factory=dict)
    finish: Callable[[DataFrame], DataFrame] = lambda rows: rows

    def of(self, readings: DataFrame) -> DataFrame:
        timed = self.readings(readings).withColumn("reading_date", F.to_date("recorded_at"))
        rows = timed.groupBy(*self.keys).agg(*(column.alias(name) for name, (column, _) in self.columns.items()))
        return rows.withColumn(MONTH, F.date_format("reading_date", "yyyy-MM"))

    def together(self, rows: DataFrame) -> DataFrame:
        """One partial row for each key."""
        added = []
        for name, (_, how) in self.columns.items():
            made = {"sum": F.sum, "min": F.min, "max": F.max}[how](name)
            added.append(made.cast(rows.schema[name].dataType).alias(name))
        return rows.groupBy(*self.keys, MONTH).agg(*added)


def _of(name: str, *kinds: str) -> dict[str, tuple[Column, str]]:
    """Partial columns of one measure: its sum and count, and extremes or squares."""
    value = F.col(name)
    made = {
        "sum": (F.sum(value).cast("decimal(38,4)"), "sum"),
        "n": (F.count(value), "sum"),
        "min": (F.min(value), "min"),
        "max": (F.max(value), "max"),
        "squares": (F.sum(value * value).cast("decimal(38,8)"), "sum"),
    }
    return {f"{name}_{kind}": made[kind] for kind in ("sum", "n", *kinds)}


def _common() -> dict[str, tuple[Column, str]]:
    return {"reading_count": (F.count(F.lit(1)), "sum"), TIME: (F.max(TIME), "max")}


def _mean(name: str, digits: int) -> Column:
    return rounded(ratio(f"{name}_sum", f"{name}_n"), digits)


def _weather(rows: DataFrame) -> DataFrame:
    return rows.select(
        "region",
        "reading_date",
        _mean("temperature_c", 2).alias("avg_temperature_c"),
        rounded("temperature_c_min", 2).alias("min_temperature_c"),
        rounded("temperature_c_max", 2).alias("max_temperature_c"),
        _mean("wind_speed_ms", 2).alias("avg_wind_speed_ms"),
        rounded("wind_speed_ms_max", 2).alias("max_wind_speed_ms"),
        _mean("solar_irradiance_wm2", 2).alias("avg_solar_irradiance_wm2"),
        rounded("solar_irradiance_wm2_max", 2).alias("peak_solar_irradiance_wm2"),
        _mean("humidity_pct", 2).alias("avg_humidity_pct"),
        _mean("cloud_cover_pct", 2).alias("avg_cloud_cover_pct"),
        "reading_count",
        TIME,
    )


def _deviation(name: str) -> Column:
    """Sample standard deviation from sum, count and squares; NULL for a single value."""
    total, n = F.col(f"{name}_sum").cast("double"), F.col(f"{name}_n")
    apart = F.col(f"{name}_squares").cast("double") - total * ratio(total, n)
    return F.when(n > 1, F.sqrt(F.greatest(ratio(apart, n - 1), F.lit(0.0))))


def _market(rows: DataFrame) -> DataFrame:
    spot = "spot_price_usd_mwh"
    average = ratio(f"{spot}_sum", f"{spot}_n")
    none = F.lit(0).cast("decimal(28,2)")
    return rows.select(
        "region",
        "reading_date",
        rounded(average, 4).alias("avg_spot_price_usd_mwh"),
        rounded(f"{spot}_min", 4).alias("min_spot_price_usd_mwh"),
        rounded(f"{spot}_max", 4).alias("max_spot_price_usd_mwh"),
        _mean("peak_price_usd_mwh", 4).alias("avg_peak_price_usd_mwh"),
        _mean("off_peak_price_usd_mwh", 4).alias("avg_off_peak_price_usd_mwh"),
        _mean("demand_mw", 2).alias("avg_demand_mw"),
        rounded("demand_mw_max", 2).alias("peak_demand_mw"),
        _mean("demand_forecast_mw", 2).alias("avg_demand_forecast_mw"),
        F.when(average > 0, rounded(ratio(_deviation(spot), average) * 100, 2)).otherwise(none).alias("price_volatility_pct"),
        "reading_count",
        TIME,
    )


def _carbon(rows: DataFrame) -> DataFrame:
    """A day's partial rows are one for each category; the latest read category is the day's."""
    day = ["region", "fuel_type", "reading_date"]
    latest = F.max_by("carbon_intensity_category", F.struct("last_reading", "last_id"))

    def mean(name: str) -> Column:
        return rounded(ratio(F.sum(f"{name}_sum"), F.sum(f"{name}_n")), 4)

    return rows.groupBy(*day).agg(
        mean("direct_co2_per_mwh").alias("avg_direct_co2_per_mwh"),
        mean("lifecycle_co2_per_mwh").alias("avg_lifecycle_co2_per_mwh"),
        latest.alias("carbon_intensity_category"),
        F.sum("reading_count").alias("reading_count"),
        F.max(TIME).alias(TIME),
    )


def _weather_readings(bronze: DataFrame) -> DataFrame:
    return bronze.filter(F.col("temperature_c").isNotNull() & F.col("region").isNotNull())


def _carbon_readings(bronze: DataFrame) -> DataFrame:
    known = bronze.filter(F.col("fuel_type").isNotNull() & F.col("region").isNotNull())
    return known.withColumn("fuel_type", F.lower(F.trim("fuel_type")))


NAMES = ("silver_weather_aggregated", "silver_market_aggregated", "silver_carbon_reference")


def models() -> dict[str, PartialModel]:
    """The daily models that can be kept by partial rows."""
    day = ("region", "reading_date")
    weather = (
        _of("temperature_c", "min", "max")
        | _of("wind_speed_ms", "max")
        | _of("solar_irradiance_wm2", "max")
        | _of("humidity_pct")
        | _of("cloud_cover_pct")
    )
    market = (
        _of("spot_price_usd_mwh", "min", "max", "squares")
        | _of("peak_price_usd_mwh")
        | _of("off_peak_price_usd_mwh")
        | _of("demand_mw", "max")
        | _of("demand_forecast_mw")
    )
    latest = {"last_reading": (F.max("recorded_at"), "max"), "last_id": (F.max("id"), "max")}
    carbon = _of("direct_co2_per_mwh") | _of("lifecycle_co2_per_mwh") | latest
    by_category = ("region", "fuel_type", "reading_date", "carbon_intensity_category")
    made = (
        PartialModel(_weather_readings, day, weather | _common(), _weather),
        PartialModel(silver.market_readings, day, market | _common(), _market),
        PartialModel(_carbon_readings, by_category, carbon | _common(), _carbon),
    )
    return dict(zip(NAMES, made, strict=True))


# ---- stored ------------------------------------------------------------------------------


def watermark(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest load time that the partial rows have taken in."""
    version = versions.current(spark, path)
    return None if version is None else versions.recorded(spark, version, TIME)


def take_in(spark: SparkSession, model: PartialModel, path: str, readings: DataFrame, batch: tuple[str, int] | None = None) -> int:
    """Adds readings to the partial rows at ``path``; returns the rows they touch.

    ``batch`` names a stream and the number of its batch: one that was taken in before, or an older
    one, is left out. Only the months of the readings are read and written.
    """
    base = versions.current(spark, path)
    notes = dict(base.notes) if base else {}
    if batch:
        if notes.get(batch[0], -1) >= batch[1]:
            return 0
        notes[batch[0]] = batch[1]
    new = model.of(readings)
    folders = versions.write_batch(new.hint("rebalance", MONTH), path, [MONTH])
    added = versions.rows(spark, path, versions.Version(0, folders, new.schema)) if folders else None
    size = added.count() if added is not None else 0
    if not size:
        if batch and base:
            versions.commit(spark, path, base, base.folders, base.schema, base.newest, notes=notes)
        return 0
    newest = versions.newest_value(added, TIME)
    if base is not None:
        months = {versions.partition_of(f) for f in folders}
        old = [f for f in base.folders if versions.partition_of(f) in months]
        if old:
            stored = versions.rows(spark, path, versions.Version(0, tuple(old), base.schema))
            together = model.together(stored.unionByName(added)).select(*base.schema.names)
            folders = versions.write_batch(together.hint("rebalance", MONTH), path, [MONTH])
        folders = (*(f for f in base.folders if versions.partition_of(f) not in months), *folders)
        seen = versions.recorded(spark, base, TIME)
        if seen is not None:
            newest = versions.newest_value(added.select(TIME).union(seen), TIME)
    versions.commit(spark, path, base, folders, new.schema, newest, notes=notes)
    return size


def show(spark: SparkSession, model: PartialModel, path: str, table: str) -> int:
    """Brings the daily table up to the partial rows; returns the months written.

    The version of the partial rows that a table shows is recorded with it: months in other folders
    since then are finished anew, all of them if that version is gone.
    """
    now = versions.current(spark, path)
    if now is None:
        return 0
    shown = versions.current(spark, table)
    before = versions.current(spark, path, shown.notes[path]) if shown and path in shown.notes else None
    if before is not None and before.number == shown.notes[path]:
        changed = [f for f in now.folders if f not in set(before.folders)]
        kept = [f for f in shown.folders if versions.partition_of(f) not in {versions.partition_of(c) for c in changed}]
    else:
        changed, kept = list(now.folders), []
    if not changed:
        return 0
    part = versions.rows(spark, path, versions.Version(0, tuple(changed), now.schema))
    finished = model.finish(part)
    month = finished.withColumn(MONTH, F.date_format("reading_date", "yyyy-MM"))
    folders = versions.write_batch(month.hint("rebalance", MONTH), table, [MONTH])
    versions.commit(spark, table, shown, (*kept, *folders), finished.schema, now.newest, notes={path: now.number})
    return len(changed)
