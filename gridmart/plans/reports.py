"""Report queries over the marts: the notebook's frames and the workbook's sheets.

Trends, distributions, rankings and snapshots are taken from all filtered rows
(``price_rows``, ``carbon_rows``, ``market_rows``); a number of rows limits listings alone.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmart.functions import mean, rounded
from gridmart.operators.snapshots import newest_rows

#: The sectors and, in the functions below, the column names that make the reports.
HEADLINE_SECTORS = ["RES", "COM", "IND"]


def _millions(total: Column, digits: int) -> Column:
    return rounded(total.cast("double") / 1_000_000, digits)


# ---- scorecard ---------------------------------------------------------------------------


def kpi_scorecard(summary: DataFrame, as_of_year: int, digits: bool = True) -> DataFrame:
    """One row of headline figures for the current and the previous year.

    ``digits=False`` leaves the figures unrounded, as the workbook takes them.
    """
    recent = summary.filter(F.col("period_year") >= as_of_year - 1)

    def shown(value: Column, places: int) -> Column:
        return rounded(value, places if digits else 8)

    def total(name: str) -> Column:
        return F.sum(name).cast("double") / 1_000_000

    return recent.agg(
        shown(total("total_generation_mwh"), 2).alias("total_gen_twh"),
        shown(mean("renewable_share_pct"), 1).alias("avg_renewable_pct"),
        shown(mean("clean_energy_share_pct"), 1).alias("avg_clean_pct"),
        shown(total("total_co2_tonnes"), 2).alias("total_co2_mt"),
        shown(mean("grid_carbon_intensity_gco2_kwh"), 1).alias("avg_carbon_intensity"),
        shown(mean("residential_price_cents_kwh"), 2).alias("avg_residential_price"),
        shown(mean("wholesale_spot_price_usd_mwh"), 2).alias("avg_wholesale_price"),
        F.count_distinct("state_code").alias("states_covered"),
        F.max("period").alias("latest_period"),
    )


# ---- generation mix ----------------------------------------------------------------------


def _mix(by_fuel: DataFrame) -> DataFrame:
    named = by_fuel.filter(F.col("fuel_type_description").isNotNull())
    return named.groupBy("period_year", "fuel_type_description", "fuel_category").agg(
        _millions(F.sum("total_generation_mwh"), 2).alias("generation_twh"),
        rounded(mean("pct_of_state_generation"), 2).alias("avg_share_pct"),
        rounded(mean("avg_direct_co2_per_mwh"), 1).alias("avg_co2_per_mwh"),
    )


def generation_mix(by_fuel: DataFrame, since_year: int = 2020) -> DataFrame:
    recent = by_fuel.filter(F.col("period_year") >= since_year)
    return (
        _mix(recent)
        .drop("avg_co2_per_mwh")
        .orderBy(F.asc_nulls_last("period_year"), F.desc_nulls_first("generation_twh"))
    )


def generation_mix_sheet(by_fuel: DataFrame, rows: int = 100) -> DataFrame:
    order = [
        F.desc_nulls_first("period_year"),
        F.desc_nulls_first("generation_twh"),
        F.asc_nulls_last("fuel_type_description"),
        F.asc_nulls_last("fuel_category"),
    ]
    return _mix(by_fuel).orderBy(*order).limit(rows)


def category_share(mix: DataFrame) -> DataFrame:
    """Generation per category in the mix's newest year."""
    yearly = mix.groupBy("period_year", "fuel_category").agg(F.sum("generation_twh").alias("generation_twh"))
    return newest_rows(yearly, "period_year", mix).select("fuel_category", "generation_twh")


# ---- prices ------------------------------------------------------------------------------


def price_rows(trends: DataFrame, since_year: int = 2021) -> DataFrame:
    """All headline prices since a year."""
    headline = trends.filter(F.col("sector_id").isin(HEADLINE_SECTORS) & (F.col("period_year") >= since_year))
    return headline.select(
        "period",
        "period_year",
        "state_code",
        "sector_id",
        "sector_name",
        rounded("price_cents_per_kwh", 2).alias("price_cents_kwh"),
        rounded("price_yoy_change_pct", 1).alias("yoy_change_pct"),
        rounded("rolling_12m_avg_price_usd_mwh", 2).alias("rolling_avg"),
    )


def price_table(trends: DataFrame, since_year: int = 2021, rows: int = 2000) -> DataFrame:
    return _newest_prices(price_rows(trends, since_year), rows)


def price_sheet(trends: DataFrame, rows: int = 500) -> DataFrame:
    headline = trends.filter(F.col("sector_id").isin(HEADLINE_SECTORS))
    return _newest_prices(headline, rows).select(
        "period",
        "state_code",
        "sector_id",
        "sector_name",
        rounded("price_usd_per_mwh", 2).alias("price_usd_mwh"),
        rounded("price_cents_per_kwh", 2).alias("price_cents_kwh"),
        rounded("price_yoy_change_pct", 1).alias("yoy_change_pct"),
        rounded("rolling_12m_avg_price_usd_mwh", 2).alias("rolling_12m_avg"),
        rounded("retail_wholesale_spread_usd_mwh", 2).alias("retail_wholesale_spread"),
    )


def _newest_prices(trends: DataFrame, rows: int) -> DataFrame:
    order = [F.desc_nulls_first("period"), F.asc_nulls_last("state_code"), F.asc_nulls_last("sector_id")]
    return trends.orderBy(*order).limit(rows)


def sector_trend(prices: DataFrame) -> DataFrame:
    """Mean price per period and sector."""
    trend = prices.groupBy("period", "sector_id", "sector_name").agg(
        rounded(mean("price_cents_kwh"), 8).alias("price_cents_kwh")
    )
    return trend.orderBy("period", "sector_id")


def yoy_distribution(prices: DataFrame) -> DataFrame:
    """Five-number summary of the yearly change per sector (the box plot's numbers)."""
    change = F.col("yoy_change_pct").cast("double")
    quartiles = F.percentile(change, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    grouped = (
        prices.filter(F.col("yoy_change_pct").isNotNull())
        .groupBy("sector_id")
        .agg(
            F.count(F.lit(1)).alias("changes"),
            F.min("yoy_change_pct").alias("lowest"),
            quartiles.alias("q"),
            F.max("yoy_change_pct").alias("highest"),
        )
    )
    return grouped.select(
        "sector_id",
        "changes",
        "lowest",
        *[rounded(F.col("q")[i], 4).alias(name) for i, name in enumerate(["quartile_1", "median", "quartile_3"])],
        "highest",
    )


# ---- carbon ------------------------------------------------------------------------------


def carbon_rows(footprint: DataFrame, since_year: int = 2021) -> DataFrame:
    """All states' footprints since a year."""
    recent = footprint.filter(F.col("period_year") >= since_year)
    return recent.select(
        "period",
        "period_year",
        "state_code",
        "state_description",
        _millions(F.col("total_co2_tonnes"), 3).alias("co2_mt"),
        rounded("renewable_share_pct", 1).alias("renewable_pct"),
        rounded("clean_energy_share_pct", 1).alias("clean_pct"),
        rounded("grid_carbon_intensity_gco2_kwh", 1).alias("carbon_intensity"),
        rounded("carbon_intensity_yoy_change_pct", 1).alias("intensity_yoy_change"),
    )


def carbon_table(footprint: DataFrame, since_year: int = 2021, rows: int = 2000) -> DataFrame:
    return _dirtiest_first(carbon_rows(footprint, since_year), "co2_mt", rows)


def carbon_sheet(footprint: DataFrame, rows: int = 500) -> DataFrame:
    shown = footprint.select(
        "period",
        "state_code",
        "state_description",
        _millions(F.col("total_generation_mwh"), 3).alias("generation_twh"),
        _millions(F.col("total_co2_tonnes"), 3).alias("co2_million_tonnes"),
        rounded("renewable_share_pct", 1).alias("renewable_share_pct"),
        rounded("clean_energy_share_pct", 1).alias("clean_energy_share_pct"),
        rounded("grid_carbon_intensity_gco2_kwh", 1).alias("grid_intensity_gco2_kwh"),
        rounded("carbon_intensity_yoy_change_pct", 1).alias("intensity_yoy_change_pct"),
    )
    return _dirtiest_first(shown, "co2_million_tonnes", rows)


def _dirtiest_first(shown: DataFrame, emissions: str, rows: int) -> DataFrame:
    order = [
        F.desc_nulls_first("period"),
        F.desc_nulls_last(emissions),
        F.asc_nulls_last("state_code"),
        F.asc_nulls_last("state_description"),
    ]
    return shown.orderBy(*order).limit(rows)


def top_states(carbon: DataFrame, count: int = 20) -> DataFrame:
    """States with the highest renewable share in the newest period, and their mean share."""
    shares = [F.desc_nulls_last("period"), F.desc_nulls_last("renewable_pct"), "state_code", "state_description"]
    # the newest period's rows come first, those without a share last of them: one pass finds both
    best, listed = carbon.orderBy(*shares).limit(count), Window.partitionBy(F.lit(0))
    newest = best.withColumn("_newest", F.max("period").over(listed))
    known = newest.filter((F.col("period") == F.col("_newest")) & F.col("renewable_pct").isNotNull())
    level = rounded(F.avg(F.col("renewable_pct").cast("double")).over(listed), 1)
    return known.select("period", "state_code", "renewable_pct", level.alias("mean_renewable_pct"))


def national_trend(carbon: DataFrame) -> DataFrame:
    trend = carbon.groupBy("period").agg(rounded(mean("carbon_intensity"), 8).alias("carbon_intensity"))
    return trend.orderBy("period")


# ---- markets -----------------------------------------------------------------------------


def market_rows(market: DataFrame) -> DataFrame:
    """All daily markets as they are shown."""
    return market.select(
        "reading_date",
        "region",
        rounded("avg_spot_price_usd_mwh", 2).alias("spot_price"),
        rounded("avg_peak_price_usd_mwh", 2).alias("peak_price"),
        rounded(F.col("avg_demand_mw") / 1000, 1).alias("demand_gw"),
        rounded("price_volatility_pct", 1).alias("volatility_pct"),
    )


def market_table(market: DataFrame, rows: int = 1000) -> DataFrame:
    return _newest_markets(market_rows(market), rows)


def market_sheet(market: DataFrame, rows: int = 500) -> DataFrame:
    return _newest_markets(market, rows).select(
        "reading_date",
        "region",
        rounded("avg_spot_price_usd_mwh", 2).alias("spot_price_usd_mwh"),
        rounded("avg_peak_price_usd_mwh", 2).alias("peak_price_usd_mwh"),
        rounded("avg_demand_mw", 0).alias("avg_demand_mw"),
        rounded("peak_demand_mw", 0).alias("peak_demand_mw"),
        rounded("price_volatility_pct", 1).alias("price_volatility_pct"),
    )


def _newest_markets(market: DataFrame, rows: int) -> DataFrame:
    return market.orderBy(F.desc_nulls_first("reading_date"), F.asc_nulls_last("region")).limit(rows)


def market_snapshot(markets: DataFrame) -> DataFrame:
    newest = newest_rows(markets, "reading_date")
    return newest.select("region", "spot_price", "peak_price", "demand_gw", "volatility_pct")


# ---- audit -------------------------------------------------------------------------------


def audit_summary(audit: DataFrame) -> DataFrame:
    """Records, runs and last completion per asset and status.

    ``audit`` holds one row per run: the current state of each.
    """
    return (
        audit.groupBy("asset_name", "status")
        .agg(
            F.sum("records_written").alias("total_records"),
            F.count(F.lit(1)).alias("run_count"),
            F.max("completed_at").alias("last_run"),
        )
        .orderBy("asset_name", "status")
    )


def all_reports(
    by_fuel: DataFrame,
    trends: DataFrame,
    footprint: DataFrame,
    summary: DataFrame,
    market: DataFrame,
    audit: DataFrame,
    as_of_year: int,
    mix_since: int = 2020,
    since: int = 2021,
) -> dict[str, DataFrame]:
    """Every report frame by name, over stored marts."""
    mix = generation_mix(by_fuel, mix_since)
    prices, carbon, markets = price_rows(trends, since), carbon_rows(footprint, since), market_rows(market)
    return {
        "kpi_scorecard": kpi_scorecard(summary, as_of_year),
        "generation_mix": mix,
        "category_share": category_share(mix),
        "price_table": price_table(trends, since),
        "sector_trend": sector_trend(prices),
        "yoy_distribution": yoy_distribution(prices),
        "carbon_table": carbon_table(footprint, since),
        "top_states": top_states(carbon),
        "national_trend": national_trend(carbon),
        "market_table": market_table(market),
        "market_snapshot": market_snapshot(markets),
        "audit_summary": audit_summary(audit),
        "executive_summary_sheet": kpi_scorecard(summary, as_of_year, digits=False),
        "generation_mix_sheet": generation_mix_sheet(by_fuel),
        "price_trends_sheet": price_sheet(trends),
        "carbon_footprint_sheet": carbon_sheet(footprint),
        "regional_performance_sheet": market_sheet(market),
    }
