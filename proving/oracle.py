"""The SQL counterpart of every query, over the same given tables.

The texts say what a query means as plainly as possible (the carbon join, for one, really
repeats its rows) and not how Spark gets there. They are assembled from named parts, each
stating which parts it reads.
"""

import re

from gridmart import schemas
from gridmart.operators import quality
from gridmart.plans import gold
from gridmart.sources import dims
from gridmart.sources.raw import BRONZE_VIEWS, column_names
from proving import adapters
from proving import queries as q


def _round(value: str, digits: int) -> str:
    return f"round(cast({value} as decimal(38,8)), {digits})"


def _ratio(top: str, bottom: str) -> str:
    return f"(cast({top} as double) / nullif(cast({bottom} as double), 0))"


def _mean(value: str) -> str:
    return _ratio(f"sum({value})", f"count({value})")


def _values(rows, names: str) -> str:
    def quoted(value):
        return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)

    body = ", ".join("(" + ", ".join(quoted(v) for v in row) + ")" for row in rows)
    return f"select * from (values {body}) as t({names})"


def _change(now: str, then: str) -> str:
    now, then = f"cast({now} as double)", f"cast({then} as double)"
    return _round(f"({now} - {then}) / nullif({then}, 0) * 100", 2)


_PARTS: dict[str, str] = {
    "raw_generation": adapters.sql(schemas.GENERATION),
    "raw_prices": adapters.sql(schemas.PRICES),
    "raw_weather": adapters.sql(schemas.WEATHER),
    "raw_carbon": adapters.sql(schemas.CARBON),
    "raw_market": adapters.sql(schemas.MARKET),
    "raw_audit": adapters.sql(schemas.AUDIT),
    "raw_forecast": adapters.sql(schemas.FORECAST),
    "fuel_codes": _values(dims.FUEL_TYPES, "code, fuel"),
    "price_states": _values(dims.PRICE_REGIONS, "state, region"),
    "summary_states": _values(dims.SUMMARY_REGIONS, "state, region"),
    "base_prices": _values(dims.BASE_PRICES, "region, base_price"),
    "factors": _values(dims.EMISSION_FACTORS, "fuel, direct, lifecycle, description"),
}
_RAW_PARTS = {
    schemas.GENERATION: "raw_generation",
    schemas.PRICES: "raw_prices",
    schemas.WEATHER: "raw_weather",
    schemas.CARBON: "raw_carbon",
    schemas.MARKET: "raw_market",
    schemas.FORECAST: "raw_forecast",
}

_PERIOD = """
    cast(split_part(period, '-', 1) as integer) as period_year,
    cast(split_part(period, '-', 2) as integer) as period_month,
    cast(period || '-01' as date) as period_date"""


def _clean_generation(source: str) -> str:
    return f"""
select id, ingested_at, period, {_PERIOD},
    upper(trim(state_code)) as state_code, trim(state_description) as state_description,
    upper(trim(sector_id)) as sector_id, trim(sector_description) as sector_description,
    upper(trim(fuel_type_code)) as fuel_type_code,
    trim(fuel_type_description) as fuel_type_description,
    cast(generation_mwh * 1000 as decimal(22,4)) as generation_mwh,
    'MWh' as generation_units_normalised, source
from {source}
where generation_mwh is not null and state_code is not null and trim(state_code) <> ''"""


_PARTS["silver_generation"] = _clean_generation("raw_generation")
_PARTS["silver_prices"] = f"""
select id, ingested_at, period, {_PERIOD},
    upper(trim(state_code)) as state_code, trim(state_description) as state_description,
    upper(trim(sector_id)) as sector_id, trim(sector_name) as sector_name,
    cast(price_cents_per_kwh * 10 as decimal(14,4)) as price_usd_per_mwh, price_cents_per_kwh,
    coalesce(revenue_million_dollars, 0) as revenue_million_dollars,
    coalesce(sales_million_kwh, 0) as sales_million_kwh, coalesce(customers, 0) as customers, source
from raw_prices
where price_cents_per_kwh > 0 and state_code is not null and trim(state_code) <> ''"""
_PARTS["silver_weather"] = f"""
select region, cast(recorded_at as date) as reading_date,
    {_round(_mean("temperature_c"), 2)} as avg_temperature_c,
    {_round("min(temperature_c)", 2)} as min_temperature_c,
    {_round("max(temperature_c)", 2)} as max_temperature_c,
    {_round(_mean("wind_speed_ms"), 2)} as avg_wind_speed_ms,
    {_round("max(wind_speed_ms)", 2)} as max_wind_speed_ms,
    {_round(_mean("solar_irradiance_wm2"), 2)} as avg_solar_irradiance_wm2,
    {_round("max(solar_irradiance_wm2)", 2)} as peak_solar_irradiance_wm2,
    {_round(_mean("humidity_pct"), 2)} as avg_humidity_pct,
    {_round(_mean("cloud_cover_pct"), 2)} as avg_cloud_cover_pct,
    count(*) as reading_count, max(ingested_at) as ingested_at
from raw_weather where temperature_c is not null and region is not null group by all"""


def _daily_market(source: str) -> str:
    spot = "spot_price_usd_mwh"
    spread = f"cast(stddev_samp({spot}) as double) / {_mean(spot)} * 100"
    return f"""
select region, cast(recorded_at as date) as reading_date,
    {_round(_mean(spot), 4)} as avg_spot_price_usd_mwh,
    {_round(f"min({spot})", 4)} as min_spot_price_usd_mwh,
    {_round(f"max({spot})", 4)} as max_spot_price_usd_mwh,
    {_round(_mean("peak_price_usd_mwh"), 4)} as avg_peak_price_usd_mwh,
    {_round(_mean("off_peak_price_usd_mwh"), 4)} as avg_off_peak_price_usd_mwh,
    {_round(_mean("demand_mw"), 2)} as avg_demand_mw,
    {_round("max(demand_mw)", 2)} as peak_demand_mw,
    {_round(_mean("demand_forecast_mw"), 2)} as avg_demand_forecast_mw,
    case when avg({spot}) > 0 then {_round(spread, 2)} else 0 end as price_volatility_pct,
    count(*) as reading_count, max(ingested_at) as ingested_at
from {source} where {spot} is not null and region is not null group by all"""


_PARTS["silver_market"] = _daily_market("raw_market")
_PARTS["carbon_readings"] = """
select *, lower(trim(fuel_type)) as fuel, cast(recorded_at as date) as reading_date
from raw_carbon where fuel_type is not null and region is not null"""
_PARTS["carbon_latest"] = """
select region, fuel, reading_date, carbon_intensity_category,
    row_number() over (partition by region, fuel, reading_date
                       order by max(recorded_at) desc, max(id) desc) as place
from carbon_readings group by region, fuel, reading_date, carbon_intensity_category"""
_PARTS["silver_carbon"] = f"""
select r.region, r.fuel as fuel_type, r.reading_date,
    {_round(_mean("r.direct_co2_per_mwh"), 4)} as avg_direct_co2_per_mwh,
    {_round(_mean("r.lifecycle_co2_per_mwh"), 4)} as avg_lifecycle_co2_per_mwh,
    max(l.carbon_intensity_category) as carbon_intensity_category,
    count(*) as reading_count, max(r.ingested_at) as ingested_at
from carbon_readings r join carbon_latest l
    on l.place = 1 and l.region = r.region and l.fuel = r.fuel and l.reading_date = r.reading_date
group by r.region, r.fuel, r.reading_date"""
_PARTS["carbon_newest"] = """
select * from silver_carbon
qualify reading_date = max(reading_date) over (partition by fuel_type)"""
_PARTS["carbon_per_fuel"] = """
select fuel_type, avg(avg_direct_co2_per_mwh) as avg_direct_co2_per_mwh,
    avg(avg_lifecycle_co2_per_mwh) as avg_lifecycle_co2_per_mwh
from carbon_newest group by fuel_type"""


def _by_fuel(carbon: str, divisor: int) -> str:
    grams = "cast(sum(g.generation_mwh) as double) * avg(coalesce(c.avg_direct_co2_per_mwh, 0))"
    return f"""
select *, {_round(f'''total_generation_mwh / nullif(sum(total_generation_mwh)
            over (partition by period, state_code), 0) * 100''', 2)} as pct_of_state_generation,
    case when fuel_type_code in ('WWW', 'WND', 'SUN', 'SOL', 'HYC', 'GEO', 'BIO') then 'renewable'
         when fuel_type_code = 'NUC' then 'low_carbon' else 'fossil' end as fuel_category
from (
    select g.period, g.period_year, g.period_month, g.period_date, g.state_code, g.state_description,
        g.fuel_type_code, g.fuel_type_description, sum(g.generation_mwh) as total_generation_mwh,
        {_round("avg(c.avg_direct_co2_per_mwh)", 8)} as avg_direct_co2_per_mwh,
        {_round("avg(c.avg_lifecycle_co2_per_mwh)", 8)} as avg_lifecycle_co2_per_mwh,
        {_round(f"{grams} / {divisor}", 2)} as estimated_co2_tonnes
    from silver_generation g
    left join fuel_codes f on f.code = g.fuel_type_code
    left join {carbon} c on c.fuel_type = f.fuel
    where g.sector_id = '99'
    group by all) s"""


_PARTS["by_fuel"] = _by_fuel("carbon_newest", gold.PARITY_DIVISOR)
_PARTS["by_fuel_plain"] = _by_fuel("carbon_per_fuel", gold.PHYSICAL_DIVISOR)


def _trends(year_before: str, month_before: str, extra: str = "") -> str:
    return f"""
select p.* exclude (id, ingested_at, source),
    {_change("p.price_usd_per_mwh", year_before)} as price_yoy_change_pct,
    {_change("p.price_usd_per_mwh", month_before)} as price_mom_change_pct,
    {_round("avg(p.price_usd_per_mwh) over (series rows between 11 preceding and current row)", 2)}
        as rolling_12m_avg_price_usd_mwh,
    s.region, m.avg_spot_price_usd_mwh as wholesale_spot_price_usd_mwh,
    m.avg_peak_price_usd_mwh as wholesale_peak_price_usd_mwh,
    {_round("p.price_usd_per_mwh - coalesce(m.avg_spot_price_usd_mwh, 0)", 2)}
        as retail_wholesale_spread_usd_mwh
from silver_prices p
left join price_states s on s.state = p.state_code
left join silver_market m on m.region = s.region and m.reading_date = p.period_date
{extra}
window series as (partition by p.state_code, p.sector_id order by p.period_date)"""


def _same_series(alias: str, months: int) -> str:
    return f"""left join silver_prices {alias} on {alias}.state_code = p.state_code
    and {alias}.sector_id = p.sector_id
    and {alias}.period_date = cast(p.period_date - interval {months} month as date)"""


_PARTS["trends"] = _trends(
    "lag(p.price_usd_per_mwh, 12) over series", "lag(p.price_usd_per_mwh, 1) over series"
)
_PARTS["trends_calendar"] = _trends(
    "y.price_usd_per_mwh", "b.price_usd_per_mwh", _same_series("y", 12) + "\n" + _same_series("b", 1)
)


def _category_sum(name: str) -> str:
    return f"sum(case when fuel_category = '{name}' then total_generation_mwh else 0 end)"


def _fuel_max(*codes: str) -> str:
    listed = ", ".join(f"'{c}'" for c in codes)
    return f"max(case when fuel_type_code in ({listed}) then total_generation_mwh end)"


_PARTS["state_months"] = f"""
select period, period_year, period_month, period_date, state_code, state_description,
    sum(total_generation_mwh) as total_generation_mwh, sum(estimated_co2_tonnes) as total_co2_tonnes,
    {_category_sum("renewable")} as renewable_generation_mwh,
    {_category_sum("low_carbon")} as low_carbon_generation_mwh,
    {_category_sum("fossil")} as fossil_generation_mwh,
    {_fuel_max("NG")} as natural_gas_mwh, {_fuel_max("COL")} as coal_mwh,
    {_fuel_max("NUC")} as nuclear_mwh, {_fuel_max("WWW", "WND")} as wind_mwh,
    {_fuel_max("SUN", "SOL")} as solar_mwh, {_fuel_max("HYC")} as hydro_mwh
from by_fuel group by all"""
_PER_MWH = _ratio("total_co2_tonnes", "total_generation_mwh")
_PARTS["footprint"] = f"""
select *,
    {_round(_ratio("renewable_generation_mwh", "total_generation_mwh") + " * 100", 2)}
        as renewable_share_pct,
    {_round(_ratio("(renewable_generation_mwh + low_carbon_generation_mwh)", "total_generation_mwh")
            + " * 100", 2)} as clean_energy_share_pct,
    {_round(_ratio("total_co2_tonnes * 1000", "total_generation_mwh"), 2)}
        as grid_carbon_intensity_gco2_kwh,
    {_change(_PER_MWH, f"lag({_PER_MWH}, 12) over (partition by state_code order by period_date, state_description nulls last)")}
        as carbon_intensity_yoy_change_pct
from state_months"""


def _summary(states: str) -> str:
    return f"""
select f.*, coalesce(s.region, 'OTHER') as grid_region,
    p.price_usd_per_mwh as residential_price_usd_mwh,
    p.price_cents_per_kwh as residential_price_cents_kwh,
    p.price_yoy_change_pct as residential_price_yoy_change_pct, p.rolling_12m_avg_price_usd_mwh,
    m.avg_spot_price_usd_mwh as wholesale_spot_price_usd_mwh,
    m.avg_peak_price_usd_mwh as wholesale_peak_price_usd_mwh,
    m.avg_demand_mw, m.peak_demand_mw, m.price_volatility_pct,
    w.avg_temperature_c, w.avg_wind_speed_ms, w.avg_solar_irradiance_wm2,
    {_round('''cast(f.renewable_generation_mwh as double)
        * cast(coalesce(p.price_usd_per_mwh, 0) as double) / 1000000''', 4)}
        as renewable_revenue_million_usd
from footprint f
left join trends p on p.sector_id = 'RES' and p.state_code = f.state_code and p.period = f.period
left join {states} s on s.state = f.state_code
left join silver_market m
    on m.region = coalesce(s.region, 'OTHER') and m.reading_date = f.period_date
left join silver_weather w
    on w.region = coalesce(s.region, 'OTHER') and w.reading_date = f.period_date"""


_PARTS["summary"] = _summary("summary_states")
_PARTS["summary_once"] = _summary("(select distinct * from summary_states)")


# ---- assembling --------------------------------------------------------------------------


def _needed(text: str) -> list[str]:
    """Parts that ``text`` reads, directly or through others, in reading order."""
    found: list[str] = []
    for name in _PARTS:
        if re.search(rf"\b{name}\b", text):
            found += [*_needed(_PARTS[name]), name]
    return list(dict.fromkeys(found))


def _full(text: str) -> str:
    parts = ",\n".join(f"{name} as ({_PARTS[name]})" for name in _needed(text))
    return f"with {parts}\n{text}" if parts else text


def _doubles(source: str, columns: str, where: str = "") -> str:
    """All columns of ``source`` with the given decimals as doubles."""
    replaced = ", ".join(f"cast({c} as double) as {c}" for c in columns.split())
    return f"select * replace ({replaced}) from {source} {where}"


_PRICE_MONEY = "price_usd_per_mwh price_cents_per_kwh revenue_million_dollars sales_million_kwh"
_WEATHER_NUMBERS = """avg_temperature_c min_temperature_c max_temperature_c avg_wind_speed_ms
    max_wind_speed_ms avg_solar_irradiance_wm2 peak_solar_irradiance_wm2 avg_humidity_pct
    avg_cloud_cover_pct"""
_MARKET_NUMBERS = """avg_spot_price_usd_mwh min_spot_price_usd_mwh max_spot_price_usd_mwh
    avg_peak_price_usd_mwh avg_off_peak_price_usd_mwh avg_demand_mw peak_demand_mw
    avg_demand_forecast_mw price_volatility_pct"""
_CARBON_NUMBERS = "avg_direct_co2_per_mwh avg_lifecycle_co2_per_mwh"
_FUEL_NUMBERS = f"total_generation_mwh {_CARBON_NUMBERS} estimated_co2_tonnes pct_of_state_generation"
_TREND_NUMBERS = f"""{_PRICE_MONEY} price_yoy_change_pct price_mom_change_pct
    rolling_12m_avg_price_usd_mwh wholesale_spot_price_usd_mwh wholesale_peak_price_usd_mwh
    retail_wholesale_spread_usd_mwh"""
_FOOTPRINT_NUMBERS = """total_generation_mwh total_co2_tonnes renewable_generation_mwh
    low_carbon_generation_mwh fossil_generation_mwh natural_gas_mwh coal_mwh nuclear_mwh wind_mwh
    solar_mwh hydro_mwh renewable_share_pct clean_energy_share_pct grid_carbon_intensity_gco2_kwh
    carbon_intensity_yoy_change_pct"""
_SUMMARY_NUMBERS = f"""{_FOOTPRINT_NUMBERS} residential_price_usd_mwh residential_price_cents_kwh
    residential_price_yoy_change_pct rolling_12m_avg_price_usd_mwh wholesale_spot_price_usd_mwh
    wholesale_peak_price_usd_mwh avg_demand_mw peak_demand_mw price_volatility_pct
    avg_temperature_c avg_wind_speed_ms avg_solar_irradiance_wm2 renewable_revenue_million_usd"""
_RAW_MARKET_NUMBERS = """spot_price_usd_mwh peak_price_usd_mwh off_peak_price_usd_mwh demand_mw
    demand_forecast_mw"""


def _shown(value: str, digits: int, name: str) -> str:
    return f"cast({_round(value, digits)} as double) as {name}"


# ---- reports -----------------------------------------------------------------------------


def _kpis(rounding: dict[str, int] | None) -> str:
    figures = {
        "total_gen_twh": "cast(sum(total_generation_mwh) as double) / 1000000",
        "avg_renewable_pct": _mean("renewable_share_pct"),
        "avg_clean_pct": _mean("clean_energy_share_pct"),
        "total_co2_mt": "cast(sum(total_co2_tonnes) as double) / 1000000",
        "avg_carbon_intensity": _mean("grid_carbon_intensity_gco2_kwh"),
        "avg_residential_price": _mean("residential_price_cents_kwh"),
        "avg_wholesale_price": _mean("wholesale_spot_price_usd_mwh"),
    }
    shown = [_shown(v, rounding[n] if rounding else 8, n) for n, v in figures.items()]
    return f"""select {", ".join(shown)}, count(distinct state_code) as states_covered,
    max(period) as latest_period from summary where period_year >= {q.AS_OF_YEAR} - 1"""


_KPI_DIGITS = {
    "total_gen_twh": 2,
    "avg_renewable_pct": 1,
    "avg_clean_pct": 1,
    "total_co2_mt": 2,
    "avg_carbon_intensity": 1,
    "avg_residential_price": 2,
    "avg_wholesale_price": 2,
}
_MIX = f"""
select period_year, fuel_type_description, fuel_category,
    {_shown("cast(sum(total_generation_mwh) as double) / 1000000", 2, "generation_twh")},
    {_shown(_mean("pct_of_state_generation"), 2, "avg_share_pct")}"""
_NEWEST_PRICES = "order by period desc nulls first, state_code nulls last, sector_id nulls last limit"
_PARTS["price_rows"] = f"""
select period, period_year, state_code, sector_id, sector_name,
    {_round("price_cents_per_kwh", 2)} as price_cents_kwh,
    {_round("price_yoy_change_pct", 1)} as yoy_change_pct,
    {_round("rolling_12m_avg_price_usd_mwh", 2)} as rolling_avg
from trends where sector_id in ('RES', 'COM', 'IND') and period_year >= {q.TABLES_SINCE}"""
_DIRTIEST = "nulls last, state_code nulls last, state_description nulls last limit"
_PARTS["carbon_rows"] = f"""
select period, period_year, state_code, state_description,
    {_round("cast(total_co2_tonnes as double) / 1000000", 3)} as co2_mt,
    {_round("renewable_share_pct", 1)} as renewable_pct,
    {_round("clean_energy_share_pct", 1)} as clean_pct,
    {_round("grid_carbon_intensity_gco2_kwh", 1)} as carbon_intensity,
    {_round("carbon_intensity_yoy_change_pct", 1)} as intensity_yoy_change
from footprint where period_year >= {q.TABLES_SINCE}"""
_PARTS["top_rows"] = """
select period, state_code, renewable_pct from carbon_rows
where period = (select max(period) from carbon_rows) and renewable_pct is not null
order by renewable_pct desc, state_code, state_description limit 20"""
_PARTS["market_rows"] = f"""
select reading_date, region, {_round("avg_spot_price_usd_mwh", 2)} as spot_price,
    {_round("avg_peak_price_usd_mwh", 2)} as peak_price,
    {_round("cast(avg_demand_mw as double) / 1000", 1)} as demand_gw,
    {_round("price_volatility_pct", 1)} as volatility_pct
from silver_market"""
_MARKET_SHOWN = "spot_price peak_price demand_gw volatility_pct"


# ---- loading -----------------------------------------------------------------------------


def _split(part: str, later: bool) -> str:
    sign = ">" if later else "<="
    return f"(select * from {part} where day(ingested_at) {sign} {q.SPLIT_DAY})"


def _inserted(table: str, numbers: str) -> str:
    part, keys = _RAW_PARTS[table], schemas.LOAD_KEYS[table]
    ranked = [*["ingested_at", "id"], *[c for c in column_names(table) if c not in {"ingested_at", "id", *keys}]]
    order = ", ".join(f"{c} asc nulls last" for c in ranked)
    same = " and ".join(f"s.{k} = n.{k}" for k in keys)
    first = f"""(select * from {_split(part, True)} x
        qualify row_number() over (partition by {", ".join(keys)} order by {order}) = 1)"""
    return _doubles(
        f"{first} n", numbers, f"where not exists (select 1 from {_split(part, False)} s where {same})"
    )


_SILVER_KEYS = "period, state_code, sector_id, fuel_type_code"
_SILVER_REST = """period_year, period_month, period_date, state_description, sector_description,
    fuel_type_description, generation_mwh, generation_units_normalised, source"""
_SILVER_ORDER = ", ".join(
    f"{c.strip()} desc nulls last" for c in ("ingested_at, id, " + _SILVER_REST).split(",")
)
_UPSERTED = f"""
select * replace (cast(generation_mwh as double) as generation_mwh) from silver_generation
qualify row_number() over (partition by {_SILVER_KEYS}
    order by day(ingested_at) > {q.SPLIT_DAY} desc, {_SILVER_ORDER}) = 1"""

_EVENT_RECORDS = f"""
select event_id,
    case when event_id % 29 = 0 then null when event_id % 31 = 0 then '2024/01'
         else substring(cast(ts as string), 1, 7) end as period,
    split_part('{adapters.STATES}', ',', cast(user_id % 25 as int) + 1) as st,
    case when user_id % 4 = 0 then '' else st end as location,
    case when user_id % 8 = 0 then null else st end as stateid,
    regexp_extract(props, '"k": ([0-9]+)', 1) as k,
    case when event_id % 23 = 0 then 'abc' when event_id % 37 = 0 then ''
         when event_id % 41 = 0 then null else k end as generation,
    case when event_id % 19 = 0 then 'n/a' else k || '.25' end as price,
    case when event_id % 17 = 0 then null else k end as sales,
    case when event_id % 43 = 0 then 'many' else k || '.9' end as customers,
    event_type
from events"""
_PARTS["records"] = _EVENT_RECORDS
_BAD_PERIOD = r"(period is null or not regexp_matches(period, '^\d{4}-\d{2}$'))"
_BAD_GENERATION = "(generation is not null and try_cast(generation as decimal(18,4)) is null)"
_BAD_PRICE = "(try_cast(price as decimal(10,4)) is null)"
_BAD_CUSTOMERS = "(try_cast(customers as double) is null)"
_SECTOR = "case when event_id % 5 = 0 then '99' else 'RES' end"
_STATE_ANY = "coalesce(nullif(location, ''), nullif(stateid, ''), '')"
_STATE_PRICE = "coalesce(nullif(stateid, ''), '')"
_REASONS_GENERATION = f"""concat_ws('; ', case when {_BAD_PERIOD} then 'bad period' end,
    case when {_BAD_GENERATION} then 'bad generation' end)"""
_REASONS_PRICES = f"""concat_ws('; ', case when {_BAD_PERIOD} then 'bad period' end,
    case when {_BAD_PRICE} then 'bad price' end,
    case when {_BAD_CUSTOMERS} then 'bad customers' end)"""

_FORECAST_POINTS = f"""
select split_part('{adapters.REGIONS}', ',', cast(user_id % 9 as int) + 1) as region,
    date_trunc('hour', ts) as recorded_at, date_trunc('hour', ts) + to_hours(i) as forecast_hour,
    cast(user_id % 1000 * 100 + i as double) as forecast_demand_mw,
    case when i <> 2 then cast(event_id % 40 as double) end as temperature_c,
    cast(99 - i as double) as confidence_pct, 'enrichment_api' as source
from events, (values (1), (2), (3)) as p(i)
where event_id % 8 <> 4 and i <= event_id % 4"""

_PARTS["stored_market"] = _daily_market(f"(select * from raw_market where ingested_at < timestamp '{q.SPLIT_TIME}') e")
_PARTS["late_market"] = "select * from raw_market where ingested_at > (select max(ingested_at) from stored_market)"
_PARTS["late_daily"] = _daily_market("late_market")
_PARTS["whole_daily"] = _daily_market("raw_market")


def _timed(part: str) -> str:
    return f"(select * replace (cast(recorded_at as timestamp) as recorded_at) from {part})"


def _merged(fresh: str) -> str:
    return f"""(select f.* from {fresh} f union all by name select * from stored_market s
        where not exists (select 1 from {fresh} n
                          where n.region = s.region and n.reading_date = s.reading_date))"""


_TOUCHED = """(select w.* from whole_daily w where exists
    (select 1 from late_daily n where n.region = w.region and n.reading_date = w.reading_date))"""


# ---- data quality ------------------------------------------------------------------------


def _failed(check: quality.Check) -> str:
    if check.kind == "not_null":
        return f"{check.column} is null"
    if check.kind == "accepted_values":
        return f"{check.column} not in ({', '.join(repr(v) for v in check.values)})"
    sides = []
    if check.low is not None:
        sides.append(f"{check.column} < {check.low}")
    if check.high is not None:
        sides.append(f"{check.column} > {check.high}")
    return " or ".join(sides)


def _check_line(part: str, table: str, check: quality.Check) -> str:
    head = f"select '{table}' as table_name, '{check.column}' as column_name, '{check.kind}' as check_name, '{check.severity}' as severity"
    if check.kind == "unique":
        return f"""{head}, count(*) as failures from (select {check.column} from {part}
            where {check.column} is not null group by 1 having count(*) > 1) d"""
    return f"{head}, count(*) as failures from {part} where {_failed(check)}"


def _checks(tables: dict[str, list[quality.Check]], parts: dict[str, str]) -> str:
    lines = [_check_line(parts[t], t, c) for t, checks in tables.items() for c in checks]
    return "\nunion all ".join(lines)


_SILVER_PARTS = {
    "silver_generation_cleaned": "silver_generation",
    "silver_prices_cleaned": "silver_prices",
    "silver_weather_aggregated": "silver_weather",
    "silver_carbon_reference": "silver_carbon",
    "silver_market_aggregated": "silver_market",
}
_GOLD_PARTS = {
    "gold_generation_by_fuel_monthly": "by_fuel",
    "gold_price_trends": "trends",
    "gold_carbon_footprint": "footprint",
    "gold_executive_summary": "summary",
}


def _bronze_line(view: str, table: str) -> str:
    return f"""select '{view}' as view_name, {len(column_names(table))} as column_count,
    count(*) as row_count, max(ingested_at) as newest from {_RAW_PARTS[table]}"""


def _listed(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


_SHIFTED = """(select id, region, wind_speed_ms, solar_irradiance_wm2, humidity_pct + 20 as humidity_pct,
    cloud_cover_pct - 10 as cloud_cover_pct from raw_weather) s"""
_BROKEN = """concat_ws('; ', case when wind_speed_ms < 0 then 'wind_speed_ms' end,
    case when solar_irradiance_wm2 < 0 then 'solar_irradiance_wm2' end,
    case when humidity_pct < 0 or humidity_pct > 100 then 'humidity_pct' end,
    case when cloud_cover_pct < 0 or cloud_cover_pct > 100 then 'cloud_cover_pct' end)"""
_DIRECT_MEAN = "avg(c.direct_co2_per_mwh)"

_TEXTS: dict[str, str] = {
    "g1_generation_cleaned": _doubles("silver_generation", "generation_mwh"),
    "g2_prices_cleaned": _doubles("silver_prices", _PRICE_MONEY),
    "g3_weather_daily": _doubles("silver_weather", _WEATHER_NUMBERS),
    "g4_market_daily": _doubles("silver_market", _MARKET_NUMBERS),
    "g5_carbon_daily": _doubles("silver_carbon", _CARBON_NUMBERS),
    "g6_generation_by_fuel": _doubles("by_fuel", _FUEL_NUMBERS),
    "g6_preaggregated": _doubles("by_fuel_plain", _FUEL_NUMBERS),
    "g7_price_trends": _doubles("trends", _TREND_NUMBERS),
    "g7_calendar": _doubles("trends_calendar", _TREND_NUMBERS),
    "g8_carbon_footprint": _doubles("footprint", _FOOTPRINT_NUMBERS),
    "g9_executive_summary": _doubles("summary", _SUMMARY_NUMBERS),
    "g9_deduplicated": _doubles("summary_once", _SUMMARY_NUMBERS),
    "r1_kpis": _kpis(_KPI_DIGITS),
    "r1_kpi_sheet": _kpis(None),
    "r2_generation_mix": f"""{_MIX} from by_fuel
        where fuel_type_description is not null and period_year >= {q.MIX_SINCE} group by all""",
    "r2_mix_sheet": f"""{_MIX}, {_shown(_mean("avg_direct_co2_per_mwh"), 1, "avg_co2_per_mwh")}
        from by_fuel where fuel_type_description is not null group by all
        order by period_year desc nulls first, generation_twh desc nulls first,
            fuel_type_description nulls last, fuel_category nulls last limit 100""",
    "r2_category_share": f"""
        select fuel_category, cast(sum(cast(generation_twh as decimal(18,2))) as double) as generation_twh
        from ({_MIX} from by_fuel
              where fuel_type_description is not null and period_year >= {q.MIX_SINCE} group by all) m
        where period_year = (select max(period_year) from by_fuel where period_year >= {q.MIX_SINCE})
        group by fuel_category""",
    "r3_price_table": _doubles(
        "price_rows", "price_cents_kwh yoy_change_pct rolling_avg", f"{_NEWEST_PRICES} 2000"
    ),
    "r3_price_sheet": f"""select period, state_code, sector_id, sector_name,
        {_shown("price_usd_per_mwh", 2, "price_usd_mwh")},
        {_shown("price_cents_per_kwh", 2, "price_cents_kwh")},
        {_shown("price_yoy_change_pct", 1, "yoy_change_pct")},
        {_shown("rolling_12m_avg_price_usd_mwh", 2, "rolling_12m_avg")},
        {_shown("retail_wholesale_spread_usd_mwh", 2, "retail_wholesale_spread")}
        from trends where sector_id in ('RES', 'COM', 'IND') {_NEWEST_PRICES} 500""",
    "r3_sector_trend": f"""select period, sector_id, sector_name,
        {_shown(_mean("price_cents_kwh"), 8, "price_cents_kwh")} from price_rows group by all""",
    "r3_yoy_distribution": f"""select sector_id, count(*) as changes,
        cast(min(yoy_change_pct) as double) as lowest,
        {_shown("quantile_cont(cast(yoy_change_pct as double), 0.25)", 4, "quartile_1")},
        {_shown("quantile_cont(cast(yoy_change_pct as double), 0.5)", 4, "median")},
        {_shown("quantile_cont(cast(yoy_change_pct as double), 0.75)", 4, "quartile_3")},
        cast(max(yoy_change_pct) as double) as highest
        from price_rows where yoy_change_pct is not null group by sector_id""",
    "r4_carbon_table": _doubles(
        "carbon_rows",
        "co2_mt renewable_pct clean_pct carbon_intensity intensity_yoy_change",
        f"order by period desc nulls first, carbon_rows.co2_mt desc {_DIRTIEST} 2000",
    ),
    "r4_carbon_sheet": f"""select period, state_code, state_description,
        {_shown("cast(total_generation_mwh as double) / 1000000", 3, "generation_twh")},
        {_shown("cast(total_co2_tonnes as double) / 1000000", 3, "co2_million_tonnes")},
        {_shown("footprint.renewable_share_pct", 1, "renewable_share_pct")},
        {_shown("footprint.clean_energy_share_pct", 1, "clean_energy_share_pct")},
        {_shown("grid_carbon_intensity_gco2_kwh", 1, "grid_intensity_gco2_kwh")},
        {_shown("carbon_intensity_yoy_change_pct", 1, "intensity_yoy_change_pct")}
        from footprint order by period desc nulls first, co2_million_tonnes desc {_DIRTIEST} 500""",
    "r4_top_states": f"""select period, state_code, cast(renewable_pct as double) as renewable_pct,
        {_shown("(select avg(renewable_pct) from top_rows)", 1, "mean_renewable_pct")} from top_rows""",
    "r4_national_trend": f"""select period,
        {_shown(_mean("carbon_rows.carbon_intensity"), 8, "carbon_intensity")} from carbon_rows group by period""",
    "r5_market_table": _doubles(
        "market_rows", _MARKET_SHOWN, "order by reading_date desc nulls first, region nulls last limit 1000"
    ),
    "r5_market_sheet": f"""select reading_date, region,
        {_shown("avg_spot_price_usd_mwh", 2, "spot_price_usd_mwh")},
        {_shown("avg_peak_price_usd_mwh", 2, "peak_price_usd_mwh")},
        {_shown("silver_market.avg_demand_mw", 0, "avg_demand_mw")},
        {_shown("silver_market.peak_demand_mw", 0, "peak_demand_mw")},
        {_shown("silver_market.price_volatility_pct", 1, "price_volatility_pct")}
        from silver_market order by reading_date desc nulls first, region nulls last limit 500""",
    "r5_latest_snapshot": _doubles(
        "(select * exclude (reading_date) from market_rows where reading_date = (select max(reading_date) from market_rows)) s",
        _MARKET_SHOWN,
    ),
    "r6_audit_summary": """select asset_name, status, cast(sum(records_written) as bigint) as total_records,
        count(*) as run_count, max(completed_at) as last_run from raw_audit group by all""",
    "l7_audit_state": """select * from raw_audit
        qualify row_number() over (partition by run_id, asset_name
            order by completed_at is not null desc, completed_at desc nulls last, id desc) = 1""",
    "j3_newest_per_fuel": _doubles("carbon_newest", _CARBON_NUMBERS),
    "k1_ordered_trends": _doubles("trends", _TREND_NUMBERS, "order by period desc, state_code, sector_id"),
    "k2_ordered_summary": _doubles(
        "summary", _SUMMARY_NUMBERS, "order by period desc, total_generation_mwh desc nulls last"
    ),
    "k5_newest_readings": _doubles(
        f"{_timed('raw_market')} m",
        _RAW_MARKET_NUMBERS,
        "where recorded_at = (select max(recorded_at) from raw_market)",
    ),
    "s1_bronze_views": "\nunion all ".join(_bronze_line(v, t) for v, t in BRONZE_VIEWS.items()),
    "s9_period_facets": _doubles(
        "raw_generation",
        "generation_mwh",
        f"where period between '{q.FACET_RANGE[0]}' and '{q.FACET_RANGE[1]}' and state_code in ({_listed(q.FACET_STATES)})",
    ),
    "s10_page": _doubles(
        "raw_generation",
        "generation_mwh",
        "order by period desc nulls first, "
        + ", ".join(f"raw_generation.{c} asc nulls last" for c in column_names(schemas.GENERATION) if c != "period")
        + f" limit {q.PAGE_SIZE} offset {q.PAGE_NUMBER * q.PAGE_SIZE}",
    ),
    "s10_seek_page": _doubles(
        "raw_generation",
        "generation_mwh",
        "order by period desc nulls first, "
        + ", ".join(f"raw_generation.{c} asc nulls last" for c in column_names(schemas.GENERATION) if c != "period")
        + f" limit {q.PAGE_SIZE} offset {q.PAGE_NUMBER * q.PAGE_SIZE}",
    ),
    "s12_full_refresh": _doubles("raw_prices", "price_cents_per_kwh revenue_million_dollars sales_million_kwh"),
    "s12_version_reads": _doubles(
        "raw_prices", "price_cents_per_kwh revenue_million_dollars sales_million_kwh", "where sector_id = 'RES'"
    ),
    "s7_landed_pages": _doubles(
        "(select * exclude (id, ingested_at) from raw_generation) g", "generation_mwh"
    ),
    "s8_landed_readings": _doubles(
        f"(select * exclude (id, ingested_at) from {_timed('raw_market')} t) m", _RAW_MARKET_NUMBERS
    ),
    "l9_empty_guard": f"""select 'some' as run_id, '{schemas.MARKET}' as asset_name, 'success' as status,
        cast(count(*) as int) as records_written from raw_market""",
    "u1_merge_partials": _doubles("silver_market", _MARKET_NUMBERS),
    "u1_carbon_partials": _doubles("silver_carbon", _CARBON_NUMBERS),
    "u3_appended_columns": _doubles(
        """(select * from late_daily union all by name select * exclude (peak_demand_mw) from stored_market s
            where not exists (select 1 from late_daily n where n.region = s.region and n.reading_date = s.reading_date)) m""",
        _MARKET_NUMBERS,
    ),
    "s11_trailing": _doubles(
        "raw_prices",
        "price_cents_per_kwh revenue_million_dollars sales_million_kwh",
        "where period >= strftime(date '2000-06-30' - interval 90 day, '%Y-%m')",
    ),
    "s16_factors": f"""
        select f.fuel as fuel_type, cast(f.direct as double) as direct_co2_gco2_per_kwh,
            cast(f.lifecycle as double) as lifecycle_co2_gco2_per_kwh,
            case when f.lifecycle < 100 then 'low' when f.lifecycle < 500 then 'medium' else 'high' end as category,
            f.description, count(c.id) as readings, {_shown(_DIRECT_MEAN, 4, "mean_direct")},
            {_shown(f"({_round(_DIRECT_MEAN, 4)} / nullif(cast(f.direct as double), 0) - 1) * 100", 2, "off_factor_pct")}
        from factors f left join raw_carbon c on lower(trim(c.fuel_type)) = f.fuel group by f.fuel, f.direct, f.lifecycle, f.description""",
    "s17_grid": f"""
        select r.region, f.fuel_type, count(c.id) as readings, max(cast(c.recorded_at as date)) as newest
        from ({_values([(r,) for r in dims.REGIONS], "region")}) r
        cross join ({_values([(f,) for f in dims.REQUESTED_FUELS], "fuel_type")}) f
        left join raw_carbon c on c.region = r.region and lower(trim(c.fuel_type)) = f.fuel_type
        group by r.region, f.fuel_type""",
    "l5_insert_new": _inserted(schemas.GENERATION, "generation_mwh"),
    "l6_insert_prices": _inserted(
        schemas.PRICES, "price_cents_per_kwh revenue_million_dollars sales_million_kwh"
    ),
    "l1_normalise": f"""
        select event_id, period, {_STATE_ANY} as state_code,
            case when event_id % 3 = 0 then 'Place ' || st else 'State ' || st end as state_description,
            {_SECTOR} as sector_id, cast(null as string) as sector_description,
            case when event_id % 7 = 0 then 'SUN' else 'NG' end as fuel_type_code,
            event_type as fuel_type_description,
            cast(cast(generation as decimal(18,4)) as double) as generation_mwh,
            'thousand megawatthours' as generation_units, 'eia_api' as source, 'fixture' as api_request_id
        from records where not {_BAD_PERIOD} and not {_BAD_GENERATION}""",
    "l2_normalise_prices": f"""
        select event_id, period, {_STATE_PRICE} as state_code,
            case when event_id % 3 = 0 then '' else 'State ' || st end as state_description,
            {_SECTOR} as sector_id, event_type as sector_name,
            cast(price as double) as price_cents_per_kwh,
            cast(k || '00.5' as double) as revenue_million_dollars,
            cast(sales as double) as sales_million_kwh, cast(k as bigint) as customers,
            'eia_api' as source, 'fixture' as api_request_id
        from records where not {_BAD_PERIOD} and not {_BAD_PRICE} and not {_BAD_CUSTOMERS}""",
    "l3_quarantine": f"""
        select 'generation' as kind, event_id, period, {_STATE_ANY} as state_code, {_SECTOR} as sector_id,
            {_REASONS_GENERATION} as reject_reason from records where {_BAD_PERIOD} or {_BAD_GENERATION}
        union all
        select 'prices', event_id, period, {_STATE_PRICE}, {_SECTOR}, {_REASONS_PRICES}
        from records where {_BAD_PERIOD} or {_BAD_PRICE} or {_BAD_CUSTOMERS}""",
    "l8_flatten": _FORECAST_POINTS,
    "u1_upsert": _UPSERTED,
    "u2_watermark": _doubles(f"{_timed('late_market')} m", _RAW_MARKET_NUMBERS),
    "u5_lookback": _doubles(
        f"{_timed('raw_market')} m",
        _RAW_MARKET_NUMBERS,
        f"where ingested_at > (select max(ingested_at) from stored_market) - interval {q.LOOKBACK_DAYS} day",
    ),
    "u1_replace_delta": _doubles(f"{_merged('late_daily')} m", _MARKET_NUMBERS),
    "u1_recompute_touched": _doubles(f"{_merged(_TOUCHED)} m", _MARKET_NUMBERS),
    "d_raw_quality": _checks(quality.RAW_CHECKS, _RAW_PARTS),
    "d2_repeated_ids": "select id from raw_market where id % 1009 = 0",
    "d_bronze_quality": _checks(
        quality.BRONZE_CHECKS, {view: _RAW_PARTS[table] for view, table in BRONZE_VIEWS.items()}
    ),
    "d_silver_quality": _checks(quality.SILVER_CHECKS, _SILVER_PARTS),
    "d_gold_quality": _checks(quality.GOLD_CHECKS, _GOLD_PARTS),
    "d7_reading_bounds": f"""select id, region, cast(humidity_pct as double) as humidity_pct,
        cast(cloud_cover_pct as double) as cloud_cover_pct, {_BROKEN} as broken
        from {_SHIFTED} where {_BROKEN} <> ''""",
    "e1_price_signal": """
        select m.id, m.region, cast(m.spot_price_usd_mwh as double) as spot_price_usd_mwh,
            cast(b.base_price as integer) as base_price_usd_mwh,
            case when m.spot_price_usd_mwh is null then null
                 when cast(m.spot_price_usd_mwh as double) / b.base_price < 0.6 then 'low'
                 when cast(m.spot_price_usd_mwh as double) / b.base_price < 1.4 then 'normal'
                 when cast(m.spot_price_usd_mwh as double) / b.base_price < 2.5 then 'high'
                 else 'critical' end as signal
        from raw_market m left join base_prices b on b.region = m.region""",
    "e2_carbon_category": """
        select id, cast(lifecycle_co2_per_mwh - 5 as double) as lifecycle,
            case when lifecycle_co2_per_mwh - 5 < 0 then 'high' when lifecycle_co2_per_mwh - 5 < 100 then 'low'
                 when lifecycle_co2_per_mwh - 5 < 500 then 'medium' else 'high' end as category
        from raw_carbon""",
    "e3_fallback": f"""
        select id,
            case when id % 5 = 0 and upper(weather_condition) not in ({_listed(dims.REGIONS)})
                 then 'ERCOT' when id % 5 = 0 then upper(weather_condition) else region end as region,
            case when id % 5 = 0 then 'coal' when lower(weather_condition) in ({_listed(dims.KNOWN_FUELS)})
                 then lower(weather_condition) else 'other' end as fuel_type
        from raw_weather""",
    "e4_horizon": f"""
        select region, issue_date, issued_at, h as hours_ahead,
            date_trunc('hour', issued_at) + to_hours(h) as forecast_hour,
            {_shown("greatest(50, 99 - 0.3 * h)", 2, "confidence_pct")}
        from (select region, cast(forecast_hour as date) as issue_date, max(forecast_hour) as issued_at
              from raw_forecast group by all) i,
            (select cast(unnest(range({q.HORIZON_HOURS})) as integer) as h) hours""",
    "e4_varying_horizon": f"""
        select region, issue_date, issued_at, h as hours_ahead,
            date_trunc('hour', issued_at) + to_hours(h) as forecast_hour,
            {_shown("greatest(50, 99 - 0.3 * h)", 2, "confidence_pct")}
        from (select region, cast(forecast_hour as date) as issue_date, max(forecast_hour) as issued_at
              from raw_forecast group by all) i,
            (select cast(unnest(range(168)) as integer) as h) hours
        where h < day(issue_date) * 5""",
    "w2_pct_of_total": f"""
        select order_year, o_orderstatus, cast(total as double) as total,
            {_shown("cast(total as double) / nullif(cast(sum(total) over (partition by order_year) as double), 0) * 100", 2, "pct")}
        from (select cast(year(o_orderdate) as integer) as order_year, o_orderstatus,
                  sum(cast(o_totalprice as decimal(18,2))) as total from orders group by all) t""",
    "w7_yoy": f"""
        select o_orderpriority, order_month, cast(total as double) as total,
            cast({_change("total", "lag(total, 12) over (partition by o_orderpriority order by order_month)")} as double) as yoy_pct
        from (select o_orderpriority, cast(date_trunc('month', o_orderdate) as date) as order_month,
                  sum(cast(o_totalprice as decimal(18,2))) as total from orders group by all) t""",
    "p15_safe_divide": f"""
        select l_partkey, returned, accepted,
            {_shown("case when accepted = 0 or accepted is null then 0 else returned / accepted end", 4, "returned_per_accepted")}
        from (select l_partkey,
                  sum(case when l_returnflag = 'R' then l_quantity else 0 end) as returned,
                  sum(case when l_returnflag = 'A' then l_quantity else 0 end) as accepted
              from lineitem group by l_partkey) t""",
    "x1_stream_readings": _doubles(
        "(select * replace (ingested_at as recorded_at) from raw_market) m", _RAW_MARKET_NUMBERS
    ),
    "x5_batch_and_stream": _doubles(
        "(select * exclude (id) replace (ingested_at as recorded_at), true as numbered_once from raw_market) m",
        _RAW_MARKET_NUMBERS,
    ),
    "x2_stream_daily": _doubles(
        f"({_daily_market('(select * replace (ingested_at as recorded_at) from raw_market) e')}) m",
        _MARKET_NUMBERS,
    ),
    "x4_stream_forecast": _FORECAST_POINTS,
}
_TEXTS["s18_report_sheet"] = _TEXTS["r5_market_sheet"]
_TEXTS["x2_stream_partials"] = _TEXTS["x2_stream_daily"]


def _first_of_stream() -> str:
    table = schemas.GENERATION
    keys = schemas.LOAD_KEYS[table]
    rest = [c for c in column_names(table) if c not in {"id", "ingested_at", *keys}]
    order = ", ".join(f"{c} asc nulls last" for c in ["ingested_at", "id", *rest])
    first = f"""(select * from raw_generation
        qualify row_number() over (partition by {", ".join(keys)} order by {order}) = 1) f"""
    return f"select * exclude (id) replace (cast(generation_mwh as double) as generation_mwh) from {first}"


_TEXTS["x3_stream_insert"] = _first_of_stream()


def oracle_sql() -> dict[str, str]:
    return {name: _full(text) for name, text in _TEXTS.items()}
