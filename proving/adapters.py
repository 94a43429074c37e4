"""The given tables read as raw tables.

Each text is one projection (or one aggregate) of one table and runs unchanged in Spark and
in the checking database: no adapter joins, so a query's plan shows its own work. Untidy
values are planted on purpose: padded and lower-case states, blank states, missing measures,
zero prices, unknown members.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart import schemas

STATES = "TX,CA,NY,PA,OH,IL,MI,MN,FL,GA,NC,VA,MA,CT,RI,ME,KS,CO,AZ,WA,OR,AL,IN,KY,WY"
REGIONS = "ERCOT,CAISO,PJM,MISO,NYISO,NEISO,SPP,WECC,SERC"
FUEL_CODES = "NG,COL,NUC,HYC,WWW,SUN,PET,GEO,OTH,BIO,WND,SOL,ALL"
CARBON_FUELS = " Coal ,natural_gas,nuclear,wind,solar_pv,hydro,petroleum"

_REGION = f"split_part('{REGIONS}', ',', cast(user_id % 9 as int) + 1)"
# every reading lies on the first day of a month of 1995 to 2001
_MONTH = (
    "make_date(cast(1995 + floor((event_id % 84) / 12) as int), "
    "cast((event_id % 84) % 12 + 1 as int), 1)"
)

GENERATION = f"""
select l_orderkey * 8 + l_linenumber as id, l_shipdate as ingested_at,
       substring(cast(l_shipdate as string), 1, 7) as period,
       case when l_partkey % 97 = 0 then '  '
            when l_linenumber = 7 then concat(' ', lower(st), ' ') else st end as state_code,
       concat('State ', st) as state_description,
       case when l_linestatus = 'F' then '99' else '1' end as sector_id,
       case when l_linestatus = 'F' then 'All Sectors' else 'Utility' end as sector_description,
       split_part('{FUEL_CODES}', ',', cast(l_partkey % 13 as int) + 1) as fuel_type_code,
       concat('Fuel ', cast(l_partkey % 13 as string)) as fuel_type_description,
       case when l_quantity = 50 then null else cast(l_quantity as decimal(18,4)) end as generation_mwh,
       'thousand megawatthours' as generation_units, 'eia_api' as source,
       'fixture' as api_request_id
from (select l_orderkey, l_linenumber, l_shipdate, l_partkey, l_linestatus, l_quantity,
             split_part('{STATES}', ',', cast(l_suppkey % 25 as int) + 1) as st
      from {{lineitem}}) b"""

PRICES = f"""
select min(o_orderkey) as id, max(o_orderdate) as ingested_at, period, st as state_code,
       concat('State ', st) as state_description, sector_id,
       concat('Sector ', sector_id) as sector_name,
       case when min(o_orderkey) % 41 = 0 then cast(0 as decimal(10,4))
            else cast(max(cast(o_totalprice as decimal(18,2))) * 0.0001 as decimal(10,4))
            end as price_cents_per_kwh,
       cast(cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(22,2)) * 0.0001
            as decimal(18,4)) as revenue_million_dollars,
       cast(count(*) * 10 as decimal(18,4)) as sales_million_kwh, count(*) as customers,
       'eia_api' as source, 'fixture' as api_request_id
from (select o_orderkey, o_orderdate, o_totalprice,
             substring(cast(o_orderdate as string), 1, 7) as period,
             split_part('{STATES}', ',', cast(o_custkey % 25 as int) + 1) as st,
             case substring(o_orderpriority, 1, 1) when '1' then 'RES' when '2' then 'COM'
                  when '3' then 'IND' when '4' then 'TRA' else 'OTH' end as sector_id
      from {{orders}}) b
group by period, st, sector_id"""

WEATHER = f"""
select event_id as id, ts as ingested_at, {_REGION} as region,
       case when event_id % 53 = 0 then null
            else cast(cast(value as decimal(10,2)) * 0.1 - 5 as decimal(6,2)) end as temperature_c,
       cast(cast(value as decimal(10,2)) * 0.02 as decimal(6,2)) as wind_speed_ms,
       cast(cast(value as decimal(10,2)) * 1.5 as decimal(8,2)) as solar_irradiance_wm2,
       cast(user_id % 101 as decimal(5,2)) as humidity_pct,
       cast(event_id % 101 as decimal(5,2)) as cloud_cover_pct,
       event_type as weather_condition, {_MONTH} as recorded_at, 'enrichment_api' as source
from {{events}}"""

CARBON = f"""
select event_id as id, ts as ingested_at, {_REGION} as region,
       split_part('{CARBON_FUELS}', ',', cast(user_id % 7 as int) + 1) as fuel_type,
       cast(value as decimal(10,4)) as direct_co2_per_mwh,
       cast(cast(value as decimal(10,4)) * 1.1 as decimal(10,4)) as lifecycle_co2_per_mwh,
       case when event_id % 59 = 0 then null when value * 1.1 < 100 then 'low'
            when value * 1.1 < 500 then 'medium' else 'high' end as carbon_intensity_category,
       {_MONTH} as recorded_at, 'enrichment_api' as source
from {{events}}"""

MARKET = f"""
select event_id as id, ts as ingested_at, {_REGION} as region,
       case when event_id % 61 = 0 then null else cast(value as decimal(10,4)) end as spot_price_usd_mwh,
       cast(cast(value as decimal(10,4)) * 2.2 as decimal(10,4)) as peak_price_usd_mwh,
       cast(cast(value as decimal(10,4)) * 0.5 as decimal(10,4)) as off_peak_price_usd_mwh,
       cast((user_id % 100000) * 100 as decimal(12,2)) as demand_mw,
       cast((user_id % 100000) * 101 as decimal(12,2)) as demand_forecast_mw,
       case when value < 27 then 'low' when value < 63 then 'normal'
            when value < 112.5 then 'high' else 'critical' end as price_signal,
       {_MONTH} as recorded_at, 'enrichment_api' as source
from {{events}}"""

AUDIT = """
select event_id as id, concat('run_', cast(user_id as string)) as run_id, event_type as asset_name,
       'fixture' as source, cast(floor(value) as int) as records_written, ts as started_at,
       case when event_id % 10 = 1 then null else ts end as completed_at,
       case when event_id % 10 = 0 then 'failed' when event_id % 10 = 1 then 'running'
            else 'success' end as status
from {events}"""

FORECAST = f"""
select event_id as id, ts as ingested_at, {_REGION} as region, ts as forecast_hour,
       cast((user_id % 100000) * 100 as decimal(12,2)) as forecast_demand_mw,
       cast(cast(value as decimal(10,2)) * 0.1 as decimal(6,2)) as temperature_c,
       cast(99 - (event_id % 168) * 0.25 as decimal(5,2)) as confidence_pct,
       ts as recorded_at, 'enrichment_api' as source
from {{events}}"""

TEXTS = {
    schemas.GENERATION: GENERATION,
    schemas.PRICES: PRICES,
    schemas.WEATHER: WEATHER,
    schemas.CARBON: CARBON,
    schemas.MARKET: MARKET,
    schemas.AUDIT: AUDIT,
    schemas.FORECAST: FORECAST,
}
TABLES = {
    schemas.GENERATION: "lineitem",
    schemas.PRICES: "orders",
}


def given(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def raw(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A raw table made of a given one. ``recorded_at`` becomes a timestamp, as stored."""
    source = TABLES.get(table, "events")
    rows = spark.sql(TEXTS[table], **{source: given(spark, folder, source)})
    if "recorded_at" in rows.columns:
        rows = rows.withColumn("recorded_at", F.col("recorded_at").cast("timestamp_ntz"))
    return rows


def sql(table: str) -> str:
    """The same text for the checking database."""
    source = TABLES.get(table, "events")
    return TEXTS[table].format(**{source: source})
