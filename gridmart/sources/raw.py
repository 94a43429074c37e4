"""Raw table scans and the bronze views over them."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart import schemas

# The bronze view of each raw table. The views keep every raw column.
BRONZE_VIEWS = {
    "bronze_eia_generation": schemas.GENERATION,
    "bronze_eia_prices": schemas.PRICES,
    "bronze_weather": schemas.WEATHER,
    "bronze_carbon_intensity": schemas.CARBON,
    "bronze_market_prices": schemas.MARKET,
}


def column_names(table: str) -> list[str]:
    return [part.split()[0] for part in _split_ddl(schemas.RAW_TABLES[table])]


def _split_ddl(ddl: str) -> list[str]:
    parts, depth, current = [], 0, ""
    for char in ddl:
        depth += (char == "(") - (char == ")")
        if char == "," and depth == 0:
            parts.append(current)
            current = ""
        else:
            current += char
    return [*parts, current]


def read_raw(spark: SparkSession, table: str, root: str) -> DataFrame:
    """Scan ``<root>/<table>`` with its fixed schema, so no file is opened to infer one."""
    stored = spark.read.schema(schemas.RAW_TABLES[table]).parquet(f"{root}/{table}")
    return stored.select(*column_names(table))


def bronze(raw: DataFrame, view: str) -> DataFrame:
    """The named columns of a bronze view; whatever else the raw frame carries is dropped."""
    return raw.select(*column_names(BRONZE_VIEWS[view]))


def register_bronze(spark: SparkSession, root: str) -> list[str]:
    """Create every bronze temporary view over the raw tables below ``root``."""
    for view, table in BRONZE_VIEWS.items():
        bronze(read_raw(spark, table, root), view).createOrReplaceTempView(view)
    return list(BRONZE_VIEWS)


def facets(
    df: DataFrame,
    start: str | None = None,
    end: str | None = None,
    states: list[str] | None = None,
) -> DataFrame:
    """Rows of a period range and a list of states; plain comparisons reach the scan."""
    wanted: list[Column] = []
    if start:
        wanted.append(F.col("period") >= start)
    if end:
        wanted.append(F.col("period") <= end)
    if states:
        wanted.append(F.col("state_code").isin(states))
    for condition in wanted:
        df = df.filter(condition)
    return df


def page(df: DataFrame, number: int = 0, size: int = 5000, tie_break: list[str] | None = None) -> DataFrame:
    """One page of rows, newest period first.

    Only offset + size rows per task survive the sort (a top-k plan). ``tie_break`` makes
    the order total, without which pages could overlap.
    """
    ties = tie_break or [name for name in df.columns if name != "period"]
    ordered = df.orderBy(F.desc_nulls_first("period"), *[F.asc_nulls_last(t) for t in ties])
    return ordered.offset(number * size).limit(size)


def page_after(df: DataFrame, last: dict | None = None, size: int = 5000, tie_break: list[str] | None = None) -> DataFrame:
    """The rows that follow ``last``, the last row of the page before, newest period first.

    Whatever the page's number, a task keeps ``size`` rows: the rows before are filtered out,
    not sorted and skipped. Without ``last`` it is the first page.
    """
    ties = tie_break or [name for name in df.columns if name != "period"]
    if last is not None:
        newest = F.col("period").isNotNull() if last["period"] is None else F.col("period") < last["period"]
        later, equal = newest, F.col("period").eqNullSafe(F.lit(last["period"]))
        for name in ties:
            value = F.lit(last[name])
            after = F.lit(False) if last[name] is None else (F.col(name) > value) | F.col(name).isNull()
            later, equal = later | (equal & after), equal & F.col(name).eqNullSafe(value)
        df = df.filter(later)
    return df.orderBy(F.desc_nulls_first("period"), *[F.asc_nulls_last(t) for t in ties]).limit(size)
