"""Supply forecast: weekly and monthly releases and the newest one."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import parsed_date
from ..operators.aggregate import sum_by
from ..operators.incremental import rows_of_new_partitions
from ..operators.joins import latest_global
from ..operators.windows import flag_newest, release_number
from ..sources.readers import PARTS, padded_parts

NAMES = {
    "forecastdate": "forecast_date", "forecastmonth": "forecast_month",
    "forecastqty": "forecast_qty", "forecasttype": "forecast_type",
    "forecastvalue": "forecast_value", "idcanale": "id_canale", "idcliente": "id_cliente",
    "logisticarea": "logistic_area", "networkcode": "network_code", "SKU": "sku",
    "PROCESSFK": "process_fk",
}


def typed_forecast(raw: DataFrame) -> DataFrame:
    """Text columns of an export with their types and names."""
    return padded_parts(raw).withColumns({
        "forecastdate": parsed_date("forecastdate", "yyyy-MM-dd"),
        "forecastmonth": parsed_date("forecastmonth", "yyyy-MM-dd"),
        "forecastqty": F.col("forecastqty").try_cast("double"),
        "matematico": F.col("matematico").try_cast("double"),
    }).withColumnsRenamed(NAMES)


def new_releases(raw: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of release days that are not stored yet."""
    return rows_of_new_partitions(typed_forecast(raw), stored, PARTS)


def release_totals(rows: DataFrame, prefix: str) -> DataFrame:
    """Totals per release, area and product, labelled with their place in the month."""
    totals = sum_by(rows, [*PARTS, "forecast_date", "logistic_area", "sku"],
                    ["forecast_qty", "matematico"])
    release = parsed_date(F.concat_ws("-", *PARTS), "yyyy-MM-dd")
    return (release_number(totals, *PARTS, prefix)
            .withColumn("ingestion_date", release).drop(*PARTS))


def newest_forecast(weekly: DataFrame, monthly: DataFrame) -> DataFrame:
    """The last weekly and the last monthly release; the newer of them is flagged.

    On the same day the monthly one is the newest.
    """
    both = latest_global(weekly, "ingestion_date").withColumn(
        "forecast_type", F.lit("WEEKLY")).unionByName(
        latest_global(monthly, "ingestion_date").withColumn("forecast_type", F.lit("MONTHLY")))
    return flag_newest(both, "ingestion_date", "forecast_type", "latest_forecast")
