"""Silver layer: typed, cleaned tables built from bronze."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from tessera.functions.clean import (ZONE_OFFSETS, digits_only, is_not_corrupt,
                                     parse_zoned_timestamp, strip_currency, title_case,
                                     to_int, to_money)
from tessera.schemas import INGEST_TS_COL, RESCUE_COL, SOURCE_FILE_COL

# The columns of the silver table.
TRANSACTION_COLUMNS = ["order_id", "item_id", "quantity", "price", "order_timestamp",
                       INGEST_TS_COL, SOURCE_FILE_COL]


def build_transactions(bronze: DataFrame, zones: Mapping[str, str] = ZONE_OFFSETS,
                       extra_columns: Sequence[str] = ()) -> DataFrame:
    """Drop corrupt rows, parse zoned timestamps, type quantity and price.

    The corrupt-flag filter sits first so Catalyst pushes it into the scan.
    """
    return (bronze.drop(RESCUE_COL)
            .filter(is_not_corrupt("corrupted_flag"))
            .withColumns({
                "order_timestamp": parse_zoned_timestamp("order_timestamp", zones),
                "price": to_money(strip_currency("price")),
                "quantity": to_int(digits_only("quantity")),
            })
            .select(*TRANSACTION_COLUMNS, *extra_columns))


def build_products(bronze: DataFrame) -> DataFrame:
    """Title-case the product name; everything else as ingested."""
    return bronze.withColumn("product_name", title_case("product_name")).drop(RESCUE_COL)
