"""Oracle prices, by oracle and by product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.plans.dimensions import product
from ledgerlens.plans.staging import staging
from ledgerlens.sources.catalog import Warehouse


def _priced_oracles(w: Warehouse) -> DataFrame:
    names = staging(w, "db_price_oracles").select(
        F.col("id").alias("oracle_id"), F.col("oracle_id").alias("oracle_key")
    )
    return staging(w, "db_prices").join(names, "oracle_id")


def int_price(w: Warehouse) -> DataFrame:
    """Prices by oracle key, without the ``-rp`` twins of other oracles."""
    return w.model(_priced_oracles).where(~F.endswith("oracle_key", F.lit("-rp"))).select(
        "oracle_key", F.col("t").alias("date_time"), F.col("val").alias("price")
    )


def int_product_price(w: Warehouse) -> DataFrame:
    products = w.model(product).select(
        "chain_id", "product_address", F.col("price_oracle_key").alias("oracle_key")
    )
    return w.model(_priced_oracles).join(products, "oracle_key").select(
        "chain_id",
        F.col("product_address").alias("token_address"),
        F.col("t").alias("date_time"),
        F.col("val").alias("price"),
    )
