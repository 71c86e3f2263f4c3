"""The full daily build: staging, both marts, all summaries, written layer by layer."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfline.config import Config
from shelfline.plans import pricing, promo, quality, staging
from shelfline.sources.ingest import require_valid_load
from shelfline.sources.sinks import ANALYTICS, MARTS, STAGING, Layers


def build_all(sales: DataFrame, cfg: Config, layers: Layers) -> dict[str, DataFrame]:
    """Build and write every dataset; returns scans of what was written.

    ``sales`` is the loaded base table. The scored rows are written once because
    the two marts and both quality datasets read them, each with its own columns.
    """
    require_valid_load(sales)
    staged = layers.write(staging.stage_sales(sales, cfg), STAGING, "sales", sort_by=["sale_date", "store_name"], stamp="loaded_at")

    def mart(df: DataFrame, name: str) -> DataFrame:
        return layers.write(df, MARTS, name, partition_by=["is_focus"], sort_by=["store_name"], stamp="built_at")

    def summary(df: DataFrame, name: str) -> DataFrame:
        return layers.write(df, ANALYTICS, name, stamp="built_at")

    promo_mart = mart(promo.build_promo_mart(staged, cfg), "promo_detection")
    price_mart = mart(pricing.build_price_mart(staged), "price_index")
    stats = quality.outlier_stats(staged, cfg)
    return {
        "sales": staged,
        "promo_detection": promo_mart,
        "price_index": price_mart,
        "promo_summary": summary(promo.promo_summary(promo_mart), "promo_summary"),
        "pricing_summary": summary(pricing.pricing_summary(price_mart), "pricing_summary"),
        "data_quality_summary": summary(quality.dq_summary(staged), "data_quality_summary"),
        "data_quality_issues": summary(quality.dq_issues(staged, stats, cfg), "data_quality_issues"),
    }
