"""Retail analytics as Spark DataFrame transformations."""

from shelfline.config import Config
from shelfline.session import configure, stage_table

__all__ = ["Config", "configure", "stage_table"]
