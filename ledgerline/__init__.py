"""Commerce analytics as Spark jobs: ingestion, staging, star schema, quality, metrics, event intake."""

from ledgerline.plans.warehouse import Warehouse
from ledgerline.settings import Settings

__all__ = ["Settings", "Warehouse"]
