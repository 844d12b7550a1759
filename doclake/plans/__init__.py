from doclake.plans.ingest import ingest_tables
from doclake.plans.layers import Lake, bronze, gold, run_layers, run_marts, silver

__all__ = ["Lake", "bronze", "gold", "ingest_tables", "run_layers", "run_marts", "silver"]
