"""Checked queries over the given tables, one per operator.

Every query reads whole tables. Where an operator compares two stores or meets stored data, the second side is derived
from the same tables with some rows missing or changed, so that there is something to find; both sides grow with the data.
"""

import importlib

MODULES = ("datastreams", "statistics", "processing", "ingest", "metadata", "laboratory", "stores", "stored")

for _module in MODULES:
    importlib.import_module(f"suite.{_module}")
