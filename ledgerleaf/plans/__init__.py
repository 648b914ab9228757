"""Named queries by family; importing the package fills the registry."""

import importlib

for _family in ("relational", "texts", "documents", "graphs", "series", "forecasts", "learning", "search", "files",):
    importlib.import_module(f"ledgerleaf.plans.{_family}")
