"""Every operator on the test tables, next to the SQL that must give the same rows."""

from farebox.registry import analytics, augment, conform, enrich, incremental, products, quality

MODULES = (conform, quality, enrich, analytics, products, incremental, augment)
QUERIES = {name: f for module in MODULES for name, f in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
