"""All queries of the core, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from loomspan.plans import counting, fusion, identity, joining, mining, quality, shaping, sourcing, wide

_MODULES = (fusion, wide, counting, joining, identity, mining, quality, shaping, sourcing)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
SQL = {name: text for module in _MODULES for name, text in module.SQL.items()}
