"""Queries of the core and their SQL."""

from corpusloom.operators import timestamps
from corpusloom.plans import archive, catalog, flows, scalars

QUERIES = {**catalog.QUERIES, **flows.QUERIES, **archive.QUERIES, **scalars.QUERIES, "p6_found": timestamps.p6_found}
SQL: dict[str, str] = {**catalog.SQL, **flows.SQL, **archive.SQL, **scalars.SQL}
