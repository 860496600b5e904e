"""All registered queries with their reference SQL."""

from salescube.catalog import (
    elasticity_oracles, elasticity_queries, report_oracles, report_queries, rollup_oracles, rollup_queries,
)

_MODULES = [
    (rollup_queries, rollup_oracles),
    (elasticity_queries, elasticity_oracles),
    (report_queries, report_oracles),
]

QUERIES = {name: query for queries, _ in _MODULES for name, query in queries.QUERIES.items()}
ORACLES = {name: sql for _, oracles in _MODULES for name, sql in oracles.ORACLES.items()}
