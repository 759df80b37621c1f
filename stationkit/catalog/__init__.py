"""Named queries over the given tables, with equivalent SQL where SQL can say it."""

from stationkit.catalog import (
    chain,
    cleaning,
    cubes,
    features,
    graph,
    learning,
    reports,
    streams,
    tables,
    temporal,
)
from stationkit.catalog.base import Query

QUERIES: dict[str, Query] = {
    **cleaning.QUERIES,
    **features.QUERIES,
    **reports.QUERIES,
    **graph.QUERIES,
    **learning.QUERIES,
    **streams.QUERIES,
    **temporal.QUERIES,
    **cubes.QUERIES,
    **tables.QUERIES,
    **chain.QUERIES,
}
