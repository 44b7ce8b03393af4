"""Importing this module registers every query."""

from casebook.plans import (  # noqa: F401
    queries_entities,
    queries_functions,
    queries_history,
    queries_insights,
    queries_lake,
    queries_rollup,
    queries_serving,
)
from casebook.plans.views import ORACLES, QUERIES  # noqa: F401
