"""Import every plan module so that all queries are registered."""

from citytherm.plans import queries, oracle, cleaning, profiling, evaluation, scenarios, ingest, learning  # noqa: F401
from citytherm.plans.registry import ORACLE, REGISTRY  # noqa: F401
