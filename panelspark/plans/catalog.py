"""All registered queries, gathered by importing the modules that register them."""

from panelspark.plans import queries_models, queries_panel  # noqa: F401
from panelspark.plans.registry import QUERIES, SQL  # noqa: F401
