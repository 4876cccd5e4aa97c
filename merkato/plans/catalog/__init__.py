"""Named queries over the order-entry tables, each with the SQL that must give the same rows."""

from merkato.plans.catalog import aggregates, decide, fitted, joins, load, model, quality, scalar, tables, windows  # noqa: F401
from merkato.plans.catalog.registry import QUERIES, SQL  # noqa: F401
