"""All registered queries and their SQL."""

from dayloom.plans import chat_queries, landing_queries, quality_queries, table_queries  # noqa: F401
from dayloom.plans.registry import QUERIES, SQL  # noqa: F401
