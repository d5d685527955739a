"""All queries of the reference's operators: importing the modules registers them."""

from quillspark.plans import data, groups, scoring, tokens, trace  # noqa: F401
from quillspark.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
