"""Named queries over the given tables, each with the SQL it is checked against."""

from quireworks.registry import chunks, ingests, texts, vectors  # noqa: F401
from quireworks.registry.core import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
