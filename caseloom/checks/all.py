"""Every registered query; importing the modules fills the registry."""

from caseloom.checks import aggregates, flows, learning, rows  # noqa: F401
from caseloom.checks.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
