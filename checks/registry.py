"""All registered queries."""

from checks import attendance, courses, entities, faults, reports, sources, text  # noqa: F401
from checks.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
