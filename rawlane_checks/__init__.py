"""Every operator as a named query over the sample tables, each with the SQL that gives the same rows."""

from rawlane_checks.registry import CHECKS
from rawlane_checks import cleaning, intake, relational, reports, routing, rules, schema, sources  # noqa: F401  (they register)

__all__ = ["CHECKS"]
