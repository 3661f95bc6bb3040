"""All queries that are not of the llm subpackage."""

from . import catalog_audit, catalog_domain, catalog_relational, catalog_text  # noqa: F401  they register themselves
from .registry import ORACLES, QUERIES  # noqa: F401
