"""Registered queries (one per operator of the survey) and their SQL oracles.

Importing this package fills :data:`quarry.plans.registry.QUERIES` and
:data:`quarry.plans.registry.ORACLE_SQL`.
"""

from quarry.plans import cleaning, features, metrics, models, text  # noqa: F401
from quarry.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
