"""Named queries over the test tables, each with the SQL it must agree with."""

from eventmart.plans import batch, keyed, learn, streams  # noqa: F401  (they register their queries)
from eventmart.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
