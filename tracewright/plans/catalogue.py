"""All registered queries of the core."""

from tracewright.plans import analytics, audits, captures, models, roundtrips, streams  # noqa: F401
from tracewright.plans.registry import ORACLES, QUERIES  # noqa: F401
