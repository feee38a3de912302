"""All registered queries."""

from cardrisk.plans import cleaning, learned, live, risk, rollups  # noqa: F401  (registers them)
from cardrisk.plans.registry import ORACLES, QUERIES  # noqa: F401
