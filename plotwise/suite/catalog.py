"""All registered queries."""

from plotwise.suite import display, grouping, job, models, quality, reshaping, scalars  # noqa: F401
from plotwise.suite.registry import ORACLES, QUERIES  # noqa: F401
