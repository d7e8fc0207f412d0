"""All registered queries (importing the sections registers them)."""

from broadsheet.plans import (  # noqa: F401
    changes,
    extensions,
    lookups,
    mapping,
    queueing,
    scalars,
    scans,
    serve,
    sinks,
    validation,
)
from broadsheet.plans.registry import ORACLES, QUERIES  # noqa: F401
