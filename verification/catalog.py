"""All registered queries."""

from verification import (  # noqa: F401
    checks_aggregate, checks_domain, checks_filter, checks_join, checks_models, checks_normalize, checks_order,
    checks_quality, checks_sink, checks_source, checks_stream, checks_window,
)
from verification.registry import ORACLES, QUERIES  # noqa: F401
