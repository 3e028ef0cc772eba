"""All registered queries."""

from __future__ import annotations

from checks import (  # noqa: F401
    ad_checks,
    category_checks,
    function_checks,
    product_checks,
    session_checks,
    sink_checks,
    source_checks,
    table_checks,
)
from checks.registry import QUERIES, SQL  # noqa: F401
