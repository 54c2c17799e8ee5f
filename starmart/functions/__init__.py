"""Column expressions and schema contracts shared by all stages (JVM-side
built-ins only – no Python UDFs)."""

from starmart.functions.schemas import (  # noqa: F401
    EVENT_SCHEMA, VALID_STATUSES, NON_REVENUE_STATUSES, GATE_THRESHOLD,
)
