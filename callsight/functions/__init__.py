"""Column-expression helpers (all native Spark functions)."""

from . import calendar, scalar, text  # noqa: F401
