"""gatewarden: authentication-threat analytics as plain Spark DataFrame jobs."""

from gatewarden.functions.clock import Calendar
from gatewarden.sources.warehouse import Warehouse

__all__ = ["Calendar", "Warehouse"]
