"""Imports every query module, which fills the registry."""

from orderloom.queries import accounts, costs, daily, dashboard, expectations, layouts, orders, quality, sources, writes
from orderloom.queries.registry import ENTRIES

__all__ = ["ENTRIES", "accounts", "costs", "daily", "dashboard", "expectations", "layouts", "orders", "quality", "sources", "writes"]
