"""Market-basket analysis and product recommendation on Spark."""

from basketry.params import MiningParams, OrderFilter, RunWindow
from basketry.workspace import Workspace

__all__ = ["MiningParams", "OrderFilter", "RunWindow", "Workspace"]
