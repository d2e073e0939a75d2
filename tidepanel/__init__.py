"""tidepanel: daily count panels (one row per entity and day) on Spark."""

from tidepanel.columns import PanelCols

__all__ = ["PanelCols"]
