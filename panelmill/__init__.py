"""Daily panel analytics on Spark: land, enrich, store and analyse one row per (entity, date)."""

from panelmill.schemas import PanelSpec

__all__ = ["PanelSpec"]
