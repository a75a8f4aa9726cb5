from panelmill.plans.registry import CURATED, build, ordered

__all__ = ["CURATED", "build", "ordered"]
