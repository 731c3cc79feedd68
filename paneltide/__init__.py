"""Panel-data operators for Spark: many time series keyed by group and integer period."""

from paneltide.spec import PanelSpec

__all__ = ["PanelSpec"]
