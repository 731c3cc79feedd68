"""From raw observations to an imputed panel with features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from paneltide.functions.materialize import cut
from paneltide.operators.features import build_features
from paneltide.operators.fill import fill_linear, fill_spline
from paneltide.operators.gaps import trim_panel
from paneltide.operators.status import cut_at_breaks
from paneltide.spec import PanelSpec


@dataclass(frozen=True)
class Settings:
    break_flag: str = "B"
    threshold: float = 0.2
    method: str = "linear"
    order: int = 3
    curve: str = "through"


def prepare_panel(df: DataFrame, spec: PanelSpec, settings: Settings = Settings()) -> DataFrame:
    """Cut at breaks, trim by missing share, impute what is left, and add features.

    With a declared time range all steps share one shuffle by group.  Without one, steps
    read their input more than once, so the panel is written between them.
    """
    if settings.method not in ("linear", "spline"):
        raise ValueError("method must be 'linear' or 'spline'")
    between = (lambda panel: panel) if spec.bounded else cut
    # Rows without a group would not outlast trimming.
    unbroken = between(cut_at_breaks(df, spec, settings.break_flag, keep_groupless=False, unique=True))
    trimmed = between(trim_panel(unbroken, spec, settings.threshold))
    # Trimming has checked the rows and made the time axis dense.
    known = spec.with_(checked=True)
    if settings.method == "linear":
        filled = fill_linear(trimmed, known)
    else:
        filled = fill_spline(trimmed, known, settings.order, settings.curve)
    return build_features(between(filled), known, keep_groupless=False)
