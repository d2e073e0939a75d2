"""Names of the four panel columns; every operator takes them as one argument."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class PanelCols:
    """Column names of a panel: entity id, day, counted value, display label."""

    entity: str = "ID_LIEU"
    day: str = "JOUR"
    value: str = "NB_VALD_TOTAL"
    label: str = "LIBELLE_ARRET"


DEFAULT = PanelCols()
