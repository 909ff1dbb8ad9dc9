"""Connected components: those of ``strataloom.operators.graph``."""

from __future__ import annotations

from ..operators.graph import connected_components

__all__ = ["connected_components"]
