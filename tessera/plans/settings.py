"""Settings: arguments over environment over file over defaults, with checked ranges. Driver side only."""

from __future__ import annotations

import os
import tomllib
from collections.abc import Mapping
from dataclasses import dataclass, fields
from pathlib import Path

PREFIX = "TESSERA_"
# Settings that are shares, and whether 0 is one of theirs.
SHARES = {"match_min": False, "target": False, "face_min": True, "head_min": True, "special_iou": True, "dedup_min": True, "min_conf": True}


@dataclass(frozen=True)
class Settings:
    """Thresholds and sizes of the pipelines."""

    match_min: float = 0.8
    target: float = 0.85
    face_min: float = 0.60
    head_min: float = 0.55
    special_iou: float = 0.85
    dedup_min: float = 0.9
    min_conf: float = 0.8
    coarse_step: int = 5
    size: int = 180
    limit: int | None = None

    def __post_init__(self):
        for name, zero in SHARES.items():
            v = getattr(self, name)
            if not (0 <= v <= 1 if zero else 0 < v <= 1):
                raise ValueError(f"{name} must lie in {'[' if zero else '('}0, 1], not {v}")
        if self.coarse_step < 2:
            raise ValueError(f"coarse_step must be 2 at least, not {self.coarse_step}")
        if self.size < 1 or self.limit is not None and self.limit < 1:
            raise ValueError("size and limit must be positive")


def load(arguments: Mapping | None = None, environment: Mapping[str, str] | None = None, path: str | None = None) -> Settings:
    """The settings in effect; a missing file is no error, a key that does not exist is."""
    environment = os.environ if environment is None else environment
    kinds = {f.name: float if isinstance(f.default, float) else int for f in fields(Settings)}
    found: dict = {}
    if path and Path(path).exists():
        with open(path, "rb") as f:
            found |= tomllib.load(f).get("tessera", {})
    found |= {n: environment[PREFIX + n.upper()] for n in kinds if environment.get(PREFIX + n.upper())}
    found |= {k: v for k, v in (arguments or {}).items() if v is not None}
    if unknown := set(found) - set(kinds):
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    try:
        return Settings(**{k: kinds[k](v) for k, v in found.items()})
    except (TypeError, ValueError) as e:
        raise ValueError(f"bad settings: {e}") from None
