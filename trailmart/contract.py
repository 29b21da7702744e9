"""The versioned contract: boundaries, date policy and thresholds, in one place for every plan."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, fields
from pathlib import Path


@dataclass(frozen=True)
class Contract:
    """Parameters of a build; ``load`` rejects unknown or badly typed keys."""

    version: str = "1"
    lead_time_days: tuple[int, ...] = (0, 7, 30, 90, 180)
    stay_nights: tuple[int, ...] = (1, 3, 7, 14)
    maximum_lead_time_days: int = 730
    maximum_stay_nights: int = 365
    minimum_interactions: int = 100
    strong_interactions: int = 1000
    maximum_quarantine_rate: float = 0.001
    maximum_multimarket_rate: float = 0.25
    minimum_rows: dict[str, int] = field(default_factory=dict)

    @classmethod
    def load(cls, path: str | Path) -> Contract:
        given = json.loads(Path(path).read_text(encoding="utf-8-sig"))
        unknown = set(given) - {f.name for f in fields(cls)}
        if unknown:
            raise ValueError(f"unknown contract keys: {sorted(unknown)}")
        for key in ("lead_time_days", "stay_nights"):
            if key in given:
                given[key] = tuple(given[key])
                if list(given[key]) != sorted(given[key]):
                    raise ValueError(f"{key} must ascend")
        return cls(**given)

    def to_json(self) -> str:
        return json.dumps(asdict(self), indent=2, sort_keys=True)


DEFAULT = Contract()
