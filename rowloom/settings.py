"""Settings of a run, from the environment."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Settings:
    """Every field can be set by ``ROWLOOM_<NAME>``."""

    provider: str = "hashing"
    model: str = "demo"
    state_dir: str = "state"
    min_text: int = 40
    window_start: str = "22:00"
    window_end: str = "07:30"
    zone: str = "Europe/Madrid"

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None) -> Settings:
        env = dict(os.environ) if env is None else env
        found = {}
        for f in fields(cls):
            value = env.get(f"ROWLOOM_{f.name.upper()}")
            if value is not None:
                found[f.name] = type(f.default)(value)
        return cls(**found)
