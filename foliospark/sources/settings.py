"""Settings of the external services, from the environment and a ``.env`` file."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from functools import lru_cache
from pathlib import Path


@dataclass(frozen=True)
class Settings:
    google_api_key: str | None = field(default=None, repr=False)
    gemini_api_key: str | None = field(default=None, repr=False)
    model: str = "gemini-2.5-flash"
    timeout_seconds: int = 15

    @property
    def api_key(self) -> str:
        """The first key that is set; never part of the printed form."""
        key = self.google_api_key or self.gemini_api_key
        if not key:
            raise ValueError("no API key: set GOOGLE_API_KEY or GEMINI_API_KEY")
        return key


def _env_file(path: Path) -> dict[str, str]:
    if not path.exists():
        return {}
    rows = (line.strip() for line in path.read_text(encoding="utf-8").splitlines())
    pairs = (row.split("=", 1) for row in rows if row and not row.startswith("#") and "=" in row)
    return {k.strip(): v.strip().strip("'\"") for k, v in pairs}


def load_settings(env_file: str = ".env") -> Settings:
    values = _env_file(Path(env_file)) | {k: v for k, v in os.environ.items() if v}
    return Settings(
        values.get("GOOGLE_API_KEY"), values.get("GEMINI_API_KEY"), values.get("GEMINI_MODEL", Settings.model),
        int(values.get("REQUEST_TIMEOUT_SECONDS", Settings.timeout_seconds))
    )


@lru_cache(maxsize=1)
def settings() -> Settings:
    """The settings, read once."""
    return load_settings()
