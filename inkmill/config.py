"""Settings: session configuration first, then the environment, then a .env file, then defaults."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any

PREFIX = "INKMILL_"


@dataclass(frozen=True)
class Speech:
    backend: str = "vieneu"
    speaker_id: str = "VN-01"
    speed: float = 1.0
    sample_rate: int = 22050
    max_chars: int = 400
    model_dir: str = "models/vieneu"
    device: str = "auto"


@dataclass(frozen=True)
class Audio:
    bitrate: str = "64k"
    sample_rate: int = 22050
    chapter_gap_sec: float = 0.6
    cover_width: int = 1400
    cover_height: int = 2100


@dataclass(frozen=True)
class Translate:
    mode: str = "off"
    command: str = ""
    url: str = ""
    model: str = ""
    batch_chars: int = 3000
    timeout_sec: int = 120


@dataclass(frozen=True)
class Config:
    speech: Speech = field(default_factory=Speech)
    audio: Audio = field(default_factory=Audio)
    translate: Translate = field(default_factory=Translate)


def read_env_file(path: str | Path) -> dict[str, str]:
    """KEY=value lines; blank ones, comments and quotes around values are left out. No file, no values."""
    try:
        rows = Path(path).read_text(encoding="utf-8").splitlines()
    except OSError:
        return {}
    pairs = (row.strip().partition("=") for row in rows if "=" in row and not row.lstrip().startswith("#"))
    return {key.strip(): value.strip().strip("'\"") for key, _, value in pairs}


def _typed(raw: str, default: Any) -> Any:
    """The text in the default's type; the default where it doesn't read as one."""
    try:
        return type(default)(raw)
    except ValueError:
        return default


def load(spark=None, env_file: str | Path = ".env") -> Config:
    """Each setting by its name: inkmill.translate.mode in the session, INKMILL_TRANSLATE_MODE outside it."""
    from_file = read_env_file(env_file)

    def group(name: str, kind: type):
        found = {}
        for f in fields(kind):
            key = f"{PREFIX}{name}_{f.name}".upper()
            raw = spark.conf.get(f"inkmill.{name}.{f.name}", None) if spark is not None else None
            raw = raw or os.environ.get(key) or from_file.get(key)
            if raw:
                found[f.name] = _typed(raw, f.default)
        return kind(**found)

    return Config(group("speech", Speech), group("audio", Audio), group("translate", Translate))


def resolve(path: str | Path, root: str | Path = ".") -> Path:
    """Absolute paths as they are, others under the root."""
    return Path(root).resolve() / path
