"""Settings from YAML with ${VAR:-default} interpolation, and the project's folders."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field
from pathlib import Path

_VAR = re.compile(r"\$\{([A-Za-z_][A-Za-z0-9_]*)(?::-([^}]*))?\}")


def interpolate(value):
    """value with variables of the environment filled in, in strings at any depth; unknown ones become their default or ""."""
    if isinstance(value, str):
        return _VAR.sub(lambda m: os.environ.get(m[1]) or m[2] or "", value)
    if isinstance(value, dict):
        return {k: interpolate(v) for k, v in value.items()}
    if isinstance(value, list):
        return [interpolate(v) for v in value]
    return value


def load(path: str) -> dict:
    import yaml

    with open(path) as f:
        return interpolate(yaml.safe_load(f) or {})


def find_root(start: str | None = None, marks: tuple[str, ...] = (".git", "config")) -> Path:
    """The nearest folder above start that holds one of the marks."""
    here = Path(start or os.getcwd()).resolve()
    for p in (here, *here.parents):
        if any((p / m).exists() for m in marks):
            return p
    return here


@dataclass
class Paths:
    root: Path
    data: Path = field(init=False)
    external: Path = field(init=False)
    processed: Path = field(init=False)
    results: Path = field(init=False)

    def __post_init__(self):
        self.data, self.results = self.root / "data", self.root / "results"
        self.external, self.processed = self.data / "external", self.data / "processed"

    @classmethod
    def from_settings(cls, settings: dict, root: str | None = None) -> "Paths":
        paths = cls(find_root(root))
        for name, value in (settings.get("paths") or {}).items():
            if hasattr(paths, name):
                setattr(paths, name, Path(value) if os.path.isabs(value) else paths.root / value)
        return paths
