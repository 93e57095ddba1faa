"""Configuration: JSON with comments, closed field sets, strict types; paths of a book's artefacts."""

from __future__ import annotations

import copy
import json
import re
from collections.abc import Mapping
from dataclasses import dataclass
from pathlib import Path

from vellumine.functions.text import uncommented


class ConfigError(ValueError):
    """The configuration breaks a rule."""


def closed(value: object, allowed: set[str], label: str) -> dict:
    """``value`` as an object without fields outside of ``allowed``."""
    if not isinstance(value, dict):
        raise ConfigError(f"{label} must be an object")
    if extra := sorted(value.keys() - allowed):
        raise ConfigError(f"{label} has unknown fields: {', '.join(extra)}")
    return value


def load(path: str | Path, allowed: set[str]) -> dict:
    """A configuration file; all its sections are objects or plain values of closed names."""
    try:
        value = json.loads(uncommented(Path(path).read_text(encoding="utf-8")))
    except ValueError as e:
        raise ConfigError(f"{path}: {e}") from e
    return closed(value, allowed, str(path))


def strict_flag(config: Mapping, name: str, default: bool = False) -> bool:
    """A boolean and nothing that merely looks like one."""
    value = config.get(name, default)
    if not isinstance(value, bool):
        raise ConfigError(f"{name} must be true or false")
    return value


def number_in(config: Mapping, name: str, low: float, high: float, default: float, whole: bool = True) -> float:
    value = config.get(name, default)
    if isinstance(value, bool) or not isinstance(value, int if whole else int | float) or not low <= value <= high:
        raise ConfigError(f"{name} must be a number from {low} to {high}")
    return value


def merged_rules(defaults: Mapping, given: Mapping) -> dict:
    """Defaults with given values; nested objects are merged one level deep, and no new names may appear."""
    out = copy.deepcopy(dict(defaults))
    for name, value in closed(dict(given), set(defaults), "rules").items():
        out[name] = out[name] | closed(value, set(out[name]), name) if isinstance(out[name], dict) else value
    return out


def project_path(value: str, root: Path, label: str) -> Path:
    """A path inside the project, given relative to it."""
    path = Path(value)
    if path.is_absolute() or not (full := (root / path).resolve()).is_relative_to(root.resolve()):
        raise ConfigError(f"{label} must lie in the project")
    return full


def slug(stem: str) -> str:
    return re.sub("_+", "_", re.sub(r"[^\w.-]+", "_", stem)).strip("._")


@dataclass(frozen=True)
class Artefacts:
    """Where a book's artefacts lie."""

    root: Path
    book: str

    @classmethod
    def of(cls, pdf: str | Path, output: str | Path) -> Artefacts:
        name = slug(Path(pdf).stem)
        if not name:
            raise ConfigError("the file name holds no letter or digit")
        return cls(Path(output), name)

    def folder(self, stage: str) -> Path:
        return self.root / self.book / stage

    def document(self, stage: str, name: str) -> Path:
        return self.folder(stage) / f"{name}.json"

    def page(self, stage: str, page: int, suffix: str = "json") -> Path:
        return self.folder(stage) / "pages" / f"page-{page:03d}.{suffix}"

    def subset(self, stage: str, name: str, label: str | None) -> Path:
        """A document of some pages only carries their label in its name."""
        return self.document(stage, f"{name}-{label}" if label else name)


def read_env(text: str, allowed: set[str], environment: Mapping[str, str]) -> dict[str, str]:
    """Allowed names of a ``.env`` text; what the environment has already stays."""
    out = {}
    for line in text.splitlines():
        name, mark, value = line.strip().removeprefix("export ").partition("=")
        if mark and name.strip() in allowed and name.strip() not in environment and not name.lstrip().startswith("#"):
            out[name.strip()] = value.strip().strip("\"'")
    return out
