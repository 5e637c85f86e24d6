"""Settings: defaults, below a file, below the environment, below what is given; and their checks."""

from __future__ import annotations

import json
import os
from typing import Any

# Fixed value: what variables of the environment begin with.
PREFIX = "DOC_ACCESS_"


def merged(low: dict[str, Any], high: dict[str, Any]) -> dict[str, Any]:
    """high over low, section by section."""
    out = dict(low)
    for k, v in high.items():
        out[k] = merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def from_file(path: str) -> dict[str, Any]:
    """A JSON file, or a YAML one where a parser for it is installed."""
    with open(path, encoding="utf-8") as f:
        if path.endswith((".yaml", ".yml")):
            try:
                import yaml
            except ImportError as e:
                raise ValueError(f"{path}: no YAML parser is installed; use JSON") from e
            return yaml.safe_load(f) or {}
        return json.load(f)


def _value(text: str) -> Any:
    """true, false, null, numbers and JSON as such; all else as text."""
    try:
        return json.loads(text)
    except ValueError:
        return text


def from_environment(environment: dict[str, str] | None = None) -> dict[str, Any]:
    """PREFIX and a name, two underscores between a section and its parts."""
    out: dict[str, Any] = {}
    for name, text in sorted((os.environ if environment is None else environment).items()):
        if name.startswith(PREFIX):
            *sections, last = name.removeprefix(PREFIX).lower().split("__")
            at = out
            for s in sections:
                at = at.setdefault(s, {})
            at[last] = _value(text)
    return out


def settings(defaults: dict[str, Any], path: str | None = None, given: dict[str, Any] | None = None) -> dict[str, Any]:
    return merged(merged(merged(defaults, from_file(path) if path else {}), from_environment()), given or {})


def problems(options: dict[str, Any], required: dict[str, type], optional: dict[str, type]) -> list[str]:
    """What is wrong with options: required ones that are missing, and values of a wrong type."""
    wrong = [f"{k}: must be {t.__name__}, is {type(options[k]).__name__}" for k, t in (required | optional).items() if k in options and not isinstance(options[k], t)]
    return wrong + [f"{k}: is missing" for k in required if k not in options]
