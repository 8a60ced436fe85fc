"""Settings from a file, with explicit overrides on top."""

from __future__ import annotations

from dataclasses import fields, is_dataclass, replace
from pathlib import Path
from typing import Any

from tickloom.plans.train import TrainRequest


def parse_pairs(pairs: list[str], kind: type = str) -> dict[str, Any]:
    """{'key': value} of 'key=value' texts, split at the first '='."""
    out = {}
    for pair in pairs:
        key, found, value = pair.partition("=")
        if not found:
            raise ValueError(f"{pair!r} is not key=value")
        out[key.strip()] = kind(value)
    return out


def parse_span(text: str) -> tuple[int, int]:
    """(first, last) of 'first:last', first < last."""
    first, found, last = text.partition(":")
    if not found or int(first) >= int(last):
        raise ValueError(f"{text!r} is not first:last with first < last")
    return int(first), int(last)


def load_request(path: str) -> TrainRequest:
    import yaml

    spec = yaml.safe_load(Path(path).read_text()) or {}
    known = {f.name for f in fields(TrainRequest)}
    if unknown := spec.keys() - known:
        raise ValueError(f"unknown settings {sorted(unknown)}")
    return TrainRequest(**spec)


def override(base: Any, given: dict[str, Any], defaults: dict[str, Any]) -> Any:
    """base with those given values that differ from their defaults: a default never undoes the file."""
    if not is_dataclass(base):
        raise TypeError("base must be a dataclass instance")
    return replace(base, **{k: v for k, v in given.items() if v != defaults.get(k)})


def merged(base: dict, over: dict) -> dict:
    """Both maps; where both have a key, the second holds."""
    return {**base, **over}
