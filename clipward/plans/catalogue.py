"""All registered queries, in survey order."""

from __future__ import annotations

import importlib
import re

from clipward.plans import registry

_MODULES = (
    "drift_queries",
    "model_queries",
    "service_queries",
    "table_queries",
    "clip_queries",
    "training_queries",
)


def _load() -> None:
    for name in _MODULES:
        importlib.import_module(f"clipward.plans.{name}")


def _position(key: str) -> tuple[int, int, str]:
    family, number = re.match(r"([a-z])(\d+)_", key).groups()
    return "svcpjaemfwt".index(family), int(number), key


def queries() -> dict[str, registry.Query]:
    _load()
    return {k: registry.QUERIES[k] for k in sorted(registry.QUERIES, key=_position)}


def oracles() -> dict[str, str]:
    _load()
    return {k: registry.ORACLES[k] for k in sorted(registry.ORACLES, key=_position)}
