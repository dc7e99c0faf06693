"""Endpoints from the environment, with defaults for one machine."""

from __future__ import annotations

import os

# Variable names and defaults.
DEFAULTS = {
    "KAFKA_BOOTSTRAP_SERVERS": "localhost:9092",
    "REDIS_HOST": "redis",
    "ES_HOST": "elasticsearch",
}


def endpoint(name: str, default: str | None = None) -> str:
    """The variable's value, else ``default``, else the built-in default."""
    value = os.environ.get(name)
    if value is not None:
        return value
    return default if default is not None else DEFAULTS[name]
