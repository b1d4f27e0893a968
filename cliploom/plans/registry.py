"""Registered plans by name."""

from __future__ import annotations

from collections.abc import Callable

PLANS: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def plan(sql: str | None = None, name: str | None = None) -> Callable:
    """Register a function of Views under its name, with its SQL."""

    def add(f: Callable) -> Callable:
        key = name or f.__name__
        if key in PLANS:
            raise ValueError(f"two plans are named {key}")
        PLANS[key] = f
        if sql:
            ORACLES[key] = sql
        return f

    return add
