"""Small helpers that tests import by name."""

from __future__ import annotations

import datetime as dt


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(f"2024-01-{text}")
