"""Equivalent SQL for the registered queries, composed from shared views."""

from __future__ import annotations

import re

from oracle.results import CONTENTS, RESULTS
from oracle.views import VIEWS


def _needed(sql: str, found: dict[str, None]) -> None:
    for name in VIEWS:
        if name not in found and re.search(rf"\b{name}\b", sql):
            _needed(VIEWS[name], found)
            found[name] = None


def compose(key: str) -> str | None:
    """The query for ``key`` with the views it needs as common table expressions, in order of use."""
    if key not in RESULTS:
        return None
    sql, found = RESULTS[key], {}
    _needed(sql, found)
    if not found:
        return sql
    views = ",\n".join(f"{name} AS MATERIALIZED ({VIEWS[name].strip()})" for name in found)
    body = sql.strip()
    return f"WITH {views},\n{body[5:]}" if body.startswith("WITH ") else f"WITH {views}\n{body}"
