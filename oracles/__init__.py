"""Independent DuckDB SQL oracles for every report.

``oracle(name)`` returns one self-contained statement: the bridge views and the
upstream reports it needs as CTEs, in dependency order, then ``select * from
name``.
"""

from __future__ import annotations

from oracles.bridge_sql import BRIDGE
from oracles.reports_sql import REPORTS

ALL = {**BRIDGE, **REPORTS}


def _order(name: str, seen: list[str]) -> None:
    if name in seen:
        return
    for dep in ALL[name][1]:
        _order(dep, seen)
    seen.append(name)


def oracle(name: str) -> str:
    order: list[str] = []
    _order(name, order)
    ctes = ",\n".join(f"{n} as (\n{ALL[n][0].strip()}\n)" for n in order)
    return f"with {ctes}\nselect * from {name}"


def with_deps(deps: list[str], body: str) -> str:
    """``body`` preceded by the CTEs of ``deps`` (and theirs); a body that starts
    with its own ``with`` is merged into the same clause."""
    order: list[str] = []
    for d in deps:
        _order(d, order)
    ctes = ",\n".join(f"{n} as (\n{ALL[n][0].strip()}\n)" for n in order)
    body = body.strip()
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"
