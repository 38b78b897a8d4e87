"""Put the common table expressions a query needs in front of it."""

from __future__ import annotations

import re

from ledgerline.oracle.tables import CTES, OUTPUT

_WORD = re.compile(r"\b[a-z_0-9]+\b")


def _uses(text: str, ctes: dict[str, str]) -> list[str]:
    return [w for w in dict.fromkeys(_WORD.findall(text)) if w in ctes]


def query(select: str, extra: dict[str, str] | None = None) -> str:
    """``select`` with the tables it names defined ahead of it, each after its own inputs."""
    ctes = {**CTES, **(extra or {})}
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in _uses(ctes[name], ctes):
            if needed != name and needed not in ordered:
                visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in _uses(select, ctes):
        visit(name)
    # A table used more than once is worked out once.
    texts = [ctes[n] for n in ordered] + [select]
    shared = {n for n in ordered if sum(len(re.findall(rf"\b{n}\b", t)) for t in texts) > 2}
    # Views named like a model would shadow nothing: the driver's tables have other names.
    body = ",\n".join(f"{n} as {'materialized ' if n in shared else ''}({ctes[n].strip()})" for n in ordered)
    return f"with {body}\n{select.strip()}" if body else select.strip()


def table_query(name: str) -> str:
    casts = [f"{c}::double as {c}" for c in OUTPUT[name].split()]
    replace = f" replace ({', '.join(casts)})" if casts else ""
    return query(f"select *{replace} from {name}")
