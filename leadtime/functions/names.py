"""Choosing columns by their names; this looks at the schema only."""

from __future__ import annotations

from collections.abc import Iterable, Sequence


def with_prefix(columns: Iterable[str], prefixes: str | Sequence[str]) -> list[str]:
    wanted = (prefixes,) if isinstance(prefixes, str) else tuple(prefixes)
    return [c for c in columns if c.startswith(wanted)]


def with_mark(columns: Iterable[str], marks: str | Sequence[str]) -> list[str]:
    wanted = (marks,) if isinstance(marks, str) else tuple(marks)
    return [c for c in columns if any(m in c for m in wanted)]


def missing(columns: Iterable[str], required: Iterable[str]) -> list[str]:
    present = set(columns)
    return [c for c in required if c not in present]
