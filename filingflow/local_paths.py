"""Local-path helper for tests and the single-machine CLI."""

from __future__ import annotations


def to_local(path: str) -> str:
    """Strip a ``file:`` scheme so stdlib code can open a local path."""
    for prefix in ("file://", "file:"):
        if path.startswith(prefix):
            return path[len(prefix):]
    return path
