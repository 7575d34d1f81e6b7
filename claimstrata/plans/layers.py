"""Names and folders of one deployment's tables."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layers:
    """Tables are `<prefix>_<layer>`; with `root`, stored in `<root>/<layer>`.

    Without `root` they are managed tables in the session's warehouse.
    """

    prefix: str = "claims"
    root: str | None = None

    def table(self, layer: str) -> str:
        return f"{self.prefix}_{layer}"

    def path(self, layer: str) -> str | None:
        return f"{self.root.rstrip('/')}/{layer}" if self.root else None
