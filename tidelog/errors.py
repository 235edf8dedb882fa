"""Error kinds and what a reader does about them."""

from __future__ import annotations

#: Kind and class. Fixed values.
CLASSES = {
    "connection_transient": "transient",
    "timeout": "transient",
    "io": "transient",
    "connection_permanent": "permanent",
    "authentication": "permanent",
    "slot_missing": "permanent",
    "cancelled": "cancelled",
    "stopped": "stopped",
    "protocol": "other",
    "buffer": "other",
    "config": "other",
    "deserialize": "other",
    "backend": "other",
    "replication": "other",
    "generic": "other",
}


class LogError(Exception):
    """An error of one of the kinds above; kinds that are neither permanent, cancelled nor stopped are retried."""

    def __init__(self, kind: str, message: str):
        if kind not in CLASSES:
            raise ValueError(f"no error kind {kind}")
        super().__init__(message)
        self.kind = kind

    @property
    def error_class(self) -> str:
        return CLASSES[self.kind]

    @property
    def retried(self) -> bool:
        return self.error_class in ("transient", "other")
