"""Texts of replication commands, and which server version takes them. Formats are fixed values."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields

from tidelog.errors import LogError

SNAPSHOTS = {"export": "EXPORT_SNAPSHOT", "nothing": "NOEXPORT_SNAPSHOT", "use": "USE_SNAPSHOT"}


def lsn_text(lsn: int) -> str:
    return f"{lsn >> 32:X}/{lsn & 0xFFFFFFFF:X}"


def lsn_number(text: str) -> int:
    hi, slash, lo = text.partition("/")
    try:
        if not slash or any(c in "+-_ " for c in hi + lo):
            raise ValueError
        return int(hi, 16) << 32 | int(lo, 16)
    except ValueError as e:
        raise LogError("protocol", f"invalid LSN {text!r}") from e


def _quoted(value: str, mark: str, literal: bool) -> str:
    if "\0" in value:
        raise LogError("config", "names and literals can't hold a null byte")
    escape = literal and "\\" in value
    inner = value.replace("\\", "\\\\") if escape else value
    return (" E" if escape else "") + mark + inner.replace(mark, mark * 2) + mark


def ident(name: str) -> str:
    return _quoted(name, '"', False)


def literal(value: str) -> str:
    return _quoted(value, "'", True)


def _options(parts: list[str]) -> str:
    return f" ({', '.join(parts)})" if parts else ""


@dataclass(frozen=True)
class SlotOptions:
    temporary: bool = False
    two_phase: bool = False
    reserve_wal: bool = False
    snapshot: str | None = None
    failover: bool = False


def create_slot(name: str, logical: bool = True, plugin: str | None = "pgoutput", options: SlotOptions = SlotOptions()) -> str:  # noqa: B008
    """Options stand one after the other, but in brackets when failover is asked for."""
    start = f"CREATE_REPLICATION_SLOT {ident(name)}{' TEMPORARY' * options.temporary}"
    if not logical:
        if options.failover:
            raise LogError("config", "failover is only supported for logical replication slots")
        return f"{start} PHYSICAL{' RESERVE_WAL' * options.reserve_wal};"
    if plugin is None:
        raise LogError("protocol", "Output plugin required for LOGICAL slots")
    if options.snapshot is not None and options.snapshot not in SNAPSHOTS:
        raise LogError("config", f"Invalid snapshot option '{options.snapshot}': expected 'export', 'nothing', or 'use'")
    parts = ["TWO_PHASE"] * options.two_phase
    if options.failover:
        if options.temporary:
            raise LogError("config", "failover replication slots cannot be temporary")
        parts += [f"SNAPSHOT '{options.snapshot}'"] if options.snapshot else []
        tail = _options([*parts, "FAILOVER"])
    else:
        parts += [SNAPSHOTS[options.snapshot]] if options.snapshot else []
        tail = "".join(f" {p}" for p in parts)
    return f"{start} LOGICAL {ident(plugin)}{tail};"


def alter_slot(name: str, two_phase: bool | None = None, failover: bool | None = None) -> str:
    given = (("TWO_PHASE", two_phase), ("FAILOVER", failover))
    parts = [f"{k} {str(v).lower()}" for k, v in given if v is not None]
    if not parts:
        raise LogError("protocol", "At least one option must be specified for ALTER_REPLICATION_SLOT")
    return f"ALTER_REPLICATION_SLOT {ident(name)}{_options(parts)};"


def drop_slot(name: str, wait: bool = False) -> str:
    return f"DROP_REPLICATION_SLOT {ident(name)}{' WAIT' * wait};"


def read_slot(name: str) -> str:
    return f"READ_REPLICATION_SLOT {ident(name)};"


def start_logical(slot: str, lsn: int = 0, options: dict[str, str] | None = None) -> str:
    parts = [f"{ident(k)} {literal(v)}" for k, v in (options or {}).items()]
    return f"START_REPLICATION SLOT {ident(slot)} LOGICAL {lsn_text(lsn)}{_options(parts)}"


def start_physical(slot: str | None = None, lsn: int = 0, timeline: int | None = None) -> str:
    if timeline == 0:
        raise LogError("config", "timeline id must be a positive integer")
    named = f"SLOT {ident(slot)} " if slot is not None else ""
    return f"START_REPLICATION {named}PHYSICAL {lsn_text(lsn)}" + (f" TIMELINE {timeline}" if timeline else "")


def create_subscription(name: str, connection: str, publication: str, slot: str, create_slot: bool = True, enabled: bool = True, copy_data: bool = True) -> str:
    flag = lambda b: str(b).lower()
    return (
        f"CREATE SUBSCRIPTION {ident(name)} CONNECTION {literal(connection)} PUBLICATION {ident(publication)} WITH (create_slot = {flag(create_slot)}, "
        f"slot_name = {literal(slot)}, enabled = {flag(enabled)}, copy_data = {flag(copy_data)})"
    )


def disable_subscription(name: str) -> str:
    return f"ALTER SUBSCRIPTION {ident(name)} DISABLE"


def detach_subscription(name: str) -> str:
    return f"ALTER SUBSCRIPTION {ident(name)} SET (slot_name = NONE)"


def drop_subscription(name: str) -> str:
    return f"DROP SUBSCRIPTION {ident(name)}"


#: Feature and the first server version that has it; version 0 is unknown and passes. Fixed values.
NEEDS = {
    "two_phase": (150_000, "TWO_PHASE replication slots"),
    "failover": (170_000, "FAILOVER replication slots"),
    "alter_slot": (170_000, "ALTER_REPLICATION_SLOT"),
    "alter_two_phase": (180_000, "altering TWO_PHASE on a replication slot"),
    "read_slot": (150_000, "READ_REPLICATION_SLOT"),
    "backup_options": (150_000, "BASE_BACKUP with options"),
    "incremental_backup": (170_000, "INCREMENTAL base backup"),
}


def preflight(version: int, *features: str) -> None:
    """Raises for the first feature the server is too old for."""
    for f in features:
        least, what = NEEDS[f]
        if 0 < version < least:
            verb = "require" if what.endswith("slots") else "requires"
            raise LogError("config", f"{what} {verb} PostgreSQL {least // 10000}+, but the server reports {version // 10000}.{version % 10000}")


@dataclass(frozen=True)
class StreamOptions:
    """What a logical stream is asked for; options() checks that the protocol version has it."""

    publications: tuple[str, ...]
    version: int = 2
    streaming: str = "off"
    binary: bool = False
    messages: bool = False
    two_phase: bool = False
    origin: str | None = None

    def options(self) -> dict[str, str]:
        if not 1 <= self.version <= 4:
            raise LogError("config", f"protocol version {self.version} is not 1 to 4")
        least = {"off": 1, "on": 2, "parallel": 4}.get(self.streaming)
        if least is None or self.version < least:
            raise LogError("config", f"streaming {self.streaming} needs protocol version {least}")
        if self.two_phase and self.version < 3:
            raise LogError("config", "two_phase needs protocol version 3")
        if self.origin not in (None, "none", "any"):
            raise LogError("config", f"origin {self.origin} is neither none nor any")
        out = {"proto_version": str(self.version), "publication_names": ",".join(ident(p) for p in self.publications)}
        flags = (("messages", self.messages), ("binary", self.binary), ("two_phase", self.two_phase))
        out |= {k: "on" for k, on in flags if on}
        if self.streaming != "off":
            out["streaming"] = self.streaming
        return out | ({"origin": self.origin} if self.origin else {})


@dataclass(frozen=True)
class BackupOptions:
    """Options of a base backup; they are written in this order."""

    label: str | None = None
    target: str | None = None
    target_detail: str | None = None
    progress: bool = False
    checkpoint: str | None = None
    wal: bool = False
    wait: bool = False
    compression: str | None = None
    compression_detail: str | None = None
    max_rate: int | None = None
    tablespace_map: bool = False
    verify_checksums: bool = False
    manifest: str | None = None
    manifest_checksums: str | None = None
    incremental: bool = False

    def parts(self) -> list[str]:
        given = ((f.name.upper(), getattr(self, f.name)) for f in fields(self))
        written = lambda name, x: (name if name == "INCREMENTAL" else f"{name} true") if x is True else f"{name} {x if isinstance(x, int) else literal(x)}"
        return [written(name, x) for name, x in given if x is not None and x is not False]


def base_backup(options: BackupOptions = BackupOptions()) -> str:  # noqa: B008
    return f"BASE_BACKUP{_options(options.parts())}"


def prepare_create_slot(version: int, name: str, logical: bool = True, plugin: str | None = "pgoutput", options: SlotOptions = SlotOptions()) -> str:  # noqa: B008
    """create_slot(), for a server that is new enough for its options."""
    if logical:
        preflight(version, *[f for f in ("two_phase", "failover") if getattr(options, f)])
    return create_slot(name, logical, plugin, options)


def prepare_alter_slot(version: int, name: str, two_phase: bool | None = None, failover: bool | None = None) -> str:
    preflight(version, "alter_slot", *["alter_two_phase"] * (two_phase is not None))
    return alter_slot(name, two_phase, failover)


def prepare_read_slot(version: int, name: str) -> str:
    preflight(version, "read_slot")
    return read_slot(name)


def prepare_base_backup(version: int, options: BackupOptions = BackupOptions()) -> str:  # noqa: B008
    if options.incremental:
        preflight(version, "incremental_backup")
    if options.parts() and 0 < version < NEEDS["backup_options"][0]:
        said = f"BASE_BACKUP with options uses the PostgreSQL 15+ parenthesized grammar, but the server reports {version // 10000}.{version % 10000}; omit all options or use PostgreSQL 15+"
        raise LogError("config", said)
    return base_backup(options)


def initialise(run: Callable[[str], object], slot: str, options: SlotOptions = SlotOptions(), plugin: str = "pgoutput") -> bool:  # noqa: B008
    """Identifies the system and makes sure that the slot is there; True if it was created now, False if it was there."""
    run("IDENTIFY_SYSTEM")
    try:
        run(create_slot(slot, plugin=plugin, options=options))
    except LogError as e:
        if "already exists" not in str(e):
            raise
        return False
    return True
