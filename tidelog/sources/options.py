"""Connection strings and retry delays."""

from __future__ import annotations

import os
import random
import re
import time
from collections.abc import Callable
from typing import TypeVar

from tidelog.errors import LogError

DEFAULTS = {"host": "localhost", "port": "5432", "user": "postgres", "sslmode": "prefer"}
SSLMODES = ("disable", "allow", "prefer", "require", "verify-ca", "verify-full")
_PAIR = re.compile(r"\s*([A-Za-z_]\w*)\s*=\s*(?:'((?:[^'\\]|\\.)*)'|(\S*))\s*")
_URI = re.compile(r"^postgres(?:ql)?://(?:([^:@/]*)(?::([^@/]*))?@)?(\[[^\]]*\]|[^:/?]*)(?::(\d+))?(?:/([^?]*))?(?:\?(.*))?$")
T = TypeVar("T")


def percent_decode(text: str) -> str:
    """%XX becomes the character of that number; anything else stays as it is."""
    return re.sub(r"%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), text)


def parse_connection(text: str) -> dict[str, str]:
    """Settings of a URI or of key=value pairs, with defaults; the password may come from PGPASSWORD."""
    found: dict[str, str] = {}
    if "://" in text:
        m = _URI.match(text)
        if not m:
            raise LogError("config", "not a connection URI")
        user, password, host, port, database, query = m.groups()
        found |= {k: percent_decode(v) for k, v in (("user", user), ("password", password), ("host", (host or "").strip("[]")), ("port", port), ("dbname", database)) if v}
        for part in filter(None, (query or "").split("&")):
            k, _, v = part.partition("=")
            found[percent_decode(k)] = percent_decode(v)
    else:
        at = 0
        while text[at:].strip():
            m = _PAIR.match(text, at)
            if not m or m.end() == at:
                raise LogError("config", f"no key=value at {at}")
            found[m[1]] = re.sub(r"\\(.)", r"\1", m[2]) if m[2] is not None else m[3]
            at = m.end()
    out = DEFAULTS | found
    if "password" not in out and "PGPASSWORD" in os.environ:
        out["password"] = os.environ["PGPASSWORD"]
    out.setdefault("dbname", out["user"])
    if out["sslmode"] not in SSLMODES:
        raise LogError("config", f"sslmode {out['sslmode']}")
    if not out["port"].isdigit() or not 0 < int(out["port"]) < 65536:
        raise LogError("config", f"port {out['port']}")
    return out


def backoff(attempt: int, first: float = 1.0, factor: float = 2.0, most: float = 60.0, jitter: float = 0.3, rng: random.Random | None = None) -> float:
    """Seconds before attempt + 1: exponential up to a cap, 30 % more or less."""
    return min(most, first * factor**attempt) * (1 + jitter * (2 * (rng or random).random() - 1))


def with_retry(act: Callable[[], T], sleep: Callable[[float], None], attempts: int = 5, most: float = 300.0, clock: Callable[[], float] = time.monotonic) -> T:
    """act(), again after errors that are retried, so often and so long (in seconds) at most; the last error is raised."""
    began = clock()
    for k in range(attempts):
        try:
            return act()
        except LogError as e:
            wait = backoff(k)
            if not e.retried or k == attempts - 1 or clock() - began + wait > most:
                raise
            sleep(wait)
    raise LogError("config", "no attempts")
