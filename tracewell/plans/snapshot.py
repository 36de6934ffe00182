"""What is loaded once and kept for a while: index metadata, the latest audit, settings."""

from __future__ import annotations

import logging
import os
import threading
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, fields
from typing import Any

log = logging.getLogger("tracewell")

PREFIX = "TRACEWELL_"


class Snapshot:
    """A value that is loaded at most once at a time and is good for ttl_ms; callers that come meanwhile wait for it."""

    def __init__(self, load: Callable[[], Any], ttl_ms: int = 300_000, clock: Callable[[], float] = time.monotonic) -> None:
        self._load, self._ttl, self._clock = load, ttl_ms / 1000, clock
        self._lock = threading.Lock()
        self._value: Any = None
        self._at: float | None = None
        self._loads = 0

    def get(self, refresh: bool = False) -> Any:
        before = self._loads
        with self._lock:
            fresh = self._at is not None and self._clock() - self._at < self._ttl
            if fresh and (not refresh or self._loads > before):
                return self._value
            self._value = self._load()  # a failure leaves what was there, and the next caller tries again
            self._at = self._clock()
            self._loads += 1
            return self._value


class Audits:
    """Runs an audit at once and then at an interval, and keeps the latest outcome."""

    def __init__(self, run: Callable[[], dict], interval_ms: int = 900_000) -> None:
        self._run, self._interval = run, interval_ms / 1000
        self._stop = threading.Event()
        self.latest: dict | None = None

    def once(self) -> dict:
        try:
            report = self._run()
            self.latest = {"checked_at": time.time(), "ok": bool(report.get("ok")), "report": report}
        except Exception as e:  # the schedule goes on; the failure is the outcome
            log.exception("audit failed")
            self.latest = {"checked_at": time.time(), "ok": False, "report": {"error": str(e)}}
        log.info("audit ok=%s", self.latest["ok"])
        return self.latest

    def start(self) -> threading.Thread:
        def loop() -> None:
            while not self._stop.is_set():
                self.once()
                self._stop.wait(self._interval)

        thread = threading.Thread(target=loop, daemon=True)
        thread.start()
        return thread

    def stop(self) -> None:
        self._stop.set()


def _number(text: str | None, default: int) -> int:
    """The number that a setting holds; the default for none, zero, or what isn't a number."""
    try:
        return int(float(text or 0)) or default
    except (ValueError, OverflowError):
        return default


@dataclass(frozen=True)
class Settings:
    """Settings of a service, each read from the variable of its upper-case name behind PREFIX."""

    range_service: str
    corpus_root: str = "./corpus"
    port: int = 8080
    audit_interval_ms: int = 900_000
    sample_limit: int = 3

    @classmethod
    def read(cls, env: Mapping[str, str] | None = None) -> Settings:
        """From environment variables; a missing address of the range service is an error that names it.

        A number that is missing, zero or no number has its default.
        """
        env = os.environ if env is None else env
        given = {f.name: env.get(PREFIX + f.name.upper()) for f in fields(cls)}
        if not given["range_service"]:
            raise ValueError(f"missing settings: {PREFIX}RANGE_SERVICE")
        return cls(**{f.name: _number(given[f.name], f.default) if isinstance(f.default, int) else given[f.name] or f.default for f in fields(cls)})
