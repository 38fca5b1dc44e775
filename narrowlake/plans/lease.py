"""One writer at a time: an exclusive lease that ends by itself when its holder dies."""

from __future__ import annotations

import json
import threading
import time
from uuid import uuid4

from pyspark.sql import SparkSession

from narrowlake.sinks.store import Store

# Seconds a lease holds without a sign of life.  Clocks of the machines that ask may
# differ by a small part of it.
SECONDS = 300


class LeaseHeld(RuntimeError):
    """Another run holds the lease."""


class LeaseLost(RuntimeError):
    """Another run took the lease over."""


class Lease:
    """Numbered files below a folder; the holder is whoever created the highest one.

    A run takes the lease by creating the next number, which only one can.  The holder
    creates further numbers while it works, each good for ``seconds``; a run that finds the
    highest one expired takes the next.  ``check`` raises once another run has done that, so
    a holder that was only slow stops before it writes.
    """

    def __init__(self, spark: SparkSession, path: str, seconds: float = SECONDS):
        self.seconds, self.owner = seconds, uuid4().hex
        self._store = Store(spark, path)
        self._number = 0
        self._lock, self._end, self._lost = threading.Lock(), threading.Event(), False
        self._beat: threading.Thread | None = None

    def _highest(self) -> tuple[int, dict | None, float]:
        entries = [e for e in self._store.list() if e.name.isdigit()]
        if not entries:
            return 0, None, 0.0
        last = entries[-1]
        try:
            return int(last.name), json.loads(self._store.read(last.name) or ""), last.modified
        except ValueError:  # its writer is at it, or died over it
            return int(last.name), None, last.modified

    def _create(self, number: int, until: float) -> bool:
        text = json.dumps({"owner": self.owner, "until": until})
        return self._store.create(f"{number:012d}", text)

    def __enter__(self) -> Lease:
        number, found, modified = self._highest()
        until = found["until"] if found else modified + self.seconds
        if number and until > time.time():
            raise LeaseHeld(f"{self._store.root} is held by {found['owner'] if found else 'a starting run'}")
        if not self._create(number + 1, time.time() + self.seconds):
            raise LeaseHeld(f"{self._store.root} was taken by another run")
        self._number = number + 1
        self._clear()
        self._beat = threading.Thread(target=self._keep, daemon=True)
        self._beat.start()
        return self

    def _clear(self) -> None:
        for entry in self._store.list():
            if entry.name.isdigit() and int(entry.name) < self._number:
                self._store.delete(entry.name)

    def _keep(self) -> None:
        while not self._end.wait(self.seconds / 3):
            try:
                self.renew()
            except LeaseLost:
                return
            except Exception:  # noqa: BLE001 - a store that does not answer is asked again; check() decides
                continue

    def renew(self) -> None:
        with self._lock:
            if self._end.is_set():
                return
            # Lower numbers are deleted, so that a next one can be created says too little: the
            # own one must be the highest before and after.
            self._lost = self._lost or self._highest()[0] != self._number
            self._lost = self._lost or not self._create(self._number + 1, time.time() + self.seconds)
            self._lost = self._lost or self._highest()[0] != self._number + 1
            if self._lost:
                raise LeaseLost(f"{self._store.root} was taken over")
            self._number += 1
            self._clear()

    def check(self) -> None:
        """Raise unless this run still holds the lease; called before each step that others would see."""
        self.renew()

    def __exit__(self, *error: object) -> None:
        self._end.set()
        with self._lock:
            if not self._lost and self._highest()[0] == self._number:
                self._create(self._number + 1, 0.0)
                self._number += 1
                self._clear()
