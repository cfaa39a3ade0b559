"""Progress of a run: a line at even intervals with the phase, how far it is and how long it has taken."""

from __future__ import annotations

import datetime
import threading
import time

LEAST_S, MOST_S = 0.25, 10.0


class Heartbeat:
    """Writes lines from a thread of its own until it is left. Periods are kept between a quarter of a second and ten."""

    def __init__(self, write, phase: str = "", period_s: float = 2.0):
        self.write, self.phase, self.period = write, phase.strip() or "Starting", min(MOST_S, max(LEAST_S, period_s))
        self.current = self.total = None
        self.since = time.monotonic()
        self._lock, self._ended = threading.Lock(), threading.Event()
        self._thread = threading.Thread(target=self._run, daemon=True)

    def report(self, phase: str, current: int | None = None, total: int | None = None) -> None:
        """A new phase begins its time anew; a blank one only moves the numbers."""
        with self._lock:
            if phase.strip() and phase != self.phase:
                self.phase, self.since = phase, time.monotonic()
            self.current, self.total = current, total

    def line(self) -> str:
        with self._lock:
            known = self.current is not None and self.total is not None
            share = f"{round(100 * self.current / self.total):3d}%" if known and self.total > 0 else "   -"
            passed = datetime.timedelta(seconds=int(time.monotonic() - self.since))
            return f"[HB {datetime.datetime.now():%H:%M:%S}] {self.phase}{f' [{self.current}/{self.total}]' if known else ''} ({share}), elapsed {str(passed).rjust(8, '0')}"

    def _run(self) -> None:
        while not self._ended.is_set():
            try:
                self.write(self.line())
            except OSError:  # nobody reads any more
                pass
            self._ended.wait(self.period)

    def __enter__(self):
        self._thread.start()
        return self

    def __exit__(self, *_):
        self._ended.set()
        self._thread.join()
