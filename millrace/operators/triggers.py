"""When a window gives out a pane: trigger descriptions and the rule that applies them.

The rule is one small state machine per key and window. It is used by the batch replay
(:mod:`millrace.operators.panes`) and by the streaming processor, so both fire alike.
Times are integers in one unit, microseconds everywhere in this package.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Any

EARLY, ON_TIME, LATE = "EARLY", "ON_TIME", "LATE"
NO_WATERMARK = -(1 << 62)
END_OF_TIME = 1 << 62


@dataclass(frozen=True)
class AfterCount:
    """The pane holds at least ``n`` elements."""

    n: int


@dataclass(frozen=True)
class AfterDelay:
    """Processing time is past the pane's first element by more than ``delay``."""

    delay: int


@dataclass(frozen=True)
class PastEnd:
    """The watermark has reached the end of the window."""


@dataclass(frozen=True)
class AfterFirst:
    """Any of the parts."""

    parts: tuple


@dataclass(frozen=True)
class AfterEach:
    """The parts one after the other, one per pane, then again from the first."""

    parts: tuple


@dataclass(frozen=True)
class Trigger:
    """``early`` fires until the watermark part (if ``on_time``) has fired, ``late`` after it."""

    early: Any = None
    on_time: bool = True
    late: Any = None
    repeat: bool = True


def after_watermark(early: Any = None, late: Any = None) -> Trigger:
    return Trigger(early, True, late)


def default_trigger() -> Trigger:
    """On time at the end of the window, then with every late arrival."""
    return Trigger(None, True, AfterCount(1))


def repeatedly(condition: Any) -> Trigger:
    return Trigger(condition, False, None)


def or_finally(condition: Any, late: Any = AfterCount(1)) -> Trigger:
    """Repeats ``condition`` until the end of the window, then fires late elements by ``late``."""
    return Trigger(condition, True, late)


def once(trigger: Trigger) -> Trigger:
    """Finishes after the first pane; the rest of the window is dropped."""
    return replace(trigger, repeat=False)


@dataclass
class Pane:
    index: int
    timing: str
    items: list


@dataclass
class WindowState:
    """What a key and window remembers between two firings."""

    items: list = field(default_factory=list)
    count: int = 0
    first: int = 0
    timely: bool = False
    step: int = 0
    passed: bool = False
    on_time_seen: bool = False
    index: int = 0
    closed: bool = False


class WindowFold:
    """Applies a trigger to one key and window; every call returns the panes it fired."""

    def __init__(self, trigger: Trigger, end: int, lateness: int, state: WindowState | None = None):
        self.trigger, self.end, self.lateness = trigger, end, lateness
        self.state = state or WindowState()
        self.now, self.watermark = 0, NO_WATERMARK

    def add(self, item: Any, count: int = 1) -> list[Pane]:
        """``count`` elements that arrive together; dropped when the window is over."""
        state = self.state
        if state.closed or self.watermark > self.end + self.lateness:
            return []
        if state.count == 0:
            state.first = self.now
        state.items.append(item)
        state.count += count
        state.timely = state.timely or self.watermark < self.end
        return self._settle()

    def advance_clock(self, now: int) -> list[Pane]:
        self.now = max(self.now, now)
        return self._settle()

    def advance_watermark(self, watermark: int) -> list[Pane]:
        self.watermark = max(self.watermark, watermark)
        return self._settle()

    def next_timer(self) -> int | None:
        """Processing time after which a pane is due, when a delay is being waited for."""
        if self.state.closed or not self.state.count:
            return None
        delay = self._delay(self._active())
        return None if delay is None else self.state.first + delay

    def _active(self) -> Any:
        return self.trigger.late if self.state.passed else self.trigger.early

    def _delay(self, condition: Any) -> int | None:
        if isinstance(condition, AfterDelay):
            return condition.delay
        if isinstance(condition, AfterFirst):
            delays = [d for d in map(self._delay, condition.parts) if d is not None]
            return min(delays) if delays else None
        if isinstance(condition, AfterEach):
            return self._delay(condition.parts[self.state.step % len(condition.parts)])
        return None

    def _ready(self, condition: Any) -> bool:
        if isinstance(condition, AfterCount):
            return self.state.count >= condition.n
        if isinstance(condition, AfterDelay):
            return self.now > self.state.first + condition.delay
        if isinstance(condition, PastEnd):
            return self.watermark >= self.end
        if isinstance(condition, AfterFirst):
            return any(self._ready(part) for part in condition.parts)
        if isinstance(condition, AfterEach):
            return self._ready(condition.parts[self.state.step % len(condition.parts)])
        return False

    def _settle(self) -> list[Pane]:
        state, fired = self.state, []
        while not state.closed:
            if self.watermark > self.end + self.lateness:
                fired += self._fire()
                state.closed = True
                break
            if self.trigger.on_time and not state.passed and self.watermark >= self.end:
                state.passed, state.step = True, 0
                fired += self._fire()
                if self.trigger.late is None:
                    self._finish()
                continue
            if not state.count or not self._ready(self._active()):
                break
            fired += self._fire()
            state.step += 1
        return fired

    def _fire(self) -> list[Pane]:
        state = self.state
        if not state.count:
            return []
        if self.watermark < self.end:
            timing = EARLY
        else:
            timing = ON_TIME if state.timely and not state.on_time_seen else LATE
            state.on_time_seen = True
        pane = Pane(state.index, timing, state.items)
        state.index += 1
        state.items, state.count, state.timely = [], 0, False
        if not self.trigger.repeat:
            self._finish()
        return [pane]

    def _finish(self) -> None:
        self.state.closed = True
        self.state.items, self.state.count = [], 0
