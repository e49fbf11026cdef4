"""A pool of service keys as a small state machine with an injected clock, and calls that retry and rotate. No table holds this state;
a client object of a partition owns one."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from dataclasses import dataclass, field

MINUTE_COOLDOWN, DAY, AFTER_MIDNIGHT, POLL = 65.0, 86_400.0, 60.0, 30.0
ATTEMPTS, FIRST_WAIT, LONGEST_WAIT = 20, 2.0, 60.0


class QuotaExhausted(Exception):
    """All keys are out of their daily quota."""


class NoKey(Exception):
    """No key is left that could ever work."""


class RateLimited(Exception):
    def __init__(self, daily: bool = False) -> None:
        super().__init__("daily quota" if daily else "rate limit")
        self.daily = daily


class InvalidKey(Exception):
    pass


class Transient(Exception):
    pass


def masked(key: str) -> str:
    return "****" + key[-3:]


@dataclass
class KeyState:
    key: str
    until: float = 0.0
    daily: bool = False
    disabled: bool = False
    requests: int = 0
    failures: int = 0


@dataclass
class KeyPool:
    """Keys are used in turn; a limited one rests, an invalid one is out for good."""

    keys: list[str]
    clock: Callable[[], float] = time.time
    sleep: Callable[[float], None] = time.sleep
    log: list[tuple[str, str, str]] = field(default_factory=list)

    def __post_init__(self) -> None:
        if not self.keys:
            raise NoKey("no keys")
        self.states = [KeyState(k) for k in self.keys]
        self.at, self.lock = 0, threading.RLock()

    def _free(self, s: KeyState) -> bool:
        return not s.disabled and s.until <= self.clock()

    def take(self, wait: bool = True) -> str:
        """The current key, or the next free one; waits for the first to come free, or raises if all are out of their daily quota."""
        while True:
            with self.lock:
                order = self.states[self.at :] + self.states[: self.at]
                free = next((s for s in order if self._free(s)), None)
                if free is not None:
                    self.at = self.states.index(free)
                    free.daily, free.requests = False, free.requests + 1
                    return free.key
                live = [s for s in self.states if not s.disabled]
                if not live:
                    raise NoKey("all keys are invalid")
                if not wait and all(s.daily for s in live):
                    raise QuotaExhausted("all keys are out of their daily quota")
                pause = min(POLL, max(0.0, min(s.until for s in live) - self.clock()))
            self.sleep(pause)

    def _rotate(self, key: str, reason: str) -> None:
        old = next(s for s in self.states if s.key == key)
        old.failures += 1
        self.at = (self.states.index(old) + 1) % len(self.states)
        self.log.append((masked(key), masked(self.states[self.at].key), reason))

    def limit(self, key: str, daily: bool = False) -> None:
        """Rest a key: a minute and some, or until a minute after the next midnight (UTC), a day at least. A key that rests already
        isn't limited again: two calls that hit one limit rotate once."""
        with self.lock:
            state, now = next(s for s in self.states if s.key == key), self.clock()
            if state.until > now:
                return
            rest = max(DAY, DAY - now % DAY + AFTER_MIDNIGHT) if daily else MINUTE_COOLDOWN
            state.until, state.daily = now + rest, daily
            self._rotate(key, "daily" if daily else "minute")

    def disable(self, key: str) -> None:
        with self.lock:
            next(s for s in self.states if s.key == key).disabled = True
            self._rotate(key, "invalid")

    def reset(self) -> None:
        """All rests end, as for another model, whose quota is its own."""
        with self.lock:
            for s in self.states:
                s.until, s.daily = 0.0, False

    def stats(self) -> dict[str, dict[str, int]]:
        with self.lock:
            return {masked(s.key): {"requests": s.requests, "failures": s.failures} for s in self.states}

    @property
    def rotations(self) -> int:
        return len(self.log)


def call(pool: KeyPool, send: Callable[[str], str], wait: bool = True, attempts: int = ATTEMPTS) -> str:
    """``send(key)`` until it answers: limited and invalid keys are rotated, passing faults and empty answers waited out, longer each time."""
    pause = FIRST_WAIT
    for _ in range(attempts):
        key = pool.take(wait)
        try:
            answer = send(key)
            if answer.strip():
                return answer
        except RateLimited as limit:
            pool.limit(key, limit.daily)
            continue
        except InvalidKey:
            pool.disable(key)
            continue
        except Transient:
            pass
        pool.sleep(pause)
        pause = min(2 * pause, LONGEST_WAIT)
    raise TimeoutError(f"no answer after {attempts} attempts")


def with_models(models: list[str], pool: KeyPool, send: Callable[[str, str], str]) -> tuple[str, str]:
    """(model, answer): each model until all keys are out of quota, then the next; the last one waits."""
    for k, model in enumerate(models):
        last = k == len(models) - 1
        try:
            return model, call(pool, lambda key, m=model: send(m, key), wait=last)
        except QuotaExhausted:
            pool.reset()
    raise QuotaExhausted("no model left")


@dataclass
class Stage:
    """A step of a run over one law; a ``gate`` that fails ends it, other steps only warn."""

    name: str
    run: Callable[[], bool]
    gate: bool = True


def staged(stages: list[Stage], wanted: set[str] | None = None) -> tuple[str, list[str]]:
    """(status, warnings) of a law: ``fail:<stage>`` at the first gate that fails or breaks, else ok."""
    names = {s.name for s in stages}
    if unknown := (wanted or set()) - names:
        raise ValueError(f"no such stage: {sorted(unknown)}")
    warnings = []
    for stage in stages:
        if wanted and stage.name not in wanted:
            continue
        try:
            good = stage.run()
        except Exception as why:
            if stage.gate:
                return f"fail:{stage.name}", [*warnings, str(why)]
            warnings.append(f"{stage.name}: {why}")
            continue
        if not good and stage.gate:
            return f"fail:{stage.name}", warnings
    return "ok", warnings


def exit_code(status: str) -> int:
    """0 if all went well; 2 for the confidence gate, 3 for the split gate, 1 otherwise."""
    return {"ok": 0, "fail:confidence": 2, "fail:split": 3}.get(status, 1)
