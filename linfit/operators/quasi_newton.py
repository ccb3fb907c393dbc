"""Limited-memory quasi-Newton steps for many fits that share passes over the data.

The driver holds each fit's parameters and a short history, that of wide fits in unnamed temporary
files; one call of ``evaluate`` is one job in
which the trial points of all fits that have not stopped are measured together.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np

from linfit.operators.errors import DivergedError

#: Pairs of steps and gradient changes that a fit remembers.
MEMORY = 10
#: Share of the promised decrease that a step must bring.
ARMIJO = 1e-4
#: Steps tried together, after the last one was too long, as parts of it.
SHORTER = (0.5, 0.125, 0.03125, 0.0078125)
#: Times that shorter steps are tried before a fit is taken to be at its optimum.
ATTEMPTS = 4

#: Bytes from which on a remembered vector is kept in a file.
FILED_BYTES = 1 << 23

Measured = tuple[float, np.ndarray]
Evaluate = Callable[[dict[int, list[np.ndarray]]], dict[int, list[Measured]]]


class Kept:
    """A vector of the history, in memory or in a file that goes with this object."""

    def __init__(self, vector: np.ndarray):
        self.vector, self.file = vector, None
        if vector.nbytes >= FILED_BYTES:
            self.vector, self.file = None, tempfile.TemporaryFile()
            vector.tofile(self.file)

    def read(self) -> np.ndarray:
        if self.file is None:
            return self.vector
        self.file.seek(0)
        return np.fromfile(self.file)


@dataclass
class Descent:
    """One fit: where it is, the points it wants measured, and whether it has stopped."""

    point: np.ndarray
    losses: list[float] = field(default_factory=list)
    gradient: np.ndarray | None = None
    steps: list[Kept] = field(default_factory=list)
    changes: list[Kept] = field(default_factory=list)
    trials: list[float] = field(default_factory=list)
    direction: np.ndarray | None = None
    attempts: int = 0
    stopped: bool = False

    def wanted(self) -> list[np.ndarray]:
        if self.gradient is None:
            return [self.point]
        return [self.point + t * self.direction for t in self.trials]

    def _aim(self) -> None:
        """The two-loop recursion: minus the gradient, scaled by the curvature that was seen."""
        q = self.gradient.copy()
        shares = []
        for kept in zip(reversed(self.steps), reversed(self.changes), strict=True):
            s, y = (v.read() for v in kept)
            a = (s @ q) / (s @ y)
            q -= a * y
            shares.append(a)
        if self.steps:
            s, y = self.steps[-1].read(), self.changes[-1].read()
            q *= (s @ y) / (y @ y)
        for *kept, a in zip(self.steps, self.changes, reversed(shares), strict=True):
            s, y = (v.read() for v in kept)
            q += (a - (y @ q) / (s @ y)) * s
        self.direction, self.attempts = -q, 0
        if self.direction @ self.gradient >= 0:  # the history misleads
            self.steps, self.changes, self.direction = [], [], -self.gradient
        norm = float(np.linalg.norm(self.gradient))
        self.trials = [1.0 if self.steps else min(1.0, 1.0 / norm)]

    def take(self, measured: list[Measured], max_iter: int, tol: float) -> None:
        if self.gradient is None:
            loss, self.gradient = measured[0]
            if not np.isfinite(loss):
                raise DivergedError(f"loss is {loss} at the start")
            self.losses = [loss]
        else:
            slope = float(self.direction @ self.gradient)
            for t, (loss, gradient) in zip(self.trials, measured, strict=True):
                if np.isfinite(loss) and loss <= self.losses[-1] + ARMIJO * t * slope:
                    break
            else:
                self.attempts += 1
                self.stopped = self.attempts > ATTEMPTS
                self.trials = [self.trials[-1] * part for part in SHORTER]
                return
            step, change = t * self.direction, gradient - self.gradient
            if step @ change > 1e-12 * np.linalg.norm(step) * np.linalg.norm(change):
                self.steps = [*self.steps[1 - MEMORY :], Kept(step)]
                self.changes = [*self.changes[1 - MEMORY :], Kept(change)]
            self.point, self.gradient = self.point + step, gradient
            self.losses.append(loss)
            gain = self.losses[-2] - loss
            self.stopped = gain <= tol * max(abs(loss), abs(self.losses[-2]), 1e-300)
        if len(self.losses) > max_iter or not np.any(self.gradient):
            self.stopped = True
        if not self.stopped:
            self._aim()


def descend(
    starts: Sequence[np.ndarray], evaluate: Evaluate, max_iter: int = 100, tol: float = 1e-6
) -> list[Descent]:
    """Minimise every objective from its start; ``losses`` has one entry per step and the start.

    A fit stops after ``max_iter`` steps, once a step gains at most ``tol`` of its loss, or when no
    shorter step gains anything.
    """
    fits = [Descent(np.asarray(x, float)) for x in starts]
    while active := {i: f for i, f in enumerate(fits) if not f.stopped}:
        measured = evaluate({i: f.wanted() for i, f in active.items()})
        for i, fit in active.items():
            fit.take(measured[i], max_iter, tol)
    return fits
