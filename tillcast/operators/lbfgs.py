"""Limited-memory BFGS on the driver, for a function whose values and gradients Spark adds up."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

SUFFICIENT, CURVATURE = 1e-4, 0.9
TRIES = 10


class SearchFailed(Exception):
    pass


@dataclass
class _Point:
    """``x + step * direction`` with value, gradient and slope along the direction."""

    step: float
    value: float
    slope: float
    gradient: np.ndarray


def _direction(gradient: np.ndarray, history: deque) -> np.ndarray:
    found = gradient.copy()
    shares = []
    for step, change in reversed(history):
        shares.append(step @ found / (step @ change))
        found -= shares[-1] * change
    if history:
        step, change = history[-1]
        found *= (step @ change) / (change @ change)
    for (step, change), share in zip(history, reversed(shares)):
        found += (share - change @ found / (step @ change)) * step
    return -found


def _between(a: _Point, b: _Point) -> float:
    """Minimum of the cubic through both points, kept off the ends."""
    left, right = (b, a) if a.step > b.step else (a, b)
    width = right.step - left.step
    d = left.slope + right.slope + 3 * (left.value - right.value) / width
    root = np.sqrt(max(d * d - left.slope * right.slope, 0.0))
    step = right.step - width * (right.slope + root - d) / (right.slope - left.slope + 2 * root)
    return min(max(step, left.step + 0.1 * width), left.step + 0.9 * width)


def _zoom(at: Callable[[float], _Point], start: _Point, low: _Point, high: _Point) -> _Point:
    for _ in range(TRIES):
        new = at(_between(low, high))
        if new.value > start.value + SUFFICIENT * new.step * start.slope or new.value >= low.value:
            high = new
            continue
        if abs(new.slope) <= CURVATURE * abs(start.slope):
            return new
        if new.slope * (high.step - low.step) >= 0:
            high = low
        low = new
    raise SearchFailed


def _search(at: Callable[[float], _Point], start: _Point, step: float) -> _Point:
    """A step that keeps the strong Wolfe conditions."""
    if not start.slope <= 0:
        raise SearchFailed
    low = start
    for n in range(TRIES):
        new = at(step)
        if not np.isfinite(new.value):
            step /= 2
            continue
        if new.value > start.value + SUFFICIENT * step * start.slope or (new.value >= low.value and n > 0):
            return _zoom(at, start, low, new)
        if abs(new.slope) <= CURVATURE * abs(start.slope):
            return new
        if new.slope >= 0:
            return _zoom(at, start, new, low)
        low = new
        step *= 1.5
    raise SearchFailed


def minimise(
    function: Callable[[np.ndarray], tuple[float, np.ndarray]],
    x: np.ndarray,
    iterations: int,
    memory: int = 10,
    tolerance: float = 1e-6,
) -> np.ndarray:
    """``function`` gives value and gradient. Ends after ``iterations``, on a flat gradient, when 20
    values differ by less than ``tolerance`` of the first, or when no step is found twice in a row."""
    value, gradient = function(x)
    first = value
    values = deque([np.inf, value], maxlen=20)
    history: deque = deque(maxlen=memory)
    done, failed = 0, False
    while done < iterations:
        if np.linalg.norm(gradient) <= max(tolerance * value, 1e-8):
            break
        if abs(value - max(values)) <= tolerance * abs(first):
            break
        direction = _direction(gradient, history)

        def at(step: float, x=x, direction=direction) -> _Point:
            value, gradient = function(x + step * direction)
            return _Point(step, value, gradient @ direction, gradient)

        start = _Point(0.0, value, gradient @ direction, gradient)
        try:
            found = _search(at, start, 1.0 if done else 1.0 / np.linalg.norm(direction))
            if found.step * np.linalg.norm(gradient) < 1e-10:
                raise SearchFailed
        except SearchFailed:
            if failed:
                break
            failed = True
            history.clear()
            continue
        failed = False
        history.append((found.step * direction, found.gradient - gradient))
        x = x + found.step * direction
        value, gradient = found.value, found.gradient
        values.append(value)
        done += 1
    return x
