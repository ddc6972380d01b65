"""What a Python worker keeps from task to task: one thing at a time.

Workers live on after a query. What one operator keeps (ids of parts, margins of
words) is dropped as soon as another operator runs in the same worker.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable

_KEPT: dict[Hashable, object] = {}


def kept(key: Hashable, make: Callable[[], object]):
    """What ``make`` gave for this key, while nothing else was kept since."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def release() -> None:
    _KEPT.clear()
