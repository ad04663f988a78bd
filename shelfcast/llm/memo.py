"""Values remembered by one Python worker, in bounded memory."""

from __future__ import annotations

from collections.abc import Callable


class Memo(dict):
    """``memo[key]`` is ``solve(key)``, remembered for the keys in recent use.

    Two generations of half the size: a full one becomes the old one, and keys that are met
    again move out of it, so frequent keys stay.
    """

    def __init__(self, solve: Callable, size: int):
        super().__init__()
        self.solve, self.half, self.old = solve, max(1, size // 2), {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.solve(key)
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value
