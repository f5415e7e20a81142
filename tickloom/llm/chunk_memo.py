"""What a task remembers of the parts of texts that come again and again."""

from __future__ import annotations

from collections.abc import Callable


class ChunkMemo:
    """Values of strings, made many at a time; two generations, so that what is still in use outlasts a full memo."""

    def __init__(self, make: Callable[[list[str]], list], limit: int):
        self.make, self.limit = make, limit
        self.young: dict[str, object] = {}
        self.old: dict[str, object] = {}

    def known(self, wanted: set[str]) -> dict[str, object]:
        """A mapping that holds all of wanted."""
        fresh = wanted - self.young.keys()
        if len(self.young) + len(fresh) > self.limit:
            self.old, self.young, fresh = self.young, {}, wanted
        if fresh:
            again = fresh & self.old.keys()
            self.young.update((c, self.old[c]) for c in again)
            unknown = list(fresh - again)
            self.young.update(zip(unknown, self.make(unknown), strict=True))
        return self.young
