"""Per-worker cache of what a tokenizer makes of one word.

Tokenizers work word by word, and most occurrences are of words seen before.
The cache is bounded: beyond ``limit`` entries it starts afresh after a slice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

#: Entries that a worker's cache may hold, and the longest word that enters it; about 60 MB at most.
LIMIT, LONGEST = 250_000, 256


class WordCache:
    def __init__(self, compute: Callable[[list[str]], list], limit: int = LIMIT):
        self.compute, self.limit, self.known = compute, limit, {}

    def table(self, lists: Iterable[list[str]]) -> dict:
        """word -> value for (at least) all words of the lists."""
        if len(self.known) > self.limit:
            self.known = {}
        todo = list(set().union(*lists).difference(self.known))
        values = self.compute(todo)
        if max(map(len, todo), default=0) <= LONGEST:
            self.known.update(zip(todo, values))
            return self.known
        found = dict(zip(todo, values))
        self.known.update((w, v) for w, v in found.items() if len(w) <= LONGEST)
        return {**self.known, **found}
