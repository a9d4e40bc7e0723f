"""What a Python worker keeps between tasks: loaded models, and what distinct words encode to."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import Any

_owner: str | None = None
_held: dict[Any, Any] = {}


def enter(owner: str) -> None:
    """Called by an operator's tasks before their first row: drops all that another operator kept in this worker.

    A worker serves the stages of a pipeline one after another. An operator that keeps
    nothing calls this too, so that its rows need not share the room with old models.
    """
    global _owner
    if owner != _owner:
        _held.clear()
        _owner = owner


def held(owner: str, key: Any, make: Callable[[], Any]) -> Any:
    """The value that ``owner`` keeps under ``key`` in this worker, made on first use.

    When another owner asks, all that the last one kept is dropped first, so a worker
    never holds the models and memories of two operators.
    """
    enter(owner)
    if key not in _held:
        _held[key] = make()
    return _held[key]


class WordMemo(dict):
    """Word -> bytes, computed once per distinct word and worker, within a fixed number of entries.

    The first ``keep`` words stay for the worker's life: frequent words are among
    them. Later words go to a second map that is emptied when it is full, so
    memory does not grow with the input. ``compute`` gets a list of new words and
    returns their values in order. Words longer than ``longest`` characters are
    never kept beyond the batch that holds them.
    """

    def __init__(
        self,
        compute: Callable[[list[str]], Iterable[bytes]],
        keep: int = 300_000,
        recent: int = 100_000,
        longest: int = 48,
    ):
        super().__init__()
        self.compute, self.keep, self.limit, self.longest = compute, keep, recent, longest
        self.recent: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        return self.recent[word]

    def learn(self, words: Iterable[str]) -> None:
        """After this every one of ``words`` can be looked up, until the next call."""
        self._learn([w for w in words if w not in self])

    def _learn(self, unknown: list[str]) -> list[bytes]:
        """The values of words that do not stay so far, each named once."""
        if len(self.recent) > self.limit:
            self.recent.clear()
        found = list(map(self.recent.get, unknown))
        new = [w for w, value in zip(unknown, found, strict=True) if value is None]
        values = list(self.compute(new))
        room = max(self.keep - len(self), 0)
        if room:
            stay = [len(w) <= self.longest for w in new[:room]]
            self.update(pair for pair, short in zip(zip(new, values, strict=True), stay, strict=False) if short)
            self.recent.update(pair for pair, short in zip(zip(new, values, strict=True), stay, strict=False) if not short)
        self.recent.update(zip(new[room:], values[room:], strict=True))
        fresh = iter(values)
        return [next(fresh) if value is None else value for value in found]

    def values_of(self, words: list[str]) -> list[bytes]:
        """The value of each of ``words``, which are distinct; those that stay are looked up once."""
        found = list(map(self.get, words))
        unknown = iter(self._learn([w for w, value in zip(words, found, strict=True) if value is None]))
        return [next(unknown) if value is None else value for value in found]

    def joined(self, split_texts: list[list[str]]) -> list[bytes]:
        """For each list of words the values of its words, one after another."""
        self.learn(set().union(*split_texts))
        get = self.__getitem__
        return [b"".join(map(get, words)) for words in split_texts]
