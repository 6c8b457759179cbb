"""Suffix and common-prefix order of one shard by external induced sorting.

The shard is a row of byte segments, each closed by a separator that equals no other. The S* suffixes
(smaller than the next one, after a larger one) are sorted first, then the L suffixes follow from scanning
them in order, and the S suffixes from scanning the L ones backwards. A scanned suffix hands its
predecessor to the queue of the predecessor's first byte. These queues, one per byte, together are a priority queue:
within a byte the order of arrival is the order of suffixes. A queue holds tuples (position, length of the
prefix shared with the tuple before it); beyond a stated amount they go to a scratch file of the task.

Shared prefixes are induced with the tuples: two neighbours in a queue share one byte more than the least prefix
shared between the scanned suffixes that sent them. They count up to a stated length, in a byte each if it is 255 at
most, else in four.

The S* suffixes are sorted by a recursion of its kind: S* substrings by one induction without prefixes, which
gives names; the string of names, whose alphabet is too large for a queue each, by doubling.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

CAP = 255  # what a prefix length counts to unless a shard asks for less or more
BLOCK = 1 << 16
HELD = 1 << 20  # tuples of all queues in memory before they go to the file; fewer than a shard has


def _counter(cap: int) -> np.dtype:
    """The type of prefix lengths up to ``cap``."""
    return np.dtype(np.uint8 if cap <= 255 else np.uint32)


class Queues:
    """First-in-first-out queues of tuples, one per symbol, over one scratch file."""

    def __init__(self, symbols: int, cap: int, held: int = HELD):
        self.parts: list[list] = [[] for _ in range(symbols)]
        self.count = 0
        self.held = held
        self.tuple = np.dtype([("at", "<i8"), ("lcp", _counter(cap))])
        self.file = None

    def push(self, symbol: int, at: np.ndarray, lcp: np.ndarray) -> None:
        self.parts[symbol].append((at, lcp))
        self.count += len(at)
        if self.count > self.held:
            self._spill()

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile(prefix="queues-")
        self.file.seek(0, 2)
        for parts in self.parts:
            for k, part in enumerate(parts):
                if isinstance(part[0], np.ndarray):
                    tuples = np.empty(len(part[0]), self.tuple)
                    tuples["at"], tuples["lcp"] = part
                    parts[k] = (self.file.tell(), len(tuples))
                    self.file.write(tuples.tobytes())
        self.count = 0

    def _load(self, part: tuple) -> tuple[np.ndarray, np.ndarray]:
        if isinstance(part[0], np.ndarray):
            return part
        start, count = part
        self.file.seek(start)
        tuples = np.frombuffer(self.file.read(count * self.tuple.itemsize), self.tuple)
        return tuples["at"].copy(), tuples["lcp"].copy()

    def arriving(self, symbol: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of a queue from its head, with those that arrive meanwhile."""
        parts, k = self.parts[symbol], 0
        while k < len(parts):
            first, size = k, 0
            while k < len(parts) and (k == first or size < BLOCK):
                size += self._size(parts[k])
                k += 1
            loaded = [self._load(p) for p in parts[first:k]]
            yield np.concatenate([p[0] for p in loaded]), np.concatenate([p[1] for p in loaded])

    @staticmethod
    def _size(part: tuple) -> int:
        return len(part[0]) if isinstance(part[0], np.ndarray) else part[1]

    def backwards(self, symbol: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks from the tail; each prefix is shared with the tuple that comes before in this order."""
        carried = 0  # prefix shared by the block's first tuple here and the one after it in the queue
        parts = self.parts[symbol]
        k = len(parts)
        while k:
            last, size = k, 0
            while k and (k == last or size < BLOCK):
                k -= 1
                size += self._size(parts[k])
            loaded = [self._load(p) for p in parts[k:last]]
            at = np.concatenate([p[0] for p in loaded])
            lcp = np.concatenate([p[1] for p in loaded])
            turned = np.empty_like(lcp)
            turned[0], turned[1:] = carried, lcp[:0:-1]
            carried = lcp[0]
            yield at[::-1], turned

    def close(self) -> None:
        if self.file:
            self.file.close()


class _LeastBetween:
    """Minimum of any range of a short array of prefix lengths."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while 2 ** len(self.rows) <= len(values):
            last, half = self.rows[-1], 2 ** (len(self.rows) - 1)
            self.rows.append(np.minimum(last[:-half], last[half:]))

    def __call__(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minima over ``low..high`` inclusive; the most its type holds where empty."""
        size = high - low + 1
        kind = self.rows[0].dtype
        found = np.full(len(low), np.iinfo(kind).max, kind)
        level = np.zeros(len(low), np.int64)
        level[size > 0] = np.log2(size[size > 0]).astype(np.int64)
        for k in np.unique(level[size > 0]).tolist():
            here = np.flatnonzero((level == k) & (size > 0))
            row = self.rows[k]
            found[here] = np.minimum(row[low[here]], row[high[here] - 2**k + 1])
        return found


class Shard:
    """``text``: symbols 0 (separator) and byte + 1, ending with a separator.

    Shared prefixes count up to ``cap``.
    """

    def __init__(self, text: np.ndarray, cap: int = CAP):
        self.text = text
        self.cap = cap
        self.kind = _counter(cap)
        n = len(text)
        rise = np.sign(np.diff(text.astype(np.int16)))
        at = np.where(rise != 0, np.arange(n - 1), n)
        following = np.minimum.accumulate(at[::-1])[::-1]
        self.small = np.ones(n, bool)  # S type
        self.small[:-1] = rise[np.minimum(following, n - 2)] > 0
        self.star = self.small.copy()
        self.star[1:] &= ~self.small[:-1]
        self.star[0] = False
        self.symbols = 257

    def shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the prefix shared by the suffixes at ``a`` and ``b``, up to the cap."""
        text, n = self.text, len(self.text)
        found = np.zeros(len(a), self.kind)
        live = np.arange(len(a))
        for k in range(self.cap):
            # A separator ends the text, so the smaller place is always inside.
            inside = np.maximum(a, b) < n
            live, a, b = live[inside], a[inside], b[inside]
            symbol = text[a]
            equal = (symbol == text[b]) & (symbol != 0)
            live, a, b = live[equal], a[equal] + 1, b[equal] + 1
            if not len(live):
                break
            found[live] = k + 1
        return found

    def _scan(
        self, queues: Queues, since: np.ndarray | None, at: np.ndarray, lcp: np.ndarray, small: bool
    ) -> None:
        """Hands the predecessors of a type to their queues, with the prefixes they share.

        ``since`` holds, by symbol, the least prefix scanned since its last tuple; None leaves prefixes out.
        """
        if not len(at):
            return
        before = at - 1
        sends = np.flatnonzero((at > 0) & (self.small[before] == small) & (self.text[before] != 0))
        m = len(at)
        symbol = self.text[before[sends]]
        order = np.argsort(symbol, kind="stable")
        sends, symbol = sends[order], symbol[order]
        first = np.flatnonzero(np.r_[True, symbol[1:] != symbol[:-1]]) if len(sends) else sends
        if since is None:
            sent, none = before[sends], np.zeros(len(sends), self.kind)
            for a, b in zip(first, [*first[1:], len(sends)]):
                queues.push(int(symbol[a]), sent[a:b], none[a:b])
            return
        least = _LeastBetween(lcp)
        previous = np.r_[-1, sends[:-1]]
        previous[first] = -1
        between = least(previous + 1, sends)
        between[first] = np.minimum(between[first], since[symbol[first]])
        grown = np.minimum(between, self.cap - 1) + 1
        np.minimum(since, lcp.min(), out=since)
        borders = np.r_[first, len(sends)]
        for a, b in zip(borders, borders[1:]):
            c = int(symbol[a])
            values = grown[a:b].astype(self.kind)
            if not queues.parts[c]:
                values[0] = 0
            queues.push(c, before[sends[a:b]], values)
        last = sends[borders[1:] - 1]
        since[symbol[first]] = least(last + 1, np.full(len(last), m - 1))

    def _pass(self, seeds: np.ndarray, seed_lcp: np.ndarray, prefixes: bool) -> tuple[Queues, Queues]:
        """Queues of L suffixes upwards and of S suffixes downwards, from sorted seeds."""
        text = self.text
        starts = np.searchsorted(text[seeds], np.arange(self.symbols + 1))
        larger = Queues(self.symbols, self.cap)
        since = np.zeros(self.symbols, self.kind) if prefixes else None
        for c in range(self.symbols):
            tail = None
            for at, lcp in larger.arriving(c):
                self._scan(larger, since, at, lcp, small=False)
                tail = at[-1:]
            for a in range(starts[c], starts[c + 1], BLOCK):
                b = min(a + BLOCK, starts[c + 1])
                lcp = seed_lcp[a:b].copy()
                if a == starts[c] and prefixes:
                    lcp[0] = self.shared(tail, seeds[a : a + 1])[0] if tail is not None else 0
                self._scan(larger, since, seeds[a:b], lcp, small=False)
        smaller = Queues(self.symbols, self.cap)
        since = np.zeros(self.symbols, self.kind) if prefixes else None
        for c in reversed(range(1, self.symbols)):
            tail = None
            for at, lcp in smaller.arriving(c):
                self._scan(smaller, since, at, lcp, small=True)
                tail = at[-1:]
            for at, lcp in larger.backwards(c):
                if tail is not None and prefixes:
                    lcp[0] = self.shared(tail, at[:1])[0]
                    tail = None
                self._scan(smaller, since, at, lcp, small=True)
        return larger, smaller

    def _sorted_stars(self) -> np.ndarray:
        """Positions of the S* suffixes in order."""
        text = self.text
        stars = np.flatnonzero(self.star)
        seeds = stars[np.argsort(text[stars], kind="stable")]
        larger, smaller = self._pass(seeds, np.zeros(len(seeds), self.kind), prefixes=False)
        parts = [seeds[text[seeds] == 0]]
        for c in range(1, self.symbols):
            for at, _ in smaller.backwards(c):
                parts.append(at[self.star[at]])
        larger.close()
        smaller.close()
        ranked = np.concatenate(parts)

        # Names: equal S* substrings get one, separators one each.
        number = np.full(len(text), -1, np.int64)
        number[stars] = np.arange(len(stars))
        length = np.diff(np.r_[stars, len(text) - 1]) + 1
        a, b = ranked[:-1], ranked[1:]
        same = (length[number[a]] == length[number[b]]) & (text[a] != 0)
        live = np.flatnonzero(same)
        for k in range(int(length.max(initial=0))):
            live = live[length[number[a[live]]] > k]
            if not len(live):
                break
            differ = text[a[live] + k] != text[b[live] + k]
            same[live[differ]] = False
            live = live[~differ]
        names = np.empty(len(stars), np.int64)
        names[number[ranked]] = np.cumsum(np.r_[1, ~same]) if len(ranked) else names
        step = 1
        while len(names) and names.max() < len(names):
            after = np.r_[names[step:], np.zeros(min(step, len(names)), np.int64)][: len(names)]
            pair = names * (len(names) + 1) + after
            order = np.argsort(pair, kind="stable")
            pair = pair[order]
            names[order] = np.cumsum(np.r_[1, pair[1:] != pair[:-1]])
            step *= 2
        ordered = np.empty_like(stars)
        ordered[names - 1] = stars
        return ordered

    def runs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The suffixes of each first byte in order, with the prefix shared with the one before, in blocks."""
        stars = self._sorted_stars()
        lcp = np.zeros(len(stars), self.kind)
        lcp[1:] = self.shared(stars[:-1], stars[1:])
        larger, smaller = self._pass(stars, lcp, prefixes=True)
        for c in range(1, self.symbols):
            tail = None
            for at, shared in larger.arriving(c):
                yield at, shared
                tail = at[-1:]
            for at, shared in smaller.backwards(c):
                if tail is not None:
                    shared[0] = self.shared(tail, at[:1])[0]
                    tail = None
                yield at, shared
        larger.close()
        smaller.close()
