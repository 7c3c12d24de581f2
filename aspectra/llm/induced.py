"""External induced sorting of suffixes, judged on their first bytes.

Suffixes travel as tuples (place, common prefix with the tuple before) through queues keyed by
their first byte. A queue is filled in sorted order, so taking its tuples in order of byte and
arrival is taking them from a priority queue, and rows beyond a memory limit go to an unlinked
file and come back in sequence. A first scan, upward, induces the L suffixes from the sorted
leftmost-S suffixes; a second, downward, induces the S suffixes from all before them. The common
prefix of two induced neighbours is one more than the least one met between their sources.

Only the first ``depth`` bytes are judged: the leftmost-S suffixes, a third of all, are found a
chunk of the text at a time and dealt to such queues by byte, recursively, until what shares its
first bytes fits in memory. There they are named by their first ``depth`` bytes, and distinct
names are ordered in words of eight bytes, descending only into what is still tied.
"""
from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

from aspectra.llm.anchors import mix

#: Tuples handled at a time.
STEP = 1 << 16
#: Bytes of text in which leftmost-S suffixes are looked for at a time.
LOOK = 1 << 19
#: Bytes of memory that sorting one suffix takes, at most about.
SORT_BYTES = 128


class DiskQueue:
    """Tuples (place, common prefix) by first byte, in order of arrival, in memory up to a limit."""

    def __init__(self, places: type, limit: int):
        self.kind, self.limit, self.used = np.dtype(places), limit, 0
        #: per byte: arrays in memory, or (offset, rows) in the file
        self.parts: list[list] = [[] for _ in range(256)]
        self.file = None

    def push(self, byte: int, place: np.ndarray, prefix: np.ndarray) -> None:
        self.parts[byte].append((place.astype(self.kind, copy=False), prefix))
        self.used += place.nbytes + prefix.nbytes
        if self.used > self.limit:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile(prefix="suffix-queue-")
        at = self.file.seek(0, 2)
        for parts in self.parts:
            held = [(i, p) for i, p in enumerate(parts) if isinstance(p[0], np.ndarray)]
            for i, (place, prefix) in held:
                self.file.write(place.tobytes())
                self.file.write(prefix.tobytes())
                parts[i] = (at, len(place))
                at += place.nbytes + prefix.nbytes
        self.used = 0

    def _load(self, part: tuple) -> tuple[np.ndarray, np.ndarray]:
        if isinstance(part[0], np.ndarray):
            return part
        at, n = part
        self.file.seek(at)
        raw = self.file.read(n * (self.kind.itemsize + 1))
        return np.frombuffer(raw, self.kind, n), np.frombuffer(raw, np.uint8, n, n * self.kind.itemsize)

    def rows(self, byte: int) -> int:
        return sum(len(p[0]) if isinstance(p[0], np.ndarray) else p[1] for p in self.parts[byte])

    def take(self, byte: int, backwards: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """A byte's tuples, oldest first (or last first), with those that arrive meanwhile."""
        parts = self.parts[byte]
        while parts:
            batch, rows = [], 0
            while parts and rows < STEP:
                place, prefix = self._load(parts.pop(-1 if backwards else 0))
                batch.append((place, prefix))
                rows += len(place)
            if backwards:
                batch.reverse()
            place, prefix = (np.concatenate(x) if len(batch) > 1 else x[0] for x in zip(*batch))
            cuts = range(0, len(place), STEP)
            for a in reversed(cuts) if backwards else cuts:
                yield place[a : a + STEP], prefix[a : a + STEP]


class _Scan:
    """One scan: induces predecessors and keeps, per target byte, the least prefix since its last tuple."""

    def __init__(self, text: np.ndarray, queue: DiskQueue, depth: int):
        self.text, self.queue, self.depth = text, queue, depth
        self.since = np.zeros(256, np.uint8)
        self.started = np.zeros(256, bool)

    def induce(self, place: np.ndarray, prefix: np.ndarray, low: int, high: int) -> None:
        """Push the predecessors whose byte is in ``low`` to ``high``; tuples come in scan order."""
        n = len(place)
        before = self.text[np.maximum(place, 1) - 1]
        at = np.flatnonzero((place > 0) & (before >= low) & (before <= high))
        least = int(prefix.min())
        if not len(at):
            np.minimum(self.since, least, out=self.since)
            return
        target = before[at]
        order = np.argsort(target, kind="stable")
        at, target = at[order], target[order]
        head = np.ones(len(at), bool)
        head[1:] = target[1:] != target[:-1]
        heads = np.flatnonzero(head)
        left = np.empty(len(at), np.int64)
        left[1:] = at[:-1] + 1
        left[heads] = 0
        levels = [prefix]  # minima of runs of 1, 2, 4, ...
        while 2 << (len(levels) - 1) <= n:
            half = 1 << (len(levels) - 1)
            levels.append(np.minimum(levels[-1][: n - 2 * half + 1], levels[-1][half : n - half + 1]))
        width = at - left + 1
        level = np.frexp(width)[1] - 1
        found = np.empty(len(at), np.uint8)
        for k in np.unique(level).tolist():
            w = np.flatnonzero(level == k)
            found[w] = np.minimum(levels[k][left[w]], levels[k][at[w] + 1 - (1 << k)])
        which = target[heads]
        found[heads] = np.minimum(found[heads], self.since[which])
        carried = np.minimum(found, self.depth - 1) + np.uint8(1)
        carried[heads[~self.started[which]]] = 0
        self.started[which] = True
        tail = np.full(n + 1, 255, np.uint8)
        tail[:n] = np.minimum.accumulate(prefix[::-1])[::-1]
        ends = np.append(heads[1:], len(at))
        np.minimum(self.since, least, out=self.since)
        self.since[which] = tail[at[ends - 1] + 1]
        moved = place[at] - 1
        for byte, a, b in zip(which.tolist(), heads.tolist(), ends.tolist()):
            self.queue.push(byte, moved[a:b], carried[a:b])


def _common(text: np.ndarray, a: int, b: int, depth: int) -> int:
    x, y = text[a : a + depth], text[b : b + depth]
    n = min(len(x), len(y))
    differs = np.flatnonzero(x[:n] != y[:n])
    return int(differs[0]) if len(differs) else n


def _words(text: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """The eight bytes at each place as one big-endian word; zeros after the end."""
    out = np.zeros(len(place), np.uint64)
    over = np.flatnonzero(place + 8 > n)
    if n >= 8:
        out[:] = np.ndarray((n - 7,), ">u8", text, strides=(1,))[np.minimum(place, n - 8)]
    if len(over):
        at = place[over, None] + np.arange(8)
        out[over] = (text[np.minimum(at, n - 1)] * (at < n)).astype(np.uint8).view(">u8")[:, 0]
    return out


def leftmost_s(text: np.ndarray) -> np.ndarray:
    """Places of S suffixes (smaller than the next) whose predecessor is L, ascending."""
    n = len(text)
    if n < 3:
        return np.zeros(0, np.int64)
    step = np.flatnonzero(text[1:] != text[:-1])  # a run of equal bytes ends at each
    starts = np.concatenate([[0], step + 1])
    rises = np.append(text[step + 1] > text[step], False)  # the last run falls to the end
    up = rises[1:] & ~rises[:-1] & (text[starts[1:]] < text[starts[1:] - 1])
    return starts[1:][up]


def leftmost_s_chunks(text: np.ndarray) -> Iterator[np.ndarray]:
    """The places of ``leftmost_s``, found in ``LOOK`` bytes at a time."""
    n, end = len(text), 0
    for a in range(0, n, LOOK):
        b = min(n, a + LOOK)
        if end < b:  # the run that holds the chunk's last byte ends before ``end``
            end = b
            while end < n:
                other = np.flatnonzero(text[end : end + STEP] != text[b - 1])
                if len(other):
                    end += int(other[0])
                    break
                end = min(n, end + STEP)
        # of that run one byte is enough, then the byte that follows it
        low = max(0, a - 1)
        piece = np.concatenate([text[low:b], text[end : end + 1]])
        places = leftmost_s(piece) + low
        yield places[(places >= a) & (places < b)]


def _sorted_in_memory(text: np.ndarray, places: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(ascending ``places`` in order of their first ``depth`` bytes, common prefixes; the first is 0)."""
    n = len(text)
    name = np.zeros(len(places), np.uint64)
    for d in range(0, depth, 8):  # equal first bytes have equal names
        word = _words(text, places + d, n)
        if d + 8 > depth:
            word >>= np.uint64(8 * (d + 8 - depth))
        name = mix(name + word + np.uint64(d + 1))
    _, first, inverse = np.unique(name, return_index=True, return_inverse=True)
    del name
    reps = places[first]
    tied = np.arange(len(reps))
    rank = np.zeros(len(reps), np.int64)
    for d in range(0, depth, 8):
        word = _words(text, reps[tied] + d, n)
        order = np.lexsort((word, rank[tied]))
        t, w, r = tied[order], word[order], rank[tied][order]
        new = np.ones(len(t), bool)
        new[1:] = (w[1:] != w[:-1]) | (r[1:] != r[:-1])
        old = np.ones(len(t), bool)
        old[1:] = r[1:] != r[:-1]
        # a rank is the number of smaller ones: the old rank and the place within its group
        k = np.arange(len(t))
        rank[t] = r + np.maximum.accumulate(np.where(new, k, 0)) - np.maximum.accumulate(np.where(old, k, 0))
        alone = new & np.append(new[1:], True)
        tied = t[~alone]
        if not len(tied):
            break
    inverse = rank[inverse]
    order = np.argsort(inverse, kind="stable")
    places, inverse = places[order], inverse[order]
    prefix = np.zeros(len(places), np.uint8)
    prefix[1:] = depth
    open_ = np.flatnonzero(inverse[1:] != inverse[:-1]) + 1
    for d in range(0, depth, 8):
        if not len(open_):
            break
        x = _words(text, places[open_] + d, n) ^ _words(text, places[open_ - 1] + d, n)
        same = x == 0
        # leading equal bytes of the words
        lead = np.zeros(len(x), np.int64)
        for b in range(7, 0, -1):
            lead += (x >> np.uint64(8 * (8 - b))) == 0
        prefix[open_] = np.minimum(depth, d + np.where(same, 8, lead))
        open_ = open_[same]
    return places, prefix


def _dealt(text: np.ndarray, chunks: Iterator[np.ndarray], d: int, kind: np.dtype, limit: int) -> DiskQueue:
    """Places of ``chunks`` in queues by the byte ``d`` after them (0 after the end), in order of arrival."""
    queue, n = DiskQueue(kind, limit), len(text)
    for places in chunks:
        at = places.astype(np.int64) + d
        byte = np.where(at < n, text[np.minimum(at, n - 1)], 0)
        order = np.argsort(byte, kind="stable")
        cuts = np.searchsorted(byte[order], np.arange(257))
        for c in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
            part = places[order[cuts[c] : cuts[c + 1]]]
            queue.push(c, part, np.zeros(len(part), np.uint8))
    return queue


def _in_order(text: np.ndarray, queue: DiskQueue, byte: int, d: int, depth: int, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A byte's places, which share their first ``d`` bytes, by their first ``depth`` bytes; chunks with common prefixes.

    The first prefix of a sorted run is 0: the caller joins the runs. What is larger than
    ``limit`` allows is dealt again by its next byte, with half the limit.
    """
    rows = queue.rows(byte)
    if d < depth and rows > max(STEP, limit // SORT_BYTES):
        inner = _dealt(text, (p for p, _ in queue.take(byte)), d, queue.kind, max(1 << 16, limit // 2))
        for c in range(256):
            yield from _in_order(text, inner, c, d + 1, depth, limit)
    elif rows and d >= depth:  # all equal: in order of place
        for k, (places, _) in enumerate(queue.take(byte)):
            prefix = np.full(len(places), depth, np.uint8)
            prefix[0] = depth if k else 0
            yield places.astype(np.int64), prefix
    elif rows:
        places = np.concatenate([p for p, _ in queue.take(byte)]).astype(np.int64)
        places, prefix = _sorted_in_memory(text, places, depth)
        for a in range(0, len(places), STEP):
            yield places[a : a + STEP], prefix[a : a + STEP]


def sorted_leftmost_s(text: np.ndarray, queue: DiskQueue, byte: int, depth: int, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Chunks (places, common prefixes) of the leftmost-S suffixes of ``byte``, by their first ``depth`` bytes."""
    last = None
    for places, prefix in _in_order(text, queue, byte, 1, depth, limit):
        if last is not None and not prefix[0]:  # all share a byte, so only a run's first has 0
            prefix[0] = _common(text, last, int(places[0]), depth)
        last = int(places[-1])
        yield places, prefix


def suffix_stream(text: np.ndarray, depth: int, limit: int = 64 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes of ``text`` from the largest to the smallest by their first ``depth`` bytes.

    Gives chunks (places, bytes shared with the suffix before, at most ``depth``). ``depth`` is at
    most 254; ``limit`` bytes of tuples are held in memory by each queue, the rest on disk.
    """
    n = len(text)
    if not n:
        return
    kind = np.int32 if n < 1 << 31 else np.int64
    seeds = _dealt(text, leftmost_s_chunks(text), 0, kind, limit)
    upward, kept = DiskQueue(kind, limit), DiskQueue(kind, limit)
    scan = _Scan(text, upward, depth)
    scan.started[text[n - 1]] = True
    upward.push(int(text[n - 1]), np.array([n - 1], kind), np.zeros(1, np.uint8))
    for c in range(256):
        last = None
        for place, prefix in upward.take(c):
            kept.push(c, place, prefix)
            scan.induce(place, prefix, c, 255)
            last = int(place[-1])
        first = True
        for place, prefix in sorted_leftmost_s(text, seeds, c, depth, limit):
            if first:
                prefix[0] = _common(text, last, int(place[0]), depth) if last is not None else 0
            first = False
            scan.induce(place, prefix, c + 1, 255)
    del seeds
    downward = DiskQueue(kind, limit)
    scan = _Scan(text, downward, depth)
    for c in range(255, -1, -1):
        last = None
        for place, prefix in downward.take(c):
            yield place, prefix
            scan.induce(place, prefix, 0, c)
            last = int(place[-1])
        next_shared = None
        for place, prefix in kept.take(c, backwards=True):
            place = place[::-1]
            flipped = np.empty(len(place), np.uint8)
            flipped[1:] = prefix[:0:-1]
            if next_shared is None:
                flipped[0] = _common(text, last, int(place[0]), depth) if last is not None else 0
            else:
                flipped[0] = next_shared
            next_shared = prefix[0]
            yield place, flipped
            if c:
                scan.induce(place, flipped, 0, c - 1)


def repeats(text: np.ndarray, asked: np.ndarray, length: int, limit: int = 64 << 20) -> np.ndarray:
    """True at each asked place whose ``length`` bytes also start at an earlier asked place.

    ``asked``: a flag per byte; an asked place must have ``length`` bytes after it.
    """
    marked = np.zeros(len(text), bool)
    best = -1  # the earliest asked place of the class that is open
    for place, prefix in suffix_stream(text, length, limit):
        cls = np.cumsum(prefix < length)
        use = asked[place]
        p, k = place[use].astype(np.int64), cls[use]
        if cls[-1] and not len(p) or len(p) and k[0]:
            best = -1
        if not len(p):
            continue
        head = np.ones(len(k), bool)
        head[1:] = k[1:] != k[:-1]
        heads = np.flatnonzero(head)
        least = np.minimum.reduceat(p, heads)
        if best >= 0:
            marked[max(best, least[0])] = True
            least[0] = min(best, least[0])
        first = least[np.cumsum(head) - 1]
        marked[p[p != first]] = True
        best = int(least[-1]) if k[-1] == cls[-1] else -1
    return marked
