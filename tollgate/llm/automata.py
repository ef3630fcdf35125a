"""Finite automata over bytes, scanned in parallel: a piece of text becomes a function.

What a piece of text does to an automaton is a function of the state in which it begins: the
state in which it ends, and how many units end inside it.  Such functions compose, and
composition is associative, so pieces are scanned independently, each from every state, and
prefix composition says afterwards in which state every piece really begins.  A block of
texts is cut into stripes of ``STRIPE`` bytes that numpy walks side by side.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np

STRIPE = 256


@dataclass(frozen=True)
class Automaton:
    """classes: of 256 bytes; move, ends: by state and class; inside, found: by state, whether a unit is unfinished there and whether a mark was seen.  State 0 is the first; the last class changes nothing."""

    classes: np.ndarray
    move: np.ndarray
    ends: np.ndarray
    inside: np.ndarray
    found: np.ndarray


def units_and_marks(end: int, marks: Iterable[bytes]) -> Automaton:
    """Units end after the byte ``end``; a mark anywhere is remembered."""
    marks = list(marks)
    bytes_ = sorted({end, *b"".join(marks)})
    classes = np.full(256, len(bytes_), np.uint8)
    classes[bytes_] = np.arange(len(bytes_))
    start = (False, b"")
    number, todo, move = {start: 0}, [start], []
    while todo:
        inside, seen = todo.pop(0)
        row = []
        for b in [*bytes_, None]:
            whole = seen if b is None else seen + bytes([b])
            if seen in marks:
                after = seen
            elif b is None:
                after = b""
            else:  # the longest end of what was seen that a mark begins with
                after = next(whole[i:] for i in range(len(whole) + 1) if any(m.startswith(whole[i:]) for m in marks) or i == len(whole))
                after = marks[0] if after in marks else after
            state = (b != end, after)
            if state not in number:
                number[state] = len(number)
                todo.append(state)
            row.append(number[state])
        move.append(row)
    states = list(number)
    n = len(states)
    table = np.column_stack((np.array(move), np.arange(n)))
    is_end = np.zeros_like(table)
    is_end[:, bytes_.index(end)] = 1
    inside, found = np.array([s[0] for s in states]), np.array([s[1] in marks for s in states])
    return _least(Automaton(classes, table, is_end, inside, found))


def _least(a: Automaton) -> Automaton:
    """Without states that nothing tells apart."""
    group = np.unique(np.column_stack((a.inside, a.found, a.ends)), axis=0, return_inverse=True)[1].reshape(-1)
    while True:
        finer = np.unique(np.column_stack((group, group[a.move])), axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == group.max():
            break
        group = finer
    order = [int(np.flatnonzero(group == g)[0]) for g in dict.fromkeys(group.tolist())]  # the first state's group first
    new = {int(group[s]): i for i, s in enumerate(order)}
    moved = np.vectorize(new.__getitem__)(group[a.move[order]])
    return Automaton(a.classes, moved, a.ends[order], a.inside[order], a.found[order])


@dataclass
class Scan:
    """Stripes of several texts: the class of each byte, stripe by stripe; each stripe's text and first byte there; each text's first stripe, and the end; and what each text does up to the end of a stripe, by state."""

    automaton: Automaton
    at: np.ndarray
    text: np.ndarray
    first: np.ndarray
    lengths: np.ndarray
    columns: np.ndarray
    state: np.ndarray
    count: np.ndarray

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        """By text and state: the state after the text, and the units that end in it."""
        n = len(self.automaton.move)
        state = np.tile(np.arange(n), (len(self.lengths), 1))
        count = np.zeros(state.shape, np.int64)
        some = np.flatnonzero(np.diff(self.first))
        last = self.first[some + 1] - 1
        state[some], count[some] = self.state[last], self.count[last]
        return state, count

    def places(self, which: np.ndarray, start: np.ndarray, k: np.ndarray) -> np.ndarray:
        """How many bytes of text ``which``, begun in state ``start``, there are up to the end of its ``k``-th unit: 0 for k = 0, all where no more than k - 1 units end."""
        out = np.where(k > 0, self.lengths[which], 0)
        if not len(self.text):
            return out
        # stripes lie text after text; counts only grow in a text, so the stripe is found by halving
        lo, hi = self.first[which].copy(), self.first[which + 1].copy()
        while (lo < hi).any():
            mid = (lo + hi) // 2
            less = (lo < hi) & (self.count[np.minimum(mid, len(self.text) - 1), start] < k)
            more = (lo < hi) & ~less
            lo[less], hi[more] = mid[less] + 1, mid[more]
        some = np.flatnonzero((k > 0) & (lo < self.first[which + 1]))
        stripe, begin = lo[some], start[some]
        before = stripe > self.first[which[some]]
        state = np.where(before, self.state[stripe - 1, begin], begin)
        left = k[some] - np.where(before, self.count[stripe - 1, begin], 0)
        place = np.zeros(len(some), np.int64)
        for j in range(STRIPE):
            c = self.columns[j, stripe]
            left = left - self.automaton.ends[state, c]
            place[(left == 0) & (place == 0)] = j + 1
            state = self.automaton.move[state, c]
        out[some] = self.at[stripe] + place
        return out


def scan(automaton: Automaton, data: np.ndarray, offsets: np.ndarray) -> Scan:
    """data: bytes of texts that lie one after another from offsets[i] to offsets[i + 1]."""
    states, kinds = automaton.move.shape
    lengths = np.diff(offsets)
    stripes = -(-lengths // STRIPE)
    first = np.concatenate(([0], np.cumsum(stripes)))
    text = np.repeat(np.arange(len(lengths)), stripes)
    at = (np.arange(len(text)) - first[text]) * STRIPE
    columns = np.full((STRIPE, len(text)), kinds - 1, np.uint8)
    if len(text):
        classes = automaton.classes[data]
        begin, end = offsets[text] + at, np.minimum(offsets[text] + at + STRIPE, offsets[text + 1])
        for j in range(STRIPE):
            there = begin + j < end
            columns[j, there] = classes[begin[there] + j]
    # the state after each byte and, above it, whether a unit ends with it
    step = (automaton.move + (automaton.ends << 8)).astype(np.uint16).reshape(-1)
    state = np.tile(np.arange(states, dtype=np.uint16), (len(text), 1))
    count = np.zeros((len(text), states), np.uint16)
    for j in range(STRIPE):
        got = step[state * np.uint16(kinds) + columns[j][:, None]]
        count += got >> np.uint16(8)
        state = got & np.uint16(255)
    state, count = state.astype(np.int64), count.astype(np.int64)
    # prefix composition within each text, over twice as many stripes each time
    place, reach = np.arange(len(text)) - first[text], 1
    while reach < (stripes.max() if len(stripes) else 0):
        some = np.flatnonzero(place >= reach)
        via = state[some - reach]
        count[some] = count[some - reach] + np.take_along_axis(count[some], via, 1)
        state[some] = np.take_along_axis(state[some], via, 1)
        reach *= 2
    return Scan(automaton, at, text, first, lengths, columns, state, count)
