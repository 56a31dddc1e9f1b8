"""A run-compressed Burrows-Wheeler index of a repetitive set of byte strings (numpy).

Strings end in a mark of their own, and marks sort before bytes, in string order. The transform is
kept as runs: for each run its start row, its byte and the row to which its first row steps back.
A directory gives each row's run. Sampled at the run ends: the length of the match between the row that a run's first row steps to
and the row above that, and where the string above starts. Inside a run both follow from the step
before: rows that are neighbours step to neighbours, and the match grows by one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

PACK = 7   # symbols of 9 bits in a 63-bit key


@dataclass
class RunIndex:
    run_of: np.ndarray        # of each row
    run_start: np.ndarray
    run_symbol: np.ndarray
    run_step: np.ndarray
    sample_match: np.ndarray
    sample_above: np.ndarray
    length: np.ndarray        # of each string
    rows: int

    @staticmethod
    def build(data: list[bytes]) -> RunIndex:
        length = np.array([len(d) for d in data], dtype=np.int64)
        flat = np.frombuffer(b"\0".join(data) + b"\0", dtype=np.uint8)
        end = np.cumsum(length + 1) - 1
        n = len(flat)
        symbol = np.zeros(n + PACK, dtype=np.int64)
        symbol[:n] = flat
        symbol[:n] += 1
        symbol[end] = 0
        string = np.repeat(np.arange(len(data), dtype=np.int32), length + 1)
        rest = np.repeat(end, length + 1) - np.arange(n)   # bytes before the mark
        two = (symbol[:-1] << 9) | symbol[1:]
        key = (two[:n] << 45) | (two[2:n + 2] << 27) | (two[4:n + 4] << 9) | symbol[6:n + 6]
        short = np.flatnonzero(rest < PACK)                # nothing of the key is behind the mark
        behind = 9 * (PACK - 1 - rest[short])
        key[short] = (key[short] >> behind) << behind
        # Suffixes whose mark is in the key differ by it: ties are in string order, which is theirs here.
        tie = np.zeros(n, dtype=np.int32)
        tie[short] = string[short] + 1
        order = np.argsort(key)
        short = np.flatnonzero(tie[order])
        order[short] = order[short][np.lexsort((order[short], key[order[short]]))]
        # A rank is the first row of its group of equal suffixes; only groups of several go on.
        ranks, width = [], PACK
        rank = _ranks(key, tie, order)
        tied = np.flatnonzero(_several(rank, order))
        while len(tied):
            ranks.append((width, rank.copy()))
            place = order[tied]
            follow = np.where(rest[place] >= width, rank[np.minimum(place + width, n - 1)].astype(np.int64) + 1, 0)
            sub = np.argsort(rank[place].astype(np.int64) * (n + 1) + follow)
            place, follow = place[sub], follow[sub]
            order[tied] = place
            old = rank[place]
            lead = np.concatenate(([True], (old[1:] != old[:-1]) | (follow[1:] != follow[:-1])))
            rank[place] = tied[np.maximum.accumulate(np.where(lead, np.arange(len(tied)), 0))]
            tied = tied[_several(rank, place)]
            width *= 2
        before = np.concatenate((np.zeros(1, np.int16), symbol[:n - 1].astype(np.int16)))[order]
        head = np.flatnonzero(np.concatenate(([True], before[1:] != before[:-1])))
        run_symbol = before[head]
        size = np.diff(np.append(head, n))
        total = np.bincount(symbol[:n], minlength=257)
        first = np.cumsum(total) - total
        by_symbol = np.argsort(run_symbol, kind="stable")
        ahead = np.cumsum(size[by_symbol]) - size[by_symbol]
        base = np.empty(len(head), dtype=np.int64)
        group = np.concatenate(([True], run_symbol[by_symbol][1:] != run_symbol[by_symbol][:-1]))
        group_start = ahead[group][np.cumsum(group) - 1]
        base[by_symbol] = ahead - group_start
        step = first[run_symbol] + base
        above = np.maximum(step - 1, 0)
        above_at = order[above]
        match = np.zeros(len(head), dtype=np.int64)
        some = np.flatnonzero((step > 0) & (run_symbol > 0))
        match[some] = _match(ranks, key, rest, order[step[some]], above_at[some])
        run_of = np.repeat(np.arange(len(head), dtype=np.int32), size)
        return RunIndex(run_of, head, run_symbol, step, match, above_at, length, n)

    def stream(self) -> tuple[np.ndarray, np.ndarray]:
        """Matching statistics of the indexed strings, each read backwards from its mark, all at
        once: for every position (strings in order, the mark last) its row and the length of its
        match with the row above."""
        end = np.cumsum(self.length + 1) - 1
        row_of, match_of = np.zeros(self.rows, np.int64), np.zeros(self.rows, np.int64)
        by_length = np.argsort(-self.length, kind="stable")
        row = by_length.copy()               # a mark's row is its string's number
        row_of[end] = np.arange(len(end))
        match = np.zeros(len(row), dtype=np.int64)
        steps = self.length[by_length]
        place = end[by_length]
        for t in range(1, int(steps[0]) + 1 if len(steps) else 0):
            active = int(np.searchsorted(-steps, -t, "right"))
            r = row[:active]
            run = self.run_of[r]
            into = r - self.run_start[run]
            match[:active] = np.where(into == 0, self.sample_match[run], match[:active] + 1)
            row[:active] = self.run_step[run] + into
            row_of[place[:active] - t] = row[:active]
            match_of[place[:active] - t] = match[:active]
        return row_of, match_of


def _ranks(key: np.ndarray, tie: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Rank of every position: the first row of equal ones."""
    new = np.ones(len(order), dtype=bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (tie[order][1:] != tie[order][:-1])
    row = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0)).astype(np.int32)
    rank = np.empty(len(order), dtype=np.int32)
    rank[order] = row
    return rank


def _several(rank: np.ndarray, place: np.ndarray) -> np.ndarray:
    """For positions in row order: does a neighbour have the same rank?"""
    r = rank[place]
    same = r[1:] == r[:-1]
    out = np.zeros(len(r), dtype=bool)
    out[1:] |= same
    out[:-1] |= same
    return out


def _match(ranks: list[tuple[int, np.ndarray]], key: np.ndarray, rest: np.ndarray, a: np.ndarray,
           b: np.ndarray) -> np.ndarray:
    """Length of the match between the suffixes at a and b, which are not the same."""
    a, b = a.copy(), b.copy()
    out = np.zeros(len(a), dtype=np.int64)
    for width, rank in reversed(ranks):
        same = np.flatnonzero(rank[a] == rank[b])
        out[same] += width
        a[same] += width
        b[same] += width
    differ = key[a] ^ key[b]
    last = np.zeros(len(a), dtype=np.int64)   # of the key's symbols, up to a mark
    for j in range(PACK):
        last += differ < 1 << 9 * j
    return out + np.minimum(last, np.minimum(rest[a], rest[b]))


def repeated_windows(data: list[bytes], k: np.ndarray, pos: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    """For every window of ``size`` bytes at the first ``n`` places of each string (string by
    string): does an equal window start earlier, in the order of (k, pos)?

    Rows whose match with the row above reaches ``size`` form one class of equal windows; the
    earliest of a class stays. The rows of a string's copies (equal byte for byte) would follow its
    own, in the same runs, and match the row above to the string's end: they are not built anew."""
    number: dict[bytes, int] = {}
    of = np.array([number.setdefault(d, len(number)) for d in data], dtype=np.int64)
    index = RunIndex.build(list(number))
    row_of, match_of = index.stream()
    begin = np.cumsum(index.length + 1) - (index.length + 1)
    turn = np.empty(len(data), dtype=np.int64)
    by_place = np.lexsort((pos, k))
    turn[by_place] = np.arange(len(data))
    own = np.zeros(len(data), dtype=bool)   # the first of its copies
    own[by_place[np.unique(of[by_place], return_index=True)[1]]] = True
    which = np.repeat(np.arange(len(data)), n)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    at = begin[of[which]] + nth
    # Windows of different strings are different places, and strings of one text do not overlap.
    when = (turn[which] << 32) + nth
    order = np.argsort((row_of[at] << 32) + turn[which])
    match = np.where(own[which], match_of[at], index.length[of[which]] - nth)
    new = match[order] < size
    # A class starts where the match is short; the row above then is another window or none.
    if len(new):
        new[0] = True
    lead = np.flatnonzero(new)
    earliest = np.repeat(np.minimum.reduceat(when[order], lead), np.diff(np.append(lead, len(order)))) if len(lead) else when
    later = np.zeros(len(which), dtype=bool)
    later[order] = when[order] != earliest
    return later
