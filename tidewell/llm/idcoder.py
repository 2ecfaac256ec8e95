"""Adaptive context-mixing range coder for token ids, many blocks side by side.

A block is coded on its own from a fresh state.  For each id three models speak: order 2 and order 1 name the
id last seen after the same two or one ids of the block, order 0 holds adaptive frequencies of id ranges.
Weights that adapt to how often each model has been right at its present confidence mix them on a line of 2^41
units: the ids named by order 2 and order 1 have their model's share, all others their part of order 0's.  A
64-bit carry-less range coder narrows its interval to the id's place.  All
numbers are integers, so any machine decodes what another one wrote.  Blocks advance in step, one id each, so
that every operation works on all blocks at once.

A step is short operations on arrays with a number for each block, so their count is the time.  Orders 2 and 1,
and the two levels of order 0, stand in one array each and take one operation for both; eight borders of
frequencies move as one value of 16 bytes.  What the encoder knows beforehand, or needs only after the models have
seen an id, is done for ``_AHEAD`` steps at a time.
"""

from __future__ import annotations

import numpy as np

#: Ids of a block.
BLOCK = 4096
#: Ids below this can be coded.
LIMIT = (1 << 16) - 4
_RANGE_BITS, _WEIGHT_BITS, _LEVEL_BITS, _RATE = 33, 8, 10, 4
_SLOTS1, _SLOTS2 = 2048, 4096
_TOP, _BOTTOM = np.uint64(1 << 48), np.uint64(1 << 44)
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
_LEAP = np.uint64(16)
_UNIT = _RANGE_BITS - 2 * _LEVEL_BITS
_LEVEL = 1 << _LEVEL_BITS
_AHEAD = 32


def _ranges() -> tuple[np.ndarray, np.ndarray]:
    """The range of every id, and the first id of every range: four ranges of each width, then of twice it."""
    number = np.arange(65)
    first = ((4 + (number & 3)) << (number >> 2)) - 4
    return (np.searchsorted(first, np.arange(1 << 16), "right") - 1).astype(np.int16), first


_RANGE, _FIRST = _ranges()
#: By how many bits the units of a range are spread over its ids; ranges beyond all ids come of damaged codes only.
_SPREAD = np.maximum(_UNIT - (np.arange(65) >> 2), 0)
_EIGHT = np.arange(8, dtype=np.int16)


def _as_rows(borders: np.ndarray) -> np.ndarray:
    """Rows of eight 16-bit borders as one value of 16 bytes each, which is only ever moved."""
    return np.ascontiguousarray(borders, np.int16).view(np.complex128).ravel()


#: A row holds the lower borders of eight symbols: the first is 0, and _LEVEL, the last upper border, is left out.
_EVEN = _EIGHT << (_LEVEL_BITS - 3)
#: What a row moves towards when the symbol of the entry's number comes; every symbol keeps a share.
_GOAL = _as_rows(_EIGHT + (_EIGHT > _EIGHT[:, None]) * (_LEVEL - 8))
#: The entry's number eight times.
_EVERY = _as_rows(np.repeat(np.arange(_LEVEL), 8).reshape(-1, 8))
#: Pairs of cumulative weights (order 2, then 1) are moved as one value.  Goals when no order, 1, 2 or both named the id.
_MIX_GOAL = np.array([[1, 2], [1, 255], [254, 255], [254, 255]], np.int32).view(np.int64).ravel()
_MIX_EVEN = np.array([1 << (_WEIGHT_BITS - 4), 1 << (_WEIGHT_BITS - 3)], np.int32).view(np.int64)


class _Model:
    """State of all blocks: contexts, range frequencies (cumulative, of 8 groups of 8) and mixing weights.

    Arrays of two rows hold order 1 and order 2, or the groups and the ranges of a group.
    """

    def __init__(self, lanes: int):
        lane = np.arange(lanes)
        self.lanes, self.lane16 = lanes, lane << 4
        self.slot = np.stack([lane * _SLOTS1, lanes * _SLOTS1 + lane * _SLOTS2])
        self.seen = np.zeros(lanes * (_SLOTS1 + _SLOTS2), np.int32)  # id * 4 + confidence
        self.lane9 = lane * 9
        self.borders = np.tile(_as_rows(_EVEN), lanes * 9)  # of each block: of the ranges of 8 groups, of the groups
        row = np.zeros(2 * lanes + 1, np.complex128)  # one more, so that every border has one after it
        self.row, self.border = row[:-1].reshape(2, lanes), row.view(np.int16)
        self.cell = (np.arange(2 * lanes) << 3).reshape(2, lanes)
        self.mix = np.tile(_MIX_EVEN, lanes * 16)

    def slots(self, last: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Where the ids seen after the last id, and after the last two, are held."""
        at = np.empty((*last.shape[:-1], 2, self.lanes), np.int64)
        at[..., 0, :] = ((last * 40503 + 7) >> 3) & (_SLOTS1 - 1)
        at[..., 1, :] = ((last * 2654435761 + before * 40503) >> 12) & (_SLOTS2 - 1)
        at += self.slot
        return at

    def renew(self, at: np.ndarray, seen: np.ndarray, sure: np.ndarray, hit: np.ndarray, fresh: np.ndarray) -> None:
        """Raise the confidence of what named the id; what did not loses some, or its place."""
        self.seen[at] = np.where(hit, seen + (sure < 3), np.where(sure <= 1, fresh, seen - 1))

    def rows(self, group: np.ndarray) -> np.ndarray:
        """Where the rows of the groups, and of the ranges in a group, are held."""
        at = np.empty((*group.shape[:-1], 2, self.lanes), np.int64)
        at[..., 0, :] = self.lane9 + 8
        at[..., 1, :] = self.lane9 + group
        return at

    def move_rows(self, at: np.ndarray, symbols: np.ndarray) -> None:
        """Move the rows that were fetched towards the symbols."""
        move, row = _GOAL.take(symbols).view(np.int16), self.row.view(np.int16)
        move -= row
        move >>= _RATE
        move += row
        self.borders[at] = move.view(np.complex128)

    def move_mix(self, state: np.ndarray, pairs: np.ndarray, goals: np.ndarray) -> None:
        move, old = goals.view(np.int32), pairs.view(np.int32)
        self.mix[state] = (old + ((move - old) >> _RATE)).view(np.int64)


def _shares(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Share of order 2, of orders 2 and 1, and weight of order 0."""
    weights = pairs.view(np.int32).reshape(*pairs.shape, 2).astype(np.int64)
    return weights[..., 0] << _RANGE_BITS, weights[..., 1] << _RANGE_BITS, (1 << _WEIGHT_BITS) - weights[..., 1]


def _places(model: _Model, now: np.ndarray, last: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place and width of the ids of some steps: the share of the highest order that names the id, else its part of order 0's."""
    steps, lanes = now.shape
    number = _RANGE.take(now).astype(np.int64)
    symbols = np.stack([number >> 3, number & 7], axis=1)
    rows, cells, slots = model.rows(symbols[:, 0]), model.cell + symbols, model.slots(last, before)
    fresh = ((now << 2) + 1).astype(np.int32)
    border, after = np.empty((2, steps, 2, lanes), np.int16)
    sure, hit, pairs = np.empty((steps, 2, lanes), np.int32), np.empty((steps, 2, lanes), bool), np.empty((steps, lanes), np.int64)
    named = now.astype(np.int32)
    for k in range(steps):
        model.borders.take(rows[k], out=model.row, mode="clip")
        model.border.take(cells[k], out=border[k], mode="clip")
        model.border.take(cells[k] + 1, out=after[k], mode="clip")
        model.move_rows(rows[k], symbols[k])
        seen = model.seen.take(slots[k])
        np.bitwise_and(seen, 3, out=sure[k])
        np.equal(seen >> 2, named[k], out=hit[k])
        model.renew(slots[k], seen, sure[k], hit[k], fresh[k])
    state = model.lane16 + sure[:, 0] + (sure[:, 1] << 2)
    goals = _MIX_GOAL.take(hit[:, 0] + 2 * hit[:, 1])
    for k in range(steps):
        model.mix.take(state[k], out=pairs[k], mode="clip")
        model.move_mix(state[k], pairs[k], goals[k])
    width = ((after - border) & (_LEVEL - 1)).astype(np.int64)
    second, above, rest = _shares(pairs)
    size = (width[:, 0] * width[:, 1]) << _SPREAD.take(number)
    start = ((border[:, 0].astype(np.int64) << _LEVEL_BITS) + width[:, 0] * border[:, 1]) << _UNIT
    start = (start + (now - _FIRST.take(number)) * size) * rest + above
    start = np.where(hit[:, 1], 0, np.where(hit[:, 0], second, start))
    return start, np.where(hit[:, 1], second, np.where(hit[:, 0], above - second, size * rest))


def _below(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The symbol of each row of borders in which the row's number ``at`` lies."""
    not_above = rows <= _EVERY.take(at, mode="clip").view(np.int16)
    return np.bitwise_count(not_above.view(np.uint64)).astype(np.int64) - 1


_TOTAL = np.uint64(_RANGE_BITS + _WEIGHT_BITS)
_TO_LEAP = np.uint64(4)
_SETTLED = np.uint64(48)


def _open(low: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Whether the top 16 bits are settled, or the width is too small and is cut to the next border."""
    opened = (low ^ (low + width)) < _TOP
    small = (width < _BOTTOM) & ~opened
    if small.any():
        width[small] = (_ALL - low[small] + np.uint64(1)) & (_BOTTOM - np.uint64(1))
        opened |= small
    return opened


def encode(ids: np.ndarray, block: int = BLOCK) -> list[bytes]:
    """The code of each block of ``block`` ids; the last block may be shorter."""
    ids = np.asarray(ids)
    if len(ids) and (ids.min() < 0 or ids.max() >= LIMIT):
        raise ValueError(f"ids must be in 0 .. {LIMIT - 1}")
    lanes = -(-len(ids) // block)
    if not lanes:
        return []
    flat = np.zeros(lanes * block, np.uint16)
    flat[: len(ids)] = ids
    steps = min(block, len(ids))
    grid = np.zeros((steps + 2, lanes), np.uint16)  # two rows of zeros come before the first ids
    grid[2:] = flat.reshape(lanes, block).T[:steps]
    tail = len(ids) - (lanes - 1) * block
    longest = 3 * steps + 8
    words = np.zeros(lanes * longest, np.uint16)
    first = np.arange(lanes) * longest
    at = first.copy()  # where the next word of each block goes
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, _ALL)
    model = _Model(lanes)
    for step in range(steps):
        k = step % _AHEAD
        if not k:
            part = grid[step : step + _AHEAD + 2].astype(np.int64)
            starts, sizes = (x.view(np.uint64) for x in _places(model, part[2:], part[1:-1], part[:-2]))
        part = width >> _TOTAL
        low += part * starts[k]
        width = part * sizes[k]
        opened = _open(low, width)
        words[at] = low >> _SETTLED  # where a block does not open, its next word takes the place
        at += opened
        leap = opened.astype(np.uint64) << _TO_LEAP
        low <<= leap
        width <<= leap
        again = np.flatnonzero(_open(low, width))
        while len(again):
            some, wide = low[again], width[again]
            words[at[again]] = some >> _SETTLED
            at[again] += 1
            some <<= _LEAP
            wide <<= _LEAP
            opened = _open(some, wide)
            low[again], width[again] = some, wide
            again = again[opened]
        if step + 1 == tail:  # the last block ends here; what it codes from now on is not kept
            last_at, last_low = at[-1], low[-1]
    at[-1], low[-1] = last_at, last_low
    flush = (low[:, None] >> np.array([48, 32, 16, 0], np.uint64)).astype("<u2")
    words = words.astype("<u2", copy=False)
    return [words[a:b].tobytes() + rest.tobytes() for a, b, rest in zip(first.tolist(), at.tolist(), flush)]


def decode(codes: list[bytes], n: int, block: int = BLOCK) -> np.ndarray:
    """The ``n`` ids of blocks coded by ``encode``."""
    return decode_blocks(codes, min(block, n)).T.ravel()[:n] if codes else np.zeros(0, np.int64)


def decode_blocks(codes: list[bytes], steps: int) -> np.ndarray:
    """The first ``steps`` ids of blocks, a column for each; what a shorter block gives after its end means nothing."""
    lanes = len(codes)
    if not lanes:
        return np.zeros((steps, 0), np.uint16)
    longest = max(map(len, codes)) // 2 + 8
    words = np.zeros((lanes, longest), np.uint16)
    for lane, code in enumerate(codes):
        words[lane, : len(code) // 2] = np.frombuffer(code, "<u2")
    ahead = np.zeros(lanes, np.uint64)  # the code's number less the lower end of the interval
    for k in range(4):
        ahead = (ahead << _LEAP) | words[:, k].astype(np.uint64)
    words = words.ravel()
    at = np.arange(lanes) * longest + 4
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, _ALL)
    model = _Model(lanes)
    row, cell, size0 = model.border[:-8].reshape(2, -1), model.cell, model.lane9 + 8
    last = before = np.zeros(lanes, np.int64)
    grid = np.zeros((steps, lanes), np.uint16)
    most = np.uint64((1 << (_RANGE_BITS + _WEIGHT_BITS)) - 1)
    for step in range(steps):
        slots = model.slots(last, before)
        seen = model.seen.take(slots)
        named, sure = seen >> 2, seen & 3
        state = model.lane16 + (sure[0] + (sure[1] << 2))
        pairs = model.mix.take(state)
        second, above, rest = _shares(pairs)
        part = width >> _TOTAL
        target = np.minimum(ahead // part, most).view(np.int64)
        # order 0: the group, the range and the id in which the target lies
        t = np.maximum(target - above, 0) // rest
        model.borders.take(size0, out=model.row[0], mode="clip")
        high = _below(row[0], t >> (_UNIT + _LEVEL_BITS))
        at0 = cell[0] + high
        a = model.border.take(at0)
        group = ((model.border.take(at0 + 1) - a) & (_LEVEL - 1)).astype(np.int64)
        inner = t - (a.astype(np.int64) << (_LEVEL_BITS + _UNIT))
        model.borders.take(model.lane9 + high, out=model.row[1], mode="clip")
        low0 = _below(row[1], (inner >> _UNIT) // group)
        at0 = cell[1] + low0
        c = model.border.take(at0)
        number = (high << 3) + low0
        size = (group * ((model.border.take(at0 + 1) - c) & (_LEVEL - 1))) << _SPREAD.take(number)
        over = inner - ((group * c) << _UNIT)
        nth = over // size
        ids = np.where(target < second, named[1], np.where(target < above, named[0], _FIRST.take(number) + nth))
        hit = named == ids
        start = np.where(hit[1], 0, np.where(hit[0], second, above + (t - over + nth * size) * rest))
        size = np.where(hit[1], second, np.where(hit[0], above - second, size * rest))
        move = part * start.view(np.uint64)
        low += move
        ahead -= move
        width = part * size.view(np.uint64)
        opened = _open(low, width)
        leap = opened.astype(np.uint64) << _TO_LEAP
        low <<= leap
        width <<= leap
        ahead <<= leap
        ahead += words.take(at, mode="clip") * opened
        at += opened
        again = np.flatnonzero(_open(low, width))
        while len(again):
            some, wide = low[again] << _LEAP, width[again] << _LEAP
            ahead[again] = (ahead[again] << _LEAP) + words.take(at[again], mode="clip")
            at[again] += 1
            opened = _open(some, wide)
            low[again], width[again] = some, wide
            again = again[opened]
        model.renew(slots, seen, sure, hit, ((ids << 2) + 1).astype(np.int32))
        model.move_mix(state, pairs, _MIX_GOAL.take(hit[0].view(np.uint8) + (hit[1].view(np.uint8) << 1)))
        number = _RANGE.take(ids, mode="clip").astype(np.int64)
        symbols = np.stack([number >> 3, number & 7])
        rows = model.rows(symbols[0])
        model.borders.take(rows, out=model.row, mode="clip")
        model.move_rows(rows, symbols)
        before, last = last, ids
        grid[step] = ids
    return grid
