"""Periodic runs of words in texts: their spans, and the texts with each run cut to its first period.

The words of a text become numbers, and the two Lyndon arrays (smaller word first, larger word
first) come from the first phase of a grouping suffix sorter: positions are grouped by their
word, the highest group is taken off the text, and every maximal chain of its members is appended
to the position before it, which moves to a new group of its own just above its old one. What a
position has gathered when its group is taken is the longest Lyndon word that starts there. All
texts of a batch take their steps at once, in arrays.

Every run is a chain of equal Lyndon roots in one of both orders. A chain is extended to both
sides by the longest common extension of neighbouring periods, and is a run if at least `TIMES`
periods and `LEAST` words long.

In such a run each three neighbouring words occur three times or more. So texts are cut first
where they do not, again and again; the pieces hold all runs, and no run goes on beyond its piece.

Defined cases: an absent or empty text, or one of white space, has no words and no runs; its
collapsed text is empty. Repeated rows are worked out each by itself. Texts are never cut short;
a text is worked out in one task, in memory and time that grow with its own length. Columns of
the input that are named like a result give way to it; all others come back as they are.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from versemill.llm.common import appended, encoded, pieces, schema_with, without

#: Words and periods that a run has at least. The cutting of texts relies on both.
LEAST, TIMES = 6, 4
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RESULT = (
    "runs array<struct<start: long, length: long, period: long>>, "
    "best struct<start: long, length: long, period: long>, collapsed string"
)
#: Bytes of text that are worked out at once; a longer text is worked out alone.
AT_ONCE = 8_000_000
#: Odd numbers that mix the words of a window into one number.
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


def repeating_pieces(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, lengths) of the pieces in which every window of three words occurs three times.

    Windows are counted by a hash, which can only be too high. A window belongs to its piece, so
    a smaller piece can be cut again.
    """
    turn = 0
    while True:
        held = lengths >= LEAST
        starts, lengths = starts[held], lengths[held]
        n = lengths - 2
        total = int(n.sum())
        if not total:
            return starts, lengths
        at = ranges(starts, n)
        piece = np.repeat(np.arange(len(n), dtype=np.uint64), n)
        with np.errstate(over="ignore"):
            key = piece + np.uint64(turn + 1)
            for k in range(3):
                key = (key * np.uint64(MIX[k])) ^ (key >> np.uint64(29))
                key += codes[at + k].astype(np.uint64)
            key *= np.uint64(MIX[3])
        bits = max(10, int(total - 1).bit_length() + 2)
        slot = (key >> np.uint64(64 - bits)).astype(np.int64)
        often = np.bincount(slot, minlength=1 << bits)[slot] >= 3
        edge = np.concatenate([[True], piece[1:] != piece[:-1]])
        opens = often & (edge | ~np.concatenate([[False], often[:-1]]))
        closes = often & (np.append(edge[1:], True) | ~np.append(often[1:], False))
        starts = at[opens]
        lengths = at[closes] - starts + 3
        turn += 1
        if int(np.maximum(lengths - 2, 0).sum()) > 0.9 * total:
            held = lengths >= LEAST
            return starts[held], lengths[held]


def lyndon(codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(length of the longest Lyndon word from each place, its group) for texts laid end to end.

    Places of equal group have equal words. Place 0 of each text is an empty one before it: the
    codes have one number more than words for every text, and one at the end.
    """
    size = len(codes)
    first = np.concatenate([[0], np.cumsum(lengths + 1)])  # the empty places
    real = np.ones(size, bool)
    real[first] = False
    places = np.nonzero(real)[0]
    text = np.repeat(np.arange(len(lengths)), lengths)
    order = np.lexsort((codes[places], text))
    slots = np.zeros(size, np.int64)  # places in the order of their groups
    slots[places] = places[order]
    slot_of = np.zeros(size, np.int64)
    slot_of[slots[places]] = places
    ranked = codes[slots[places]]
    new = np.concatenate([[True], (ranked[1:] != ranked[:-1]) | (text[1:] != text[:-1])])
    group_start = places[new]
    members = np.diff(np.append(np.nonzero(new)[0], len(places)))
    group = np.zeros(size, np.int64)  # the first slot of the group of each place
    group[slots[places]] = np.repeat(group_start, members)
    group_size = np.zeros(size, np.int64)
    group_size[group_start] = members
    before, after = np.arange(size) - 1, np.arange(size) + 1
    moved = np.zeros(size, bool)
    word = np.zeros(size, np.int64)

    top = first[1:] - 1
    low = first[:-1]
    while len(top):
        # The highest group of every text, in order of place: chains of neighbours lie together.
        start = group[slots[top]]
        taken = np.sort(slots[ranges(start, top - start + 1)])
        top = start - 1
        going = top > low
        if not going.all():
            top, low = top[going], low[going]
        ahead, behind = before[taken], after[taken]
        word[taken] = behind - taken
        heads = np.nonzero(np.concatenate([[True], ahead[1:] != taken[:-1]]))[0]
        links = np.diff(np.append(heads, len(taken)))
        left, right = ahead[heads], behind[heads + links - 1]
        after[left] = right
        before[right] = left
        grown = real[left]
        if not grown.all():
            left, links = left[grown], links[grown]
        if not len(left):
            continue
        # What has grown moves to the end of its group, longer chains higher.
        old = group[left]
        order = np.lexsort((links, old))
        left, links, old = left[order], links[order], old[order]
        other = np.concatenate([[True], old[1:] != old[:-1]])
        opens = np.nonzero(other)[0]
        n = np.diff(np.append(opens, len(left)))
        rest = group_size[old[opens]] - n
        target = ranges(old[opens] + rest, n)
        now = slot_of[left]
        moved[left] = True
        holders = slots[target]
        displaced = holders[~moved[holders]]
        moved[left] = False
        if len(displaced):
            free = now[now < np.repeat(old[opens] + rest, n)]
            slots[free] = displaced
            slot_of[displaced] = free
        slots[target] = left
        slot_of[left] = target
        split = np.nonzero(other | np.concatenate([[True], links[1:] != links[:-1]]))[0]
        sizes = np.diff(np.append(split, len(left)))
        group_size[old[opens]] = rest
        group_size[target[split]] = sizes
        group[left] = np.repeat(target[split], sizes)
    return word, group


def common_extension(codes: np.ndarray, a: np.ndarray, b: np.ndarray, room: np.ndarray, step: int) -> np.ndarray:
    """Equal words from places a and b on, going by `step`, at most `room`."""
    width = np.arange(32)
    out = np.zeros(len(a), np.int64)
    open_ = np.nonzero(room > 0)[0]
    while len(open_):
        inside = out[open_, None] + width < room[open_, None]
        way = step * np.minimum(out[open_, None] + width, room[open_, None] - 1)
        same = inside & (codes[a[open_, None] + way] == codes[b[open_, None] + way])
        n = np.where(same.all(1), len(width), np.argmin(same, 1))
        out[open_] += n
        open_ = open_[n == len(width)]
    return out


def runs_in(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of the texts at `starts`, by start and period."""
    starts, lengths = repeating_pieces(codes, starts, lengths)
    if not len(starts):
        return (np.zeros(0, np.int64),) * 3
    size = int((lengths + 1).sum()) + 1
    first = np.concatenate([[0], np.cumsum(lengths + 1)])
    real = np.ones(size, bool)
    real[first] = False
    origin = np.zeros(size, np.int64)
    origin[real] = ranges(starts, lengths)
    here = np.full(size, -1, np.int64)
    here[real] = np.unique(codes[origin[real]], return_inverse=True)[1]
    low = np.repeat(first[:-1], lengths + 1)
    high = np.repeat(first[1:], lengths + 1)
    places = np.nonzero(real)[0]
    found = []
    for sign in (1, -1):
        word, group = lyndon(sign * here, lengths)
        q = word[places]
        onward = places + q
        joined = (onward < high[places]) & (group[np.minimum(onward, size - 1)] == group[places])
        back = places - q
        known = (back > low[places]) & (group[np.maximum(back, 0)] == group[places])
        # Chains of one group do not overlap, so their heads and tails pair up in order.
        heads, tails = places[joined & ~known], places[known & ~joined]
        heads = heads[np.lexsort((heads, group[heads]))]
        tails = tails[np.lexsort((tails, group[tails]))]
        q = word[heads]
        long = tails - heads >= 2 * q  # a run of four periods holds three whole roots
        heads, tails, q = heads[long], tails[long], q[long]
        right = common_extension(here, tails, tails + q, high[tails] - tails - q, 1)
        left = common_extension(here, heads - 1, heads + q - 1, heads - low[heads] - 1, -1)
        begin, length = heads - left, tails + q + right - heads + left
        is_run = length >= np.maximum(LEAST, TIMES * q)
        found.append(np.stack([origin[begin[is_run]], length[is_run], q[is_run]]))
    start, length, period = np.unique(np.concatenate(found, 1), axis=1)
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def best_of(runs: list[dict]) -> dict | None:
    """The run of the greatest length a period, the first of equal ones."""
    best = None
    for run in runs:
        if best is None or run["length"] * best["period"] > best["length"] * run["period"]:
            best = run
    return best


def collapsed_rows(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = encoded(batch.column(text))
        for x, y in pieces(texts, AT_ONCE):
            words = [t.split() for t in texts[x:y]]
            numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
            lengths = np.array([len(w) for w in words], np.int64)
            codes = np.fromiter((numbers[w] for w in chain.from_iterable(words)), np.int64, int(lengths.sum()))
            ends = np.cumsum(lengths)
            starts = ends - lengths
            start, length, period = runs_in(codes, starts, lengths)
            change = np.zeros(len(codes) + 1, np.int64)
            np.add.at(change, start + period, 1)
            np.add.at(change, start + length, -1)
            stays = np.cumsum(change[:-1]) == 0
            cuts = np.searchsorted(start, np.append(starts, len(codes))).tolist()
            runs, best, left = [], [], []
            for i, w in enumerate(words):
                lo, hi, at = cuts[i], cuts[i + 1], starts[i]
                mine = [
                    {"start": s, "length": n, "period": p}
                    for s, n, p in zip((start[lo:hi] - at).tolist(), length[lo:hi].tolist(), period[lo:hi].tolist())
                ]
                runs.append(mine)
                best.append(best_of(mine))
                if mine:
                    w = [w[k] for k in np.nonzero(stays[at : at + len(w)])[0].tolist()]
                left.append(b" ".join(w))
            yield appended(
                batch.slice(x, y - x),
                runs=pa.array(runs, pa.list_(RUN)),
                best=pa.array(best, RUN),
                collapsed=pa.array(left, pa.binary()).cast(pa.string()),
            )


def collapse_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with `runs` (start, length and period in words, by start and period), `best` (the
    run of most periods; of equal ones the first), and `collapsed` (the words that no run
    contains after its first period, joined by one space)."""
    rows = without(docs, "runs", "best", "collapsed")
    return rows.mapInArrow(lambda batches: collapsed_rows(batches, text), schema_with(rows, RESULT))
