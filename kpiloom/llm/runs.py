"""Periodic runs of words, found on a grammar of the text.

Word numbers of a block of documents are compressed by Re-Pair: pairs that occur twice or more become a nonterminal, the most
frequent ones first, until no pair repeats. Rounds replace many pairs at once: of overlapping occurrences the one of the more
frequent pair wins. Every replacement is one node of the derivation, written down as (nonterminal, place).

A run lies inside the expansion of the lowest node that covers it, across the boundary between that node's two parts. So runs
that cross its boundary are computed once for each nonterminal, inside its expansion, and once for each boundary of the
start rule, inside the document; those of nonterminals are translated to all their places in the derivation, and
intervals of one period that overlap by a period are merged. Text that repeats inside the block is looked at once.

Runs across a boundary: for every power L of two, words of a run with period q, L/2 < q <= L, and length 4q or more recur at
distance q as whole groups of L words, and not sooner, since a group holds the whole smallest period. Five anchors before the
boundary, L/2 apart, are enough to meet such a run; the distance from an anchor to its group's next occurrence is the one
candidate. Groups are numbered by doubling and only while they recur in their document; the same numbers give the
length of a match in logarithmic steps.

Defined results
- Words are what lies between ASCII white space. A run is a stretch with smallest period q and length of max(6, 4q) words or more
  that no neighbouring word extends. Null and wordless texts have no runs.
- Each row is looked at on its own, equal rows alike. Texts are never cut; memory grows with the longest text.
- Columns of the documents pass through; one that has the name of a result column is replaced by it.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.session import ship_package

#: Words of the documents that share a grammar; a longer document has its own.
BLOCK_WORDS = 200_000
#: An odd number: its multiples modulo 2^32 differ.
_SCATTER = 0x9E3779B1
#: A run has at least this many periods, and at least this many words.
PERIODS, SHORTEST = 4, 6

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("runs", T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))),
    T.StructField("collapsed", T.StringType()),
])


@dataclass
class Grammar:
    """Nonterminals numbered from 0: size of the left part and of the whole, and the places where each is derived."""

    left: np.ndarray
    size: np.ndarray
    symbol: np.ndarray  # per node of the derivation, sorted: the nonterminal and its place in the text
    place: np.ndarray
    rest: np.ndarray  # places of the symbols that remain in the start rule, separators included


def grammar_of(values: np.ndarray) -> Grammar:
    """Re-Pair by rounds over values from 0 up; negative values separate documents and join no pair."""
    terminals = int(values.max(initial=-1)) + 1
    symbols, places = values.astype(np.int64), np.arange(len(values))
    sizes = np.ones(len(values), np.int64)
    left, size, made, at, symbols_made = [], [], [], [], terminals
    while len(symbols) > 1:
        a, b = symbols[:-1], symbols[1:]
        free = np.flatnonzero((a >= 0) & (b >= 0))
        if not len(free):
            break
        pairs, which = np.unique(a[free] * symbols_made + b[free], return_inverse=True)
        # equal pairs side by side (x x x) overlap: every second one counts
        same = np.append(False, (free[1:] == free[:-1] + 1) & (which[1:] == which[:-1]))
        index = np.arange(len(free))
        opening = np.maximum.accumulate(np.where(same, 0, index))
        own = (index - opening) % 2 == 0
        often = np.bincount(which[own], minlength=len(pairs))
        # an occurrence yields to a neighbour whose pair is more frequent; scattered numbers decide between equally frequent ones
        weight = np.full(len(symbols) + 1, -1, np.int64)
        weight[free + 1] = np.where(often > 1, (often << 32) + (np.arange(len(pairs)) * _SCATTER & 0xFFFFFFFF), -1)[which]
        here = weight[free + 1]
        wins = own & (here >= 0) & (here >= weight[free]) & (here >= np.append(weight[2:], -1)[free])
        taken = np.bincount(which[wins], minlength=len(pairs))
        wins &= taken[which] > 1
        if not wins.any():
            break
        chosen, which = free[wins], which[wins]
        used, number = np.unique(which, return_inverse=True)
        sample = chosen[np.unique(which, return_index=True)[1]]
        left.append(sizes[sample])
        size.append(sizes[sample] + sizes[sample + 1])
        made.append(number + (symbols_made - terminals))
        at.append(places[chosen])
        symbols, sizes = symbols.copy(), sizes.copy()
        symbols[chosen] = symbols_made + number
        sizes[chosen] += sizes[chosen + 1]
        stay = np.ones(len(symbols), bool)
        stay[chosen + 1] = False
        symbols, sizes, places = symbols[stay], sizes[stay], places[stay]
        symbols_made += len(used)
    symbol, place = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (made, at))
    by = np.lexsort((place, symbol))
    return Grammar(*(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, size)), symbol[by], place[by], places)


class Groups:
    """Numbers of the groups of 1, 2, 4, ... values at each place, for places whose group recurs in its document; others are -1 and match nothing."""

    def __init__(self, values: np.ndarray, document: np.ndarray, deepest: int):
        self.levels: list[np.ndarray] = []
        n = len(values)
        alive = np.flatnonzero(values >= 0)
        key = document[alive] * (int(values.max(initial=0)) + 1) + values[alive]
        length = 1
        while len(alive):
            by = np.argsort(key, kind="stable")
            ordered = key[by]
            fresh = np.append(True, ordered[1:] != ordered[:-1])
            recurs = ~(fresh & np.append(fresh[1:], True))
            number = np.cumsum(fresh) - 1
            level = np.full(n, -1, np.int32)
            alive = alive[by][recurs]
            level[alive] = number[recurs]
            self.levels.append(level)
            length *= 2
            if length > deepest:
                break
            alive = np.sort(alive)
            alive = alive[alive + length // 2 < n]
            follows = level[alive + length // 2]
            alive, follows = alive[follows >= 0], follows[follows >= 0]
            key = level[alive].astype(np.int64) * n + follows
        self.n = n

    def next_distance(self, level: int) -> np.ndarray:
        """Per place the distance to the next occurrence of its group; 0 where there is none."""
        numbers = self.levels[level]
        alive = np.flatnonzero(numbers >= 0)
        by = alive[np.argsort(numbers[alive], kind="stable")]
        distance = np.zeros(self.n, np.int64)
        again = numbers[by[1:]] == numbers[by[:-1]]
        distance[by[:-1][again]] = (by[1:] - by[:-1])[again]
        return distance

    def match(self, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
        """How many values match from places a and b on, forwards (step 1) or backwards (step -1, the places themselves not counted)."""
        done = np.zeros(len(a), np.int64)
        # a match may be longer than twice the deepest group: that level is repeated while it helps
        for level in range(len(self.levels) - 1, -1, -1):
            numbers, length = self.levels[level], 1 << level
            going = np.arange(len(a))
            while len(going):
                x, y = (p[going] + (done[going] if step > 0 else -done[going] - length) for p in (a, b))
                inside = (np.minimum(x, y) >= 0) & (np.maximum(x, y) < self.n)
                x, y, going = x[inside], y[inside], going[inside]
                equal = (numbers[x] >= 0) & (numbers[x] == numbers[y])
                going = going[equal]
                done[going] += length
                if level < len(self.levels) - 1:
                    break
        return done


def _crossing(groups: Groups, low: np.ndarray, boundary: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs across the boundaries, each inside its [low, high): number of the boundary, start, end, period."""
    found = []
    for level in range(len(groups.levels)):
        length = 1 << level
        wide = np.flatnonzero(high - low >= np.maximum(SHORTEST, PERIODS * (length // 2 + 1)))
        if not len(wide):
            continue
        distance = groups.next_distance(level)
        near = (distance > length // 2) & (distance <= length)
        if not near.any():
            continue
        half = max(1, length // 2)
        for back in range(0, 2 * length + 1, half):
            anchor = boundary[wide] - back
            inside = (anchor >= low[wide]) & (anchor < high[wide])
            of, anchor = wide[inside], anchor[inside]
            of, anchor = of[near[anchor]], anchor[near[anchor]]
            found.append(np.stack([of, anchor, distance[anchor]]))
    if not found:
        return (np.zeros(0, np.int64),) * 4
    of, anchor, q = np.concatenate(found, axis=1)
    # the whole run around an anchor is the same for all its boundaries
    (places, periods), which = np.unique(np.stack([anchor, q]), axis=1, return_inverse=True)
    end = (places + periods + groups.match(places, places + periods, 1))[which.ravel()]
    start = (places - groups.match(places, places + periods, -1))[which.ravel()]
    start, end = np.maximum(start, low[of]), np.minimum(end, high[of])
    long = (end - start >= np.maximum(SHORTEST, PERIODS * q)) & (start <= boundary[of]) & (end >= boundary[of])
    rows = np.unique(np.stack([of, start, end, q])[:, long], axis=1)
    return tuple(rows)


def runs_of(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of all runs of documents [starts, ends), which negative values separate; by start, then period."""
    document = np.searchsorted(starts, np.arange(len(values)), "right") - 1
    longest = int((ends - starts).max(initial=0))
    groups = Groups(values, document, max(1, longest // PERIODS) * 2)
    grammar = grammar_of(values)
    # nonterminals long enough for a run, each at its first place
    first = np.searchsorted(grammar.symbol, np.arange(len(grammar.size)))
    long = np.flatnonzero(grammar.size >= SHORTEST)
    low = grammar.place[first[long]]
    # boundaries of the start rule, each inside its document
    rest = grammar.rest[values[grammar.rest] >= 0]
    own = document[rest]
    rest, own = rest[rest > starts[own]], own[rest > starts[own]]
    of, start, end, period = _crossing(
        groups, np.concatenate([low, starts[own]]), np.concatenate([low + grammar.left[long], rest]), np.concatenate([low + grammar.size[long], ends[own]]))
    inner = of < len(long)
    symbol = long[of[inner]]
    # to all places of the derivation
    begin, until = np.searchsorted(grammar.symbol, symbol), np.searchsorted(grammar.symbol, symbol, "right")
    copies = until - begin
    which = np.repeat(np.arange(len(symbol)), copies)
    place = grammar.place[np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies) + begin[which]]
    shift = place - low[of[inner]][which]
    start = np.concatenate([start[inner][which] + shift, start[~inner]])
    end = np.concatenate([end[inner][which] + shift, end[~inner]])
    period = np.concatenate([period[inner][which], period[~inner]])
    # intervals of one period that overlap by a period are one run
    by = np.lexsort((start, period))
    start, end, period = start[by], end[by], period[by]
    if len(start):
        reach = np.maximum.accumulate(end + (period - period[0]) * (len(values) + 1)) - (period - period[0]) * (len(values) + 1)
        opens = np.append(True, (period[1:] != period[:-1]) | (start[1:] + period[1:] > reach[:-1]))
        start, end, period = start[opens], reach[np.append(opens[1:], True)], period[opens]
    by = np.lexsort((period, start))
    return start[by], end[by], period[by]


def _found(texts: list[str | None], block_words: int) -> Iterator[dict]:
    """n_words, runs and collapsed of each text, in order."""
    waiting: list[list[bytes]] = []
    size = 0
    for text in texts:
        words = (text or "").encode("utf-8", "surrogatepass").split()
        if waiting and size + len(words) > block_words:
            yield from _block(waiting)
            waiting, size = [], 0
        waiting.append(words)
        size += len(words) + 1
    yield from _block(waiting)


def _block(documents: list[list[bytes]]) -> Iterator[dict]:
    vocabulary: defaultdict[bytes, int] = defaultdict(count().__next__)
    counts = np.array([len(w) for w in documents], np.int64)
    starts = np.cumsum(counts + 1) - counts - 1
    values = np.full(int((counts + 1).sum()), -1, np.int64)
    for words, begin in zip(documents, starts):
        values[begin : begin + len(words)] = np.fromiter(map(vocabulary.__getitem__, words), np.int64, len(words))
    start, end, period = runs_of(values, starts, starts + counts)
    bounds = np.searchsorted(start, np.append(starts, len(values)))
    for i, words in enumerate(documents):
        found = [{"start": int(a - starts[i]), "length": int(b - a), "period": int(q)} for a, b, q in zip(*(x[bounds[i] : bounds[i + 1]] for x in (start, end, period)))]
        kept = words
        if found:
            stays = np.ones(len(words), bool)
            for r in found:
                stays[r["start"] + r["period"] : r["start"] + r["length"]] = False
            kept = [w for w, s in zip(words, stays) if s]
        yield {"n_words": len(words), "runs": found, "collapsed": b" ".join(kept).decode("utf-8", "surrogatepass")}


def with_runs(docs: DataFrame, text_column: str = "text", keep: list[str] | None = None, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Every document with n_words, runs (start, length, period; by start, then period) and collapsed.

    ``collapsed`` holds the words joined by one space, without those that a run repeats after its first period. ``keep`` names the
    columns to carry along (all by default). One pass without a shuffle.
    """
    ship_package(docs.sparkSession)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in RESULT.names]
    run = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(_found(batch.column(text_column).to_pylist(), block_words))
            made = [pa.array([r["n_words"] for r in rows], pa.int64()), pa.array([r["runs"] for r in rows], pa.list_(run)), pa.array([r["collapsed"] for r in rows], pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + made, names=[*keep, *RESULT.names])

    wanted = list(dict.fromkeys([*keep, text_column]))
    return docs.select(*[F.col(f"`{c}`") for c in wanted]).mapInArrow(found, T.StructType([docs.schema[c] for c in keep] + list(RESULT.fields)))
