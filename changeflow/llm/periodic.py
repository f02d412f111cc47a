"""Periodic runs of words, found with a run-length grammar by recompression.

A run is a stretch of words that repeats with a smallest period q, is at least
``max(least, times * q)`` words long and cannot be extended. No suffix array is
built:

* Candidates lie on harmonic grids: for each period p, the words at p, 2 p,
  3 p, ... A run of period p and three or more periods holds two neighbouring
  grid steps g, g + p, g + 2 p, and every word of its first step equals the
  word p later. So only steps that agree at a few places are candidates, and
  of a streak of them the first one not yet covered.
* The texts are compressed into a run-length grammar by recompression: each
  round replaces maximal blocks of one symbol (``a a a`` -> ``a^3``), then
  pairs ``a b`` with a from the left and b from the right part of a partition
  of the symbols. Equal stretches of text are parsed alike but at their ends.
* An LCE query (how far do two places agree, forwards or backwards) goes up
  the grammar's levels while symbols agree, one comparison a level, and down
  again from the first that differ. It gives the exact extension of a
  candidate. All queries of many texts climb together, as numpy arrays.

Row-local: a task works on the texts it holds, about ``CHUNK_WORDS`` words at
a time (a longer text is one piece of work), nothing is shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import small_batches

LEAST = 24
TIMES = 3
CHUNK_WORDS = 400_000
#: candidate steps that climb the grammar together
AT_ONCE = 100_000


def _names(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, int]:
    """Equal pairs get equal numbers from 0; and how many there are."""
    _, number = np.unique(left.astype(np.int64) << 32 | right, return_inverse=True)
    return number.ravel(), int(number.max()) + 1 if len(number) else 0


class Grammar:
    """Levels of a run-length grammar over ``codes``. Codes below ``walls``
    are separators: they are all different and are never compressed.

    Per level: ``symbols``, ``first`` (the place of each symbol's first child
    on the level below, and the end), ``parent`` (of each place below) and
    whether the level was made of blocks."""

    def __init__(self, codes: np.ndarray, walls: int, seed: int = 5):
        self.symbols, self.first, self.parent, self.blocks = [codes.astype(np.int64)], [None], [None], [None]
        self.top, rng = int(codes.max()) + 1, np.random.default_rng(seed)
        while True:
            level = self.symbols[-1]
            inner = level >= walls
            if not (inner[1:] & inner[:-1]).any():
                break  # every text is one symbol
            same = (level[1:] == level[:-1]) & inner[1:]
            if same.any():
                self._blocks(level, same)
            else:
                self._pairs(level, inner, rng)

    def _level(self, starts: np.ndarray, replaced: np.ndarray, names: np.ndarray, kinds: int, blocks: bool) -> None:
        """A new level whose symbols begin at ``starts``; those in
        ``replaced`` get new names, the others keep theirs."""
        level = self.symbols[-1]
        symbols = level[starts]
        symbols[replaced] = self.top + names
        self.top += kinds
        begins = np.zeros(len(level), np.int64)
        begins[starts] = 1
        self.symbols.append(symbols)
        self.first.append(np.append(starts, len(level)))
        self.parent.append(np.cumsum(begins) - 1)
        self.blocks.append(blocks)

    def _blocks(self, level: np.ndarray, same: np.ndarray) -> None:
        starts = np.flatnonzero(np.append(True, ~same))
        length = np.diff(np.append(starts, len(level)))
        long = length > 1
        names, kinds = _names(level[starts[long]], length[long])
        self._level(starts, long, names, kinds, True)

    def _pairs(self, level: np.ndarray, inner: np.ndarray, rng) -> None:
        while True:  # a partition of the symbols that compresses at least a pair
            odd = np.uint64(int(rng.integers(1 << 62)) * 2 + 1)
            left = (level.astype(np.uint64) * odd >> np.uint64(63)).astype(bool)
            pair = inner[:-1] & inner[1:] & left[:-1] & ~left[1:]
            if pair.any():
                break
        starts = np.flatnonzero(~np.append(False, pair))
        replaced = np.append(pair, False)[starts]
        at = starts[replaced]
        names, kinds = _names(level[at], level[at + 1])
        self._level(starts, replaced, names, kinds, False)

    def lce(self, x: np.ndarray, y: np.ndarray, step: int) -> np.ndarray:
        """How many symbols agree from places x and y (different ones of one
        text) on, going right (step 1) or left (-1), including x and y."""
        x0, x, y = x, x.copy(), y.copy()
        top = len(self.symbols) - 1
        ended = np.full(len(x), top)  # the level on which the query met a difference
        going = np.arange(len(x))
        for h in range(top):
            symbols, first, parent = self.symbols[h], self.first[h + 1], self.parent[h + 1]
            a, b = x[going], y[going]
            up_a, up_b = parent[a], parent[b]
            if step > 0:
                at_edge = (first[up_a] == a) & (first[up_b] == b)
                rest_a, rest_b = first[up_a + 1] - a, first[up_b + 1] - b
            else:
                at_edge = (first[up_a + 1] - 1 == a) & (first[up_b + 1] - 1 == b)
                rest_a, rest_b = a - first[up_a] + 1, b - first[up_b] + 1
            agree = symbols[a] == symbols[b]
            if self.blocks[h + 1]:
                # inside a block: the shorter rest is passed; another rest ends the query there
                inside = ~at_edge & agree
                move = np.where(inside, np.minimum(rest_a, rest_b), 0)
                over = ~at_edge & (~agree | (rest_a != rest_b))
            else:
                # second of a pair: one symbol is passed, then both begin anew
                inside = ~at_edge & agree
                move = inside.astype(np.int64)
                over = ~at_edge & ~agree
            a, b = a + step * move, b + step * move
            x[going], y[going] = np.where(over, a, parent[a]), np.where(over, b, parent[b])
            ended[going[over]] = h
            going = going[~over]
            if not len(going):
                break
        # on the way down: of two symbols that differ, an equal first part is passed
        for h in range(top, 0, -1):
            at = np.flatnonzero(ended >= h)
            if not len(at):
                continue
            symbols, first = self.symbols[h - 1], self.first[h]
            begin_a, begin_b = first[x[at]], first[y[at]]
            end_a, end_b = first[x[at] + 1], first[y[at] + 1]
            a, b = (begin_a, begin_b) if step > 0 else (end_a - 1, end_b - 1)
            equal = symbols[a] == symbols[b]
            part = np.minimum(end_a - begin_a, end_b - begin_b) if self.blocks[h] else 1
            x[at], y[at] = a + step * np.where(equal, part, 0), b + step * np.where(equal, part, 0)
        return np.abs(x - x0)


def grid_steps(codes: np.ndarray, longest: int, times: int = TIMES) -> tuple[np.ndarray, np.ndarray]:
    """(p, g): the steps of the harmonic grids that may lie in a run: words at
    g, g + p and g + 2 p agree, and some words between with those p later."""
    ps, gs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    n = len(codes)
    for p in range(1, longest // times + 1):
        grid = codes[::p]
        if len(grid) < 3:
            break
        equal = grid[1:] == grid[:-1]
        at = np.flatnonzero(equal[1:] & equal[:-1]) * p
        if len(at) and p > 1:
            at = at[codes[at + p // 2] == codes[at + p // 2 + p]]
            at = at[codes[at + 1] == codes[at + 1 + p]]
            at = at[codes[at + p - 1] == codes[at + 2 * p - 1]]
        if len(at):
            ps.append(np.full(len(at), p))
            gs.append(at)
    return np.concatenate(ps), np.concatenate(gs)


def find_runs(codes: np.ndarray, begin: np.ndarray, longest: int, least: int = LEAST,
              times: int = TIMES) -> np.ndarray:
    """All runs as rows (start, length, period), by start and period. Texts
    begin at the places ``begin``; before each and at the end stands a
    separator, a code from 0 to the number of texts."""
    p, g = grid_steps(codes, longest, times)
    owner = np.searchsorted(begin, g, side="right")
    fine = owner == np.searchsorted(begin, g + 2 * p, side="right")
    p, g, owner = p[fine], g[fine], owner[fine]
    if not len(p):
        return np.zeros((0, 3), np.int64)
    # the grammar of the texts that have a candidate
    some = np.zeros(len(begin) + 1, bool)
    some[owner] = True
    mark = np.zeros(len(codes), np.int64)
    mark[begin - 1] = 1
    place = np.flatnonzero(np.append(some[np.cumsum(mark)[:-1]], True))
    grammar, g = Grammar(codes[place], len(begin) + 1), np.searchsorted(place, g)
    found, todo = [], np.arange(len(p))
    while len(todo):
        # of each streak of neighbouring steps the first one
        opens = np.append(True, (p[todo[1:]] != p[todo[:-1]]) | (g[todo[1:]] != g[todo[:-1]] + p[todo[1:]]))
        ask = todo[opens]
        start, end = np.zeros(len(ask), np.int64), np.zeros(len(ask), np.int64)
        for lo in range(0, len(ask), AT_ONCE):
            i = ask[lo:lo + AT_ONCE]
            start[lo:lo + AT_ONCE] = g[i] - grammar.lce(g[i] - 1, g[i] + p[i] - 1, -1)
            end[lo:lo + AT_ONCE] = g[i] + p[i] + grammar.lce(g[i], g[i] + p[i], 1)
        found.append(np.stack([place[start], end - start, p[ask]], axis=1))
        # the steps of a streak that its first step's run does not hold are asked again
        todo = todo[(g[todo] + p[todo] >= end[np.cumsum(opens) - 1]) & ~opens]
    runs = np.concatenate(found)
    runs = runs[runs[:, 1] >= np.maximum(least, times * runs[:, 2])]
    # of the periods of one stretch only the smallest is its period
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    runs = runs[np.append(True, (runs[1:, :2] != runs[:-1, :2]).any(1))[:len(runs)]]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _analysed(texts: list[list[bytes]], least: int, times: int) -> list[tuple[np.ndarray, bytes]]:
    """Runs and collapsed text of each word list."""
    sizes = np.array([len(w) for w in texts])
    name = defaultdict(count(len(texts) + 1).__next__)  # lower codes are separators
    codes = np.arange(int(sizes.sum()) + len(texts) + 1)
    begin = np.cumsum(np.append(0, sizes[:-1] + 1)) + 1
    for i, (words, b) in enumerate(zip(texts, begin.tolist())):
        codes[b - 1] = i
        codes[b:b + len(words)] = np.fromiter(map(name.__getitem__, words), np.int64, len(words))
    codes[-1] = len(texts)
    runs = find_runs(codes, begin, int(sizes.max(initial=0)), least, times)
    owner = np.searchsorted(begin, runs[:, 0], side="right") - 1
    edge = np.searchsorted(owner, np.arange(len(texts) + 1))
    out = []
    for i, words in enumerate(texts):
        own = runs[edge[i]:edge[i + 1]].copy()
        if len(own):
            own[:, 0] -= begin[i]
            change = np.zeros(len(words) + 1, np.int64)
            np.add.at(change, own[:, 0] + own[:, 2], 1)
            np.add.at(change, own[:, 0] + own[:, 1], -1)
            words = [words[j] for j in np.flatnonzero(np.cumsum(change)[:-1] == 0).tolist()]
        out.append((own, b" ".join(words)))
    return out


def periodic_runs(docs: DataFrame, text_col: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """All columns of ``docs`` plus ``n_words``, ``runs`` and ``collapsed``.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. ``runs``: every stretch
    with smallest period q and ``max(least, times * q)`` or more words that no
    neighbouring word extends with period q, as (start, length, period) by
    start and period. ``collapsed``: the words joined by one space, without
    those that a run contains after its first q words.

    Null and empty texts have no words, no runs and an empty ``collapsed``.
    Rows that repeat are treated alike; an empty table gives an empty table.
    Input columns named like the added ones are replaced. ``times`` is 3 or
    more."""
    if times < 3:
        raise ValueError("runs of fewer than three periods may lie between the grid steps")
    small_batches(docs.sparkSession)
    added = ["n_words", "runs", "collapsed"]
    src = docs.drop(*[c for c in added if c != text_col])
    at = src.columns.index(text_col)
    if text_col in added:
        raise ValueError("the text column has the name of an added column")
    schema = T.StructType([*src.schema.fields, T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(T.StructType(
                               [T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))),
                           T.StructField("collapsed", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        held: list[tuple[pa.RecordBatch, list[list[bytes]]]] = []

        def flush():
            results = iter(_analysed([w for _, texts in held for w in texts], least, times))
            for b, texts in held:
                part = [next(results) for _ in texts]
                whole = np.concatenate([np.zeros((0, 3), np.int64), *(r for r, _ in part)])
                ends = np.cumsum([0, *(len(r) for r, _ in part)]).astype(np.int32)
                struct = pa.StructArray.from_arrays([pa.array(whole[:, j].copy()) for j in range(3)],
                                                    names=["start", "length", "period"])
                cells = [*b.columns, pa.array([len(w) for w in texts], pa.int64()),
                         pa.ListArray.from_arrays(pa.array(ends), struct).cast(arrow.field("runs").type),
                         pa.array([c for _, c in part], pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(cells, schema=arrow)
            held.clear()

        n = 0
        for b in batches:
            texts = [(t or b"").split() for t in b.column(at).cast(pa.binary()).to_pylist()]
            held.append((b, texts))
            n += sum(map(len, texts))
            if n >= CHUNK_WORDS:
                yield from flush()
                n = 0
        if held:
            yield from flush()

    return src.mapInArrow(run, schema)


def strongest(runs: Column) -> Column:
    """The run of greatest length / period (exact; ties: smallest start, then
    period), null if there is none."""
    def order(a, b):
        more, less = a["length"] * b["period"], b["length"] * a["period"]
        return (F.when(more > less, -1).when(more < less, 1)
                .when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1))
                .when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0))

    return F.get(F.array_sort(runs, order), F.lit(0))


def run_text(runs: Column) -> Column:
    """``start,length,period`` and a line feed for every run."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
