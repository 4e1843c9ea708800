"""Operator 11: periodic runs of words by an enhanced suffix array and the branching-tandem test.

The words of a block of documents become one sequence in which no two documents share a symbol.
Its suffixes are sorted by prefix doubling; the ranks of every doubling are kept, and tell how far
any two places agree, forwards and backwards. An LCP interval of depth d holds the places of one
string of d words. For each interval, the suffixes i of all children but the largest are tested:
where the place i+d or i-d lies in the interval too (by the inverse suffix array) and the words
after the two copies differ, a square ends there that can't be rotated to the right. Rotated to the
left as far as the words agree, it covers its run; squares of one run merge, and the smallest
period stays. No tree is built: intervals are pairs of places in the suffix array.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadsift.llm.common import map_batches

#: Words of documents whose suffixes are sorted together; a longer document is a block of its own.
BLOCK_WORDS = 200_000


class Suffixes:
    """Suffix array, inverse and LCP values of a sequence of documents: symbols, and the document of each place."""

    def __init__(self, symbol: np.ndarray, end: np.ndarray):
        """end: for each place, the place after its document's last; no symbol stands in two documents."""
        n = self.n = len(symbol)
        self.symbol, self.end = np.append(symbol, -1), end
        self.sa = symbol.argsort(kind="stable")
        self.levels: list[np.ndarray] = []  # of the first 2**k words: equal numbers for equal words; -1 behind the last place
        rank = np.full(n + 1, -1, np.int64)
        slots, first = np.arange(n), symbol[self.sa]
        width = 1
        while len(slots):
            fresh = np.r_[True, first[1:] != first[:-1]]
            rank[self.sa[slots]] = slots[np.maximum.accumulate(np.where(fresh, np.arange(len(slots)), 0))]
            shared = ~(fresh & np.r_[fresh[1:], True])
            slots = slots[shared]
            if not len(slots):
                break
            self.levels.append(rank.astype(np.int32) if n < 1 << 31 else rank.copy())
            at = self.sa[slots]
            then = at + width
            first = rank[at] * (n + 1) + np.where(then < end[at], rank[np.minimum(then, n)] + 1, 0)
            order = first.argsort(kind="stable")
            self.sa[slots], first = at[order], first[order]
            width *= 2
        self.isa = rank
        self.lcp = np.zeros(n, np.int64)
        if self.levels:
            near = np.flatnonzero(self.symbol[self.sa[1:]] == self.symbol[self.sa[:-1]]) + 1
            self.lcp[near] = self.agree(self.sa[near - 1], self.sa[near])

    def agree(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from the places a and b on are the same."""
        out = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            out += (level[a + out] == level[b + out]).astype(np.int64) << k
        return out

    def agree_before(self, a: np.ndarray, b: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """How many words before the places a < b of one document, which begins at begin, are the same."""
        out = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level, back = self.levels[k], out + (1 << k)
            inside = a - back >= begin
            same = inside & (level[np.where(inside, a - back, 0)] == level[np.where(inside, b - back, 1)])
            out += same.astype(np.int64) << k
        return out

    def intervals(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(boundaries between children, and the first and last slot of the interval of each), for all intervals of depth 1 and more."""
        at = np.flatnonzero(self.lcp > 0)
        lcp = np.append(self.lcp, 0)

        def nearest(step: int) -> np.ndarray:
            """The nearest boundary before (-1) or after (1) with a smaller value, by jumps over larger ones."""
            to = np.arange(self.n + 1) + step
            left = at
            while len(left := left[lcp[to[left]] >= lcp[left]]):
                to[left] = to[to[left]]
            return to[at]

        return at, nearest(-1), nearest(1) - 1


def _squares(s: Suffixes, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first place, period) of the squares that the word after them ends."""
    at, low, high = s.intervals()
    if not len(at):
        return at, at
    depth = s.lcp[at]
    order = np.lexsort((at, high, low))
    at, low, high, depth = at[order], low[order], high[order], depth[order]
    new = np.r_[True, (low[1:] != low[:-1]) | (high[1:] != high[:-1])]
    interval = np.cumsum(new) - 1
    last = np.r_[new[1:], True]
    # Children: one begins at the interval's first slot and one at each boundary.
    start = np.concatenate([low[new], at])
    stop = np.concatenate([at[new], np.where(last, high + 1, np.r_[at[1:], 0])])
    of = np.concatenate([interval[new], interval])
    size = stop - start
    order = np.lexsort((-size, of))
    small = np.ones(len(of), bool)
    small[order[np.r_[True, of[order][1:] != of[order][:-1]]]] = False  # the largest child isn't looked through
    start, size, of = start[small], size[small], of[small]
    lows, highs, depths = low[new][of], high[new][of], depth[new][of]
    each = np.repeat(np.arange(len(of)), size)
    i = s.sa[np.arange(len(each)) - np.repeat(np.cumsum(size) - size, size) + start[each]]
    d, lows, highs = depths[each], lows[each], highs[each]
    found = []
    for sign in (1, -1):
        j = i + sign * d
        inside = (j >= begin[i]) & (j < s.end[i])
        rank = s.isa[np.where(inside, j, 0)]
        inside &= (rank >= lows) & (rank <= highs)
        found.append((np.minimum(i, j)[inside], d[inside]))
    first, period = (np.concatenate(x) for x in zip(*found, strict=True))
    after = first + 2 * period
    ended = (after >= s.end[first]) | (s.symbol[first + period] != s.symbol[np.minimum(after, s.n)])
    return first[ended], period[ended]


def runs_of(symbol: np.ndarray, begin: np.ndarray, end: np.ndarray, min_words: int, min_periods: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first place, length, smallest period) of all runs of at least min_words words and min_periods (2 or more) periods, by place and period."""
    s = Suffixes(symbol, end)
    first, period = _squares(s, begin)
    start = first - s.agree_before(first, first + period, begin[first])
    length = first + 2 * period - start
    long = length >= np.maximum(min_words, min_periods * period)
    start, length, period = start[long], length[long], period[long]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    least = np.r_[True, (start[1:] != start[:-1]) | (length[1:] != length[:-1])][: len(start)]
    start, length, period = start[least], length[least], period[least]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _block(documents: list[list[bytes]], min_words: int, min_periods: int) -> Iterator[tuple[list[dict], bytes]]:
    """The runs of each document, and its words without what repeats in them, joined by one space."""
    sizes = np.array([len(w) for w in documents])
    ends = np.cumsum(sizes)
    begins = ends - sizes
    begin, end = np.repeat(begins, sizes), np.repeat(ends, sizes)
    known: dict[bytes, int] = {}
    words = np.array([known.setdefault(w, len(known)) for document in documents for w in document], np.int64)
    start, length, period = runs_of(begin * len(known) + words, begin, end, min_words, min_periods)
    bounds = np.searchsorted(start, np.append(begins, len(words)))
    for k, document in enumerate(documents):
        a, b = bounds[k], bounds[k + 1]
        if a == b:
            yield [], b" ".join(document)
            continue
        rows = list(zip((start[a:b] - begins[k]).tolist(), length[a:b].tolist(), period[a:b].tolist(), strict=True))
        gone = np.zeros(len(document) + 1, np.int64)
        np.add.at(gone, [r[0] + r[2] for r in rows], 1)
        np.add.at(gone, [r[0] + r[1] for r in rows], -1)
        gone = np.cumsum(gone)
        yield [dict(zip(("start", "length", "period"), r, strict=True)) for r in rows], b" ".join(w for w, g in zip(document, gone.tolist(), strict=False) if not g)


def _blocks(documents: Iterator[list[bytes]]) -> Iterator[list[list[bytes]]]:
    out: list[list[bytes]] = []
    held = 0
    for words in documents:
        if out and held + len(words) > BLOCK_WORDS:
            yield out
            out, held = [], 0
        out.append(words)
        held += len(words)
    if out:
        yield out


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 24, min_periods: int = 3, reorder: Callable[[int | None, int], np.ndarray | None] | None = None) -> DataFrame:
    """(doc_id, n_words, runs, best, collapsed) of every whole text.

    Words are runs of characters other than ASCII white space, numbered from 0. runs: all stretches
    of words with a smallest period q, at least min_words long and min_periods * q long, that no
    neighbouring word extends with that period, as (start, length, period) by start, then period.
    best: that of the greatest exact length / period, on ties of the smallest start, then period;
    null without runs. collapsed: the words joined by one space, without those that some run holds
    after its first period. reorder(doc_id, number of words) may give places whose words are taken
    instead of the text's own order.

    Null, empty and white-space texts have no words and no runs, and collapse to an empty text.
    Rows are kept one for one, null and repeated ids included; other columns are left out whatever
    their names. An empty table gives an empty result. A task holds a block of about BLOCK_WORDS
    words, or one longer document, and some 4 bytes a word for each doubling of its longest repeat.
    """
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def split(batch: pa.RecordBatch) -> Iterator[list[bytes]]:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = (text or b"").split()  # of bytes: at ASCII white space alone
            order = reorder(doc_id, len(words)) if reorder else None
            yield words if order is None else [words[i] for i in order.tolist()]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for block in _blocks(split(batch)):
                told = list(_block(block, min_words, min_periods))
                best = [min(r, key=lambda x: (-Fraction(x["length"], x["period"]), x["start"], x["period"]), default=None) for r, _ in told]
                columns = [batch.column(0).slice(done, len(block)), pa.array(list(map(len, block)), pa.int64()), pa.array([r for r, _ in told], pa.list_(run)), pa.array(best, run), pa.array([t for _, t in told], pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "best", "collapsed"])
                done += len(block)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return map_batches(source, rows, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, best struct<start: long, length: long, period: long>, collapsed string")


def run_digests(docs: DataFrame, **options) -> DataFrame:
    """The figures of find_runs() that a reader compares."""
    told = find_runs(docs, **options)
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n"))))
    return told.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
