"""Operator 2: removal of repeated passages by level-wise doubling.

To find word windows that occur more than once, windows of a quarter of the length are looked at
first; those that repeat alone are extended to twice that length, and of these those that repeat
alone to the full length, until no candidates survive. At the first level it is enough to look at
windows whose hash is least among the quarter windows of some full window: equal full windows
have equal least ones, so none is lost and few are shuffled.

Copies of whole texts are counted first and take part once: each of their windows repeats, and
the one that takes part stands for them all.

Words go by 64-bit hashes. Candidates of the first levels are told apart by one 64-bit hash of
those, and the full windows that are removed by two independent ones together; texts by two, too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadsift.llm.common import bound_batches, settle, settled

WINDOW = 35
#: Windows that a task counts on its own before it hands them on; a window that many texts share leaves each block once.
BLOCK = 300_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def split_words(text: str | None) -> list[bytes]:
    """Runs of bytes other than ASCII white space, which are the words as UTF-8."""
    return (text or "").encode().split()


class Windows:
    """Hashes of a text's word windows of any length."""

    def __init__(self, words: list[bytes]):
        self.n = len(words)
        self.words = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, self.n)
        self.of: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def hashes(self, starts: np.ndarray, length: int, base: np.uint64 = _BASE) -> np.ndarray:
        """A polynomial of the words' hashes over the odd base, which tells windows apart independently of another base's."""
        if int(base) not in self.of:
            powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(self.n, base)]))
            back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(self.n, np.uint64(pow(int(base), -1, 1 << 64)))]))
            self.of[int(base)] = np.concatenate([[np.uint64(0)], np.cumsum(self.words * powers[:-1])]), back
        sums, back = self.of[int(base)]
        return mix((sums[starts + length] - sums[starts]) * back[starts] + np.uint64(length))


def _slide(x: np.ndarray, width: int, op: Callable) -> np.ndarray:
    """op over each ``width`` neighbours, by doubling."""
    done = 1
    while 2 * done <= width:
        x = op(x[:-done], x[done:])
        done *= 2
    return op(x[: len(x) - (width - done)], x[width - done :]) if done < width else x


def least_windows(w: Windows, short: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the windows of ``short`` words whose hash is least in some window of ``window`` words."""
    if w.n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h, width = w.hashes(np.arange(w.n - short + 1), short), window - short + 1
    least = _slide(h, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    starts = np.flatnonzero(_slide(np.concatenate([edge, least, edge]), width, np.maximum) == h)
    return starts, h[starts]


def _rows(hashes: list[np.ndarray], sids: list[int], starts: list[np.ndarray], others: list[np.ndarray]) -> pd.DataFrame:
    """One block: the first place of each hash goes by the hash, further ones are sure and go anywhere. ``others`` are second hashes, if any."""
    h = np.concatenate(hashes)
    at = np.concatenate(starts)
    sid = np.repeat(np.array(sids, np.int64), [len(x) for x in starts])
    second = np.concatenate(others) if others else np.zeros(len(h), np.uint64)
    order = np.lexsort((second, h)) if others else np.argsort(h, kind="stable")
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[order[1:]] != h[order[:-1]]) | (second[order[1:]] != second[order[:-1]])
    group = np.cumsum(fresh) - 1
    weight, later = np.empty(len(h), np.int8), np.empty(len(h), bool)
    weight[order] = np.minimum(np.bincount(group), 2)[group]
    later[order] = ~fresh
    part = np.where(later, mix(sid.astype(np.uint64) * _BASE + at.astype(np.uint64)), h).astype(np.int64)
    out = {"part": part, "sid": sid, "start": at.astype(np.int32), "weight": weight}
    return pd.DataFrame(out | {"part2": second.astype(np.int64)} if others else out)


def _emit(pick: Callable[[Windows, np.ndarray | None], tuple[np.ndarray, ...]]):
    """A mapInPandas function over sid, the text, [starts] and any other columns that gives the picked windows in blocks.

    Repeated rows share a sid and stand next to each other; one of them speaks for all.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, sids, starts, others, held, last = [], [], [], [], 0, None
        for f in frames:
            found = f["starts"] if "starts" in f else [None] * len(f)
            for sid, text, before in zip(f["sid"].tolist(), f[TEXT], found, strict=True):
                if sid == last:
                    continue
                last = sid
                at, h, *second = pick(Windows(split_words(text)), before)
                if len(at):
                    hashes.append(h)
                    sids.append(sid)
                    starts.append(at)
                    others.extend(second)
                    held += len(at)
                if held >= BLOCK:
                    yield _rows(hashes, sids, starts, others)
                    hashes, sids, starts, others, held = [], [], [], [], 0
        if held:
            yield _rows(hashes, sids, starts, others)

    return run


#: The text's name while columns go by neutral names.
TEXT = "_text"
ROWS = "part long, sid long, start int, weight byte"


def _repeated(rows: DataFrame) -> DataFrame:
    """(sid, starts) of windows that occur more than once."""
    often = F.sum("weight").over(Window.partitionBy(*[c for c in rows.columns if c.startswith("part")]))
    return rows.withColumn("often", often).filter(F.col("often") > 1).groupBy("sid").agg(F.collect_list("start").alias("starts"))


def _extend(short: int, long: int):
    """Windows of ``long`` words that begin or end as a surviving one of ``short`` words does."""

    def pick(w: Windows, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a = np.asarray(before, np.int64)
        starts = np.unique(np.concatenate([a, a - (long - short)]))
        starts = starts[(starts >= 0) & (starts + long <= w.n)]
        return starts, w.hashes(starts, long)

    return pick


def _around(short: int, window: int):
    """All windows of ``window`` words that hold a surviving one of ``short`` words."""

    def pick(w: Windows, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a = np.asarray(before, np.int64)
        starts = np.unique((a[:, None] - np.arange(window - short + 1)[None, :]).ravel())
        starts = starts[(starts >= 0) & (starts + window <= w.n)]
        return starts, w.hashes(starts, window), w.hashes(starts, window, _OTHER)

    return pick


def repeated_windows(docs: DataFrame, window: int = WINDOW, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows with their sid, marks): marks hold sid, copied (the text occurs more than once) and the
    starts of its repeated windows. Rows with equal columns share a sid.

    In the rows the text is named TEXT and the other columns _c0, _c1, ...; every level reads these
    same rows whole, so that they are shuffled by sid once.
    """
    if window < 4:
        raise ValueError("windows have four words at least")
    bound_batches(docs.sparkSession)
    half = -(-window // 2)
    quarter = -(-half // 2)
    others = [c for c in docs.columns if c != text_col]
    hashed = [F.col(f"`{c}`") for c in others if docs.schema[c].dataType.typeName() not in ("map", "variant")]
    text = F.col(f"`{text_col}`").cast("string")
    sid = F.xxhash64(text, *hashed)
    rows = docs.select(sid.alias("sid"), text.alias(TEXT), *[F.col(f"`{c}`").alias(f"_c{k}") for k, c in enumerate(others)])
    keys = docs.select(sid.alias("sid"), F.xxhash64(text).alias("k1"), F.xxhash64(text, F.lit(1)).alias("k2"))
    copies = keys.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.min("sid").alias("one")).filter("n > 1")
    copies = copies.select((F.bitwise_not(F.col("k1"))).alias("l1"), (F.bitwise_not(F.col("k2"))).alias("l2"), "one")  # dealt anew, so that a text with very many copies can be split
    copied = keys.select("sid", (F.bitwise_not(F.col("k1"))).alias("l1"), (F.bitwise_not(F.col("k2"))).alias("l2")).join(copies, ["l1", "l2"]).groupBy("sid").agg(F.max((F.col("sid") == F.col("one")).cast("int")).alias("stands"))
    apart = rows.join(copied, "sid", "left").filter("stands IS NULL OR stands = 1").drop("stands")

    level = _repeated(apart.mapInPandas(settled(_emit(lambda w, _: least_windows(w, quarter, window))), ROWS))
    level = _repeated(rows.join(level, "sid").mapInPandas(settled(_emit(_extend(quarter, half))), ROWS))
    level = _repeated(rows.join(level, "sid").mapInPandas(settled(_emit(_around(half, window))), f"{ROWS}, part2 long"))
    marks = copied.select("sid", F.lit(True).alias("copied")).join(level, "sid", "full")
    return rows, marks


def cover(n: int, copied: bool | None, starts: np.ndarray | None, window: int) -> np.ndarray:
    """Which of n words lie in a repeated window."""
    if copied and n >= window:
        return np.ones(n, bool)
    edge = np.zeros(n + 1, np.int64)
    if starts is not None and not copied:
        starts = np.unique(np.asarray(starts, np.int64))
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + window, -1)
    return np.cumsum(edge[:-1]) > 0


def result_name(docs: DataFrame) -> str:
    """``dedup``, with as many underscores before it as keep it apart from the columns of ``docs``, in any case of letters."""
    name, taken = "dedup", {c.lower() for c in docs.columns}
    while name in taken:
        name = f"_{name}"
    return name


def remove_repeats(docs: DataFrame, window: int = WINDOW, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``dedup``: struct of n_words, n_removed, kept (words joined by a
    space) and text (the text as it was where nothing is removed, else ``kept``).

    A word goes if a window of ``window`` words that covers it begins elsewhere too, in another
    document or the same one, judged on the input. Null text has no words, kept "" and text null.
    Texts with fewer words than a window keep them all. Repeated rows are copies of each other.
    An empty table gives an empty result. Very long texts take part whole. Where ``docs`` has a column
    ``dedup`` the new one is named as result_name() says.
    """
    rows, marks = repeated_windows(docs, window, text_col)

    @F.pandas_udf("n_words long, n_removed long, kept string")
    def kept(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, copied, starts in parts:
            out = []
            for text, c, s in zip(texts, copied, starts, strict=True):
                words = split_words(text)
                gone = cover(len(words), bool(c), s, window)
                out.append((len(words), int(gone.sum()), b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g).decode()))
            yield pd.DataFrame(out, columns=["n_words", "n_removed", "kept"])
        settle()

    joined = rows.join(marks, "sid", "left").withColumn("_d", kept(TEXT, F.coalesce("copied", F.lit(False)), "starts"))
    whole: Column = F.when(F.col("_d.n_removed") > 0, F.col("_d.kept")).otherwise(F.col(TEXT))
    others = [c for c in docs.columns if c != text_col]
    named = [F.col(TEXT).alias(c) if c == text_col else F.col(f"_c{others.index(c)}").alias(c) for c in docs.columns]
    return joined.select(*named, F.struct("_d.n_words", "_d.n_removed", "_d.kept", whole.alias("text")).alias(result_name(docs)))
