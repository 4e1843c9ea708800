"""Operator 3: URL rules by a cascade of Bloom filters.

Level 0 encodes the listed keys. Every key that the corpus could ask for (its key universe) is
run against it, and those that pass without being listed are encoded by level 1; the listed keys
that pass level 1 are encoded by level 2, and so on with lower levels ever smaller, until no
wrong key is left. A key is listed if the first level that turns it away has an odd number; that
is exact over the universe, and rows are judged by bit tests and without a join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most bytes that a cascade may have, as it is sent to every executor.
MAX_FILTER_BYTES = 256 << 20
SALT = 0x5EED


class BloomLevel:
    """Bits at places drawn from two 64-bit hashes of a key and the level's number."""

    def __init__(self, level: int, n_bits: int, n_hashes: int, words: np.ndarray):
        self.level, self.n_bits, self.n_hashes, self.words = level, n_bits, n_hashes, words

    @staticmethod
    def shape(n_keys: int, rate: float) -> tuple[int, int]:
        n_bits = max(64, math.ceil(-n_keys * math.log(rate) / math.log(2) ** 2 / 64) * 64)
        return n_bits, max(1, round(n_bits / max(1, n_keys) * math.log(2)) if n_keys > 4 else round(-math.log2(rate)))

    @staticmethod
    def places(h1: np.ndarray, h2: np.ndarray, level: int, n_bits: int, n_hashes: int) -> np.ndarray:
        a, b = h1.astype(np.uint64), h2.astype(np.uint64) | np.uint64(1)
        steps = np.arange(level * 64, level * 64 + n_hashes, dtype=np.uint64)
        mixed = a[:, None] + steps[None, :] * b[:, None]
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
        return mixed % np.uint64(n_bits)

    def has(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        p = self.places(h1, h2, self.level, self.n_bits, self.n_hashes)
        return ((self.words[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1)).all(axis=1)


class Cascade:
    def __init__(self, levels: list[BloomLevel]):
        self.levels = levels

    def has(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Whether each key is listed; exact for keys of the universe."""
        out, left = np.full(len(h1), len(self.levels) % 2 == 1), np.arange(len(h1))
        for k, level in enumerate(self.levels):
            passed = level.has(h1[left], h2[left]) if len(left) else np.zeros(0, bool)
            out[left[~passed]] = k % 2 == 1
            left = left[passed]
        return out


def key_hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(key, F.lit(SALT))


def _encode(keys: DataFrame, level: int, n_keys: int, rate: float) -> BloomLevel:
    """Build one level from (h1, h2) rows: bits are set within partitions and merged by word."""
    n_bits, n_hashes = BloomLevel.shape(n_keys, rate)
    if n_bits // 8 > MAX_FILTER_BYTES:
        raise ValueError(f"level {level} would need {n_bits // 8} bytes")

    def bits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            p = np.unique(BloomLevel.places(f["h1"].to_numpy(), f["h2"].to_numpy(), level, n_bits, n_hashes))
            yield pd.DataFrame({"word": (p >> np.uint64(6)).astype(np.int64), "mask": (np.uint64(1) << (p & np.uint64(63))).astype(np.int64)})

    words = np.zeros(n_bits // 64, np.uint64)
    merged = keys.select("h1", "h2").mapInPandas(bits, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask"))
    for row in merged.toLocalIterator():  # a level's words, bounded above
        words[row["word"]] = np.int64(row["mask"]).astype(np.uint64)
    return BloomLevel(level, n_bits, n_hashes, words)


def _passing(level: BloomLevel):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f[level.has(f["h1"].to_numpy(), f["h2"].to_numpy())]

    return run


def build_cascade(listed: DataFrame, universe: DataFrame, first_rate: float = 0.01, rate: float = 0.5, max_levels: int = 64) -> Cascade:
    """A cascade for the column ``key`` of ``listed``, exact on the column ``key`` of ``universe``.

    Null keys are not keys. Repeated keys count once. With nothing listed the cascade is empty and
    holds nothing. Listed keys need not be in the universe.
    """
    h1, h2 = key_hashes(F.col("key"))
    ours = listed.select("key").dropna().distinct().select("key", h1.alias("h1"), h2.alias("h2")).persist()
    n = ours.count()
    if not n:
        return Cascade([])
    levels = [_encode(ours, 0, n, first_rate)]
    schema = "key string, h1 long, h2 long"
    # False positives alone are looked up in the list; they are a small share of the universe.
    wrong = universe.select("key").dropna().select("key", h1.alias("h1"), h2.alias("h2")).mapInPandas(_passing(levels[0]), schema).distinct().join(ours.select("key"), "key", "left_anti").persist()
    sides, keep = [wrong, ours], [wrong, ours]
    while (n := sides[0].count()) and len(levels) < max_levels:
        levels.append(_encode(sides[0], len(levels), n, rate))
        rest = sides[1].mapInPandas(_passing(levels[-1]), schema).persist()
        keep.append(rest)
        sides = [rest, sides[0]]
    for frame in keep:
        frame.unpersist()
    if n:
        raise ValueError("keys with equal hashes: no cascade is exact")
    return Cascade(levels)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substr({}, instr({}, '://') + 3)".replace("{}", "url"))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit("")), F.coalesce(path, F.lit(""))


def _keys(path_lengths: list[int]) -> Column:
    """Every (host suffix, path prefix) of a row that a rule could name, longest host first, then longest path."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    lengths = F.filter(F.array(*[F.lit(n) for n in sorted(path_lengths, reverse=True)]), lambda n: n <= F.length("path"))
    pairs = F.transform(suffixes, lambda s: F.transform(lengths, lambda n: F.concat(s, F.substring(F.col("path"), F.lit(1), n))))
    return F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(F.flatten(pairs))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row.

    ``rules`` are (verdict, host, path); a rule fits its host and all subdomains where the path
    starts with its own. The longest host wins and then the longest path. Without a rule the
    verdict is ``default``: what no list names is not filtered. A key is host + path; as hosts
    have no slash and rule paths begin with one, keys are distinct. Null and malformed urls have
    empty host and path and fit no rule. Repeated rows are judged each; other columns are left
    out. An empty table gives an empty result. Lists may be long: their cascades' size is checked.
    """
    if any(not path.startswith("/") for _, _, path in rules):
        raise ValueError("a rule's path begins with a slash")
    spark = pages.sparkSession
    source = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    host, path = url_parts(F.col("url"))
    rows = source.select("page_id", host.alias("host"), path.alias("path")).withColumn("keys", _keys(sorted({len(p) for _, _, p in rules}) or [1]))
    universe = rows.select("host", "path", "keys").select(F.explode("keys").alias("key"))
    cascades = {v: build_cascade(_rule_keys(spark, rules, v), universe) for v in ("block", "allow")}
    block, allow = (cascades[v] for v in ("block", "allow"))

    @F.pandas_udf("array<int>")
    def listed(h1: pd.Series, h2: pd.Series) -> pd.Series:
        """For each key: 2 if blocked, 1 if allowed, 0 if in no list."""
        sizes = h1.map(len).to_numpy()
        a, b = (np.concatenate([np.asarray(x, np.int64) for x in s] or [np.zeros(0, np.int64)]).astype(np.int64) for s in (h1, h2))
        found = np.where(block.has(a, b), 2, np.where(allow.has(a, b), 1, 0)).astype(np.int32)
        return pd.Series(np.split(found, np.cumsum(sizes)[:-1]) if len(sizes) else [])

    judged = rows.withColumn("found", listed(F.transform("keys", lambda k: key_hashes(k)[0]), F.transform("keys", lambda k: key_hashes(k)[1])))
    hit = F.element_at(F.filter(F.arrays_zip("keys", "found"), lambda x: x["found"] > 0), 1)
    judged = judged.select("page_id", "host", "path", F.when(F.exists("found", lambda x: x > 0), hit).alias("hit"))
    verdict = F.when(F.col("hit.found") == 2, "block").when(F.col("hit.found") == 1, "allow").otherwise(default)
    return judged.select("page_id", "host", "path", F.col("hit.keys").alias("rule"), verdict.alias("verdict"))


def _rule_keys(spark: SparkSession, rules: list[tuple[str, str, str]], verdict: str) -> DataFrame:
    return spark.createDataFrame([(h + p,) for v, h, p in rules if v == verdict], "key string")
