"""Operator 5: near-duplicates by a chosen-path set similarity join.

A document is the set of its word shingles and has a sketch of minwise tokens. A tree takes all
sets at its root; every node picks a few sketch coordinates by a hash of its path and sends each
set to the children named by the set's tokens there. Nodes of few sets are compared exhaustively,
larger ones branch further, and independent trees are repeated so that a link is found with high
probability.

Equal sets are one class from the start. Rounds of stars come first: each set is compared with one
member of each of its nodes, the likeliest is confirmed on the full sets, and what is linked is one
component, so that a large group of near copies costs a row or two each and not a pair each. Then
the trees are walked. In a large node where one component has many members these don't branch: the
others are compared with them by sketches, in blocks, and those near enough to some member are
confirmed against their likeliest one and, failing that, against all members on full sets, in
blocks. The others branch on without them. Members of nodes that are still large at the last level
are compared exhaustively on full sets, in blocks of a family.

Odds that a pair at similarity exactly 0.8 is missed: it agrees on 72 of 128 sketch values or more
but with a probability of 3e-10 (binomial), and meets in one of the 16 nodes of the first level but
for 7e-12; where nodes are large and branch, it misses a tree with probability 0.06 and all eight
with 9e-8. Pairs of higher similarity are missed less often.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadsift.llm.common import WORD, bound_batches, cut, forget, settled
from roadsift.llm.components import connected_components
from roadsift.llm.substring_dedup import Windows, mix

#: Values of a sketch; those of them (32 bits each) that nodes branch on; trees; coordinates a node picks; sets of a small node; levels.
SKETCH, BRANCHING, TREES, PICKS, LEAF, LEVELS = 128, 64, 8, 2, 64, 3
#: Rounds of stars, and times that links are followed to twice their length after each; what isn't reached is only compared again.
ROUNDS, JUMPS = 3, 2
#: Rows and shingles of a block, about; rows that hold a frequent token, at least.
BLOCK, BLOCK_SHINGLES, OFTEN = 1000, 300_000, 64
#: Sketches must agree on the threshold less this share.
SLACK = 0.2375

_SEEDS = mix(np.arange(1, SKETCH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_TURNS = mix(_SEEDS) | np.uint64(1)


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles of ``size`` words, A-Z in lower case."""
    words = Windows((text or "").encode().lower().split())
    if not words.n:
        return np.zeros(0, np.uint64)
    length = min(size, words.n)
    return np.unique(words.hashes(np.arange(words.n - length + 1), length))


def sketch(tokens: np.ndarray) -> np.ndarray:
    """The least value of each of SKETCH hash functions over the set."""
    out = np.full(SKETCH, np.uint64(0xFFFFFFFFFFFFFFFF))
    for k in range(0, len(tokens), 1024):
        values = tokens[k : k + 1024, None] ^ _SEEDS[None, :]
        values *= _TURNS[None, :]
        np.minimum(out, values.min(axis=0), out=out)
    return (out >> np.uint64(32)).astype("<u4")


def _described(size: int):
    """Sizes, identities and sketches: ``tokens`` to branch on, and ``bits``, a byte of each value, to compare."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for text in f["text"]:
                s = shingles(text, size)
                if len(s):
                    values = sketch(s)
                    rows.append((len(s), int(mix(s).sum().astype(np.int64)), int(np.bitwise_xor.reduce(s).astype(np.int64)), values[:BRANCHING].tobytes(), values.astype(np.uint8).tobytes()))
                else:
                    rows.append((0, 0, 0, b"", b""))
            told = pd.DataFrame(rows, columns=["n_shingles", "s1", "s2", "tokens", "bits"])
            yield pd.concat([f[["doc_id", "row"]].reset_index(drop=True), told], axis=1)

    return run


DESCRIBED = "doc_id long, row long, n_shingles long, s1 long, s2 long, tokens binary, bits binary"


def _picks(paths: np.ndarray) -> np.ndarray:
    """The PICKS coordinates that each path branches on."""
    turns = np.arange(1, PICKS + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
    return ((mix(paths[:, None] + turns[None, :]) >> np.uint64(40)) % np.uint64(BRANCHING)).astype(np.int64)


def _children(roots: int | None):
    """(d, path) rows one level below; from the roots of so many trees where there is no path yet, whose picks all differ."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            tokens = np.frombuffer(b"".join(f["tokens"]), "<u4").reshape(len(f), BRANCHING)
            if roots is not None:
                paths = np.tile(mix(np.arange(1, roots + 1, dtype=np.uint64)), len(f))
                at = np.repeat(np.arange(len(f)), roots)
                picks = np.tile((np.arange(roots)[:, None] * PICKS + np.arange(PICKS)[None, :]) % BRANCHING, (len(f), 1))
            else:
                paths, at = f["path"].to_numpy().astype(np.uint64), np.arange(len(f))
                picks = _picks(paths)
            out = [mix(mix(paths * np.uint64(BRANCHING) + picks[:, k].astype(np.uint64)) ^ tokens[at, picks[:, k]].astype(np.uint64)) for k in range(PICKS)]
            d = np.tile(f["d"].to_numpy()[at], PICKS)
            yield pd.DataFrame({"d": d, "path": np.concatenate(out).astype(np.int64)}).drop_duplicates()

    return run


CHILD = "d long, path long"


@F.pandas_udf(T.DoubleType())
def agreement(a: pd.Series, b: pd.Series) -> pd.Series:
    """The share of values on which two sketches agree."""
    x, y = (np.frombuffer(b"".join(s), np.uint8).reshape(-1, SKETCH) for s in (a, b))
    return pd.Series((x == y).mean(axis=1))


def _agree(pairs: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """(a, b, share) of pairs whose sketches agree well."""
    with_b = pairs.join(sketches.select(F.col("d").alias("b"), F.col("bits").alias("y")), "b")
    both = with_b.join(sketches.select(F.col("d").alias("a"), F.col("bits").alias("x")), "a")
    return both.select("a", "b", agreement("x", "y").alias("share")).filter(F.col("share") >= least)


def _confirm(pairs: DataFrame, source: DataFrame, first: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= percent * union.

    Texts are shuffled by doc_id once, and of those that a pair names one side goes to the other.
    """
    named = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct().join(first.withColumnRenamed("row", "_row"), "doc_id")
    texts = source.join(named, "doc_id").filter("row = _row").select(F.col("doc_id").alias("d"), "row", "text").dropDuplicates(["d", "row"])
    with_b = pairs.select("a", "b").join(texts.select(F.col("d").alias("b"), F.col("text").alias("y")), "b")
    both = with_b.join(texts.select(F.col("d").alias("a"), F.col("text").alias("x")), "a")

    @F.pandas_udf("boolean")
    def linked(x: pd.Series, y: pd.Series) -> pd.Series:
        out, sets = [], {}
        for s, t in zip(x, y, strict=True):
            for text in (s, t):
                if text not in sets:
                    sets[text] = shingles(text, size)
            p, q = sets[s], sets[t]
            common = len(np.intersect1d(p, q, assume_unique=True))
            out.append(100 * common >= percent * (len(p) + len(q) - common) and common > 0)
        return pd.Series(out, dtype=bool)

    return both.filter(linked("x", "y")).select("a", "b")


def _restored(rows: DataFrame, small: DataFrame, key: str) -> DataFrame:
    """rows with the columns of ``small``, whose key is dealt anew so that a frequent key can be split."""
    return rows.withColumn("_w", F.bitwise_not(F.col(key))).join(small.withColumn("_w", F.bitwise_not(F.col(key))).drop(key), "_w").drop("_w")


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """rows (d, ...) with the component of d, which is d itself where there is no label."""
    if labels is None:
        return rows.withColumn("component", F.col("d"))
    return rows.join(labels, "d", "left").withColumn("component", F.coalesce("component", "d"))


def _ends(links: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(hi, lo): the two components of each link that joins different ones."""
    for side, name in (("a", "u"), ("b", "v")):
        links = _labelled(links.withColumn("d", F.col(side)), labels).withColumnRenamed("component", name).drop("d")
    return links.select(F.greatest("u", "v").alias("hi"), F.least("u", "v").alias("lo")).filter("hi <> lo").distinct()


def _hooked(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels after each component has joined the least one below it that it is linked with. Equal labels mean linked sets; different ones mean nothing yet."""
    parent = _ends(links, labels).groupBy("hi").agg(F.min("lo").alias("lo"))
    for _ in range(JUMPS):
        on = parent.select(F.bitwise_not(F.col("hi")).alias("_w"), F.col("lo").alias("next"))
        parent = parent.withColumn("_w", F.bitwise_not(F.col("lo"))).join(on, "_w", "left").select("hi", F.coalesce("next", "lo").alias("lo"))
    fresh = parent.select(F.col("hi").alias("d"), F.col("lo").alias("component"))
    if labels is None:
        return fresh
    moved = parent.select(F.bitwise_not(F.col("hi")).alias("_w"), "lo")
    old = labels.withColumn("_w", F.bitwise_not(F.col("component"))).join(moved, "_w", "left").select("d", F.coalesce("lo", "component").alias("component"))
    return old.union(fresh)


def _leaf_pairs(rows: DataFrame) -> DataFrame:
    """All (a, b) of each small node that aren't in one component yet."""
    small = rows.groupBy("path").agg(F.collect_list(F.struct("d", "component")).alias("all"))
    pair = F.flatten(F.transform("all", lambda x: F.transform(F.filter("all", lambda y: (y["d"] < x["d"]) & (y["component"] != x["component"])), lambda y: F.struct(x["d"].alias("a"), y["d"].alias("b")))))
    return small.select(F.explode(pair).alias("p")).select("p.a", "p.b").distinct()


def _families(rows: DataFrame) -> DataFrame:
    """(d, family) of the members of nodes; nodes that share a member are one family, so that a pair meets once."""
    heads = rows.groupBy("path").agg(F.min("d").alias("head"))
    stars = _restored(rows.select("path", "d"), heads, "path").select(F.col("d").alias("a"), F.col("head").alias("b"))
    return connected_components(stars).select(F.col("node").alias("d"), F.col("component").alias("family"))


def _common(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of sets (rows) with sets (columns)."""
    told, code = np.unique(np.concatenate([*x, *y]), return_inverse=True)
    n = sum(len(s) for s in x)
    of_x, of_y = np.repeat(np.arange(len(x)), [len(s) for s in x]), np.repeat(np.arange(len(y)), [len(s) for s in y])
    code_x, code_y = code[:n], code[n:]
    in_y = np.bincount(code_y, minlength=len(told))
    out = np.zeros((len(x), len(y)), np.float32)
    often = np.flatnonzero((in_y > OFTEN) & (np.bincount(code_x, minlength=len(told)) > 0))
    place = np.full(len(told), -1)
    place[often] = np.arange(len(often))
    for k in range(0, len(often), 1024):  # frequent tokens by dense products
        dense = []
        for code_s, of_s, rows in ((code_x, of_x, len(x)), (code_y, of_y, len(y))):
            at = (place[code_s] >= k) & (place[code_s] < k + 1024)
            m = np.zeros((rows, 1024), np.float32)
            m[of_s[at], place[code_s[at]] - k] = 1
            dense.append(m)
        out += dense[0] @ dense[1].T
    order = np.argsort(code_y, kind="stable")
    starts, of_y = np.cumsum(in_y) - in_y, of_y[order]
    ends = np.cumsum([len(s) for s in x])
    for i in range(len(x)):  # the others by the rows that hold them
        own = code_x[ends[i] - len(x[i]) : ends[i]]
        own = own[(place[own] < 0) & (in_y[own] > 0)]
        if len(own):
            count = in_y[own]
            at = np.repeat(starts[own] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            out[i] += np.bincount(of_y[at], minlength=len(y))
    return out


def _block_links(size: int, percent: int, alone: bool):
    """Links (a, b) of two sides of a block, or with ``alone`` of one side with itself: of all that there are, as many as join its components."""

    def run(f: pd.DataFrame) -> pd.DataFrame:
        group, ids = pd.factorize(f["component"])[0], f["d"].to_numpy()
        side = f["side"].to_numpy()
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if alone and not len(right) and f["i"].iloc[0] == f["j"].iloc[0]:
            right = left
        out: list[tuple[int, int]] = []
        if len(left) and len(right) and len(np.unique(group)) > 1:
            sets = [shingles(t, size) for t in f["text"]]
            n = np.array([len(s) for s in sets])
            common = _common([sets[k] for k in left], [sets[k] for k in right])
            for i, both in zip(left, common, strict=True):
                hit = (100 * both >= percent * (n[i] + n[right] - both)) & (both > 0) & (group[right] != group[i])
                for j in right[hit]:
                    if group[i] != group[j]:
                        out.append((max(ids[i], ids[j]), min(ids[i], ids[j])))
                        group[group == group[j]] = group[i]
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return run


def _nearest(least: float):
    """(a, component, b, share): for each row of side 0 the member of side 1 whose sketch agrees most, if well enough."""

    def run(f: pd.DataFrame) -> pd.DataFrame:
        left, right = f[f["side"] == 0], f[f["side"] == 1]
        out: list[tuple[int, int, int, float]] = []
        if len(left) and len(right):
            x, y = (np.frombuffer(b"".join(part["bits"]), np.uint8).reshape(-1, SKETCH) for part in (left, right))
            ids, component = right["d"].to_numpy(), int(right["component"].iloc[0])
            for d, row in zip(left["d"].tolist(), x, strict=True):
                share = (y == row).sum(axis=1)
                if share.max() >= least * SKETCH:
                    best = int(share.argmax())
                    out.append((d, component, int(ids[best]), share[best] / SKETCH))
        return pd.DataFrame(out, columns=["a", "component", "b", "share"]).astype({"a": "int64", "component": "int64", "b": "int64", "share": "float64"})

    return run


def _texts(rows: DataFrame, source: DataFrame, first: DataFrame) -> DataFrame:
    """rows (d, ...) with the text of d's set."""
    chosen = rows.withColumnRenamed("d", "doc_id").join(first.withColumnRenamed("row", "_row"), "doc_id")
    return source.join(chosen, "doc_id").filter("row = _row").drop("row").withColumnRenamed("doc_id", "d").withColumnRenamed("_row", "row").dropDuplicates([*rows.columns, "row"])


def _against_all(suspects: DataFrame, labels: DataFrame, sketches: DataFrame, source: DataFrame, first: DataFrame, size: int, percent: int) -> DataFrame:
    """Links of each suspect (d, component) with the members of the component, all compared on full sets, in blocks of bounded rows and shingles."""
    of = suspects.select("component").distinct()
    members = labels.join(of, "component").select("component", "d").union(of.select("component", F.col("component").alias("d")))
    both = suspects.select("component", "d", F.lit(0).alias("side")).union(members.select("component", "d", F.lit(1).alias("side")))
    both = both.join(sketches.select("d", "n_shingles").groupBy("d").agg(F.max("n_shingles").alias("n_shingles")), "d")
    n = lambda s: F.greatest(F.lit(1), F.ceil(F.count(F.when(F.col("side") == s, 1)) / BLOCK), F.ceil(F.sum(F.when(F.col("side") == s, F.col("n_shingles"))) / BLOCK_SHINGLES)).cast("int")
    blocks = both.groupBy("component").agg(n(0).alias("n0"), n(1).alias("n1"))
    texts = _texts(_restored(both, blocks, "component").select("d", "side", F.col("component").alias("of"), "n0", "n1"), source, first)
    own = lambda c: F.pmod(F.xxhash64("d"), F.col(c)).cast("int")
    all_of = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    met = texts.withColumn("ij", F.explode(F.when(F.col("side") == 0, F.transform(all_of("n1"), lambda j: F.struct(own("n0").alias("i"), j.alias("j")))).otherwise(F.transform(all_of("n0"), lambda i: F.struct(i.alias("i"), own("n1").alias("j"))))))
    component = F.when(F.col("side") == 1, F.col("of")).otherwise(F.bitwise_not(F.col("d")))  # a suspect is a component of its own here
    met = met.select("of", "ij.i", "ij.j", "side", "d", component.alias("component"), "text")
    return met.groupBy("of", "i", "j").applyInPandas(_block_links(size, percent, False), "a long, b long")


def _family_links(rows: DataFrame, families: DataFrame, sketches: DataFrame, source: DataFrame, first: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between different components among the members of nodes that stay large, all compared on full sets.

    A family is cut in blocks of bounded rows and shingles, and each two blocks meet in one group.
    """
    of = families.join(rows.select("d", "component").distinct(), "d")
    sized = of.join(sketches.groupBy("d").agg(F.max("n_shingles").alias("n_shingles")), "d")
    blocks = sized.groupBy("family").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks"), F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").drop("lo", "hi")
    dealt = _restored(sized.drop("n_shingles"), blocks, "family").withColumn("own", F.pmod(F.xxhash64("d"), F.col("blocks")).cast("int"))
    met = _texts(dealt, source, first).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("family", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"), "d", "component", "text")
    return met.groupBy("family", "i", "j").applyInPandas(_block_links(size, percent, True), "a long, b long")


def _scanned(large: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """Suspects (a, component, b, share): sets of a large node that are near some member of the component with most members there.

    ``large`` has path, d, component, n, most and top. Both sides are dealt to blocks of bounded rows.
    """
    side = (F.col("component") == F.col("top")).cast("int")
    rows = large.join(sketches.select("d", "bits"), "d").withColumn("side", side)
    rows = rows.withColumns({"n0": F.ceil((F.col("n") - F.col("most")) / BLOCK).cast("int"), "n1": F.ceil(F.col("most") / BLOCK).cast("int")})
    own = lambda c: F.pmod(F.xxhash64("d"), F.col(c)).cast("int")
    all_of = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    rows = rows.withColumn("ij", F.explode(F.when(F.col("side") == 0, F.transform(all_of("n1"), lambda j: F.struct(own("n0").alias("i"), j.alias("j")))).otherwise(F.transform(all_of("n0"), lambda i: F.struct(i.alias("i"), own("n1").alias("j"))))))
    return rows.select("path", "ij.i", "ij.j", "side", "d", "component", "bits").groupBy("path", "i", "j").applyInPandas(_nearest(least), "a long, component long, b long, share double")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, n_shingles, component_id, kept) of every row.

    Rows are linked where 100 * intersection >= percent * union of their shingle sets. A text with
    fewer words than a shingle is one shingle; one without words, or null, is empty and linked
    with nothing. ``component_id`` is the smallest doc_id reachable, ``kept`` says that it is the
    row's own. ``row`` is a hash of the row's columns. Rows that share a doc_id are one node of the
    links. A null doc_id takes no part: its component is null and the row is kept. An empty table
    gives an empty result. Other columns take no part but in ``row`` and may have any name. Very long
    texts take part whole; a worker holds the shingles of one at a time. Sets are told apart by 128
    bits of hashes.
    """
    spark, made = docs.sparkSession, []

    def step(df: DataFrame) -> DataFrame:
        made.append(cut(df))
        return made[-1]

    bound_batches(spark)
    hashed = [F.col(f"`{c}`") for c in docs.columns if docs.schema[c].dataType.typeName() not in ("map", "variant")]
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(*hashed).alias("row"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    told = step(source.mapInPandas(settled(_described(shingle)), DESCRIBED))
    sets = told.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = sets.groupBy("s1", "s2").agg(F.min("doc_id").alias("d"))
    members = step(_restored(sets.select("doc_id", "row", "s1", "s2"), classes.withColumnRenamed("s2", "_s2"), "s1").filter("s2 = _s2").select("doc_id", "row", "d").distinct())
    first = members.filter("doc_id = d").select("doc_id", "row").distinct()
    sketches = step(sets.join(first, ["doc_id", "row"]).select(F.col("doc_id").alias("d"), "n_shingles", "tokens", "bits").distinct())
    least = percent / 100 - SLACK

    nodes = sketches.select("d", "tokens").mapInPandas(settled(_children(TREES)), CHILD)
    busy = nodes.groupBy("path").agg(F.min("d").alias("lo"), F.max("d").alias("hi")).filter("lo <> hi").select("path")
    nodes = step(_restored(nodes, busy, "path").select("d", "path"))

    labels, links = None, []
    for turn in range(ROUNDS):
        known = labels
        rows = _labelled(nodes, labels)
        first_of = F.struct("d", "component") if turn == 0 else F.struct(F.xxhash64("d", F.lit(turn)).alias("h"), "d", "component")
        heads = rows.groupBy("path").agg(F.min(first_of).alias("head"), F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("path", F.col("head.d").alias("b"), F.col("head.component").alias("of"))
        stars = _restored(rows, heads, "path").filter("component <> of").select(F.col("d").alias("a"), "b").distinct()
        best = step(_agree(stars, sketches, least).groupBy("a").agg(F.max_by("b", F.struct("share", F.bitwise_not(F.col("b")))).alias("b")))
        new = step(_confirm(best, source, first, shingle, percent))
        forget(best)
        if new.isEmpty():
            break
        links.append(new)
        labels = step(_hooked(known, new))
        if known is not None:
            forget(known)

    pairs, suspects, at = [], [], nodes
    for level in range(LEVELS):
        rows = _labelled(at, labels)
        counted = rows.groupBy("path", "component").agg(F.count("*").alias("m")).groupBy("path").agg(F.sum("m").alias("n"), F.max(F.struct("m", "component")).alias("x")).filter("n > x.m")
        full = (F.col("n") > LEAF) & (F.col("x.m") > LEAF // 2)
        kinds = counted.select("path", "n", F.col("x.m").alias("most"), F.when(full, F.col("x.component")).alias("top"))
        rows = step(_restored(rows, kinds, "path").withColumn("rest", F.when(F.col("top").isNull(), F.col("n")).otherwise(F.col("n") - F.col("most"))))
        others = rows.filter("top IS NULL OR component <> top")
        pairs.append(step(_leaf_pairs(others.filter(F.col("rest").between(2, LEAF)))))
        full = rows.filter("top IS NOT NULL")
        if not full.isEmpty():
            suspects.append(step(_scanned(full, sketches, least)))
        large = others.filter(F.col("rest") > LEAF)
        if large.isEmpty():
            break
        if level + 1 == LEVELS:
            links.append(step(_family_links(large, _families(large), sketches, source, first, shingle, percent)))
            break
        done, at = at, step(large.select("path", "d").join(sketches.select("d", "tokens"), "d").mapInPandas(settled(_children(None)), CHILD).distinct())
        forget(done, rows)

    found = _agree(_all(pairs).distinct(), sketches, least).select("a", "b")
    if suspects:
        each = step(_all(suspects).groupBy("a", "component").agg(F.max_by("b", "share").alias("b")))
        sure = _confirm(step(found.union(each.select("a", "b")).distinct()), source, first, shingle, percent)
        sure = step(sure)
        left = step(each.join(sure, ["a", "b"], "left_anti").select(F.col("a").alias("d"), "component"))
        if not left.isEmpty():
            links.append(step(_against_all(left, labels, sketches, source, first, shingle, percent)))
    else:
        sure = step(_confirm(step(found), source, first, shingle, percent))
    links.append(sure)
    read = {id(t) for t in (told, members, labels, *links)}
    forget(*[t for t in made if id(t) not in read])
    twice = members.groupBy("doc_id").agg(F.min("d").alias("b"), F.max("d").alias("a")).filter("a <> b")
    links.append(members.join(twice.select("doc_id", "b"), "doc_id").select(F.col("d").alias("a"), "b").filter("a <> b").distinct())
    parts = connected_components(_ends(_all(links), labels).select(F.col("hi").alias("a"), F.col("lo").alias("b")))

    placed = _labelled(members.select("doc_id", "row", "d"), labels)
    placed = placed.withColumn("_w", F.bitwise_not(F.col("component"))).join(parts.select(F.bitwise_not(F.col("node")).alias("_w"), F.col("component").alias("part")), "_w", "left")
    placed = placed.select("doc_id", "row", F.coalesce("part", "component").alias("component_id")).distinct()
    out = told.select("doc_id", "row", "n_shingles").join(placed, ["doc_id", "row"], "left")
    component = F.coalesce("component_id", "doc_id")
    out = cut(out.select("doc_id", "row", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")))
    forget(*made)
    return out


def _all(parts: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.union, parts)


def one_of_each(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of near-duplicates, with the columns of ``docs``.

    Of rows with words that share a doc_id, which are one node of the links, one stays: the one
    with the least hash. Rows without words or with a null doc_id all stay.
    """
    judged = near_duplicates(docs, shingle, percent).filter("n_shingles > 0 AND doc_id IS NOT NULL")
    stays = judged.groupBy("doc_id").agg(F.min("row").alias("_row"), F.first("kept").alias("_kept")).filter("_kept").select(F.col("doc_id").alias("_id"), "_row", F.lit(True).alias("_stays"))
    hashed = [F.col(f"`{c}`") for c in docs.columns if docs.schema[c].dataType.typeName() not in ("map", "variant")]
    judges = F.col("doc_id").isNotNull() & F.coalesce(F.col("text").cast("string"), F.lit("")).rlike(WORD)
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col("doc_id").cast("long").alias("_id"), F.xxhash64(*hashed).alias("_row"), F.when(judges, F.lit(-1)).otherwise(F.monotonically_increasing_id()).alias("_n"))
    marked = marked.dropDuplicates(["_id", "_row", "_n"])  # repeats of a row with words become one
    return marked.join(stays, ["_id", "_row"], "left").filter("_n >= 0 OR _stays").select("_doc.*")
