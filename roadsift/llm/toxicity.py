"""Operator 10: toxicity by a weighted finite-state pattern grammar.

A lexicon reads words as classes (insult, threat, target, negation, reporting verb, other) and
marks as soft or hard boundaries. Five weighted transducers work on these in a cascade: reported
speech marks insults and threats that stand in it, also beyond a colon or quotation mark; negation
marks those in its scope; target tells a clause's end whether a target stood in the clause; insult
and threat take their words in and write at the clause's end what kind of clause it was. Every arc
has a weight; weights add up along a path. A generic composition makes one deterministic machine
of the five, which writes a kind and a weight for each matched clause. A document's score is a
logistic function of how many of its clauses are of each kind and of their weight; its factors are
fitted on training labels, and so are the word stems of the insult class beyond a few seeds.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadsift.llm.common import bound_batches, settle

#: The classifier is fitted on about this many labelled rows at most, chosen by a hash of doc_id.
TRAINING_ROWS = 20_000
#: Rows whose crc32(doc_id as text) has this remainder by 4 are never learnt from.
HELD_OUT = 2
THRESHOLD = 0.3
#: A learnt stem stands in this share of the toxic training documents at least, and is so many times likelier there.
STEM_SHARE, STEM_ODDS, STEM_DOCS, STEM_SHORTEST, STEM_LONGEST = 0.012, 60.0, 4, 3, 12
MOST_STEMS = 5_000

# Seed words of the classes.
INSULTS = "idiot idiots moron morons stupid loser losers scum worthless pathetic disgusting trash clown imbecile idiote imbécile connard salaud dumm dummkopf abschaum arschloch idiota imbécil estúpido estúpida basura"
THREATS = "kill hurt destroy beat burn crush murder tuer frapper brûler töten schlagen vernichten verbrennen matar golpear quemar destruir"
TARGETS = "you your yours u he she they them him her people tu toi vous ton ta vos votre il elle ils du dich dir dein deine ihr euch er sie tú ti usted ustedes vosotros tus él ella ellos"
NEGATIONS = "not no never none cannot don doesn isn aren wasn ne pas jamais aucun nicht kein keine nie niemals nunca jamás ningún"
REPORTS = "said says say saying called calls wrote quoted according dit disait écrit appelé selon sagte sagt nannte schrieb laut dijo dice llamó escribió según"

TOKEN = re.compile(r"[^\W\d_]+|[.!?;:,…|()\[\]\"«»“”\n]")
#: Marks that end a sentence, and with it reported speech; the others end a clause only.
HARD = frozenset(".!?;…|\n")
#: Most words whose class a worker remembers.
REMEMBERED = 100_000
KINDS = ("insult", "insult_at_target", "negated_insult", "reported_insult", "threat", "softened_threat")
#: Weights of arcs: an insult or a threat at its clause's end, a target beside it, and what negation and reported speech take away.
INSULT, THREAT, TARGET, NEGATED, REPORTED = 1.0, 1.5, 1.0, -0.75, -0.5
#: Words after a negation that it reaches over.
SCOPE = 3
#: The lexicon's symbols: insult, threat, target, negation, reporting verb, other word, soft and hard boundary.
SYMBOLS = "IHTNRw,."

Arc = tuple[str, float, object]


class Transducer:
    """Deterministic and weighted: arcs[state, symbol] = (what is written, weight, next state). A symbol without an arc is written as it is."""

    def __init__(self, start: object, arcs: dict[tuple[object, str], Arc]):
        self.start, self.arcs = start, arcs

    def step(self, state: object, symbol: str) -> Arc:
        return self.arcs.get((state, symbol), (symbol, 0.0, state))

    def run(self, symbols: Iterable[str]) -> tuple[list[str], float]:
        """What is written for a sequence, and the weight of its path."""
        out, total, state = [], 0.0, self.start
        for s in symbols:
            written, weight, state = self.step(state, s)
            out.append(written)
            total += weight
        return out, total


def composed(machines: list[Transducer], symbols: Iterable[str]) -> Transducer:
    """One transducer that does what the machines do one after another, over the states that ``symbols`` reach."""
    symbols = list(symbols)
    start = tuple(m.start for m in machines)
    arcs: dict[tuple[object, str], Arc] = {}
    known, todo = {start}, [start]
    while todo:
        state = todo.pop()
        for symbol in symbols:
            written, total, ends = symbol, 0.0, []
            for m, own in zip(machines, state, strict=True):
                written, weight, end = m.step(own, written)
                total += weight
                ends.append(end)
            to = tuple(ends)
            arcs[state, symbol] = (written, total, to)
            if to not in known:
                known.add(to)
                todo.append(to)
    return Transducer(start, arcs)


def reported_speech() -> Transducer:
    """After a reporting verb, to the sentence's end, insults I and threats H become I~ and H~."""
    arcs: dict[tuple[object, str], Arc] = {("own", "R"): ("w", 0.0, "reported"), ("reported", "R"): ("w", 0.0, "reported"), ("reported", "."): (".", 0.0, "own")}
    for c in "IH":
        arcs["reported", c] = (f"{c}~", REPORTED, "reported")
    return Transducer("own", arcs)


def negation() -> Transducer:
    """Insults and threats among the SCOPE words after a negation in its clause become I- and H-."""
    arcs: dict[tuple[object, str], Arc] = {}
    for left in range(SCOPE + 1):
        arcs[left, "N"] = ("w", 0.0, SCOPE)
        for end in ",.":
            arcs[left, end] = (end, 0.0, 0)
        for word in ("w", "T"):
            arcs[left, word] = (word, 0.0, max(0, left - 1))
        for c in "IH":
            for word in (c, f"{c}~"):
                arcs[left, word] = (f"{c}-", NEGATED, left - 1) if left else (word, 0.0, 0)
    return Transducer(0, arcs)


def target() -> Transducer:
    """The end of a clause with a target becomes ,+ or .+"""
    arcs: dict[tuple[object, str], Arc] = {}
    for seen in (False, True):
        arcs[seen, "T"] = ("w", 0.0, True)
        for end in ",.":
            arcs[seen, end] = (f"{end}+" if seen else end, 0.0, False)
    return Transducer(False, arcs)


def _taking(letter: str, grades: dict[str, int]) -> dict[tuple[object, str], Arc]:
    """Arcs that take in one kind of word and keep the gravest grade of it in the clause."""
    return {(held, letter + mark): ("w", 0.0, max(held, grade)) for held in range(max(grades.values()) + 1) for mark, grade in grades.items()}


def insult() -> Transducer:
    """Takes insults in and names the clause at its end by the gravest: negated, reported or plain, then with or without a target."""
    arcs = _taking("I", {"-": 1, "~": 2, "": 3})
    for held, kind in ((1, "negated_insult"), (2, "reported_insult"), (3, "insult")):
        for end in (",", ".", ",+", ".+"):
            at = "+" in end
            arcs[held, end] = (f"{end}{'insult_at_target' if at and held == 3 else kind}", INSULT + TARGET * at, 0)
    return Transducer(0, arcs)


def threat() -> Transducer:
    """Takes threats in; a clause with a threat, a target and no insult is named by it, and one with an insult keeps its name."""
    arcs = _taking("H", {"-": 1, "~": 1, "": 2})
    for held, kind in ((0, ""), (1, "softened_threat"), (2, "threat")):
        for end in (",", ".", ",+", ".+"):
            if "+" in end and held:
                arcs[held, end] = (kind, THREAT + TARGET, 0)
            else:
                arcs[held, end] = ("", 0.0, 0)
            for named in KINDS[:4]:
                arcs[held, end + named] = (named, THREAT * (held == 2), 0)
    return Transducer(0, arcs)


def grammar() -> Transducer:
    return composed([reported_speech(), negation(), target(), insult(), threat()], SYMBOLS)


class Grammar:
    """Counts clause kinds of whole texts and their weight, given the learnt stems of the insult class."""

    def __init__(self, stems: list[str]):
        self.whole = {w: c for c, words in (("R", REPORTS), ("N", NEGATIONS), ("T", TARGETS), ("H", THREATS), ("I", INSULTS)) for w in words.split()}
        self.whole |= {s[:-1]: "I" for s in stems if s.endswith("$")}
        self.stems = frozenset(s for s in stems if not s.endswith("$"))
        self.lengths = sorted({len(s) for s in self.stems})
        self.known: dict[str, str] = {}
        machine = grammar()
        self.start, self.arcs = machine.start, {key: (KINDS.index(written) if written in KINDS else -1, weight, to) for key, (written, weight, to) in machine.arcs.items()}

    def symbol(self, token: str) -> str:
        if not token[0].isalpha():
            return "." if token in HARD else ","
        if token in self.whole:
            return self.whole[token]
        return "I" if any(token[:n] in self.stems for n in self.lengths) else "w"

    def count(self, text: str | None) -> list[float]:
        """How many clauses are of each kind, the weight of all those, and how many clauses there are."""
        tokens = TOKEN.findall((text or "").lower())
        new = set(tokens).difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known, new = {}, set(tokens)
        self.known.update((t, self.symbol(t)) for t in new)
        read = "".join(map(self.known.__getitem__, tokens))
        out, total = [0] * len(KINDS), 0.0
        if "I" in read or "H" in read:
            for sentence in read.split("."):
                if "I" in sentence or "H" in sentence:
                    state, held = self.start, 0.0
                    for c in f"{sentence}.":
                        kind, weight, state = self.arcs[state, c]
                        held += weight
                        if c == "," or c == ".":
                            if kind >= 0:
                                out[kind] += 1
                                total += held
                            held = 0.0
        clauses = sum(map(bool, read.replace(",", ".").split(".")))
        return [*map(float, out), total, float(clauses)]


def features(counts: np.ndarray) -> np.ndarray:
    """Logarithms of the counts of each kind, of the matched clauses' weight and of their share."""
    kinds, total, clauses = counts[:, : len(KINDS)], counts[:, len(KINDS) : -1], counts[:, -1:]
    matched = kinds.sum(axis=1, keepdims=True)
    return np.hstack([np.ones_like(clauses), np.log1p(kinds), np.log1p(np.maximum(total, 0)), np.log1p(100 * matched / np.maximum(clauses, 1))])


def fit_weights(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 60) -> np.ndarray:
    """Ridge logistic regression by Newton steps; with one class only, the intercept says so."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        move = np.linalg.solve(hessian, x.T @ (y - p) - penalty * w)
        w += np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-9:
            break
    w[1:] = np.maximum(w[1:], 0)  # a match never speaks for a text
    return w


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text by 4; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4


def training_rows(docs: DataFrame, labels: DataFrame, bound: int = TRAINING_ROWS) -> DataFrame:
    """(text, toxic) of labelled rows outside the held-out fold, about ``bound`` at most."""
    ours = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic")).dropna().filter(remainder(F.col("id")) != HELD_OUT)
    share = min(1.0, bound / max(1, ours.count()))
    ours = ours.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)))).groupBy("id").agg(F.max("toxic").alias("toxic"))
    joined = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text")).join(F.broadcast(ours), "id")  # about ``bound`` rows of two numbers
    return joined.select(F.coalesce("text", F.lit("")).alias("text"), "toxic")


def _word_starts(text: str) -> set[str]:
    out: set[str] = set()
    for w in set(TOKEN.findall(text.lower())):
        if w[0].isalpha():
            out.update(w[:n] for n in range(STEM_SHORTEST, min(len(w), STEM_LONGEST) + 1))
            out.add(w + "$")
    return out


def distinct_texts(rows: DataFrame) -> DataFrame:
    """One of the rows whose texts share their least shingle of three words: copies must not count as evidence again."""
    words = F.split(F.lower("text"), r"\s+")
    on = lambda k: F.slice(words, F.lit(k), F.lit(1 << 30))
    shingles = F.zip_with(F.zip_with(words, on(2), lambda a, b: F.xxhash64(a, b)), on(3), lambda h, c: F.xxhash64(h, c))
    return rows.withColumn("_sig", F.array_min(shingles)).dropDuplicates(["toxic", "_sig"]).drop("_sig")


def learn_stems(rows: DataFrame) -> list[str]:
    """Word starts (and whole words, with a $ at their end) that toxic training texts have and others lack."""
    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    least = max(STEM_DOCS, STEM_SHARE * n1)

    def counts(of: frozenset[str] | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            c: Counter[str] = Counter()
            for batch in batches:
                for text in batch.column(0).to_pylist():
                    c.update(_word_starts(text) if of is None else of.intersection(_word_starts(text)))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], ["stem", "n"])

        return run

    def top(toxic: int, of: frozenset[str] | None) -> dict[str, int]:
        found = rows.filter(F.col("toxic") == toxic).select("text").mapInArrow(counts(of), "stem string, n long").groupBy("stem").agg(F.sum("n").alias("n"))
        if of is None:
            found = found.filter(F.col("n") >= least).orderBy(F.desc("n"), "stem").limit(MOST_STEMS)
        return {r["stem"]: r["n"] for r in found.collect()}

    bad = top(1, None)
    good = top(0, frozenset(bad))
    odds = {s: (k + 0.5) / (n1 + 1) / ((good.get(s, 0) + 0.05) / (n0 + 1)) for s, k in bad.items()}
    clear = {s for s, o in odds.items() if o >= STEM_ODDS}
    out: list[str] = []
    for s in sorted(clear, key=lambda s: (len(s), s)):
        if s.endswith("$"):
            if not any(s.startswith(x) for x in out):
                out.append(s)
        elif not any(x.startswith(s) and len(x) == len(s) + 1 and bad[x] >= 0.9 * bad[s] for x in bad) and not any(s.startswith(x) for x in out):
            out.append(s)
    return out


class Model:
    def __init__(self, stems: list[str], weights: np.ndarray):
        self.stems, self.weights = stems, weights


def counted(texts: DataFrame, stems: list[str], column: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns and ``counts``, the clause kinds of the text."""
    bound_batches(texts.sparkSession)

    @F.pandas_udf("array<double>")
    def kinds(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Grammar(stems)
        for texts in parts:
            yield pd.Series([reader.count(t) for t in texts], dtype=object)
        del reader
        settle()

    return texts.select(*keep, kinds(F.col(column)).alias("counts"))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn stems and weights. Without labelled rows, the seeds and weights of 1 remain."""
    rows = training_rows(docs, labels).persist()
    try:
        stems = learn_stems(distinct_texts(rows))
        got = counted(rows, stems, keep=("toxic",)).groupBy("toxic", "counts").agg(F.count("*").alias("n")).collect()  # of about TRAINING_ROWS rows
    finally:
        rows.unpersist()
    if not got:
        return Model(stems, np.array([-3.0, *[1.0] * (len(KINDS) + 2)]))
    got.sort(key=lambda r: (r["toxic"], r["counts"]))
    x = features(np.repeat(np.array([r["counts"] for r in got]), [r["n"] for r in got], axis=0))
    y = np.repeat(np.array([r["toxic"] for r in got], float), [r["n"] for r in got])
    return Model(stems, fit_weights(x, y))


def score_texts(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """``keep`` columns, score (0 to 1) and predicted of every row.

    Null and empty texts have no clause and get the score of the intercept. The whole text is
    read. Equal texts have equal scores. An empty table gives an empty result.
    """
    weights = model.weights.tolist()
    kinds = counted(docs.select(*keep, F.col(text_col).cast("string").alias("_text")), model.stems, "_text", keep)
    matched = F.aggregate(F.slice("counts", 1, len(KINDS)), F.lit(0.0), lambda s, x: s + x)
    z = F.lit(weights[0])
    for k, w in enumerate(weights[1:-1], 1):
        z = z + F.lit(w) * F.log1p(F.greatest(F.element_at("counts", k), F.lit(0.0)))
    z = z + F.lit(weights[-1]) * F.log1p(100.0 * matched / F.greatest(F.element_at("counts", -1), F.lit(1.0)))
    score = 1 / (1 + F.exp(-z))
    return kinds.select(*keep, score.alias("score")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, with their columns."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col("text").alias("_text"))
    return score_texts(whole, fit(docs, labels), ("_doc",), "_text").filter(F.col("predicted") == 0).select("_doc.*")
