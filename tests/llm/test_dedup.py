import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F

from roadsift.llm import components, near_dedup, registry, substring_dedup


def corpus():
    """Copies, near copies, shared passages, repeats within a text and short texts."""
    rng = random.Random(5)
    word = lambda: rng.choice("ab cd ef gh ij kl mn op qr st uv wx".split()) + str(rng.randrange(400))
    base = [[word() for _ in range(rng.randrange(40, 160))] for _ in range(12)]
    out = [list(b) for b in base] + [list(base[0]), list(base[1])]
    for b in base[:6]:
        c = list(b)
        for _ in range(2):
            c[rng.randrange(len(c))] = word()
        out.append(c)
    passage = [word() for _ in range(50)]
    out += [b[:20] + passage + b[20:40] for b in base[6:9]] + [passage + ["x"] + passage, base[3][:34], ["one", "two"], ["ONE", "two"], []]
    return [(k, " ".join(w)) for k, w in enumerate(out)] + [(100, None), (101, "tab\tseparated\x0bwords not"), (102, "a\n" * 80)]


def removed(docs, window):
    words = {d: substring_dedup.split_words(t) for d, t in docs}
    seen = Counter(tuple(w[i : i + window]) for w in words.values() for i in range(len(w) - window + 1))
    out = {}
    for d, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out[d] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode())
    return out


def test_substring_dedup_equals_brute_force(docs):
    rows = corpus()
    for window in (35, 7):
        got = {r["doc_id"]: (r["dedup"]["n_words"], r["dedup"]["n_removed"], r["dedup"]["kept"]) for r in substring_dedup.remove_repeats(docs(rows), window).collect()}
        assert got == removed(rows, window)


def test_substring_dedup_odd_rows(odd, docs):
    rows = substring_dedup.remove_repeats(odd)
    assert rows.columns == [*odd.columns, "dedup"]
    got = sorted((r["doc_id"] or 0, r["text"] or "", r["dedup"]["n_removed"]) for r in rows.collect())
    assert [g[0] for g in got] == sorted(r["doc_id"] or 0 for r in odd.collect())
    assert next(g[2] for g in got if g[0] == 5) > 1900  # its own words repeat
    assert substring_dedup.remove_repeats(docs([])).count() == 0


def test_substring_dedup_of_repeated_rows_and_a_column_of_the_same_name(docs):
    text = " ".join(f"w{k}" for k in range(50))
    rows = docs([(1, text)] * 40 + [(2, "short one"), (2, "short one")]).withColumn("dedup", F.lit("mine")).withColumn("x.y", F.lit(1))
    out = substring_dedup.remove_repeats(rows)
    assert out.columns == [*rows.columns, "_dedup"]
    got = Counter((r["doc_id"], r["_dedup"]["n_removed"], r["dedup"]) for r in out.collect())
    assert got == {(1, 50, "mine"): 40, (2, 0, "mine"): 2}


def test_substring_dedup_query_digests(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in registry.op2_substring_dedup(spark, sf).collect()}
    assert got == {d: (n, k, hashlib.sha256(kept.encode()).hexdigest()) for d, (n, k, kept) in removed(rows, 35).items()}


def components_of(docs, size):
    def shingles(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()

    sets = {d: shingles(t) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(s), find(d), find(d) == d) for d, s in sets.items()}


def test_near_dedup_equals_brute_force(docs):
    rows = corpus()
    for size in (4, 5):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(docs(rows), size).collect()}
        assert got == components_of(rows, size)


def template_pages(n, sets_of=500, seed=3):
    """Pages of one template at similarities of about 0.74, each some of the words its own, with a few pairs at 0.8 and more."""
    rng = random.Random(seed)
    template, fresh, out = [f"t{k}" for k in range(sets_of)], iter(range(10**9)), []
    for k in range(n):
        page = list(template)
        for i in rng.sample(range(0, sets_of, 5), 8):
            page[i] = f"u{next(fresh)}"
        if k % 9 == 8:  # linked with an earlier page, by words that only these two have
            page = list(out[rng.randrange(len(out))])
            for i in rng.sample(range(0, sets_of, 5), 10):
                page[i] = f"u{next(fresh)}"
        out.append(page)
    return [(k, " ".join(p)) for k, p in enumerate(out)]


def test_near_dedup_finds_all_links_of_a_large_family(docs):
    rows = template_pages(600)
    expected = components_of_many(rows, 5)
    assert 400 < len(set(expected.values())) < 600
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs(rows)).collect()}
    assert got == expected


def spread_copies(n, length=160, seed=4):
    """Copies of one text with few to very many changed words, among them many that link with a few others only, and unlike texts."""
    rng = random.Random(seed)
    base, fresh, out = [f"t{k}" for k in range(length)], iter(range(10**9)), []
    for k in range(n):
        copy = list(base)
        for i in rng.sample(range(length), rng.choice((0, 1, 2, 3, 4, 6, 8, 12))):
            copy[i] = f"u{next(fresh)}"
        out.append((k, " ".join(copy)))
    return out + [(n + k, " ".join([*base[:60], *(f"v{next(fresh)}" for _ in range(60))])) for k in range(200)]


def test_near_dedup_of_a_large_group_of_near_copies(docs):
    rows = spread_copies(1200)
    expected = components_of_many(rows, 4)
    assert 250 < len(set(expected.values())) < 700
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs(rows), 4).collect()}
    assert got == expected


def components_of_many(docs, size):
    """Brute force over arrays: the shared shingles of all pairs at once."""
    import numpy as np

    sets = [{tuple(w[i : i + size]) for i in range(len(w) - size + 1)} for w in (t.split() for _, t in docs)]
    count = Counter(s for x in sets for s in x)
    place = {s: k for k, s in enumerate(s for s, c in count.items() if c > 1)}
    m = np.zeros((len(docs), len(place)), np.float32)
    for k, x in enumerate(sets):
        m[k, [place[s] for s in x if s in place]] = 1
    common, n = m @ m.T, np.array([len(x) for x in sets])
    linked = 100 * common >= 80 * (n[:, None] + n[None, :] - common)
    np.fill_diagonal(linked, True)
    out = np.arange(len(docs))
    while True:
        least = np.array([out[np.flatnonzero(row)].min() for row in linked])
        if (least == out).all():
            return {d: docs[k][0] for (d, _), k in zip(docs, out.tolist(), strict=True)}
        out = least


def test_near_dedup_odd_rows(odd, docs):
    got = near_dedup.near_duplicates(odd).collect()
    assert sorted(r["doc_id"] or 0 for r in got) == sorted(r["doc_id"] or 0 for r in odd.collect())
    assert all(r["kept"] for r in got) and next(r["component_id"] for r in got if r["doc_id"] is None) is None
    assert near_dedup.near_duplicates(docs([])).count() == 0
    kept = near_dedup.one_of_each(docs([(2, "a b c d e f"), (1, "A b c d e f"), (3, None), (4, "")]))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4]


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(20)] + [(50, 40), (60, 60)], "a long, b long")
    got = {r["node"]: r["component"] for r in components.connected_components(links).collect()}
    assert got == {k: 0 for k in range(21)} | {40: 40, 50: 40}
