"""Periodic runs, web archives and token alignment, each against a plain version."""

import base64
import gzip
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from roadsift.llm import period_runs, registry, token_alignment, web_archives

SF = "/root/testdata/sf0.001"


def texts_of(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


# Periodic runs.


def plain_runs(w, least, periods):
    """All maximal stretches of each period, the smallest period of each kept."""
    found = {}
    for q in range(1, len(w) // periods + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, periods * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize(("least", "periods"), [(1, 2), (6, 2), (6, 3), (24, 3)])
def test_runs_of_random_words(least, periods):
    rng = random.Random(least + periods)
    for _ in range(200):
        documents = []
        for _ in range(rng.randint(1, 4)):
            n, k = rng.randint(0, 60), rng.choice([1, 2, 3, 5])
            w = [b"%d" % rng.randrange(k) for _ in range(n)]
            if n and rng.random() < 0.5:
                p = rng.randint(1, max(1, n // 3))
                w = [w[i % p] for i in range(n)]
                if rng.random() < 0.5:
                    w[rng.randrange(n)] = b"z"
            documents.append(w)
        for w, (runs, _) in zip(documents, period_runs._block(documents, least, periods), strict=True):
            assert [(r["start"], r["length"], r["period"]) for r in runs] == plain_runs(w, least, periods)


def test_odd_rows_have_runs_too(odd, docs):
    rows = period_runs.find_runs(odd.union(docs([(9, "a b " * 40), (10, " \t\n"), (11, "x " * 3000)]).select(*odd.columns[:5], *(F.lit(7) for _ in odd.columns[5:])))).collect()
    told = defaultdict(list)
    for r in rows:
        told[r["doc_id"]].append(r)
    assert len(rows) == odd.count() + 3 and len(told[3]) == 2
    for i in (1, 2, 10):
        assert told[i][0]["n_words"] == 0 and told[i][0]["runs"] == [] and told[i][0]["best"] is None and told[i][0]["collapsed"] == ""
    assert told[9][0]["collapsed"] == "a b" and tuple(told[9][0]["best"]) == (0, 80, 2)
    assert told[11][0]["collapsed"] == "x" and tuple(told[11][0]["best"]) == (0, 3000, 1)
    assert period_runs.find_runs(docs([])).count() == 0


def test_op11_digests(spark):
    text, rows = texts_of(spark), registry.op11_period_runs(spark, SF).collect()
    assert len(rows) == len(text)
    for r in rows:
        w = (text[r["doc_id"]] or "").encode().split()
        h, n = zlib.crc32(str(r["doc_id"]).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(w, 24, 3) if n < 1500 else [(x["start"], x["length"], x["period"]) for x in next(iter(period_runs._block([w], 24, 3)))[0]]
        gone = {i for s, m, q in runs for i in range(s + q, s + m)}
        assert r["n_runs"] == len(runs)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None, None, None))
        assert (r["start"], r["length"], r["period"]) == best
        assert r["exponent_milli"] == (None if best[0] is None else 1000 * best[1] // best[2])
    assert sum(r["n_runs"] for r in rows) > 5


# Web archives.



def test_arc_versions_and_broken_records():
    records = [("http://a.org/x y", "199612041530", "text/html", b"HTTP/1.0 200 OK\r\nX: 1\r\n\r\nbody\n\n"), ("dns:a.org", "19970101000000", "text/dns", b"a.org IN A 1.2.3.4\n"), ("http://b.org/", "notadate", "text/html", b"plain")]
    for version in (1, 2):
        data = web_archives.arc_bytes("t.arc", version, iter(records))
        for stored in (data, gzip.compress(data[:100]) + gzip.compress(data[100:])):
            told = [web_archives.warc_fields("t.arc", r) for r in web_archives.parse_arc(stored)]
            assert [t["type"] for t in told] == ["warcinfo", "response", "resource", None]
            assert (told[1]["date"], told[1]["uri"], told[1]["payload_bytes"]) == ("1996-12-04T15:30:00Z", "http://a.org/x y", 6)
            assert told[1]["payload_digest"] == base64.b32encode(hashlib.sha1(b"body\n\n").digest()).decode()
            assert told[3]["problem"] == "date"
        first, *rest = web_archives.parse_arc(data[:-5])
        assert rest[-1].problem == "truncated" and first.fields["URL"] == "filedesc://t.arc"
    told = list(web_archives.parse_arc(b"no header at all\n" + web_archives.arc_bytes("t.arc", 2, iter(records[:1]))))
    assert [r.problem for r in told] == ["header line", None, None]


def test_warc_streams_across_pieces():
    record = lambda block: b"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <x>\r\nWARC-Date: d\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(block), block)
    blocks = [b"", b"a\r\n\r\nWARC/1.1\r\n\r\n", b"\n" * 50, "ü".encode() * 99]
    data = b"".join(map(record, blocks))
    for size in (1, 7, 1000):
        told = list(web_archives.read_stream(data[i : i + size] for i in range(0, len(data), size)))
        assert [t["payload"] for t in told] == blocks
    with pytest.raises(ValueError, match="truncated"):
        list(web_archives.read_stream([data[:-1]]))
    with pytest.raises(ValueError, match="doesn't end"):
        list(web_archives.read_stream([data.replace(b"Content-Length: 17", b"Content-Length: 16")]))


PAGES = [(1, "http://a/", "same"), (5, "http://b/", "same"), (3, None, "same"), (None, "http://c/", "same"), (7, "http://d/ e", None), (8, "ftp://d/", ""), (11, "filedesc://x", "version?"), (12, "nothing", "HTTP/1.0 200 OK\r\n\r\n"), (9, "http://e/", "x\r\n\r\nWARC/1.1\r\n" * 3), (9, "http://e/", "x\r\n\r\nWARC/1.1\r\n" * 3), (10, "http://ü/", "ü" * 70000)]


def expected(pages):
    best = {}
    for page, _, html in pages:
        best[html or ""] = max(best.get(html or "", -1), -1 if page is None else page)
    return Counter((p, len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(), "response" if p == best[h or ""] else "revisit", None if p == best[h or ""] else best[h or ""]) for p, _, h in pages)


def test_pages_through_archives(spark):
    pages = spark.createDataFrame([(*p, 1) for p in PAGES], "page_id long, url string, html string, head int")
    assert Counter(map(tuple, web_archives.archive_pages(pages).collect())) == expected(PAGES)
    assert web_archives.archive_pages(pages.filter("false")).count() == 0


def test_op12_digests(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    assert Counter(map(tuple, registry.op12_web_archives(spark, SF).collect())) == expected(pages)


# Token alignment.


class Plain:
    """Alignment without windows, by walking through both token lists."""

    def __init__(self):
        self.a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f, open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as g:
            self.spelled = token_alignment.Aligner(f.read(), g.read()).spelled

    def align(self, text):
        if not text:
            return None
        tokens = [self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)]
        parts = [[s[i] for i in ids] for s, ids in zip(self.spelled, tokens, strict=True)]
        if any(b"".join(p) != (" " + text).encode() for p in parts):
            return None
        (a, b), links, groups, i, j, x, y = tokens, [], [], 0, 0, 0, 0
        held = [[], []]
        while i < len(a):
            links.append((a[i], b[j]))
            at, to = x + len(parts[0][i]), y + len(parts[1][j])
            if at <= to:
                held[0].append(a[i])
                i, x = i + 1, at
            if to <= at:
                held[1].append(b[j])
                j, y = j + 1, to
            if at == to:
                groups.append("|".join(",".join(map(str, h)) for h in held))
                held = [[], []]
        return a, b, groups, links


@pytest.fixture(scope="module")
def plain():
    return Plain()


def expected_alignment(plain, texts):
    told = [plain.align(t) for t in texts]
    count = Counter(link for x in told if x for link in set(x[3]))
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    return [(len(x[0]), len(x[1]), len(x[2]), len(x[3]), sum(count[k] == best[k[0]] for k in x[3]), sum(count[k] for k in x[3]), ";".join(x[2])) if x else (0, 0, 0, 0, 0, 0, "") for x in told]


ODD_TEXTS = ["a  b", "x ▁ y", "<|endoftext|> x <s> </s>", "tab\tx\n y  ", " lead", "trail ", " ", "\x00 null", "ab" * 3000, "it's we'll 12 345 don’t", "the cat the cat", "the cat the cat", "line\nline\n\nend", "½ x² ﬀ", "x\u0085y\xa0z"]


def test_alignment_of_odd_texts(odd, docs, plain, monkeypatch):
    monkeypatch.setattr(token_alignment, "BLOCK_CHARACTERS", 300)
    all_docs = odd.union(docs([(100 + k, t) for k, t in enumerate(ODD_TEXTS)]).select(*odd.columns[:5], *(F.lit(7) for _ in odd.columns[5:])))
    own = Counter()
    rows = [(r["doc_id"], r["text"]) for r in all_docs.collect()]
    for (i, _), x in zip(rows, expected_alignment(plain, [t for _, t in rows]), strict=True):
        own[i, *x] += 1
    got = token_alignment.align_tokens(all_docs, registry.BYTE_BPE, registry.PIECE_BPE)
    assert Counter((r["doc_id"], *(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"))) for r in got.collect()) == own
    assert token_alignment.align_tokens(docs([]), registry.BYTE_BPE, registry.PIECE_BPE).count() == 0
    assert [tuple(r) for r in token_alignment.align_tokens(docs([(1, None)]), registry.BYTE_BPE, registry.PIECE_BPE, digest=True).select("doc_id", "n_links", "count_sum", "groups").collect()] == [(1, 0, 0, "")]


def test_op13_digests(spark, plain):
    text = texts_of(spark)
    own = {i: (*x[:6], hashlib.sha256(x[6].encode()).hexdigest() if x[6] else "") for i, x in zip(text, expected_alignment(plain, list(text.values())), strict=True)}
    got = {r["doc_id"]: tuple(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")) for r in registry.op13_token_alignment(spark, SF).collect()}
    assert got == own
