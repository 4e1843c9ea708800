"""Splitting texts into the units within which byte-pair merges act."""

from __future__ import annotations

import functools
import itertools
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tokenizers

# White space as the Unicode property White_Space has it, and the
# two public split patterns, written over it.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
LOWER_CASE_PATTERN = rf"{CONTRACTIONS}|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+"
BYTE_LEVEL_PATTERN = rf"{CONTRACTIONS}| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"

#: Characters of plain texts: on these NFC changes nothing, lower case is letter for letter and every
#: Unicode version agrees which are letters and digits. Texts with others are normalized and split by
#: the library itself, whose Unicode tables are older than those of the regex module.
PLAIN = r"\t-\r -~\xa0-\u012f\u0131-\u024f\u2010-\u2027\u2030-\u205e\u20ac"
NOT_PLAIN = re.compile(f"[^{PLAIN}]")
_NOT_PLAIN_RE2 = "[^" + re.sub(r"\\[xu]([0-9a-f]+)", r"\\x{\1}", PLAIN) + "]"

#: Most entries, and most bytes of words, in each of the two generations of a worker's cache.
CACHE_WORDS, CACHE_BYTES = 150_000, 4 << 20


@functools.cache
def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    out = {b: chr(b) for b in own}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(own))
    return [out[b] for b in range(256)]


class Vocabulary:
    """What the file of a tokenizers BPE model says."""

    def __init__(self, text: str):
        spec = json.loads(text)
        self.ids: dict[str, int] = spec["model"]["vocab"]
        self.merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.suffix: str = spec["model"].get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.lower = spec.get("normalizer") is not None
        self.pattern = regex.compile(LOWER_CASE_PATTERN if self.lower else BYTE_LEVEL_PATTERN)
        found = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.cut = regex.compile(f"({found})") if found else None
        self._text = text
        self._byte_of = {c: b for b, c in enumerate(byte_symbols())}

    @functools.cached_property
    def library(self) -> tokenizers.Tokenizer:
        return tokenizers.Tokenizer.from_str(self._text)

    def library_pieces(self, text: str) -> list[str]:
        """Pre-split words of a text that is not plain, as the library normalizes and splits it."""
        if self.lower:
            text = self.library.normalizer.normalize_str(text)
        byte = self._byte_of
        return [bytes(map(byte.__getitem__, piece)).decode() for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def pieces_of(self, chunks: list[str]) -> tuple[pa.Array, np.ndarray]:
        """(pre-split words of all chunks of plain text in order, where each chunk's begin and the last one's end).

        Chunks of a lower-case pattern hold no white space. Without an apostrophe, which may begin a
        contraction, such a chunk is cut around each digit and each run of marks; the others go
        through the pattern.
        """
        if not self.lower:
            pieces = list(map(self.pattern.findall, chunks))
            return pa.array(itertools.chain.from_iterable(pieces), pa.string()), np.cumsum([0, *map(len, pieces)])
        kept = spread(given := pa.array(chunks, pa.string()))
        if (hard := pc.match_substring(given, "'").to_numpy(zero_copy_only=False)).any():
            at = np.flatnonzero(hard)
            kept = pc.replace_with_mask(kept, pa.array(hard), pa.array([" ".join(self.pattern.findall(chunks[k])) for k in at], pa.string()))
        split = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(kept))
        return split.flatten(), split.offsets.to_numpy() - split.offsets[0].as_py()

    def parts(self, text: str) -> list[tuple[str, int | None]]:
        """The text cut at its special strings: (text, None) or (string, its id)."""
        if self.cut is None or not any(s in text for s in self.special):
            return [(text, None)]
        return [(x, self.special[x] if k % 2 else None) for k, x in enumerate(self.cut.split(text)) if x]

    def split(self, text: str) -> list[tuple[list[str], str, int]]:
        """The text in order: (chunks, "chunks", 0) of plain text, (pre-split words, "pieces", 0) of other text and ([], "", id) of a special string."""
        out: list[tuple[list[str], str, int]] = []
        for part, special in self.parts(text):
            if special is not None:
                out.append(([], "", special))
            elif NOT_PLAIN.search(part):
                out.append((self.library_pieces(part), "pieces", 0))
            else:
                out.append((self.chunks(part.lower() if self.lower else part), "chunks", 0))
        return out

    def chunks(self, text: str) -> list[str]:
        """The text cut at white space so that the pieces of the chunks are the pieces of the text.

        Lower-case patterns drop all white space, so every run of it is a cut. Byte-level patterns
        give a space to the word after it: cut before each space that has a word after it. Texts
        for which that can't be said stay whole.
        """
        if self.lower:
            return text.split()
        if LOOSE.search(text):
            return [text]
        first, *rest = text.split(" ")
        return [first, *map(" ".__add__, rest)]


#: A space that has no word after it.
LOOSE = re.compile(rf" (?:[{SPACE}]|$)")


#: Characters of texts that are split at once.
BLOCK_CHARACTERS = 1_000_000


def blocks(texts: list[str | None]) -> Iterator[list[str | None]]:
    """The texts in order, in lists of about BLOCK_CHARACTERS; a longer text is a list of its own."""
    out: list[str | None] = []
    held = 0
    for text in texts:
        if out and held + len(text or "") > BLOCK_CHARACTERS:
            yield out
            out, held = [], 0
        out.append(text)
        held += len(text or "")
    if out:
        yield out


def spread(texts: pa.Array) -> pa.Array:
    """Plain texts with a space around each digit and each run of marks."""
    return pc.replace_substring_regex(texts, r"([^\pL\pN\s\xa0]+|\pN)", r" \1 ")


def plain_blocks(texts: pa.Array, special: Iterable[str]) -> Iterator[tuple[np.ndarray, pa.Array, str]]:
    """(places, texts there, kind) of about BLOCK_BYTES each; null counts as empty. Kinds are "odd" (not plain, or with
    special strings), "apostrophes" and "simple"."""
    texts = pc.fill_null(texts, "")
    odd = pc.match_substring_regex(texts, _NOT_PLAIN_RE2)
    for s in special:
        odd = pc.or_(odd, pc.match_substring(texts, s))
    odd = odd.to_numpy(zero_copy_only=False)
    apostrophes = pc.match_substring(texts, "'").to_numpy(zero_copy_only=False) & ~odd
    sizes = pc.binary_length(texts).to_numpy()
    for kind, which in (("odd", odd), ("apostrophes", apostrophes), ("simple", ~odd & ~apostrophes)):
        at = np.flatnonzero(which)
        block = (np.cumsum(sizes[at], dtype=np.int64) - 1) // BLOCK_BYTES
        for part in np.split(at, np.flatnonzero(np.diff(block)) + 1):
            if len(part):
                yield part, texts.take(pa.array(part)), kind


#: Bytes of texts whose words are told apart at once.
BLOCK_BYTES = 4 << 20


class WordCache:
    """word -> value for lists of words, in two generations of bounded entries and bytes: words used since the last turn stay."""

    def __init__(self, compute):
        self.compute, self.young, self.old, self.held = compute, {}, {}, 0

    def clear(self) -> None:
        self.young, self.old, self.held = {}, {}, 0

    def many(self, words: Iterable[str]) -> dict:
        """A mapping that holds (at least) the given words."""
        words = set(words)
        missing = list(words.difference(self.young))
        kept = {w: v for w in missing if (v := self.old.get(w)) is not None}
        missing = [w for w in missing if w not in kept] if kept else missing
        self.held += sum(map(len, missing)) + sum(map(len, kept))
        self.young.update(kept)
        self.young.update(zip(missing, self.compute(missing), strict=True))
        found = self.young
        if len(found) >= CACHE_WORDS or self.held >= CACHE_BYTES:
            self.old, self.young, self.held = (found if self.held < 2 * CACHE_BYTES else {}), {}, 0
        return found
