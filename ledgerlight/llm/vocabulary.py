"""Vocabularies of public tokenizers: pair tables, and pre-tokens to ids with a bounded memory of known words."""

from __future__ import annotations

import base64
import json
import unicodedata

import numpy as np

from ledgerlight.llm.common import once
from ledgerlight.llm.merges import PairTable, merge_all
from ledgerlight.llm.pretokens import Pieces, distinct, split

KNOWN_WORDS = 120_000


class Vocabulary:
    """Pre-tokens to ids. ``whole`` holds the pre-tokens that are one token by themselves. ``known`` holds words met
    lately, ``older`` those met before them: words that come again and again stay, the others go.
    """

    whole: dict[str, int]
    whole_ids: dict[str, bytes]
    known: dict[str, bytes]
    older: dict[str, bytes]
    table: PairTable

    def start_ids(self, raw: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Ids of single bytes; ``stops`` are the places behind each word's last byte."""
        raise NotImplementedError

    def merge(self, words: list[str]) -> list[bytes]:
        """Ids of words by merging alone, as little-endian unsigned 32-bit integers."""
        joined = "".join(words)
        raw = np.frombuffer(joined.encode(), np.uint8)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        wide = np.concatenate(([0], np.cumsum(1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF))))
        stops = wide[np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))]
        return merge_all(self.start_ids(raw, stops), np.diff(stops, prepend=0), self.table)

    def encode(self, words: list[str]) -> list[bytes]:
        """Ids of words: a look-up for known words and whole tokens, merges for the rest."""
        out = list(map(self.known.get, words))
        missed = [i for i, ids in enumerate(out) if ids is None]
        if missed:
            names = [words[i] for i in missed]
            ids = [older or whole for older, whole in zip(map(self.older.get, names), map(self.whole_ids.get, names))]
            rest = [k for k, there in enumerate(ids) if there is None]
            if rest:
                for k, made in zip(rest, self.merge([names[k] for k in rest])):
                    ids[k] = made
            for i, there in zip(missed, ids):
                out[i] = there
            self.keep(names, ids)
        return out

    def keep(self, words: list[str], ids: list[bytes]) -> None:
        if len(self.known) + len(words) > KNOWN_WORDS:
            self.known, self.older = {}, self.known
        self.known.update(zip(words[:KNOWN_WORDS], ids))


def byte_characters() -> list[str]:
    """The character that stands for each byte: printable Latin-1 for itself, the others from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class WordVocabulary(Vocabulary):
    """Lower-cased words whose last byte carries a word end; read from a tokenizers file."""

    keep_space = False

    def __init__(self, path: str):
        self.known, self.older, self.whole_ids = {}, {}, {}
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model = told["model"]
        ids, end = model["vocab"], model["end_of_word_suffix"]
        self.special = {x["content"]: x["id"] for x in told["added_tokens"]}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right = (np.array([ids[m[k]] for m in merges]) for k in (0, 1))
        merged = np.array([ids[a + b] for a, b in merges])
        self.table = PairTable(left, right, np.arange(len(merges)), merged)
        letters = byte_characters()
        self.inner = np.array([ids[c] for c in letters], np.int32)
        self.last = np.array([ids[c + end] for c in letters], np.int32)
        self.whole = self.prove_whole(ids, end, {c: b for b, c in enumerate(letters)})
        self.whole_ids = {w: i.to_bytes(4, "little") for w, i in self.whole.items()}

    def prove_whole(self, ids: dict[str, int], end: str, byte_of: dict[str, int]) -> dict[str, int]:
        """Vocabulary strings that end a word and that the merges put together to themselves alone."""
        found = {}
        for token, number in ids.items():
            if token.endswith(end) and all(c in byte_of for c in token[: -len(end)]):
                try:
                    found[bytes(byte_of[c] for c in token[: -len(end)]).decode()] = number
                except UnicodeDecodeError:
                    continue
        words = [w for w in found if w]
        return {w: found[w] for w, x in zip(words, self.merge(words)) if x == found[w].to_bytes(4, "little")}

    def start_ids(self, raw: np.ndarray, stops: np.ndarray) -> np.ndarray:
        out = self.inner[raw]
        out[stops - 1] = self.last[raw[stops - 1]]
        return out

    def normal(self, text: str) -> str:
        """NFC, then lower case character by character: no final sigma."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def pieces(self, texts: list[str]) -> Pieces:
        return split([self.normal(t) for t in texts], keep_space=False)


class ByteVocabulary(Vocabulary):
    """Byte strings with ranks; any two neighbours whose joint string is listed may merge."""

    keep_space = True

    def __init__(self, path: str):
        self.known, self.older, self.whole_ids = {}, {}, {}
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}
        ranks = self.ranks
        pairs = [
            (ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t))
            if t[:i] in ranks and t[i:] in ranks
        ]
        left, right, rank = np.array(pairs).T
        self.table = PairTable(left, right, rank, rank)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.whole = {}
        for token, number in ranks.items():
            try:
                self.whole[token.decode()] = number
            except UnicodeDecodeError:
                continue
        self.whole_ids = {w: i.to_bytes(4, "little") for w, i in self.whole.items()}
        self.strings: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, number in ranks.items():
            self.strings[number] = token

    def start_ids(self, raw: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return self.single[raw]

    def pieces(self, texts: list[str]) -> Pieces:
        return split(texts, keep_space=True)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def word_vocabulary(path: str) -> WordVocabulary:
    """Read once per worker process."""
    return once(("words", path), lambda: WordVocabulary(path))


def byte_vocabulary(path: str) -> ByteVocabulary:
    return once(("bytes", path), lambda: ByteVocabulary(path))


def ids_of_texts(vocabulary: Vocabulary, texts: list[str]) -> list[bytes]:
    """The ids of each text, in order, as little-endian unsigned 32-bit integers."""
    pieces = vocabulary.pieces(texts)
    words, index = distinct(pieces)
    coded = vocabulary.encode(words)
    flat = np.frombuffer(b"".join(coded), "<u4")
    sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
    offsets = np.cumsum(sizes) - sizes
    each = sizes[index]
    ends = np.cumsum(each)
    gather = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(offsets[index] - (ends - each), each)
    ids = flat[gather].astype("<u4") if len(each) else np.empty(0, "<u4")
    totals = np.bincount(pieces.owner, weights=each, minlength=len(texts)).astype(np.int64)
    stops = np.cumsum(totals) * 4
    raw = ids.tobytes()
    return [raw[b - 4 * n:b] for b, n in zip(stops.tolist(), totals.tolist())]


def counts_of_texts(vocabulary: Vocabulary, texts: list[str]) -> np.ndarray:
    """How many ids each text has: one for each whole token, the merged ones counted once per distinct word."""
    pieces = vocabulary.pieces(texts)
    words, index = distinct(pieces)
    sizes = np.ones(len(words), np.int64)
    rest = [i for i, w in enumerate(words) if w not in vocabulary.whole]
    if rest:
        sizes[rest] = [len(x) // 4 for x in vocabulary.encode([words[i] for i in rest])]
    return np.bincount(pieces.owner, weights=sizes[index], minlength=len(texts)).astype(np.int64)


def special_parts(vocabulary: WordVocabulary, text: str) -> list[str]:
    """A text cut at the special strings in it, which stay as parts of their own."""
    parts = [text]
    for mark in vocabulary.special:
        parts = [y for x in parts for y in ([x] if x in vocabulary.special else around(x, mark))]
    return parts


def around(text: str, mark: str) -> list[str]:
    pieces = text.split(mark)
    return [x for i, piece in enumerate(pieces) for x in ([mark, piece] if i else [piece])]


def word_ids(vocabulary: WordVocabulary, texts: list[str]) -> list[bytes]:
    """Ids of whole texts; a special string inside a text is one token."""
    marked = [i for i, t in enumerate(texts) if any(s in t for s in vocabulary.special)]
    if not marked:
        return ids_of_texts(vocabulary, texts)
    out = ids_of_texts(vocabulary, ["" if i in set(marked) else t for i, t in enumerate(texts)])
    for i in marked:
        parts = special_parts(vocabulary, texts[i])
        coded = ids_of_texts(vocabulary, ["" if p in vocabulary.special else p for p in parts])
        out[i] = b"".join(
            vocabulary.special[p].to_bytes(4, "little") if p in vocabulary.special else x for p, x in zip(parts, coded)
        )
    return out


def word_counts(vocabulary: WordVocabulary, texts: list[str]) -> np.ndarray:
    """Number of ids of whole texts, with the same rule for special strings."""
    marked = {i for i, t in enumerate(texts) if any(s in t for s in vocabulary.special)}
    out = counts_of_texts(vocabulary, ["" if i in marked else t for i, t in enumerate(texts)])
    for i in marked:
        parts = special_parts(vocabulary, texts[i])
        out[i] = counts_of_texts(vocabulary, ["" if p in vocabulary.special else p for p in parts]).sum()
        out[i] += sum(p in vocabulary.special for p in parts)
    return out
