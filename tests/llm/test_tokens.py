import base64
import hashlib
import random
import zlib

import numpy as np
import pytest
import tiktoken
from public_tokenizers import PATTERN
from tokenizers import Tokenizer

from ledgerlight.llm import packing, vocabulary
from ledgerlight.llm.byte_bpe import decode_ids, encode_texts, round_trip
from ledgerlight.llm.merges import PairTable, merge_all
from ledgerlight.llm.pretokens import distinct, split
from ledgerlight.llm.queries import RANKS, WORDS
from ledgerlight.llm.token_counts import token_counts
from ledgerlight.llm.vocabulary import byte_vocabulary, ids_of_texts, word_counts, word_ids, word_vocabulary

LETTERS = "a bS's\t\n '!2é lrevtmd  .,"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def rank_library():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def odd_texts():
    picked = random.Random(1)
    made = ["".join(picked.choice(LETTERS) for _ in range(picked.randrange(60))) for _ in range(1500)]
    return made + [
        "", "  ", "it's 's 'll  \n's it'll've '''s 'S I'M x'dd 12 3 4.5 <|endoftext|> a<|startoftext|><|endoftext|>",
        "ΑΣ Σ İstanbul ñ é 日本語テキスト  x\x1cy \x85z", "a" * 3000 + "!" * 500, "½ ² ٣ Ⅷ é́ क्षि ไทย 👩‍👩‍👧",
    ]


def raw(ids):
    return np.array(ids, "<u4").tobytes()


def test_word_ids_are_the_librarys(library, odd_texts):
    vocabulary = word_vocabulary(WORDS)
    wanted = [raw(e.ids) for e in library.encode_batch(odd_texts, add_special_tokens=False)]
    assert word_ids(vocabulary, odd_texts) == wanted
    assert word_counts(vocabulary, odd_texts).tolist() == [len(x) // 4 for x in wanted]


def test_byte_ids_are_the_librarys_and_decode_back(rank_library, odd_texts):
    vocabulary = byte_vocabulary(RANKS)
    found = ids_of_texts(vocabulary, odd_texts)
    assert found == [raw(rank_library.encode_ordinary(t)) for t in odd_texts]
    assert [vocabulary.decode(x) for x in found] == [t.encode() for t in odd_texts]


def test_whole_tokens_are_proved(library):
    whole = word_vocabulary(WORDS).whole
    picked = random.Random(2).sample(sorted(whole), 300)
    alone = [w for w in picked if len(split([w], keep_space=False).starts) == 1]
    assert len(alone) > 200
    assert all(library.encode(w, add_special_tokens=False).ids == [whole[w]] for w in alone if w == w.lower())


def test_long_words_merge_like_short_ones():
    table = PairTable(np.array([0, 1, 2]), np.array([0, 1, 0]), np.array([0, 1, 2]), np.array([1, 2, 3]))
    rows = [np.array([0] * n, np.int32) for n in (1, 2, 3, 5, 9, 1500)]
    flat, sizes = np.concatenate(rows), np.array([len(r) for r in rows])

    def plain(word):
        word = list(word)
        ranks = {(0, 0): (0, 1), (1, 1): (1, 2), (2, 0): (2, 3)}
        while True:
            found = [(ranks[p][0], i) for i, p in enumerate(zip(word, word[1:])) if p in ranks]
            if not found:
                return word
            _, i = min(found)
            word[i:i + 2] = [ranks[word[i], word[i + 1]][1]]

    assert merge_all(flat, sizes, table) == [raw(plain(r)) for r in rows]


def test_distinct_pre_tokens_point_back():
    texts = ["one two one", "", "two  three's\n"]
    pieces = split(texts, keep_space=True)
    words, index = distinct(pieces)
    assert len(set(words)) == len(words)
    told = [""] * 3
    for i, owner in zip(index.tolist(), pieces.owner.tolist()):
        told[owner] += words[i]
    assert told == texts


def test_counts_of_odd_documents(odd_docs, no_docs, library):
    rows = token_counts(odd_docs, WORDS).collect()
    assert len(rows) == odd_docs.count() and rows[0].asDict().keys() == {"doc_id", "n_bytes", "n_tokens", "over_limit"}
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by_id[3]["n_tokens"] == by_id[4]["n_tokens"] == by_id[5]["n_tokens"] == by_id[4]["n_bytes"] == 0
    assert by_id[7]["n_tokens"] == 500_000 and by_id[7]["over_limit"]
    assert sorted(r["n_tokens"] for r in rows if r["doc_id"] is None)[0] == 0
    for r in odd_docs.where("doc_id in (1, 6, 8, 9)").collect():
        assert by_id[r["doc_id"]]["n_tokens"] == len(library.encode(r["text"], add_special_tokens=False).ids)
    assert token_counts(no_docs, WORDS).count() == 0


def test_documents_go_through_ids_and_back(odd_docs, no_docs, rank_library):
    for r in round_trip(odd_docs, RANKS).join(odd_docs.select("doc_id", "text"), "doc_id").collect():
        ids = raw(rank_library.encode_ordinary(r["text"] or ""))
        assert r["ids_sha256"] == hashlib.sha256(ids).hexdigest() and r["n_tokens"] == len(ids) // 4
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    coded = encode_texts(odd_docs.where("doc_id = 8"), RANKS)
    assert bytes(decode_ids(coded, RANKS).first()["decoded"]).decode() == odd_docs.where("doc_id = 8").first()["text"]
    assert round_trip(no_docs, RANKS).count() == 0


def check_packing(docs, library, window):
    rows = [r.asDict() | {"ids": bytes(r["ids"])} for r in packing.pack(docs, WORDS, window).collect()]
    wanted = sorted(
        raw(library.encode(r["text"] or "", add_special_tokens=False).ids + [2]) for r in docs.select("text").collect()
    )
    sequences = {}
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"] and 0 < r["length"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(sequences) == list(range(len(sequences)))
    padding = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    assert sum(r["length"] for r in rows) == sum(len(x) // 4 for x in wanted)
    return rows, wanted, padding


def test_packing_places_every_id_once(some_docs, library):
    docs = some_docs.select("doc_id", "text")
    rows, wanted, padding = check_packing(docs, library, 512)
    joined = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        assert r["start"] == len(joined.get(r["doc_id"], b"")) // 4
        joined[r["doc_id"]] = joined.get(r["doc_id"], b"") + r["ids"]
        assert zlib.crc32(r["ids"]) >= 0
    assert sorted(joined.values()) == wanted and padding == 0


def test_packing_of_odd_documents(odd_docs, no_docs, library):
    small = odd_docs.where("doc_id is null or doc_id <> 7")
    _, _, padding = check_packing(small, library, 64)
    assert padding == 0
    assert packing.pack(no_docs, WORDS).count() == 0
    with pytest.raises(ValueError):
        packing.pack(no_docs, WORDS, window=100)


def test_window_plans_use_every_piece_once():
    picked = np.random.default_rng(3)
    for _ in range(20):
        lengths = picked.integers(1, 257, picked.integers(1, 3000))
        histogram = {int(k): int(n) for k, n in zip(*np.unique(lengths, return_counts=True))}
        plan = packing.plan_windows(histogram, 256)
        taken = {}
        for length, first, behind, *_ in plan.slots:
            taken.setdefault(length, []).append((first, behind))
        for length, n in histogram.items():
            ranges = sorted(taken[length])
            assert ranges[0][0] == 0 and ranges[-1][1] == n
            assert all(a[1] == b[0] for a, b in zip(ranges, ranges[1:]))


def test_least_squares_fit_an_exact_mixture():
    counts = np.zeros(65, np.int64)
    counts[[40, 24]], counts[[50, 14]] = 70, 30
    combos, _ = packing.combinations(counts, 64)
    x = packing.least_squares(combos, counts)
    made = np.bincount(combos.ravel(), weights=np.repeat(x, 3), minlength=65)
    assert abs(made[1:] - counts[1:]).max() < 1


def test_words_that_come_again_stay_known(monkeypatch):
    """Where more words come than are kept, those of every batch are merged once and not again."""
    monkeypatch.setattr(vocabulary, "KNOWN_WORDS", 60)
    words = vocabulary.WordVocabulary(WORDS)
    usual = [f"qzx{'jk' * i}w" for i in range(1, 20)]
    plain, merged, merge = words.merge(usual), [], words.merge
    monkeypatch.setattr(words, "merge", lambda some: merged.extend(some) or merge(some))
    for k in range(20):
        fresh = [f"xq{k}vzj{i}kq" for i in range(30)]
        assert words.encode([*usual, *fresh])[: len(usual)] == plain
        assert len(words.known) <= 60 and len(words.older) <= 60
    assert all(merged.count(w) == 1 for w in usual)
    assert words.encode(["the", "xq"])[0] == words.whole_ids["the"]
