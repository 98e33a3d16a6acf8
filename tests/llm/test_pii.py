import random
import re

import pytest

from ledgerlight.llm import pii

# The definitions of the base kinds.
DEFINED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def sound(kind, match):
    digits = [int(c) for c in match if c.isdigit()]
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits)))
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def plain(text):
    found = [
        (m.start(), i, f"{kind}:{m.start()}:{m.end()}") for i, (kind, pattern) in enumerate(DEFINED.items())
        for m in re.finditer(pattern, text) if sound(kind, m.group())
    ]
    return ",".join(x for _, _, x in sorted(found))


@pytest.fixture(scope="module")
def texts():
    picked = random.Random(3)
    made = []
    for letters, longest in (("ab@.-+%_ 0123456789 ()é\n😀A", 70), ("0123456789 -+().", 60), ("ab@.%-", 30)):
        made += ["".join(picked.choice(letters) for _ in range(picked.randrange(longest))) for _ in range(1500)]
    return made + [
        "", "a@b.c..d@e.f", "a@b.com%x@y.zz", "x.@y.z", "1.2.3.4.5.6.7.8", "999.1.1.1 001.002.003.004",
        "4111 1111 1111 1111", "4111-1111-1111-1111 5500000000000004 é 340000000000009", "+1 (017) 555-7713 call",
        "1 " * 30_000, "9" * 60_000, "a." * 40_000 + "@x.y", "😀a@b.co 😀 1.2.3.4", "1 2 3 4 5 6 7 8 9 0 1 2 3 " * 20,
    ]


def test_base_spans_are_those_of_the_definitions(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.find(docs).collect():
        assert r["base"] == plain(texts[r["doc_id"]])
        told = [x.split(":") for x in r["spans"].split(",") if x]
        kept = [x for x in told if x[0] in DEFINED]
        assert ",".join(":".join(x) for x in kept) == r["base"]
        for kind in DEFINED:
            assert r[f"n_{kind}"] == sum(x[0] == kind for x in kept)
        assert [int(x[1]) for x in told] == sorted(int(x[1]) for x in told)


def test_documents_spans_and_added_kinds(some_docs):
    texts = {r["doc_id"]: r["text"] for r in some_docs.collect()}
    secrets = 0
    for r in pii.find(some_docs).collect():
        assert r["base"] == plain(texts[r["doc_id"]])
        for kind, a, b in (x.split(":") for x in r["spans"].split(",") if x):
            if kind == "secret":
                secrets += 1
                assert re.fullmatch("[0-9a-fA-F]{32,}", texts[r["doc_id"]][int(a):int(b)])
    assert secrets == sum(len(re.findall("(?i)token = \"[0-9a-f]{40}\"", t)) for t in texts.values())


def test_expectation_maximisation_tells_good_labelers_from_bad_ones():
    picked = random.Random(9)
    counts = {}
    for _ in range(20_000):
        truth = picked.random() < 0.3
        votes = tuple(
            (1 if truth else -1) * (1 if picked.random() < right else -1) for right in (0.95, 0.9, 0.85, 0.5)
        )
        counts[votes] = counts.get(votes, 0) + 1
    share, tables, posterior = pii.reliabilities(counts)
    assert abs(share - 0.3) < 0.03
    for k, right in enumerate((0.95, 0.9, 0.85, 0.5)):
        assert abs(tables[k][1, 1] - right) < 0.05 and abs(tables[k][-1, 0] - right) < 0.05
    offset, weight = pii.train({"kind": counts})["kind"]
    assert weight[0] > weight[2] > weight[3]
    agree = sum(n for v, n in counts.items() if (offset + sum(w * x for w, x in zip(weight, v)) >= 0) == (posterior[v] >= 0.5))
    assert agree / sum(counts.values()) > 0.98


def test_context_decides_about_loose_candidates(spark):
    key = "0123456789abcdef0123456789abcdef01234567"
    rows = [(i, f"my token = \"{key}\" here") for i in range(30)] + [(100 + i, "plain_words_in_a_very_long_name again") for i in range(60)]
    found = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(found[i] == "secret:12:52" for i in range(30)) and not any(found[100 + i] for i in range(60))


def test_masking(spark, odd_docs, no_docs):
    docs = spark.createDataFrame([(1, "é a@b.co, 1.2.3.4!", 9), (2, None, 3), (3, "", None)], "doc_id long, text string, n_chars long")
    rows = {r["doc_id"]: (r["text"], r["n_chars"]) for r in pii.without_personal_data(docs).collect()}
    assert rows == {1: ("é [EMAIL], [IP]!", 16), 2: (None, None), 3: ("", None)}
    masked = pii.without_personal_data(odd_docs)
    assert masked.columns == odd_docs.columns and masked.count() == odd_docs.count()
    assert masked.where("doc_id = 8 and text like '%[PHONE]'").count() == 1
    assert pii.without_personal_data(no_docs).count() == 0 and pii.find(no_docs).count() == 0


def test_odd_documents_and_no_python_in_the_plan(odd_docs):
    rows = pii.find(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {r["doc_id"]: r["n_ip"] for r in rows}[9] == 1 and sum(r["n_email"] for r in rows if r["doc_id"] is None) == 1
    plan = pii.find(odd_docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
