import re

from ledgerlight.llm import licenses


def plain(text, threshold=licenses.THRESHOLD):
    passages = dict.fromkeys([text, *re.split("\n[ \t\r\n]*\n", text), *text.split("\n")])
    best, matched = None, 0
    for passage in passages:
        grams = set(licenses.bigrams_of(re.sub("[^\x00-\x7f]", " ", passage)))
        hits = []
        for name, template in sorted(licenses.TEMPLATES.items()):
            wanted = set(licenses.bigrams_of(template))
            dice = 2 * len(grams & wanted) / (len(grams) + len(wanted))
            if dice >= threshold - 1e-9:
                hits.append((-dice, name))
        matched += bool(hits)
        best = min([*hits, *([best] if best else [])], default=None)
    return (best[1], round(-best[0], 6), matched) if best else (None, None, 0)


def test_documents_by_brute_force(some_docs):
    texts = {r["doc_id"]: r["text"] for r in some_docs.collect()}
    rows = licenses.scan(some_docs).collect()
    assert {r["doc_id"]: (r["license"], r["dice"], r["passages"]) for r in rows} == {i: plain(t) for i, t in texts.items()}
    assert sum(r["license"] is not None for r in rows) > 0


def test_changed_notices(spark):
    notices = list(licenses.TEMPLATES.items())
    texts = [t for _, t in notices]
    texts += [t.upper() for t in texts] + [" ".join(t.split()[1:]) for t in texts] + [f"intro words\n\n{t}\n\nmore" for t in texts]
    texts += [t.replace(" ", "\n") for t in texts[:12]] + ["Licensed under CC BY-NC 4.0. Released under the MIT License."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    for i, text in enumerate(texts):
        assert (rows[i]["license"], rows[i]["dice"], rows[i]["passages"]) == plain(text)
    assert [rows[i]["license"] for i in range(len(notices))] == [n for n, _ in notices]


def test_bounds_are_exact():
    for m in range(1, 60):
        low, high = licenses.size_bounds(m, 0.8)
        for n in range(1, 150):
            assert (2 * min(m, n) / (m + n) >= 0.8 - 1e-12) == (low <= n <= high)


def test_odd_documents_and_no_python_in_the_plan(odd_docs, no_docs):
    found = licenses.scan(odd_docs)
    assert found.count() == odd_docs.count() and found.where("license is not null").count() == 0
    assert not re.search("Python|Pandas|Arrow", found._jdf.queryExecution().toString())
    assert licenses.scan(no_docs).count() == 0
