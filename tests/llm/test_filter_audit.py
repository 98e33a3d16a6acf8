import itertools
import re
import string

from pyspark.sql import functions as F

from ledgerlight.llm import filter_audit as fa

WORD = re.compile("[^\x20\x09-\x0D]+")


def plain_mask(doc_id, text, rows):
    words = WORD.findall(text)
    capitals = sum(c in string.ascii_uppercase for c in text)
    copy = doc_id is not None and any(t == text and i is not None and i < doc_id for i, t in rows)
    return (
        (len(words) < 200), (100 * len(set(words)) < 50 * len(words)), (100 * capitals > 2 * len(text)),
        any(c in text for c in "#$%&*|"), copy,
    )


def plain(rows, labels):
    """Every order applied to the rows, one filter after another."""
    same = [(i, t or "") for i, t, _ in rows]
    by_text = {}
    for i, t in same:
        by_text.setdefault(t, []).append((i, t))
    marked = [(i, p or "", plain_mask(i, t or "", by_text[t or ""])) for i, t, p in rows]
    out, shapley = {}, {}
    for part in {p for _, p, _ in marked}:
        own = [(i, m) for i, p, m in marked if p == part]
        for order in itertools.permutations(range(5)):
            left, gone = own, []
            for step, f in enumerate(order, start=1):
                here = [(i, m) for i, m in left if m[f]]
                redundant = sum(m[f] for _, m in gone)
                left, gone = [(i, m) for i, m in left if not m[f]], gone + here
                unique = sum(m[f] and sum(m) == 1 for _, m in own)
                good = sum((i, "quality") in labels for i, _ in here)
                toxic = sum((i, "toxic") in labels for i, _ in here)
                shapley[part, f] = shapley.get((part, f), 0) + len(here)
                out[part, "".join("ABCDE"[x] for x in order), step] = [len(left), len(here), redundant, unique, good, toxic, f]
    return {k: (*v[:6], shapley[k[0], v[6]]) for k, v in out.items()}


def collected(df):
    rows = df.collect()
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in rows}
    assert len(found) == len(rows)
    return found


def label_set(rows):
    return {(i, n) for i, q, t in rows for n, v in (("quality", q), ("toxic", t)) if v == 1 and i is not None}


def test_documents_by_brute_force(spark, folder, some_docs):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = [(r["doc_id"], r["text"], r["source"]) for r in some_docs.collect()]
    assert collected(fa.audit(some_docs, labels)) == plain(rows, label_set(tuple(r) for r in labels.collect()))


def test_filters_at_their_bounds(spark):
    varied = " ".join(f"w{i}" for i in range(200))
    texts = [
        varied, " ".join(varied.split()[:199]), " ".join(["a", "b"] * 100), " ".join(f"w{i % 100}" for i in range(200)),
        " ".join(f"w{i % 99}" for i in range(200)), "A" + "b" * 49, "AB" + "b" * 98, "AB" + "b" * 97, "ÄÖ" + "x" * 10, "50 %", "5\x1c5 \x0b 6", "A" * 2,
    ]
    rows = [(i, t, "p") for i, t in enumerate(texts)] + [(50 + i, t, "q") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labels = spark.createDataFrame([(0, 1, 0), (3, None, 1), (3, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    found = collected(fa.audit(docs, labels))
    assert found == plain(rows, {(0, "quality"), (3, "quality"), (3, "toxic")})
    # all of q are copies of p: as the first filter, E removes them
    assert found["q", "EABCD", 1][:2] == (0, len(texts))


def test_one_hot_part_and_one_hot_text(spark):
    rows = spark.range(30_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same text").otherwise(F.concat(F.lit("t "), "id")).alias("text"),
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 100)).alias("source"),
    )
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = collected(fa.audit(rows, labels))
    assert len({k[0] for k in found}) == 51 and found["hot", "EABCD", 1][:2] == (10_001, 4_999)


def test_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(4, 1, 1), (None, 1, 1), (9, 1, None)], "doc_id long, quality int, toxic int")
    rows = [(r["doc_id"], r["text"], r["source"]) for r in odd_docs.collect()]
    assert collected(fa.audit(odd_docs, labels.withColumn("mask", F.lit(1)))) == plain(rows, label_set(tuple(r) for r in labels.collect()))
    assert fa.audit(no_docs, labels).count() == 0
    assert fa.audit(odd_docs, labels.limit(0)).count() == 600 * 3


def test_swaps_lead_through_all_orders():
    for n in range(6):
        order, seen = list(range(n)), {tuple(range(n))}
        for i in fa.neighbour_swaps(n):
            order[i], order[i + 1] = order[i + 1], order[i]
            seen.add(tuple(order))
        assert len(seen) == len(list(itertools.permutations(range(n))))


def test_a_swap_keeps_what_is_counted_and_shares_equal_nodes():
    weights = {m: (m % 3 + 1, m % 2, 0) for m in range(32)}
    diagram = fa.Diagram(5, weights)
    for level in fa.neighbour_swaps(5):
        diagram.swap(level)
        for mask, weight in weights.items():
            at = diagram.root
            for name in diagram.order:
                at = at.high if mask >> name & 1 else at.low
            assert at.weight == weight
    even = fa.Diagram(5, {m: (1, 0, 0) for m in range(32)})
    assert [len(t) for t in even.tables] == [1] * 6
