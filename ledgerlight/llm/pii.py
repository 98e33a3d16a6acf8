"""Personal data by weak supervision, in DataFrame functions alone.

Four base kinds are found by their definitions and always stay. Further kinds start as loose candidates on which four
labelers vote: a strict pattern, a gazetteer of cue words right before the candidate, the wider context, and the
candidate's shape. How often each combination of votes occurs is counted over all documents, at most 81 rows per
kind; expectation-maximisation on those counts estimates how reliable each labeler is, and a logistic classifier over
the votes is trained on its posteriors. The classifier then decides each candidate inside the plan.

Regular expressions here never repeat a group, and never start twice in one run of characters, so neither
the stack nor the time of a search grows with long runs.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base kinds in the order in which equal starts are listed.
BASE_KINDS = ("email", "ip", "card", "phone")
MARK = "﷐"
LOCAL = f"A-Za-z0-9._%+{MARK}-"
EMAIL = rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]+"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
DIGIT_RUN = r"(?<![0-9])[0-9][0-9 -]{10,}[0-9]"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"

PLACES = "array<struct<s:int,m:string>>"
SPANS = "array<struct<s:int,k:int,e:int>>"


@dataclass(frozen=True)
class LooseKind:
    """A kind that the method adds: where to look, and what the four labelers go by (Java patterns)."""

    name: str
    loose: str
    strict: str
    cues: str
    context: str
    shape: str


# Patterns and cue words of the kinds that the method adds.
LOOSE_KINDS = (
    LooseKind(
        "secret", r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{20,}", r"^([0-9a-fA-F]{32,}|[A-Z0-9]{20}|(sk|ghp|xox[bp])[_-][A-Za-z0-9_-]{16,})$",
        r"(?i)(token|secret|password|passwd|api[_ -]?key|access[_ -]?key)[\"']?[ ]*[=:][ ]*[\"']?$",
        r"(?i)token|secret|passw|key|credential|bearer", r"^(?=.*[0-9])(?=.*[A-Za-z]).*$",
    ),
    LooseKind(
        "ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
        r"(?i)(ssn|social security( number| no\.?)?)[:# ]*$", r"(?i)ssn|social|security|tax", r"^[0-9-]+$",
    ),
    LooseKind(
        "iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])", r"^[A-Z]{2}[0-9]{2}[A-Z]{0,4}[0-9]{10,}[A-Z0-9]*$",
        r"(?i)(iban|account( number| no\.?)?)[:# ]*$", r"(?i)iban|account|bank|transfer", r"^[A-Z]{2}.*[0-9]{6}.*$",
    ),
    LooseKind(
        "telephone", r"(?<![0-9A-Za-z+.(-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])",
        r"^\(?[2-9][0-9]{2}\)?[ .-][2-9][0-9]{2}[ .-][0-9]{4}$", r"(?i)(phone|tel|call|mobile|fax|cell)[.:# ]*$",
        r"(?i)phone|tel|call|mobile|fax|contact", r"^(\([0-9]{3}\) |[0-9]{3}([.-])[0-9]{3}\2).*$",
    ),
)
KINDS = BASE_KINDS + tuple(k.name for k in LOOSE_KINDS)
LABELERS = 4
CONTEXT_CHARS = 48
EM_STEPS = 100


def located(text: Column, pattern: str) -> Column:
    """Places and texts of the matches, in code points: what lies between the matches gives the distances."""
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return running(between, found, lambda at, between, match: (at + F.length(between), match))


def running(between: Column, found: Column, place: Callable) -> Column:
    """Fold alternating (between, match) texts into (start, text) with running starts."""
    def step(acc: Column, x: Column) -> Column:
        start, kept = place(acc["at"], x["b"], x["m"])
        return F.struct(
            (acc["at"] + F.length(x["b"]) + F.length(F.coalesce(x["m"], F.lit("")))).alias("at"),
            F.concat(acc["out"], F.array(F.struct(start.alias("s"), kept.alias("m")))).alias("out"),
        )

    pairs = F.zip_with(between, found, lambda b, m: F.struct(F.coalesce(b, F.lit("")).alias("b"), m.alias("m")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(PLACES).alias("out"))
    return F.filter(F.aggregate(pairs, start, step, lambda acc: acc["out"]), lambda x: x["m"].isNotNull())


def pieces(run: Column, start: Column) -> Column:
    """A run of digits and separators cut where two separators meet; each piece with its place in the text."""
    cut = F.split(run, "[ -]{2,}", -1)
    gaps = F.regexp_extract_all(run, F.lit("[ -]{2,}"), F.lit(0))

    def step(acc: Column, x: Column) -> Column:
        return F.struct(
            (acc["at"] + F.length(x["b"]) + F.length(F.coalesce(x["m"], F.lit("")))).alias("at"),
            F.concat(acc["out"], F.array(F.struct((acc["at"] + start).alias("s"), x["b"].alias("m")))).alias("out"),
        )

    pairs = F.zip_with(cut, gaps, lambda b, m: F.struct(F.coalesce(b, F.lit("")).alias("b"), m.alias("m")))
    return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), F.array().cast(PLACES).alias("out")), step, lambda a: a["out"])


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Every second digit from the right doubled, nines cast out, the sum a multiple of ten."""
    turned = F.split(F.reverse(number), "")
    values = F.transform(turned, lambda d, i: F.when(
        i % 2 == 1, F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2),
    ).otherwise(d.cast("int")))
    return F.aggregate(values, F.lit(0), lambda a, v: a + F.coalesce(v, F.lit(0))) % 10 == 0


def valid_ip(match: Column) -> Column:
    def small(part: Column) -> Column:
        plain = F.regexp_replace(part, "^0+", "")
        return (F.length(plain) < 3) | ((F.length(plain) == 3) & (plain <= "255"))

    return F.forall(F.split(match, r"\."), small)


def as_spans(places: Column, kind: str) -> Column:
    number = F.lit(KINDS.index(kind))
    return F.transform(places, lambda x: F.struct(x["s"].alias("s"), number.alias("k"), (x["s"] + F.length(x["m"])).alias("e")))


def only_if(there: Column, spans: Column) -> Column:
    """Spare texts without the telling character the costlier search."""
    return F.when(there, spans).otherwise(F.array().cast(SPANS))


def base_spans(text: Column) -> Column:
    """All spans of the base kinds, by start, then kind."""
    plain = F.regexp_replace(F.translate(text, MARK, " "), r"\.(?![A-Za-z0-9-])", MARK)
    email = as_spans(located(plain, EMAIL), "email")
    ip = as_spans(F.filter(located(text, IP), lambda x: valid_ip(x["m"])), "ip")
    numbers = F.flatten(F.transform(located(text, DIGIT_RUN), lambda x: pieces(x["m"], x["s"])))
    card = as_spans(F.filter(numbers, lambda x: F.length(digits(x["m"])).between(12, 19) & luhn(digits(x["m"]))), "card")
    phone = as_spans(F.filter(located(text, PHONE), lambda x: F.length(digits(x["m"])).between(9, 15)), "phone")
    found = F.concat(
        only_if(F.contains(text, F.lit("@")), email),
        only_if(text.rlike(r"[0-9]\.[0-9]"), ip),
        only_if(text.rlike("[0-9][0-9 -]{10,}[0-9]"), card),
        only_if(text.rlike(r"\+[0-9]"), phone),
    )
    return F.array_sort(found)


def candidates(text: Column, kind: LooseKind) -> Column:
    """Loose matches of one kind with the votes of the four labelers: 1 for, -1 against, 0 abstains."""
    def judged(x: Column) -> Column:
        before = F.substring(text, F.greatest(x["s"] - CONTEXT_CHARS + 1, F.lit(1)), F.least(x["s"], F.lit(CONTEXT_CHARS)))
        votes = F.array(
            F.when(x["m"].rlike(kind.strict), 1).otherwise(-1),
            F.when(before.rlike(kind.cues), 1).otherwise(-1),
            F.when(before.rlike(kind.context), 1).otherwise(0),
            F.when(x["m"].rlike(kind.shape), 1).otherwise(-1),
        )
        return F.struct(x["s"].alias("s"), (x["s"] + F.length(x["m"])).alias("e"), votes.alias("votes"))

    found = F.transform(located(text, kind.loose), judged)
    return F.when(text.rlike(kind.loose), found).otherwise(F.array().cast("array<struct<s:int,e:int,votes:array<int>>>"))


def vote_counts(docs: DataFrame, text: str = "text") -> dict[str, dict[tuple[int, ...], int]]:
    """For each added kind how often each combination of votes occurs in all documents: at most 81 rows a kind."""
    column = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))

    def listed_votes(kind: LooseKind) -> Column:
        return F.transform(
            candidates(F.col("__t"), kind), lambda c: F.struct(F.lit(kind.name).alias("kind"), c["votes"].alias("votes")),
        )

    listed = [listed_votes(kind) for kind in LOOSE_KINDS]
    found = docs.select(column.alias("__t")).select(F.explode(F.concat(*listed)).alias("c"))
    counted = found.groupBy("c.kind", "c.votes").agg(F.count("*").alias("n")).collect()
    out: dict[str, dict[tuple[int, ...], int]] = {k.name: {} for k in LOOSE_KINDS}
    for row in sorted(counted, key=lambda r: (r["kind"], list(r["votes"]))):
        out[row["kind"]][tuple(row["votes"])] = row["n"]
    return out


def reliabilities(counts: dict[tuple[int, ...], int]) -> tuple[float, list[dict[tuple[int, int], float]], dict[tuple[int, ...], float]]:
    """Expectation-maximisation for one kind: the share of true candidates, each labeler's vote
    probabilities given the truth, and the posterior of each combination of votes. Starts from the majority.
    """
    posterior = {v: min(max(0.5 + 0.5 * sum(v) / LABELERS, 0.05), 0.95) for v in counts}
    share, tables = 0.5, []
    for _ in range(EM_STEPS):
        total = sum(counts.values())
        share = (sum(counts[v] * posterior[v] for v in counts) + 1) / (total + 2)
        tables = []
        for k in range(LABELERS):
            table = {}
            for truth in (0, 1):
                weight = {v: counts[v] * (posterior[v] if truth else 1 - posterior[v]) for v in counts}
                mass = sum(weight.values()) + 3
                for vote in (-1, 0, 1):
                    # one imagined vote each, and one that takes the labeler for right
                    right = vote == (1 if truth else -1)
                    table[vote, truth] = (sum(w for v, w in weight.items() if v[k] == vote) + 0.5 + 1.5 * right) / mass
            tables.append(table)
        fresh = {}
        for v in counts:
            true = share * math.prod(tables[k][v[k], 1] for k in range(LABELERS))
            false = (1 - share) * math.prod(tables[k][v[k], 0] for k in range(LABELERS))
            fresh[v] = true / (true + false)
        moved = max((abs(fresh[v] - posterior[v]) for v in counts), default=0.0)
        posterior = fresh
        if moved < 1e-9:
            break
    return share, tables, posterior


def train(counts: dict[str, dict[tuple[int, ...], int]]) -> dict[str, tuple[float, list[float]]]:
    """Offset and one weight per labeler for every kind: a logistic fit to the posteriors, by gradient steps."""
    out = {}
    for kind, table in counts.items():
        if not table:
            out[kind] = (-1.0, [1.0] * LABELERS)
            continue
        _, _, posterior = reliabilities(table)
        total = sum(table.values())
        offset, weight = 0.0, [1.0] * LABELERS
        for _ in range(500):
            gradient = [0.0] * (LABELERS + 1)
            for v, n in table.items():
                score = offset + sum(w * x for w, x in zip(weight, v))
                miss = n / total * (1 / (1 + math.exp(-max(min(score, 30.0), -30.0))) - posterior[v])
                gradient[0] += miss
                for k in range(LABELERS):
                    gradient[k + 1] += miss * v[k]
            offset -= gradient[0] + 1e-4 * offset
            weight = [w - gradient[k + 1] - 1e-4 * (w - 1) for k, w in enumerate(weight)]
        out[kind] = (offset, weight)
    return out


def all_spans(text: Column, base: Column, classifier: dict[str, tuple[float, list[float]]]) -> Column:
    """Base spans and the accepted candidates that overlap none of them, by start, then kind."""
    def added(kind: LooseKind) -> Column:
        offset, weight = classifier[kind.name]

        def accepted(c: Column) -> Column:
            score = F.lit(offset)
            for k, w in enumerate(weight):
                score = score + F.lit(w) * c["votes"][k]
            free = ~F.exists(base, lambda b: (b["s"] < c["e"]) & (c["s"] < b["e"]))
            return (score >= 0) & free

        chosen = F.filter(candidates(text, kind), accepted)
        number = F.lit(KINDS.index(kind.name))
        return F.transform(chosen, lambda c: F.struct(c["s"].alias("s"), number.alias("k"), c["e"].alias("e")))

    return F.array_sort(F.concat(base, *[added(kind) for kind in LOOSE_KINDS]))


def named(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(n) for n in KINDS])
    told = F.transform(spans, lambda x: F.concat_ws(":", names[x["k"]], x["s"].cast("string"), x["e"].cast("string")))
    return F.array_join(told, ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with [KIND] in place of each span; of overlapping spans the first is named."""
    names = F.array(*[F.lit(f"[{n.upper()}]") for n in KINDS])

    def step(acc: Column, x: Column) -> Column:
        free = x["s"] >= acc["at"]
        kept = F.substring(text, acc["at"] + 1, x["s"] - acc["at"])
        return F.struct(
            F.greatest(acc["at"], x["e"]).alias("at"),
            F.when(free, F.concat(acc["out"], kept, names[x["k"]])).otherwise(acc["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    whole = F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def marked(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with __text, __base and __spans: the text, its base spans and all its spans."""
    classifier = train(vote_counts(docs, text))
    column = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    told = docs.withColumn("__text", column).withColumn("__base", base_spans(F.col("__text")))
    return told.withColumn("__spans", all_spans(F.col("__text"), F.col("__base"), classifier))


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base, spans), one row for each row of docs.

    base and spans list kind:start:end in code points, end exclusive; the counts are those of the base kinds. Null and
    empty texts have none; null keys keep their row; repeated rows each give one; an empty table gives none and
    trains nothing; columns other than key and text are not read. Texts are searched whole.
    """
    source = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    told = marked(source)

    def count(kind: str) -> Column:
        return F.size(F.filter("__base", lambda x: x["k"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE_KINDS]
    return told.select("doc_id", *counts, named(F.col("__base")).alias("base"), named(F.col("__spans")).alias("spans"))


def without_personal_data(docs: DataFrame) -> DataFrame:
    """docs with every span replaced by its kind in brackets, and n_chars counted anew; null texts stay null."""
    told = marked(docs)
    fresh = F.when(F.col("text").isNotNull(), redacted(F.col("__text"), F.col("__spans")))
    columns = [fresh.alias("text") if n == "text" else F.col(f"`{n}`") for n in docs.columns]
    out = told.select(*columns)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast(kind)))
    return out.select(*[F.col(f"`{n}`") for n in docs.columns])
