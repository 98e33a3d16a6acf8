"""How often the jobs read their input, counted by the rows their stages took in."""

import uuid

import pytest
from pyspark.sql import functions as F

from ledgerlight.models import tuning
from ledgerlight.operators import evaluate as ev
from ledgerlight.operators import explore, impute, lookups, profile
from ledgerlight.operators.quantiles import exact_quantiles
from ledgerlight.plans import prepare as prep
from ledgerlight.plans import report
from ledgerlight.session import dealt, keyed_table, materialise
from ledgerlight.sources.counted import counted
from ledgerlight.sources.txn import ID, transactions


@pytest.fixture(scope="module")
def written(spark):
    return materialise(transactions(spark, "/root/testdata/sf0.01"))


def rows_read(spark):
    context = spark.sparkContext._jsc.sc()
    context.listenerBus().waitUntilEmpty()
    numbers = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0)
    stages = context.statusStore().stageList(None, False, False, numbers, None)
    return sum(stages.apply(i).inputRecords() for i in range(stages.size()))


def scans(spark, rows, work):
    """What work gives, and how many times as many rows as the table has were read meanwhile."""
    before = rows_read(spark)
    out = work()
    return out, (rows_read(spark) - before) / rows


def jobs(spark, work):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        out = work()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def file_scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_cleaning_reads_its_input_twice(spark, written):
    rows = written.count()
    fitted, read = scans(spark, rows, lambda: impute.fit_table(written, one_hot=("category", "gender")))
    assert read <= 2.2
    # the same values as worked out one by one
    numeric = [n for n in ("amt", "city_pop") if n in written.columns]
    medians = exact_quantiles(written, numeric, [0.5])
    assert {n: fitted.imputation.medians[n] for n in numeric} == pytest.approx({n: v[0] for n, v in medians.items()})
    modes = profile.column_modes(written, ["category"])
    assert fitted.imputation.words["category"] == modes["category"] and fitted.imputation.words["job"] == "Unknown"
    assert fitted.vocabulary["gender"] == ["F", "M"] and "category" in fitted.vocabulary


def test_medians_by_brackets_of_any_shape(spark):
    shapes = {
        "ties": F.col("id") % 3, "skewed": F.exp(F.col("id") % 500 / 10), "one": F.lit(7), "two": F.when(F.col("id") < 2, F.col("id")),
        "odd": F.when(F.col("id") % 2 == 0, F.col("id") * 0.25), "none": F.lit(None).cast("double"),
        "text": F.when(F.col("id") % 5 == 0, "abc").otherwise((F.col("id") % 77).cast("string")),
    }
    df = spark.range(5_000).select(*[F.when(F.col("id") % 11 != 0, c).alias(n) for n, c in shapes.items()])
    fitted = impute.fit_table(df, numeric=list(shapes), text=[])
    numbers = {n: F.col(n).try_cast("double") for n in shapes}
    wanted = {n: v[0] if v[0] is not None else 0.0 for n, v in exact_quantiles(df, numbers, [0.5]).items()}
    assert fitted.imputation.medians == pytest.approx(wanted)


def test_preparing_reads_the_raw_table_three_times(spark, written):
    rows = written.count()
    before = rows_read(spark)
    fitted = impute.fit_table(written, one_hot=("category", "gender"), limit=100)
    table = prep.transform(fitted.imputation.apply(written), fitted.vocabulary, ages_known=True)
    counted(table, materialise, "is_fraud")
    assert (rows_read(spark) - before) / rows <= 3.2


def test_a_profile_reads_its_input_few_times(spark, written):
    rows = written.count()
    tables, read = scans(spark, rows, lambda: report.profile_tables(written, key=ID))
    assert read <= 6.3  # measures, quartiles, values, row hashes; the copies' hashes and kinds of values are read again
    whole = [tables[n].select(F.lit(n).alias("n")) for n in tables]
    union = whole[0]
    for part in whole[1:]:
        union = union.unionByName(part)
    inputs = [n for n in tables if file_scans(tables[n]) and n in ("head", "duplicate_rows")]
    assert union.count() > 0 and len(inputs) <= 2
    assert {r["column"]: r["missing_count"] for r in tables["missing_values"].collect()} == {
        r["column"]: r["missing_count"] for r in profile.missing_values(written).collect()
    }
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert same(tables["target_distribution"], profile.target_distribution(written, "is_fraud"))
    assert same(tables["general_information"], profile.shape(written))


def test_charts_read_their_input_few_times(spark, written):
    table = materialise(prep.transform(written))
    rows = table.count()
    tables, read = scans(spark, rows, lambda: report.explore_tables(table, key=ID))
    assert read <= 4.3  # ranges, quantiles, cells, and the cut of the scatter chart if there are many rows
    # what is left to the reader of the charts: the points of the scatter chart, and cells, which are few
    _, later = scans(spark, rows, lambda: [tables[n].collect() for n in tables])
    assert later <= 1.7
    for name, column in (("amount_boxplot", explore.log_amount()), ("distance_boxplot", F.col("customer_merchant_distance_km"))):
        mine = {r["is_fraud"]: r.asDict() for r in tables[name].collect()}
        other = {r["is_fraud"]: r.asDict() for r in explore.boxplot(table, column).collect()}
        assert mine.keys() == other.keys() and all(mine[k] == pytest.approx(other[k]) for k in mine)
    named = explore.with_category(table)
    one, two = ({r["category"]: tuple(r) for r in t.collect()} for t in (tables["category_rates"], explore.category_summary(named)))
    assert one == two
    hours = {r["transaction_hour"]: r["fraud_rate"] for r in explore.rate_by(table, "transaction_hour", "transaction_hour").collect()}
    assert {r["transaction_hour"]: r["fraud_rate"] for r in tables["hour_rates"].collect()} == pytest.approx(hours)
    amounts = [sorted(map(str, t.collect())) for t in (tables["amount_summary"], explore.amount_summary(table))]
    assert amounts[0] == amounts[1]
    plain = explore.histogram(table, "customer_merchant_distance_km", 40)
    assert [r["count"] for r in tables["distance_histogram_full"].orderBy("bin").collect()] == [r["count"] for r in plain.orderBy("bin").collect()]


def test_charts_of_labels_with_gaps(spark, written):
    table = materialise(prep.transform(written).withColumn("is_fraud", F.when(F.col(ID) % 9 != 0, F.col("is_fraud"))))
    tables = report.explore_tables(table, key=ID)
    assert {r["is_fraud"] for r in tables["target_distribution"].collect()} == {True, False, None}
    assert {r["is_fraud"] for r in tables["amount_boxplot"].collect()} == {True, False, None}


def test_counts_come_with_the_write(spark, written):
    done = prep.prepare(written, key=ID, drop=("customer_id", "ts"))
    summary, made = jobs(spark, lambda: prep.scaling_summary(done))
    assert made == 0
    found = {r["metric"]: r["value"] for r in summary.collect()}
    assert found["input_rows"] == done.reduced.count() and found["train_rows"] == done.train.count()
    assert found["test_rows"] == done.test.count() and found["sampled_fraud_rows"] == done.reduced.where("is_fraud").count()
    sample = prep.prepare(written, key=ID, drop=("customer_id", "ts"), sample_rows=500)
    by_name = {n: getattr(sample, n).groupBy("is_fraud").count() for n in ("reduced", "sampled", "train", "test")}
    for name, counts in by_name.items():
        assert {r["is_fraud"]: r["count"] for r in counts.collect()} == sample.counts[name].by_class()


def exchanges(df, table_columns):
    """Exchanges above a scan that reads one of these columns."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    found, above = 0, []
    for line in lines:
        depth = len(line) - len(line.lstrip(" :+-"))
        above = [(d, text) for d, text in above if d < depth]
        if "FileScan" in line and any(c in line for c in table_columns):
            found += sum("Exchange" in text for _, text in above)
        above.append((depth, line))
    return found


def test_a_keyed_source_is_not_shuffled(spark, written, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        source = keyed_table(dealt(written.select(ID, "is_fraud", F.col("amt").alias("source_amount")), ID), ID)
        scored = materialise(written.where(F.col(ID) % 5 == 0).select(ID, "is_fraud", F.lit(0.5).alias("score")))
        joined = lookups.attach_amount(scored, source, ID, "source_amount", "amt")
        assert exchanges(joined, ["source_amount"]) == 0 and joined.count() == scored.count()
        matched = source.join(scored.select(ID), ID, "left_semi")
        assert exchanges(matched, ["source_amount"]) == 0
        lined = lookups.alignment(scored, matched.withColumn("is_fraud", F.col("is_fraud")), ID, "is_fraud")
        row = lined.first()
        assert row["left_rows"] == row["right_rows"] and row["label_mismatches"] == 0
        counts = source.groupBy(ID).count()
        assert exchanges(counts, ["source_amount", ID]) == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.fixture(scope="module")
def many_scores(spark):
    df = spark.range(3_000).select(
        F.col("id").alias("trans_num"), (F.col("id") % 10 == 0).alias("is_fraud"),
        *[(F.pmod(F.col("id") * p, F.lit(97)) / 10 + F.when(F.col("id") % 10 == 0, 2.0 * i).otherwise(0.0)).alias(f"score{i}")
          for i, p in enumerate((31, 57, 83, 11, 5, 7))],
    )
    return materialise(df)


def test_reports_of_many_scores_are_those_of_each(spark, many_scores):
    names = [f"score{i}" for i in range(6)]
    thresholds = [ev.with_zero([0.5 * t + i for t in range(12)]) for i in range(6)]
    scored = ev.Scored(many_scores, key="trans_num")
    for bound in (10, 10**6):
        ev_rows = ev.running_totals.__defaults__
        ev.running_totals.__defaults__ = (*ev_rows[:-1], bound)
        try:
            together = ev.training_reports(scored, names, thresholds)
            chosen = {r["point"]: r for r in ev.select_thresholds(together, "point").collect()}
            for i, name in enumerate(names):
                own = ev.training_report(ev.Scored(many_scores.withColumn("amt", F.lit(0.0)), score=name), thresholds[i])
                mine = together.where(F.col("point") == i).drop("point")
                a, b = ([tuple(r) for r in t.select(own.columns).orderBy("threshold").collect()] for t in (own, mine))
                assert len(a) == len(b) == len(thresholds[i]) and all(x == pytest.approx(y) for x, y in zip(a, b))
                assert chosen[i]["threshold"] == ev.select_threshold(own).first()["threshold"]
        finally:
            ev.running_totals.__defaults__ = ev_rows


def test_jobs_of_a_search_do_not_grow_with_its_points(spark, many_scores, monkeypatch):
    table = tuning.FeatureTable(many_scores, "trans_num", "is_fraud", ("score0", "score1", "score2"))
    point = tuning.param_grid("linear", "fast")[0]
    grids = [[{**point, "fraud_weight": w, "non_fraud_ratio": r} for w in ws for r in rs] for ws, rs in (((50,), (2,)), ((50, 51, 52), (2, 3)))]
    real, counts = tuning._fit_grid, []
    for grid in grids:
        # fits share their passes (test_models); how many they need depends on the slowest
        fitted = real("linear", table, grid, 42)
        monkeypatch.setattr(tuning, "_fit_grid", lambda *a, fitted=fitted: fitted)
        (_, _, results), made = jobs(spark, lambda grid=grid: tuning.tune("linear", table, grid))
        counts.append(made)
        assert len(results) == len(grid)
        for result in results:
            assert result["fit_rows"] == result["fit_fraud_rows"] * (1 + result["non_fraud_ratio"])
    assert counts[0] > 0 and counts[1] == counts[0]


def test_undersamples_of_several_ratios_are_cut_together(spark, many_scores):
    counts = {True: 300, False: 2_700}
    ratios = {"_two": 2, "_four": 4, "_many": 50}
    rows = tuning.sampling.with_undersamples(many_scores, "is_fraud", "trans_num", ratios, counts, 42)
    found = {r["trans_num"]: r for r in rows.collect()}
    assert len(found) == 3_000
    for name, ratio in ratios.items():
        alone = tuning.sampling.undersample(many_scores, "is_fraud", "trans_num", ratio, 42)
        assert {r["trans_num"] for r in alone.collect()} == {k for k, r in found.items() if r[name]}
