"""Run the steps from the command line: ``spark-submit`` or ``python -m ledgerlight STEP --folder ...``.

Every step reads and writes tables below one folder: raw (or --input), cleaned, transformed, reduced,
sampled, train, test, models and reports. ``all`` runs them in order.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ledgerlight import schema as s
from ledgerlight.functions.features import with_cycles
from ledgerlight.models import artifact as art
from ledgerlight.models.tuning import KERNEL, ONE_CLASS, chosen_models
from ledgerlight.operators import encode, sampling, scale
from ledgerlight.operators.impute import clean
from ledgerlight.operators.lookups import require_key
from ledgerlight.operators.profile import missing_values
from ledgerlight.plans import detect, report
from ledgerlight.plans import prepare as prep
from ledgerlight.session import dealt, keyed_table, owned_tables, prepare
from ledgerlight.sources.counted import ClassCounts, counted
from ledgerlight.sources.tables import read_table, write_report, write_table

# Step and flag names.
STEPS = ("clean", "transform", "reduce", "scale", "stats", "eda", "train", "evaluate")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ledgerlight")
    p.add_argument("step", choices=[*STEPS, "all"])
    p.add_argument("--folder", required=True, help="folder of all tables")
    p.add_argument("--input", help="raw table, Parquet or CSV (default: raw below the folder)")
    p.add_argument("--key", default=s.KEY)
    p.add_argument("--nrows", type=int, help="clean only the first rows in key order")
    p.add_argument("--sample-size", type=int, help="work on a sample of so many rows (default: all rows)")
    p.add_argument("--fraud-sample-rate", type=float, default=s.SAMPLE_RATE)
    p.add_argument("--no-sample", action="store_true", help="all rows, whatever the sample size")
    p.add_argument("--vocabulary-limit", type=int, default=encode.VOCABULARY_LIMIT, help="most one-hot columns for one column")
    p.add_argument("--models", nargs="+", default=[ONE_CLASS], choices=["linear", "kernel", "oneclass", "both", "all"])
    p.add_argument("--param-preset", choices=["fast", "default"], default="default")
    p.add_argument("--validation-size", type=float, default=s.TEST_SHARE)
    p.add_argument("--training-sample-size", type=int)
    p.add_argument("--kernel-training-sample-size", type=int)
    p.add_argument("--oneclass-training-sample-size", type=int)
    p.add_argument("--eval-sample-size", type=int)
    p.add_argument("--random-state", type=int, default=s.SEED)
    p.add_argument("--dry-run", action="store_true", help="train without saving")
    return p


class Steps:
    def __init__(self, spark: SparkSession, options: argparse.Namespace):
        self.spark, self.o = spark, options
        self.base = options.folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def read(self, name: str):
        return read_table(self.spark, self.path(name))

    def raw(self, rows: int | None = None):
        return read_table(self.spark, self.o.input or self.path("raw"), rows=rows, key=self.o.key)

    def clean(self) -> None:
        raw = self.raw(self.o.nrows)
        write_report(missing_values(raw), self.path("reports/missing_values"))
        write_table(clean(raw), self.path("cleaned"))

    def transform(self) -> None:
        table = prep.transform(self.read("cleaned"), vocabulary_limit=self.o.vocabulary_limit)
        _, known = counted(table, lambda df: write_table(df, self.path("transformed")))
        write_report(prep.transform_summary(table, known.rows), self.path("reports/transform"))

    def reduce(self) -> None:
        before = self.read("transformed")
        after = prep.reduce_columns(before, keep=[self.o.key])
        _, known = counted(after, lambda df: write_table(df, self.path("reduced")))
        write_report(prep.reduction_summary(before, after, known.rows), self.path("reports/reduction"))

    def scale(self) -> None:
        reduced, key, seed = self.read("reduced"), self.o.key, self.o.random_state
        require_key(reduced, key)
        found = sampling.class_counts(reduced, s.TARGET)
        whole = ClassCounts(sum(found.values()), found[True], found[False])
        if self.o.sample_size is not None and not self.o.no_sample:
            reduced = sampling.sample_by_rate(
                reduced, s.TARGET, key, self.o.sample_size, self.o.fraud_sample_rate, seed, found
            )
        _, known = counted(reduced, lambda df: write_table(df, self.path("sampled")), s.TARGET)
        sampled, counts = self.read("sampled"), known.by_class()
        train, test = sampling.split(with_cycles(sampled), s.TARGET, key, s.TEST_SHARE, f"{seed}:split", counts)
        fitted = scale.fit_scaling(train)
        write_table(fitted.apply(train), self.path("train"))
        write_table(fitted.apply(test), self.path("test"))
        counts = {"reduced": whole, **prep.split_counts(counts)}
        done = prep.Prepared(self.read("reduced"), sampled, self.read("train"), self.read("test"), fitted, counts)
        write_report(prep.scaling_summary(done), self.path("reports/scaling"))
        write_report(prep.split_distribution(done), self.path("reports/class_distribution"))

    def stats(self) -> None:
        for name, table in report.profile_tables(self.raw(), key=self.o.key).items():
            write_report(table, self.path(f"reports/stats/{name}"))

    def eda(self) -> None:
        for name, table in report.explore_tables(self.read("transformed"), key=self.o.key).items():
            # the points of the scatter chart hold every positive row: no report, a table
            put = write_table if name == "amount_and_distance" else write_report
            put(table, self.path(f"reports/eda/{name}"))

    def train(self) -> None:
        table = detect.feature_table(
            self.read("train"), self.o.key, rows=self.o.training_sample_size, seed=self.o.random_state
        )
        limits = {KERNEL: self.o.kernel_training_sample_size, ONE_CLASS: self.o.oneclass_training_sample_size}
        folder = None if self.o.dry_run else self.path("models")
        trained = detect.train(
            table, self.o.models, self.o.param_preset, self.o.validation_size, limits, folder, self.o.random_state
        )
        for kind, result in trained.items():
            write_report(result.tuning, self.path(f"reports/tuning/{kind}"))

    def evaluate(self) -> None:
        # all models first: a missing one shows before any work
        models = [art.load(self.spark, self.path(f"models/{kind}")) for kind in chosen_models(self.o.models)]
        source = keyed_table(dealt(self.read("sampled").select(self.o.key, s.TARGET, "amt"), self.o.key), self.o.key)
        for model in models:
            detect.evaluate(
                self.read("test"), self.read("train"), source, model, self.o.key,
                rows=self.o.eval_sample_size, folder=self.path("reports/evaluation"), seed=self.o.random_state,
            )


def main(arguments: list[str] | None = None) -> None:
    options = parser().parse_args(arguments)
    spark = prepare(SparkSession.builder.appName("ledgerlight").getOrCreate())
    steps = Steps(spark, options)
    chosen = STEPS if options.step == "all" else (options.step,)
    if options.dry_run and options.step == "all":
        chosen = STEPS[:-1]
    for name in chosen:
        with owned_tables(spark):
            getattr(steps, name)()


if __name__ == "__main__":
    main()
