"""Button-text corpus: merging, labelling work lists, classifier benchmark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crawlprism.functions.text import selection_confirm, trim_space
from crawlprism.operators.detection import LABELS, classify_button

BENCHMARK_LABELS = tuple(label for label in LABELS if label != "other")
# Length of the example lists, and the quality bar.
EXAMPLES = 25
MIN_WEIGHTED_RATE = 0.9


def merge_corpus(old: DataFrame, new: DataFrame) -> DataFrame:
    """occurrences add up, existing labels stay, new texts have none yet."""
    both = old.select("button_text", "occurences", "label").unionByName(
        new.select("button_text", "occurences", F.lit(None).cast("string").alias("label"))
    )
    return both.groupBy("button_text").agg(
        F.sum("occurences").alias("occurences"), F.coalesce(F.max("label"), F.lit("")).alias("label")
    )


def label_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """texts whose label differs, most frequent first."""
    old = before.select("button_text", F.coalesce("label", F.lit("")).alias("old_label"))
    new = after.select("button_text", "occurences", F.coalesce("label", F.lit("")).alias("new_label"))
    return (
        old.join(new, "button_text")
        .filter("old_label <> new_label")
        .select("button_text", "occurences", "old_label", "new_label")
        .orderBy(F.desc("occurences"), "button_text")
    )


def selection_changes(changes: DataFrame) -> DataFrame:
    """Label changes of selection-confirming buttons."""
    return changes.filter(selection_confirm(F.col("button_text")))


def corpus_prepare(corpus: DataFrame, limit: int | None = None) -> DataFrame:
    """Rows with a valid label, most frequent first. ``limit`` takes rows in corpus order
    (column ``row`` where the source has one, else the order of the result, so that runs agree)."""
    rows = corpus.withColumn("label", F.lower(trim_space(F.coalesce("label", F.lit(""))))).filter(
        F.col("label").isin(*LABELS)
    )
    if limit is not None:
        order = ["row"] if "row" in rows.columns else [F.desc("occurences"), "button_text", "label"]
        rows = rows.orderBy(*order).limit(limit)
    return rows.orderBy(F.desc("occurences"), "button_text")


def predict(corpus: DataFrame, patterns=None) -> DataFrame:
    return classify_button(corpus, "button_text", "predicted", patterns)


def label_benchmark(results: DataFrame) -> DataFrame:
    """Per label, how well ``predicted`` meets ``label`` — by rows and by occurrences.

    Rows are first reduced to one total per (label, predicted) pair, at most 20 groups.
    """
    totals = (
        results.filter("label <> 'other'")
        .groupBy("label", "predicted")
        .agg(F.count("*").alias("n"), F.sum("occurences").alias("w"))
    )
    targets = F.explode(F.array(*[F.lit(x) for x in BENCHMARK_LABELS])).alias("target")
    t = totals.select("label", "predicted", "n", "w", targets)
    support = F.col("label") == F.col("target")
    right = support & (F.col("predicted") == F.col("target"))
    wrong = ~support & (F.col("predicted") == F.col("target"))

    def total(c: str, cond=None):
        return F.coalesce(F.sum(F.when(cond, F.col(c)) if cond is not None else F.col(c)), F.lit(0))

    sums = []
    for prefix, c in (("row", "n"), ("weighted", "w")):
        sums += [
            total(c, support).alias(f"{prefix}Support"),
            total(c, right).alias(f"{prefix}Correct"),
            total(c, wrong).alias(f"{prefix}FalsePositives"),
            total(c, support & ~right).alias(f"{prefix}Missed"),
            total(c).alias(f"_{prefix}All"),
        ]
    g = t.groupBy(F.col("target").alias("label")).agg(*sums)
    rates = []
    for prefix in ("row", "weighted"):
        rates += [
            F.try_divide(f"{prefix}Correct", f"{prefix}Support").alias(f"{prefix}CorrectRate"),
            F.try_divide(f"{prefix}FalsePositives", f"_{prefix}All").alias(f"{prefix}FalsePositiveRate"),
        ]
    return g.select("*", *rates).drop("_rowAll", "_weightedAll")


def benchmark_totals(bench: DataFrame) -> DataFrame:
    """Sums over the labels that have support."""
    names = ["rowSupport", "weightedSupport", "rowCorrect", "weightedCorrect", "weightedFalsePositives", "weightedMissed"]
    sums = bench.filter("rowSupport > 0").agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    return sums.select(
        "*",
        F.try_divide("rowCorrect", "rowSupport").alias("rowCorrectRate"),
        F.try_divide("weightedCorrect", "weightedSupport").alias("weightedCorrectRate"),
    )


def benchmark_examples(results: DataFrame, n: int = EXAMPLES) -> DataFrame:
    """The most frequent false positives and misses of each label. The rank filter is pushed
    below the shuffle, so a task sends at most ``n`` rows per list."""
    wrong = results.filter(F.col("label").isin(*BENCHMARK_LABELS) & (F.col("label") != F.col("predicted")))
    case = lambda target, kind: F.struct(F.col(target).alias("target"), F.lit(kind).alias("kind"))
    cases = wrong.select(
        "button_text",
        "label",
        "predicted",
        "occurences",
        F.explode(F.array(case("predicted", "false_positive"), case("label", "missed"))).alias("c"),
    ).filter("c.target <> 'other'")
    flat = cases.select(F.col("c.target").alias("target"), F.col("c.kind").alias("kind"), *cases.columns[:4])
    order = Window.partitionBy("target", "kind").orderBy(F.desc("occurences"), "button_text")
    return flat.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def label_counts(corpus: DataFrame) -> DataFrame:
    """G25."""
    return (
        corpus.filter("label IS NOT NULL AND label <> ''")
        .groupBy("label")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "label")
    )


def unlabelled(corpus: DataFrame, force: bool = False, limit: int | None = None, order: str = "button_text") -> DataFrame:
    """Rows still to be labelled (all of them with ``force``), the first ``limit`` in order."""
    rows = corpus if force else corpus.filter(F.coalesce("label", F.lit("")) == "")
    return rows.orderBy(order).limit(limit) if limit is not None else rows


def quality_gate(bench: DataFrame) -> DataFrame:
    """No false positive and a weighted rate above the bar, for every label with support."""
    clean = F.col("rowFalsePositives") == 0
    good = F.col("weightedCorrectRate") > MIN_WEIGHTED_RATE
    return bench.filter("rowSupport > 0").agg(
        F.coalesce(F.bool_and(clean), F.lit(True)).alias("no_false_positives"),
        F.coalesce(F.bool_and(good), F.lit(True)).alias("accurate"),
        F.coalesce(F.bool_and(clean & good), F.lit(True)).alias("passed"),
    )
