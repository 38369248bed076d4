"""Models that are plain aggregates: naive Bayes (M9) and the best first split
of a classification tree (M5)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_features.operators.ranks import running_totals


def naive_bayes_table(df: DataFrame, label: str, features: list[str], smoothing: float = 1.0) -> DataFrame:
    """Log-probabilities of multinomial naive Bayes as rows (class, feature,
    log_probability); the feature ``(prior)`` holds the class's own. One grouped
    aggregate; rows with a NULL label or feature take no part, a negative
    feature fails the query."""
    checked = [F.when(F.col(f) < 0, F.raise_error(F.lit(f"negative {f}"))).otherwise(F.col(f).cast("double")).alias(f) for f in features]
    rows = df.select(F.col(label).cast("double").alias("class"), *checked).dropna()
    sums = rows.groupBy("class").agg(F.count(F.lit(1)).alias("_n"), *[F.sum(f).alias(f) for f in features])
    every = sums.agg(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("classes")).first()
    log_rows = F.log(F.lit((every["rows"] or 0) + every["classes"] * smoothing))
    mass = reduce(lambda a, b: a + b, [F.col(f) for f in features])
    total = F.log(mass + smoothing * len(features))
    prior = F.log(F.col("_n") + smoothing) - log_rows
    wide = sums.select("class", prior.alias("(prior)"), *[(F.log(F.col(f) + smoothing) - total).alias(f) for f in features])
    return wide.unpivot(["class"], ["(prior)", *features], "feature", "log_probability")


def naive_bayes_predict(df: DataFrame, table: DataFrame, features: list[str]) -> DataFrame:
    """``df`` with ``prediction``: the class of the largest posterior, the
    smallest class in a tie. The model (classes x features numbers) becomes an
    expression; the rows are not shuffled."""
    cells = {(r["class"], r["feature"]): r["log_probability"] for r in table.collect()}  # the model alone
    classes = sorted({c for c, _ in cells})
    scores = [reduce(lambda a, b: a + b, [F.col(f) * cells[c, f] for f in features], F.lit(cells[c, "(prior)"])) for c in classes]
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return df.withColumn("prediction", F.coalesce(*[F.when(s == best, F.lit(c)) for s, c in zip(scores, classes, strict=True)]))


def best_splits(df: DataFrame, label: str, features: list[str]) -> DataFrame:
    """Per feature the split ``value <= threshold`` of the largest Gini gain
    over a 0/1 label, among all its values: feature, threshold, n_left,
    n_right, gain. Cumulative sums over (feature, value) counts, summed range by
    range. Rows with a NULL label are left out, NULL features of a row too;
    ties go to the smaller threshold; a feature of one value has no split."""
    rows = df.select(F.col(label).cast("double").alias("_y"), *[F.col(f).cast("double").alias(f) for f in features]).filter("_y is not null")
    long = rows.unpivot(["_y"], features, "feature", "value").filter("value is not null")
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_y") > 0).alias("pos"))
    upto = running_totals(counts, ["value"], {"nl": F.col("n"), "pl": F.col("pos")}, ["feature"])
    whole = counts.groupBy("feature").agg(F.sum("n").alias("nt"), F.sum("pos").alias("pt"))
    both = upto.join(whole, "feature").filter("nl < nt")

    def gini(pos, n):
        p = pos / n
        return 1.0 - p * p - (1.0 - p) * (1.0 - p)

    nl, pl, nt, pt = (F.col(c).cast("double") for c in ("nl", "pl", "nt", "pt"))
    gain = gini(pt, nt) - nl / nt * gini(pl, nl) - (nt - nl) / nt * gini(pt - pl, nt - nl)
    scored = both.select("feature", F.struct(F.round(gain, 9).alias("gain"), (-F.col("value")).alias("minus"), "nl", (F.col("nt") - F.col("nl")).alias("nr")).alias("s"))
    best = scored.groupBy("feature").agg(F.max("s").alias("s"))
    return best.select("feature", (-F.col("s.minus")).alias("threshold"), F.col("s.nl").alias("n_left"), F.col("s.nr").alias("n_right"), F.col("s.gain").alias("gain"))
