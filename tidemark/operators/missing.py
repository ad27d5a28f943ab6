"""Why values are missing: joint patterns, nullity correlations, mechanism tests."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.joins import null_safe_join
from tidemark.functions.missing import is_missing, null_if_nan
from tidemark.functions.ordering import running_total
from tidemark.functions.quantiles import quantiles
from tidemark.operators.aggregates import percent_by_group
from tidemark.session import pin


def missing_flags(df: DataFrame, columns: Sequence[str], suffix: str = "_missing") -> DataFrame:
    return df.withColumns({f"{c}{suffix}": is_missing(df, c) for c in columns})


def any_present(df: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(or_, [~is_missing(df, c) for c in columns])


def co_missing(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows by the two missing flags, with percent of all rows."""
    flags = df.select(is_missing(df, a).alias(f"{a}_missing"), is_missing(df, b).alias(f"{b}_missing"))
    return percent_by_group(flags, flags.columns)


def missing_independence(df: DataFrame, a: str, b: str) -> DataFrame:
    """Observed share of rows missing both, the share expected if independent, lift and 2x2 chi-square."""
    n = F.count(F.lit(1)).cast("double")
    counts = df.select(is_missing(df, a).alias("a"), is_missing(df, b).alias("b")).agg(
        n.alias("n"),
        F.count_if("a").cast("double").alias("na"),
        F.count_if("b").cast("double").alias("nb"),
        F.count_if(F.col("a") & F.col("b")).cast("double").alias("nab"),
    )
    n, na, nb, nab = (F.col(c) for c in ("n", "na", "nb", "nab"))
    cross = nab * (n - na - nb + nab) - (na - nab) * (nb - nab)
    return counts.select(
        (na / n).alias("share_a"),
        (nb / n).alias("share_b"),
        (na / n * nb / n).alias("expected"),
        (nab / n).alias("observed"),
        F.try_divide(nab * n, na * nb).alias("lift"),
        F.try_divide(n * cross * cross, na * nb * (n - na) * (n - nb)).alias("chi_square"),
    )


def missing_by_category(df: DataFrame, missing: Sequence[str], category: str) -> DataFrame:
    """Rows missing all of ``missing``, counted by category with their share of these rows."""
    gone = df.where(reduce(lambda x, y: x & y, [is_missing(df, c) for c in missing]))
    return percent_by_group(gone.select(category), [category])


def nullity_patterns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per missing pattern, one digit per column, 1 = missing."""
    digits = F.concat(*[is_missing(df, c).cast("int").cast("string") for c in columns])
    return df.select(digits.alias("pattern")).groupBy("pattern").agg(F.count(F.lit(1)).alias("count"))


EVERY_ROW = -1  # stands beside the positions of missing columns, so that totals come from the same counts


def _gone(df: DataFrame, columns: Sequence[str]) -> Column:
    """``EVERY_ROW`` and the positions of the row's missing columns."""
    return F.array_compact(
        F.array(F.lit(EVERY_ROW), *[F.when(is_missing(df, c), F.lit(i)) for i, c in enumerate(columns)])
    )


def _named(columns: Sequence[str], position: str) -> Column:
    return F.get(F.array(*[F.lit(c) for c in columns]), F.col(position))


def missing_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(a, b, n, na, nb, nab)`` for every pair of columns: all rows, rows missing a, missing b, missing both.

    One scan counts the distinct patterns; pairs are unfolded from the gaps of each pattern, so the work follows
    the missing values and not the number of scans. The counts of all pairs, a number that the schema fixes, meet in
    one sorted array, where each is found by its place.
    """
    width = len(columns)
    every = F.sequence(F.lit(EVERY_ROW), F.lit(width - 1))
    gone = F.filter(every, lambda i: (i == EVERY_ROW) | (F.substring("pattern", i + 1, 1) == "1"))
    # the outer form adds no filter, which Spark would move below the count and evaluate for every row
    found = (
        nullity_patterns(df, columns).select(gone.alias("gone"), F.col("count").alias("rows"))
        .select("gone", "rows", F.explode_outer("gone").alias("i"))
        .select("i", F.explode_outer(F.filter("gone", lambda g: g >= F.col("i"))).alias("j"), "rows")
    )
    none = df.sparkSession.range(1).select(F.explode(every).alias("i")).select(
        "i", F.explode(F.sequence(F.col("i"), F.lit(width - 1))).alias("j"), F.lit(0).cast("bigint").alias("rows")
    )
    counts = found.union(none).groupBy("i", "j").agg(F.sum("rows").alias("rows"))
    table = counts.agg(F.sort_array(F.collect_list(F.struct("i", "j", "rows"))).alias("t"))

    def count(i: Column, j: Column) -> Column:
        """Rows missing both: row i of the triangle starts after the i - EVERY_ROW longer ones before it."""
        before = i - EVERY_ROW
        start = before * (width + 1) - (before * (before - 1) / 2).cast("int")
        return F.get(F.col("t"), start + j - i)["rows"]

    def pair(i: Column, j: Column) -> Column:
        all_rows, name = F.lit(EVERY_ROW), F.array(*[F.lit(c) for c in columns])
        return F.struct(
            F.get(name, i).alias("a"), F.get(name, j).alias("b"), count(all_rows, all_rows).alias("n"),
            count(all_rows, i).alias("na"), count(all_rows, j).alias("nb"), count(i, j).alias("nab"),
        )

    pairs = F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.lit(width - 1)),
            lambda i: F.transform(F.slice(F.sequence(F.lit(0), F.lit(width - 1)), i + 2, F.lit(width)), lambda j: pair(i, j)),
        )
    )
    return table.select(F.inline(pairs))


def nullity_corr(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Correlation of missing flags for pairs of columns that are neither full nor empty."""
    n, na, nb, nab = (F.col(c).cast("double") for c in ("n", "na", "nb", "nab"))
    spread = F.sqrt(na * (n - na)) * F.sqrt(nb * (n - nb))
    r = F.try_divide(n * nab - na * nb, spread)
    return missing_pairs(df, columns).select("a", "b", r.alias("r")).where(F.col("r").isNotNull())


def nullity_distance(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Euclidean distance of missing flags for every pair of columns."""
    differ = F.col("na") + F.col("nb") - 2 * F.col("nab")
    return missing_pairs(df, columns).select("a", "b", F.sqrt(differ.cast("double")).alias("distance"))


def value_missing_corr(df: DataFrame, values: Sequence[str], missing: Sequence[str]) -> DataFrame:
    """Correlation of observed values with missing flags, over rows where the value is present.

    With a flag, the correlation follows from the mean where it holds and the mean and spread of all rows, so one
    scan with a map-side combine measures any number of pairs.
    """
    given = F.array(
        *[F.struct(F.lit(i).alias("v"), null_if_nan(df, v).cast("double").alias("x")) for i, v in enumerate(values)]
    )
    seen = df.select(_gone(df, missing).alias("gone"), F.inline(F.filter(given, lambda g: g["x"].isNotNull())))
    cells = pin(
        seen.select("v", "x", F.explode_outer("gone").alias("m")).groupBy("v", "m")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"))
    )
    whole = cells.where(F.col("m") == EVERY_ROW).select("v", *[F.col(c).alias(f"all_{c}") for c in ("n", "mean", "std")])
    pairs = df.sparkSession.range(len(values)).select(
        F.col("id").cast("int").alias("v"), F.explode(F.sequence(F.lit(0), F.lit(len(missing) - 1))).alias("m")
    )
    share = F.coalesce(F.col("n") / F.col("all_n"), F.lit(0.0))
    r = F.try_divide(share * (F.col("mean") - F.col("all_mean")), F.col("all_std") * F.sqrt(share * (1 - share)))
    return (
        pairs.join(cells.drop("std"), ["v", "m"], "left").join(whole, "v", "left")
        .select(_named(values, "v").alias("value_column"), _named(missing, "m").alias("missing_column"), r.alias("r"))
        .where(F.col("value_column") != F.col("missing_column"))
    )


def missing_present_summary(df: DataFrame, value: str, flag: Column) -> DataFrame:
    """Box-plot numbers of ``value`` (and of log1p of it) where the flag holds and where it does not."""
    base = df.select(flag.alias("is_missing"), null_if_nan(df, value).cast("double").alias("v"))
    marks = quantiles(base, "v", [0.25, 0.5, 0.75], ["is_missing"], ["q25", "q50", "q75"])
    basic = base.groupBy("is_missing").agg(
        F.count("v").alias("count"), F.min("v").alias("min"), F.max("v").alias("max"), F.avg("v").alias("mean"),
        F.avg(F.log1p(F.when(F.col("v") > -1, F.col("v")))).alias("mean_log1p"),
    )
    spread = F.col("q75") - F.col("q25")
    return null_safe_join(basic, marks, ["is_missing"]).withColumns(
        {"lower_fence": F.col("q25") - 1.5 * spread, "upper_fence": F.col("q75") + 1.5 * spread}
    )


def scatter_sample(df: DataFrame, key: str, columns: Sequence[str], fraction: float) -> DataFrame:
    """Points for a scatter plot: a repeatable sample by the hash of a key."""
    picked = F.pmod(F.xxhash64(key), F.lit(1_000_000)) < F.lit(int(fraction * 1_000_000))
    return df.where(picked).select(*columns)


# -- Little's test -----------------------------------------------------------------------------------


def chi_square_tail(x: float, dof: float) -> float:
    """Upper tail of the chi-square distribution: series or continued fraction of the incomplete gamma."""
    a, z = dof / 2.0, x / 2.0
    if z <= 0:
        return 1.0
    scale = math.exp(a * math.log(z) - z - math.lgamma(a))
    if z < a + 1:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-15:
            k += 1
            term *= z / k
            total += term
        return max(0.0, 1.0 - total * scale)
    b = z + 1 - a
    c, d = 1e300, 1.0 / b
    h = d
    for i in range(1, 10000):
        an = -i * (i - a)
        b += 2
        d = 1.0 / (an * d + b)
        c = b + an / c
        step = d * c
        h *= step
        if abs(step - 1) < 1e-15:
            break
    return min(1.0, h * scale)


def little_mcar(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Little's test that values are missing completely at random: statistic, degrees of freedom, p-value.

    Spark reduces the table to one row per missing pattern (count and means) and one row of overall means
    and pairwise-complete covariances; what is left to solve is a p x p system per pattern, done inside the
    tasks that hold the pattern rows.
    """
    columns = list(columns)
    p = len(columns)
    base = df.select(*[null_if_nan(df, c).cast("double").alias(c) for c in columns])
    pattern = F.concat(*[F.col(f"`{c}`").isNotNull().cast("int").cast("string") for c in columns])
    groups = (
        base.groupBy(pattern.alias("pattern"))
        .agg(F.count(F.lit(1)).alias("n"), F.array(*[F.avg(c) for c in columns]).alias("means"))
        .where(F.col("pattern").contains("1"))
    )

    def paired(a: str, b: str) -> Column:
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        return F.covar_samp(F.when(both, F.col(a)), F.when(both, F.col(b)))

    overall = base.agg(
        F.struct(
            F.array(*[F.avg(c) for c in columns]).alias("mean"),
            F.array(*[paired(a, b) for a in columns for b in columns]).alias("cov"),
        ).alias("o")
    )

    def distance(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                seen = [i for i, ch in enumerate(r.pattern) if ch == "1"]
                delta = np.array([r.means[i] - r.mean[i] for i in seen])
                cov = np.array(r.cov, dtype=float).reshape(p, p)[np.ix_(seen, seen)]
                # columns that depend on each other, or do not vary, add nothing: the least-norm solution leaves them out
                inverse = np.linalg.pinv(np.nan_to_num(cov), rcond=1e-12, hermitian=True)
                rows.append((float(r.n) * float(delta @ inverse @ delta), len(seen)))
            yield pd.DataFrame(rows, columns=["d2", "observed"])

    parts = groups.withColumn("o", overall.scalar()).select("pattern", "n", "means", "o.mean", "o.cov")
    total = parts.mapInPandas(distance, "d2 double, observed long").agg(
        F.sum("d2").alias("statistic"), (F.sum("observed") - p).alias("dof")
    )

    def with_tail(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(
                p_value=[chi_square_tail(s, d) if d > 0 else 1.0 for s, d in zip(batch["statistic"], batch["dof"])]
            )

    return total.mapInPandas(with_tail, "statistic double, dof long, p_value double")


# -- predicting missingness --------------------------------------------------------------------------


def auc_by_ranks(df: DataFrame, score: str, label: str) -> DataFrame:
    """Exact area under the ROC curve, ties counted half.

    Labels are counted per distinct score first; the running count of negatives is spread over range
    partitions, so neither many ties nor many distinct scores meet in one task.
    """
    cells = df.groupBy(F.col(score).alias("s")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    ranked = running_total(cells, ["s"], F.col("neg"), "neg_upto")
    wins = F.col("pos") * (F.col("neg_upto") - F.col("neg") + F.col("neg") / 2.0)
    return ranked.agg(F.try_divide(F.sum(wins), F.sum("pos").cast("double") * F.sum("neg")).alias("auc"))


def missing_auc(df: DataFrame, target: str, features: Sequence[str], strength: float = 1.0) -> DataFrame:
    """Fit a logistic model of "``target`` is missing" on the features (gaps as 0) and return its AUC.

    ``strength`` is the weight of the data against the squared weights, summed over rows; Spark's penalty is
    per row, hence the division.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    base = df.select(
        is_missing(df, target).cast("double").alias("label"),
        *[F.coalesce(null_if_nan(df, f).cast("double"), F.lit(0.0)).alias(f) for f in features],
    )
    frame = VectorAssembler(inputCols=list(features), outputCol="features").transform(base).select("label", "features")
    penalty = 1.0 / (strength * max(1, frame.count()))
    model = LogisticRegression(regParam=penalty, standardization=False, maxIter=100).fit(frame)
    # ranks only need the linear part, written as a plain expression over the same columns
    linear = reduce(
        lambda a, b: a + b, [F.col(f) * F.lit(float(w)) for f, w in zip(features, model.coefficients)], F.lit(float(model.intercept))
    )
    return auc_by_ranks(base.select("label", linear.alias("score")), "score", "label")


