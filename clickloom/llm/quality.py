"""Quality rules: robust multivariate outliers among documents of one language and source.

Each document gives a vector of transformed statistics. Per group the minimum-covariance-determinant estimate of
location and scatter is found by concentration steps: keep the three quarters of the group nearest to the present
estimate, estimate again from these. A document is rejected if its squared Mahalanobis distance exceeds ``CUT``.

A step is one aggregation: moments by group and distance bin, combined before the shuffle, so a group of any size
costs a few hundred small rows. The first estimate is the middle of coordinatewise quartiles, from counts of rounded
values. Documents that fail the base rules take no part in the estimates.

The estimate of a pair of language and source is drawn towards that of its whole language, large sources included:
with n documents it weighs n / (n + ``PRIOR``), so that no verdict turns on a size. A floor is added to each variance; a
language below ``PRIOR`` documents has it ``PRIOR`` / n times as large, as few tell little of the scatter. Languages never mix.
Null languages and sources are values of their own. A null or empty text has no words and
fails the base rules. Rows are judged one by one, so repeated rows get equal verdicts; columns of the table that are named like the method's own stay as they are. An empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from clickloom.llm.tables import free_name, hinted, stored, table
from clickloom.llm.textstats import statistics

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")

#: base rules: words at least, percent of words in repeated windows at most
LEAST_WORDS, MOST_REPEATED = 10, 20
#: documents that a language's estimate counts for in those of its sources, part of a group that an estimate keeps, steps
PRIOR, KEEP, STEPS = 200, 0.75, 5
#: chi-square quantile of one in a million at 5 dimensions; the factor that makes scatter from the nearest 75 % consistent
CUT, CONSISTENT = 35.9, 1.41
#: standard deviations that are added to each coordinate, in its own unit: nothing closer than these counts as different.
#: Repeated windows end at 0.2, where the base rule begins, so their floor is as much finer
FLOORS = (0.05, 0.25, 0.1, 0.03, 0.3)
P = len(FLOORS)


def _count(texts: pa.Array) -> pa.Array:
    parts = [pa.StructArray.from_arrays([pa.array(s[c], pa.int64()) for c in COUNTS], list(COUNTS)) for _, s in statistics(texts)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.struct([(c, pa.int64()) for c in COUNTS]))


# so marked, a filter on the counts does not make the plan count a second time
text_counts = F.arrow_udf(_count, T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])).asNondeterministic()


def base_failed(counts: Column) -> Column:
    return (counts["n_words"] < LEAST_WORDS) | (100 * counts["n_repeat_words"] > MOST_REPEATED * counts["n_words"])


def vector(counts: Column) -> list[Column]:
    """Word length, symbols, repeated lines, repeated windows, capitals; constants pull short texts to the middle."""
    return [
        F.log((counts["word_chars"] + 500) / (counts["n_words"] + 100)),
        F.log1p(100 * counts["n_symbols"] / (counts["word_chars"] + 200)),
        counts["n_dup_lines"] / (counts["n_lines"] + 10),
        counts["n_repeat_words"] / (counts["n_words"] + 50),
        F.log((counts["n_upper"] + 4) / (counts["word_chars"] + 200)),
    ]


def _key(lang: str, source: str) -> Column:
    return F.to_json(F.struct(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{source}`").cast("string").alias("source")))


_LANG = "lang "  # no pair's key begins so


def _whole(lang: str) -> Column:
    return F.concat(F.lit(_LANG), F.to_json(F.struct(lang)))


def _estimate(group: pa.Table, n: float, centre: np.ndarray, cov: np.ndarray) -> pa.Table:
    kind = pa.list_(pa.float64())
    return pa.table({"grp": [group["grp"][0].as_py()], "n": [float(n)], "centre": pa.array([centre], kind),
                     "cov": pa.array([cov.ravel()], kind), "inverse": pa.array([np.linalg.inv(cov).ravel()], kind)})


def _floor(group: pa.Table, n: float) -> np.ndarray:
    """Variances added to the estimate of a group of n documents; a pair's grow with its language's weight instead."""
    return np.square(FLOORS) * (max(1, PRIOR / n) if group["grp"][0].as_py().startswith(_LANG) else 1)


def _first(counts: pa.Table) -> pa.Table:
    """Quartiles of each coordinate from counts of rounded values."""
    which, value, n = (counts[c].to_numpy() for c in ("i", "value", "n"))
    size = n.sum() / P
    centre, scale = np.zeros(P), np.sqrt(_floor(counts, size))
    for i in range(P):
        order = np.flatnonzero(which == i)
        order = order[np.argsort(value[order])]
        share = np.cumsum(n[order]) / n[order].sum()
        low, centre[i], high = value[order][np.searchsorted(share, (0.25, 0.5, 0.75))] / 1000
        scale[i] = max(scale[i], (high - low) / 1.349)
    return _estimate(counts, size, centre, np.diag(scale**2))


def _next(bins: pa.Table) -> pa.Table:
    """The estimate from the nearest bins that hold ``KEEP`` of the group."""
    order = np.argsort(bins["bin"].to_numpy())
    seen = np.cumsum(bins["n"].to_numpy()[order])
    near = order[:np.searchsorted(seen, KEEP * seen[-1]) + 1]
    m = {c: bins[c].to_numpy()[near].sum() for c in bins.column_names if c not in ("grp", "bin")}
    centre = np.array([m[f"s{i}"] for i in range(P)]) / m["n"]
    cov = np.array([[m[f"s{min(i, j)}{max(i, j)}"] for j in range(P)] for i in range(P)]) / m["n"] - np.outer(centre, centre)
    return _estimate(bins, seen[-1], centre, CONSISTENT * cov + np.diag(_floor(bins, seen[-1])))


_ESTIMATE = "grp string, n double, centre array<double>, cov array<double>, inverse array<double>"


def _drawn(both: pa.Table) -> pa.Table:
    """Each pair's estimate, drawn towards its language's."""
    columns = {c: np.array(both[c].to_pylist()) for c in ("n", "centre", "cov", "lang_centre", "lang_cov")}
    w = (columns["n"] / (columns["n"] + PRIOR))[:, None]
    centre = w * columns["centre"] + (1 - w) * columns["lang_centre"]
    cov = (w * columns["cov"] + (1 - w) * columns["lang_cov"]).reshape(-1, P, P)
    kind = pa.list_(pa.float64())
    return pa.table({"pair": both["grp"], "centre": pa.array(list(centre), kind),
                     "inverse": pa.array(list(np.linalg.inv(cov).reshape(-1, P * P)), kind)})


def _draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield from _drawn(pa.Table.from_batches([batch])).to_batches()


def distance(x: list[Column]) -> Column:
    """Squared Mahalanobis distance from the row's ``centre`` and ``inverse``."""
    off = [v - F.col("centre")[i] for i, v in enumerate(x)]
    return sum((F.col("inverse")[i * P + j] * off[i] * off[j] for i in range(P) for j in range(P)), F.lit(0.0))


def fit(slim: DataFrame) -> DataFrame:
    """Estimates by (language, source) key ``pair``, from rows with pair, lang and the coordinates x0, x1, ..."""
    groups = F.explode(F.array(F.col("pair"), _whole("lang"))).alias("grp")
    rows = slim.select(groups, *[f"x{i}" for i in range(P)])
    x = [F.col(f"x{i}") for i in range(P)]
    rounded = F.posexplode(F.array(*[F.round(v * 1000).cast("long") for v in x])).alias("i", "value")
    estimate = stored(rows.select("grp", rounded).groupBy("grp", "i", "value").agg(F.count("*").alias("n"))
                      .groupBy("grp").applyInArrow(_first, _ESTIMATE), "quality-estimate")
    moments = [F.count("*").alias("n"), *[F.sum(x[i]).alias(f"s{i}") for i in range(P)],
               *[F.sum(x[i] * x[j]).alias(f"s{i}{j}") for i in range(P) for j in range(i, P)]]
    for _ in range(STEPS):
        near = rows.join(hinted(estimate.drop("n", "cov")), "grp").withColumn("bin", F.floor(16 * F.log(distance(x) + 1e-6)))
        estimate = stored(near.groupBy("grp", "bin").agg(*moments).groupBy("grp").applyInArrow(_next, _ESTIMATE), "quality-estimate")
    whole = estimate.select(F.col("grp").alias("whole"), F.col("centre").alias("lang_centre"), F.col("cov").alias("lang_cov"))
    pairs = stored(slim.select("pair", _whole("lang").alias("whole")).distinct(), "quality-pairs")
    both = estimate.join(hinted(pairs.withColumnRenamed("pair", "grp")), "grp").join(hinted(whole), "whole")
    return stored(both.select("grp", "n", "centre", "cov", "lang_centre", "lang_cov").mapInArrow(
        _draw, "pair string, centre array<double>, inverse array<double>"), "quality-fit")


def judge(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The table (or its columns ``keep``) with ``quality``: counts, base_failed, distance and kept.

    The estimates come from all rows; with texts kept, they are counted once more rather than shuffled.
    """
    measured = docs.select(_key(lang, source).alias("pair"), F.col(lang).cast("string").alias("lang"), text_counts(F.col(text)).alias("c"),
                           *[F.col(f"`{k}`").alias(f"keep_{i}") for i, k in enumerate(keep or [])])
    slim = stored(measured, "quality-counts")
    estimates = fit(slim.where(~base_failed(F.col("c"))).select("pair", "lang", *[v.alias(f"x{i}") for i, v in enumerate(vector(F.col("c")))]))
    if keep is None:
        rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _key(lang, source).alias("pair"),
                           text_counts(F.col(text)).alias("c"))
        columns = [F.col("row")[c].alias(c) for c in docs.columns]
    else:
        rows, columns = slim, [F.col(f"keep_{i}").alias(k) for i, k in enumerate(keep)]
    judged = rows.join(hinted(estimates.withColumnRenamed("pair", "fit_pair")), F.col("pair") == F.col("fit_pair"), "left")
    failed, far = base_failed(F.col("c")), distance(vector(F.col("c")))
    return judged.select(*columns, F.struct(
        F.col("c.*"), failed.alias("base_failed"), far.alias("distance"),
        (~failed & F.coalesce(far <= CUT, F.lit(False))).alias("kept")).alias(free_name(docs, "quality")))


def good_documents(docs: DataFrame) -> DataFrame:
    """The rows of the table that are kept."""
    name = free_name(docs, "quality")
    return judge(docs).where(F.col(f"{name}.kept")).select(*[F.col(f"`{c}`") for c in docs.columns])


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), keep=["doc_id"]).select(
        "doc_id", *[f"quality.{c}" for c in COUNTS[:5]], "quality.base_failed", "quality.kept", "quality.distance")
