"""Mixing sources to target weights by entropy balancing.

Rates w of documents (expected copies) should stay close to 1 in relative entropy while each source's tokens,
sum(w * size), meet its target. The optimum tilts exponentially: w = exp(lambda_source * size / mean size), at most
``MOST``. The dual is convex; its lambdas are found by Newton steps, each one distributed aggregation. Documents of one
source and size share their rate, so the steps run over counts by (source, size), made once.

Rates become copies cell by cell, from the largest size down, so that tokens taken follow tokens wanted: the error of a
source ends below its smallest size where a cell can still take or leave one. In a cell the documents with the smallest
seeded hashes of their id and text take one copy more. Rows that share the last such hash are numbered, so that no more
of them take it than are wanted. Reruns agree, but for which of the rows equal in id and text these are.

Targets share all tokens by weight; one stops at ``MOST`` times its source's size and the excess goes to the others.

A null text has size 0; size 0 keeps one copy, as copies of it cost nothing. A null source is a source of its own. Rows
without id or with a repeated one count like others; rows repeated in full can differ by one copy. An empty table gives
none. A column of the table named like one of the result's is replaced.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from clickloom.llm.tables import free_name, stored, table

SEED = 20250310
MOST = 3
WEIGHTS = (1, 2, 3)
STEPS = 60
PRECISION = 1e-9
OWN = ("size", "source_size", "target", "copies")
#: documents of one (source, size) are ranked in pieces of about so many
PIECE = 256
#: numbered rows of one hash are counted in blocks of at most so many
BLOCK = 4096


def size_of(text: Column) -> Column:
    """Words between ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, most: int = MOST) -> DataFrame:
    """Per source: source_size and target. One row per source is ordered; the level is a prefix sum over these rows.

    With weights w and caps c = most * size, targets are min(c, level * w): sources reach their caps in order of c / w.
    """
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_ratio = Window.orderBy("ratio", "source")
    weighed = sizes.withColumn(
        "weight", F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]),
                               F.pmod(F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1, F.lit(len(WEIGHTS))) + 1))
    capped = weighed.withColumns({"cap": most * F.col("source_size"), "ratio": most * F.col("source_size") / F.col("weight")})
    summed = capped.withColumns({
        "full": F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "open": F.sum("weight").over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
        "total": F.sum("source_size").over(everything)})
    own_level = (F.col("total") - F.col("full")) / F.col("open")
    # the first source not filled gives the level; filled ones come before it
    first = F.min(F.when(own_level <= F.col("ratio"), F.struct("ratio", "source", own_level.alias("level")))).over(everything)
    return summed.withColumn("level", first["level"]).select(
        "source", "source_size",
        F.least(F.col("cap").cast("double"), F.coalesce(F.col("level"), F.lit(0.0)) * F.col("weight")).alias("target"))


def _tilted(most: int) -> Column:
    return F.least(F.lit(float(most)), F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean"), F.lit(50.0))))


def tilts(cells: DataFrame, goals: DataFrame, most: int = MOST, steps: int = STEPS) -> DataFrame:
    """Per source the lambda whose rates meet the target: Newton steps kept inside a shrinking bracket.

    Each step sums tokens and their derivative over all cells by source, then moves each source's row.
    """
    state = goals.select("source", "target", "mean", F.lit(0.0).alias("tilt"), F.lit(-1e4).alias("low"), F.lit(1e4).alias("high"),
                         (F.col("target") >= most * F.col("source_size")).alias("done"))
    state = stored(state, "mix-state")
    for _ in range(steps):
        rate = _tilted(most)
        sums = (
            cells.join(state.where("NOT done"), F.col("cell_source").eqNullSafe(F.col("source")))
            .groupBy("source").agg(
                F.sum(F.col("n") * F.col("size") * rate).alias("tokens"),
                F.sum(F.when(rate < most, F.col("n") * F.col("size") * F.col("size") / F.col("mean") * rate).otherwise(0.0)).alias("slope"))
            .select(F.col("source").alias("sum_source"), "tokens", "slope"))
        over = F.col("tokens") > F.col("target")
        moved = state.where("NOT done").join(sums, F.col("source").eqNullSafe(F.col("sum_source"))).withColumns({
            "low": F.when(over, F.col("low")).otherwise(F.col("tilt")),
            "high": F.when(over, F.col("tilt")).otherwise(F.col("high")),
            "off": F.abs(F.col("tokens") - F.col("target")) / F.greatest(F.col("target"), F.lit(1e-9)),
        })
        newton = F.col("tilt") - (F.col("tokens") - F.col("target")) / F.nullif(F.col("slope"), F.lit(0.0))
        inside = (newton > F.col("low")) & (newton < F.col("high"))
        # the first steps outside the bracket go outwards by doubling, later ones halve it
        fallback = F.when(F.col("low") <= -1e4, F.col("high") * 2 - 1).when(F.col("high") >= 1e4, F.col("low") * 2 + 1) \
            .otherwise((F.col("low") + F.col("high")) / 2)
        moved = moved.withColumn("done", (F.col("off") < PRECISION) | (F.col("high") - F.col("low") < 1e-13)).withColumn(
            "tilt", F.when(F.col("done"), F.col("tilt")).when(F.coalesce(inside, F.lit(False)), newton).otherwise(fallback))
        state = stored(moved.select(*state.columns).unionByName(state.where("done")), "mix-state")
        if state.where("NOT done").isEmpty():
            break
    return state


def _round_cells(cells: pa.Table) -> pa.Table:
    """Whole copies of each cell of one source, larger sizes first; tokens taken follow those wanted."""
    cells = cells.take(np.argsort(-cells["size"].to_numpy(), kind="stable"))
    size, n, rate, most = (cells[c].to_numpy() for c in ("size", "n", "rate", "most"))
    wanted = np.cumsum(rate * n * size)
    given, taken = np.empty(len(n), np.int64), 0
    for i in range(len(n)):
        given[i] = min(max(round((wanted[i] - taken) / size[i]), 0), int(most[i]) * n[i])
        taken += int(given[i]) * int(size[i])
    return cells.select(["cell_source", "size", "n"]).append_column("copies", pa.array(given))


def mix(docs: DataFrame, source: str = "source", text: str = "text", key: str = "doc_id", most: int = MOST,
        seed: int = SEED) -> DataFrame:
    """All rows with ``size``, ``source_size``, ``target`` and ``copies``; a name that the table has gets a ``_`` more."""
    rows = planned_copies(docs, source, text, key, most, seed)
    return rows.select("row.*", *[F.col(c).alias(free_name(docs, c)) for c in OWN])


def planned_copies(docs: DataFrame, source: str = "source", text: str = "text", key: str = "doc_id", most: int = MOST,
                   seed: int = SEED) -> DataFrame:
    """All rows as ``row``, beside ``size``, ``source_size``, ``target`` and ``copies``."""
    own = F.xxhash64(F.lit(seed), F.col(key), F.col(text))
    # the only pass over texts
    slim = stored(docs.select(F.col(source).alias("cell_source"), size_of(F.col(text)).alias("size"), own.alias("h")), "mix-sizes")
    cells = stored(slim.groupBy("cell_source", "size").agg(F.count("*").alias("n")), "mix-cells")
    per_source = cells.groupBy(F.col("cell_source").alias("source")).agg(
        F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("docs"))
    goals = stored(targets(per_source.select("source", "source_size"), most).join(
        per_source.select(F.col("source").alias("s"), "docs"), F.col("source").eqNullSafe(F.col("s"))).select(
        "source", "source_size", "target", (F.col("source_size") / F.col("docs")).alias("mean")), "mix-goals")
    solved = tilts(cells.where("size > 0"), goals, most)

    rated = cells.where("size > 0").join(
        solved.join(goals.select(F.col("source").alias("g"), "source_size"), F.col("source").eqNullSafe(F.col("g"))),
        F.col("cell_source").eqNullSafe(F.col("source"))).select(
        "cell_source", "size", "n", F.lit(most).alias("most"),
        F.when(F.col("target") >= most * F.col("source_size"), F.lit(float(most))).otherwise(_tilted(most)).alias("rate"))
    whole = rated.groupBy("cell_source").applyInArrow(
        _round_cells, f"cell_source {dict(rated.dtypes)['cell_source']}, size long, n long, copies long").select(
        "cell_source", "size", "n", F.floor(F.col("copies") / F.col("n")).alias("each"), (F.col("copies") % F.col("n")).alias("more"))
    whole = stored(whole, "mix-whole")

    # the hash up to which documents of a cell take one more: ranks within pieces of the cell, by hash
    split = slim.join(whole.where("more > 0").withColumnRenamed("cell_source", "s"),
                      F.col("cell_source").eqNullSafe(F.col("s")) & (slim["size"] == whole["size"])).select(
        "cell_source", slim["size"], "h", "more",
        F.floor((F.col("h") / F.lit(2.0**64) + 0.5) * F.ceil(F.col("n") / F.lit(PIECE))).alias("piece"))
    before = Window.partitionBy("cell_source", "size").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    counted = split.groupBy("cell_source", "size", "piece").agg(F.count("*").alias("here"), F.first("more").alias("more")).withColumn(
        "rest", F.col("more") - F.coalesce(F.sum("here").over(before), F.lit(0))).where("rest > 0 AND rest <= here").select(
        F.col("cell_source").alias("s"), F.col("size").alias("z"), F.col("piece").alias("p"), "rest")
    last = split.join(counted, F.col("cell_source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")) & (F.col("piece") == F.col("p")))
    # rows of one hash are one row here, with their count
    upto = Window.partitionBy("cell_source", "size").orderBy("h").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = last.groupBy("cell_source", "size", "h").agg(F.count("*").alias("here"), F.first("rest").alias("rest")).withColumn(
        "upto", F.sum("here").over(upto))
    cuts = ranked.where("rest <= upto AND rest > upto - here").select(
        F.col("cell_source").alias("cut_source"), F.col("size").alias("cut_size"), F.col("h").alias("cut"),
        F.when(F.col("rest") < F.col("upto"), F.col("rest") - F.col("upto") + F.col("here")).alias("part"))
    plan = whole.join(cuts, F.col("cell_source").eqNullSafe(F.col("cut_source")) & (F.col("size") == F.col("cut_size")), "left").select(
        F.col("cell_source").alias("plan_source"), F.col("size").alias("plan_size"), "each", "cut", "part")
    plan = stored(plan.join(goals.withColumnRenamed("source", "g"), F.col("plan_source").eqNullSafe(F.col("g"))).drop("g", "mean"), "mix-plan")
    none = goals.select(F.col("source").alias("plan_source"), F.lit(0).cast("long").alias("plan_size"), F.lit(1).cast("long").alias("each"),
                        F.lit(None).cast("long").alias("cut"), F.lit(None).cast("long").alias("part"), "source_size", "target")

    measured = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(source).alias("doc_source"),
                           size_of(F.col(text)).alias("size"), own.alias("h"))
    def planned(rows: DataFrame) -> DataFrame:
        return measured.join(rows, F.col("doc_source").eqNullSafe(F.col("plan_source")) & (F.col("size") == F.col("plan_size")))

    def result(rows: DataFrame, more: Column) -> DataFrame:
        return rows.select("row", "size", "source_size", "target",
                           (F.col("each") + F.coalesce(more.cast("long"), F.lit(0))).alias("copies"))

    at_cut = F.coalesce(F.col("part").isNotNull() & (F.col("h") == F.col("cut")), F.lit(False))
    everything = planned(plan.unionByName(none))
    split_cuts = plan.where("part IS NOT NULL")
    if split_cuts.isEmpty():
        return result(everything, F.col("h") <= F.col("cut"))
    # of the rows that share a cut hash only some take one more: these rows are kept with a number
    equal = stored(planned(split_cuts).where(at_cut).withColumn("number", F.monotonically_increasing_id()), "mix-equal")
    return result(everything.where(~at_cut), F.col("h") <= F.col("cut")).unionByName(_numbered(equal, result))


def _numbered(equal: DataFrame, result: Callable[[DataFrame, Column], DataFrame]) -> DataFrame:
    """Results of numbered rows, of which the first ``part`` of each (source, size) take one copy more."""
    cell = ["plan_source", "plan_size"]
    slim = equal.select(*cell, "part", "number", F.floor(F.col("number") / F.lit(BLOCK)).alias("block"))
    before = Window.partitionBy(*cell).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = slim.groupBy(*cell, "block").agg(F.count("*").alias("here"), F.first("part").alias("part")).withColumn(
        "rest", F.col("part") - F.coalesce(F.sum("here").over(before), F.lit(0))).where("rest > 0 AND rest <= here").select(
        F.col("plan_source").alias("s"), F.col("plan_size").alias("z"), F.col("block").alias("b"), "rest")
    last = slim.join(blocks, F.col("plan_source").eqNullSafe(F.col("s")) & (F.col("plan_size") == F.col("z")) & (F.col("block") == F.col("b")))
    ends = stored(last.withColumn("rank", F.row_number().over(Window.partitionBy(*cell).orderBy("number"))).where("rank = rest").select(
        "s", "z", F.col("number").alias("last")), "mix-last")
    return result(equal.join(ends, F.col("plan_source").eqNullSafe(F.col("s")) & (F.col("plan_size") == F.col("z"))), F.col("number") <= F.col("last"))


def expand(planned: DataFrame) -> DataFrame:
    """Rows of ``planned_copies``, each as often as its copies say, with the columns of their table."""
    return planned.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planned_copies(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select(
        "row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", "row.source")
