"""Lines and records of CSV files, found in parallel.

Lines end in a line feed; a carriage return before it belongs to the line's end. A record is a
line, or several while a quote is open. One grammar holds for files of every size.

A line alone does not tell whether it starts inside quotes. But for either assumption it tells
where it ends, so each file block can be summed up as a pair of outcomes, the few summaries of a
file can be chained, and every line then knows its state and its record number. No file is read
by a single task, however large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


def decoded(metadata_field: str) -> Column:
    """File metadata is URL-encoded except for '+'."""
    return F.url_decode(F.replace(F.col(f"_metadata.{metadata_field}"), F.lit("+"), F.lit("%2B")))


def open_after(line: Column, open_before: bool) -> Column:
    """Whether a line ends inside a quoted cell, given whether it starts in one.

    A quote opens a cell only as its first character; elsewhere in a bare cell it is text.
    """
    def step(is_open: Column, piece: Column) -> Column:
        odd = (F.octet_length(piece) - F.octet_length(F.replace(piece, F.lit('"'), F.lit("")))) % 2 == 1
        return F.when(is_open | F.startswith(piece, F.lit('"')), is_open != odd).otherwise(is_open)

    return F.when(
        F.contains(line, F.lit('"')), F.aggregate(F.split(line, ","), F.lit(open_before), step)
    ).otherwise(F.lit(open_before))


def is_open_after(line: str, is_open: bool) -> bool:
    """The same rule for one line on the driver."""
    for piece in line.split(","):
        if is_open or piece.startswith('"'):
            is_open ^= piece.count('"') % 2 == 1
    return is_open


def file_path() -> Column:
    """Path of a row's file as ``storage.plain`` spells it."""
    return F.regexp_replace(decoded("file_path"), "^file:/+", "file:/")


def without_return(text: Column) -> Column:
    return F.when(F.endswith(text, F.lit("\r")), F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)


def read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row per line: path, block and place (its position), record, broken (never)."""
    return spark.read.option("lineSep", "\n").text(paths).select(
        file_path().alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        without_return(F.col("value")).alias("record"),
        F.lit(False).alias("broken"),
    ).where("record <> ''")


def _chain(df: DataFrame, keys: list[str], order: list[str], if_closed: str, if_open: str) -> DataFrame:
    """Add after_closed and after_open: the state after each row for either state before the first.

    A row either fixes the state, flips it or leaves it. So the state is that of the latest
    fixing row, flipped by the flips since.
    """
    running = Window.partitionBy(*keys).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    fixes = F.col(if_closed) == F.col(if_open)
    flips = F.col(if_closed) & ~F.col(if_open)
    fixed = F.when(fixes, F.struct(F.col(if_closed).alias("state"), F.col("flips").alias("flips")))
    chained = df.withColumn("flips", F.sum(F.when(flips, 1).otherwise(0)).over(running)).withColumn(
        "fixed", F.last(fixed, ignorenulls=True).over(running)
    )

    def after(first: bool) -> Column:
        since = F.col("flips") - F.coalesce(F.col("fixed.flips"), F.lit(0))
        return F.coalesce(F.col("fixed.state"), F.lit(first)) != (since % 2 == 1)

    return chained.withColumns({"after_closed": after(False), "after_open": after(True)}).drop(
        "flips", "fixed"
    )


def read_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row per record: path, block and place (its position), record, broken.

    A file may end inside quotes. If that record is more than one line, its lines are rows of their
    own, ``broken``: no record gathers the rest of a file.
    """
    keys, order = ["path", "block"], ["line_no"]
    lines = (
        spark.read.option("lineSep", "\n").text(paths)
        .select(
            "value",
            file_path().alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line_no"),
        )
        .withColumns({"if_closed": open_after(F.col("value"), False), "if_open": open_after(F.col("value"), True)})
    )
    within = Window.partitionBy(*keys).orderBy(*order)
    states = _chain(lines, keys, order, "if_closed", "if_open").withColumns({
        "open_if_closed": F.lag("after_closed", 1, False).over(within),
        "open_if_open": F.lag("after_open", 1, True).over(within),
    })

    blocks = states.groupBy(*keys).agg(
        F.max_by("after_closed", "line_no").alias("if_closed"),
        F.max_by("after_open", "line_no").alias("if_open"),
        F.count_if(~F.col("open_if_closed")).alias("starts_if_closed"),
        F.count_if(~F.col("open_if_open")).alias("starts_if_open"),
    )
    by_file = Window.partitionBy("path").orderBy("block")
    whole_file = by_file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = (
        _chain(blocks, ["path"], ["block"], "if_closed", "if_open")
        .withColumn("starts_open", F.lag("after_closed", 1, False).over(by_file))
        .withColumn(
            "starts",
            F.when(F.col("starts_open"), F.col("starts_if_open")).otherwise(F.col("starts_if_closed")),
        )
        .select(
            "path", "block", "starts_open",
            F.coalesce(
                F.sum("starts").over(by_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("records_before"),
            F.sum("starts").over(whole_file).alias("records"),
            F.last("after_closed").over(whole_file).alias("ends_open"),
            F.max("block").over(whole_file).alias("last_block"),
        )
    )

    is_open = F.when(F.col("starts_open"), F.col("open_if_open")).otherwise(F.col("open_if_closed"))
    running = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = states.join(placed, keys).withColumn(
        "record_no",
        F.col("records_before") + F.sum(F.when(is_open, 0).otherwise(1)).over(running),
    )
    # a record of one line passes as it is; only others are gathered
    line = {"block": F.col("block"), "place": F.col("line_no"), "record": without_return(F.col("value"))}
    tail = F.col("ends_open") & (F.col("record_no") == F.col("records"))
    after = F.when(F.col("starts_open"), F.col("after_open")).otherwise(F.col("after_closed"))
    alone = ~is_open & (~after | (tail & F.col("last_line")))
    last_line = F.lead("line_no").over(within).isNull() & (F.col("block") == F.col("last_block"))
    marked = numbered.withColumn("last_line", last_line).withColumns({"alone": alone, "tail": tail})
    single = marked.where("alone OR tail").select(
        "path", *[c.alias(n) for n, c in line.items()], (~F.col("alone")).alias("broken")
    )
    parts = F.array_sort(F.collect_list(F.struct("block", "line_no", "value")))
    several = (
        marked.where("NOT alone AND NOT tail").groupBy("path", "record_no").agg(parts.alias("parts"))
        .select(
            "path",
            F.col("parts")[0]["block"].alias("block"),
            F.col("parts")[0]["line_no"].alias("place"),
            without_return(F.array_join(F.transform("parts", lambda p: p["value"]), "\n")).alias("record"),
            F.lit(False).alias("broken"),
        )
    )
    return single.unionByName(several).where("record <> ''")
