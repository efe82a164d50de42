"""CSV event files whose headers drift.

A first scan looks at line ends, quotes and lines that may be headers, and tells three kinds of file.
Plain files have no line break inside quotes, one line like their header and no blank line: their rows
are all other lines, whatever their order, parsed in one scan. Files with more such lines need the
place of those; files with breaks inside quotes are read as records. Files are grouped by kind and
header, and cells are renamed, merged and derived by plain expressions, so one run over many shapes
stays one DataFrame.

One grammar holds for files of every size. A header is the first line that is not blank, and more
lines while a quote is open. After it, lines without any character are no rows; lines of blanks are.
A quote opens a cell only as its first character. Line breaks inside quotes stay as they are.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from clickloom import session
from clickloom.functions import text
from clickloom.operators.validate import ABSENT
from clickloom.schema import CORE_COLUMNS, EVENT_COLUMNS
from clickloom.sources import csv_records, storage

# Header spellings, compared in lower case, and the column they mean.
HEADER_ALIASES = {
    "clientid": "client_id",
    "client_id": "client_id",
    "eventname": "event_name",
    "event_name": "event_name",
    "eventdata": "event_data",
    "event_data": "event_data",
    "pageurl": "page_url",
    "page_url": "page_url",
    "useragent": "user_agent",
    "user_agent": "user_agent",
    "referrer": "referrer",
    "timestamp": "timestamp",
    "date": "date",
    "time": "time",
}

# Bytes in which a header must end; beyond, it cannot be read and all lines are rejected rows.
HEADER_BYTES = 1 << 20
_NO_LIMIT = 1 << 50


def clean_name(name: str | None) -> str:
    """A header's name without byte order marks and outer blanks."""
    return "" if name is None else name.replace("\ufeff", "").strip()


def event_column(name: str | None) -> str:
    """The event column that a header means, or its own clean name."""
    return HEADER_ALIASES.get(clean_name(name).lower(), clean_name(name))


@dataclass(frozen=True)
class HeaderShape:
    """What one header record offers, and what it lacks."""

    headers: tuple[str, ...]
    targets: tuple[str, ...] = field(init=False)
    derives_timestamp: bool = field(init=False)

    def __post_init__(self):
        targets = [event_column(h) for h in self.headers]
        has = {name: name in targets for name in ("timestamp", "date", "time")}
        derives = not has["timestamp"] and has["date"] and has["time"]
        if not has["timestamp"] and has["date"] != has["time"]:
            targets = ["timestamp" if t in ("date", "time") else t for t in targets]
        object.__setattr__(self, "targets", tuple(targets))
        object.__setattr__(self, "derives_timestamp", derives)

    @property
    def effective(self) -> set[str]:
        names = set(self.targets)
        if self.derives_timestamp:
            names = (names - {"date", "time"}) | {"timestamp"}
        return names

    @property
    def extra_columns(self) -> list[str]:
        return sorted(self.effective - set(EVENT_COLUMNS))

    @property
    def missing_core(self) -> list[str]:
        return sorted(set(CORE_COLUMNS) - self.effective)


@dataclass(frozen=True)
class SourceFile:
    """A file; ``name`` is its path below the folders that the pattern names without wildcards."""

    path: str
    name: str
    size: int
    shape: HeaderShape


def parse_header(record: str) -> HeaderShape:
    """The shape of a header record; none that csv can read gives a shape without columns."""
    try:
        cells = next(csv.reader([record.removeprefix("\ufeff")]), [])
    except csv.Error:
        cells = []
    return HeaderShape(tuple(clean_name(c) for c in cells))


def header_record(content: bytes, complete: bool) -> str | None:
    """The header record in a file's first bytes; None if it does not end in these."""
    lines = content.decode("utf-8", errors="replace").split("\n")
    if not complete:
        lines.pop()  # may go on
    record, is_open = None, False
    for line in lines:
        line = line.removesuffix("\r") if not is_open else line
        if record is None and not line.strip("\ufeff \t\r"):
            continue
        start = line.removeprefix("\ufeff") if record is None else line
        record = line if record is None else f"{record}\n{line}"
        is_open = csv_records.is_open_after(start, is_open)
        if not is_open:
            return record
    return None if record is not None or not complete else ""


def _first_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Path and header record of a partition that is one file; of what stands behind the header little is read."""
    path, content, record = None, b"", None
    for batch in batches:
        for name in batch["path"][:1].to_pylist():
            path = path or name
        content += b"".join(line + b"\n" for line in batch["line"].to_pylist())
        record = header_record(content[:HEADER_BYTES], False)
        if record is not None or len(content) > HEADER_BYTES:
            break
    else:
        record = record or header_record(content[:-1], True)
    if path is not None:
        yield pa.RecordBatch.from_pydict({"path": [path], "record": [record]})


def _headers(spark: SparkSession, paths: list[str]) -> dict[str, str | None]:
    """Header records by path. Tasks take one file each and stop reading when its header is complete."""
    whole = session.derived(spark, {
        # no file is split and none shares a task; batches are a few lines
        "spark.sql.files.maxPartitionBytes": _NO_LIMIT,
        "spark.sql.files.openCostInBytes": _NO_LIMIT,
        "spark.sql.files.maxPartitionNum": len(paths),
        "spark.sql.execution.arrow.maxRecordsPerBatch": 64,
    })
    session.ship_package(spark)
    lines = whole.read.option("lineSep", "\n").text(paths).select(
        csv_records.file_path().alias("path"), F.col("value").cast("binary").alias("line"))
    found = lines.mapInArrow(_first_records, "path string, record string")
    return {r.path: r.record for r in found.collect()}


def discover(spark: SparkSession, pattern: str) -> list[SourceFile]:
    """Files of a glob with their header shapes, by name. Tasks read their first lines, the driver plans with the headers."""
    files = storage.list_files(spark, pattern)
    full = [path for path, _, size in files if size]
    records = _headers(spark, full) if full else {}
    return [SourceFile(path, name, size, parse_header(records.get(path) or "")) for path, name, size in files]


_REPORT_SCHEMA = (
    "source_file string, headers array<string>, normalized_headers array<string>, "
    "extra_columns array<string>, missing_core array<string>"
)


def header_report(spark: SparkSession, files: Iterable[SourceFile]) -> DataFrame:
    """Per file: headers, normalised headers, unexpected columns, missing core columns."""
    rows = [
        (f.name, list(f.shape.headers), sorted(f.shape.effective), f.shape.extra_columns,
         f.shape.missing_core)
        for f in files
    ]
    return spark.createDataFrame(rows, _REPORT_SCHEMA)


def file_list(spark: SparkSession, files: Iterable[SourceFile]) -> DataFrame:
    return spark.createDataFrame([(f.name,) for f in files], "source_file string")


# What may stand around the names of a header line without changing them.
_AROUND = ' \t"\ufeff'


def _bare(name: str) -> str:
    return "".join(c for c in name if c not in _AROUND)


def _token(name: str) -> str:
    """A part of the name that each spelling of it holds."""
    return max(re.findall(r"[A-Za-z0-9_]+", name), key=len, default="")


def _is_blank(record: Column) -> Column:
    """Nothing but blanks; lines that begin otherwise pass unread."""
    first = F.ascii(record)
    return F.when(first.isin(32, 9, 0xFEFF), F.trim(F.translate(record, "\t\ufeff", "  ")) == "").otherwise(record == "")


def _may_be_header(record: Column, first: Column, last: Column, bare: Column) -> Column:
    """True for each line whose cells are the header's names, and for few others.

    Only lines with parts of the first and last name are read whole.
    """
    named = F.contains(record, first) & F.contains(record, last)
    return F.when(named, F.translate(record, _AROUND, "") == bare).otherwise(False)


def _header_marks(shape: HeaderShape) -> tuple[str, str, str]:
    if not shape.headers:
        return "", "", ""
    return _token(shape.headers[0]), _token(shape.headers[-1]), ",".join(map(_bare, shape.headers))


PLAIN, ORDERED, RECORDS = "plain", "ordered", "records"


def _by_header(files: Iterable[SourceFile]) -> dict[tuple[HeaderShape, str], list[SourceFile]]:
    """Files by header and by the folder that their names are below."""
    groups: dict[tuple[HeaderShape, str], list[SourceFile]] = {}
    for f in files:
        groups.setdefault((f.shape, f.path.removesuffix(f.name)), []).append(f)
    return groups


def file_kinds(spark: SparkSession, files: list[SourceFile]) -> dict[str, str]:
    """How each file is read, by path; a parallel scan of the lines, without parsing them."""
    def looked_at(shape: HeaderShape, group: list[SourceFile]) -> DataFrame:
        record = csv_records.without_return(F.col("value"))
        return spark.read.option("lineSep", "\n").text([f.path for f in group]).select(
            csv_records.file_path().alias("path"),
            csv_records.open_after(record, False).alias("opens"),
            _may_be_header(record, *map(F.lit, _header_marks(shape))).alias("header"),
            ((record != "") & _is_blank(record)).alias("blank"))

    lines = reduce(DataFrame.unionByName, [looked_at(shape, group) for (shape, _), group in _by_header(files).items()])
    found = lines.groupBy("path").agg(F.max("opens").alias("spans"), F.count_if("header").alias("headers"), F.count_if("blank").alias("blanks"))
    return {r.path: RECORDS if r.spans else PLAIN if (r.headers, r.blanks) == (1, 0) else ORDERED for r in found.toLocalIterator()}


def _after_header(rows: DataFrame, headers: Column) -> DataFrame:
    """Rows behind their file's header, found by its place. Only rows that look like it, or are blank, are put in order."""
    like_header = F.transform("cells", lambda c: F.trim(F.replace(F.coalesce(c, F.lit("")), F.lit("\ufeff"), F.lit("")))) == headers
    marked = rows.withColumns({"like_header": F.coalesce(like_header, F.lit(False)), "blank": _is_blank(F.col("record"))})
    sure = marked.where("NOT like_header AND NOT blank")
    order = Window.partitionBy("path").orderBy("block", "place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = F.sum(F.col("like_header").cast("int")).over(order)
    rest = marked.where("like_header OR blank").withColumn("seen", seen).where("seen > 1 OR (seen = 1 AND NOT like_header)")
    return sure.unionByName(rest.drop("seen"))


def _read_shape(spark: SparkSession, shape: HeaderShape, folder: str, files: list[SourceFile], kind: str) -> DataFrame:
    paths = [f.path for f in files]
    positions = [f"_c{i}" for i in range(len(shape.headers))]
    rows = csv_records.read_records(spark, paths) if kind == RECORDS else csv_records.read_lines(spark, paths)
    if kind == PLAIN:
        rows = rows.where(~_may_be_header(F.col("record"), *map(F.lit, _header_marks(shape))))
    if positions:
        ddl = ", ".join(f"{p} string" for p in positions)
        parsed = F.from_csv("record", ddl, {"escape": '"', "mode": "PERMISSIVE", "multiLine": "true", "maxCharsPerColumn": "-1"})
        rows = rows.withColumn("parsed", parsed).withColumn("cells", F.array(*[F.col("parsed")[p] for p in positions]))
        if kind != PLAIN:
            rows = _after_header(rows, F.array(*[F.lit(h) for h in shape.headers]))
    name = F.substring(F.col("path"), F.lit(len(folder) + 1), F.length("path"))
    cells = rows.select(name.alias("source_file"), *[F.when(~F.col("broken"), F.col("cells")[i]).alias(p) for i, p in enumerate(positions)])
    return normalize_columns(cells, shape, positions)


def normalize_columns(df: DataFrame, shape: HeaderShape, positions: list[str],
                      *keep: str) -> DataFrame:
    """Null tokens, merged aliases, derived timestamp and the expected columns of one shape."""
    sources: dict[str, list[Column]] = {}
    seen: set[str] = set()
    for position, header, target in zip(positions, shape.headers, shape.targets):
        if header in seen:
            continue  # a repeated header is an extra column
        seen.add(header)
        sources.setdefault(target, []).append(text.null_token_to_null(F.col(position)))
    merged = {target: text.first_non_blank(columns) for target, columns in sources.items()}

    absent = [c for c in EVENT_COLUMNS if c not in shape.effective]
    absences = F.array(*[F.lit(c) for c in absent]).cast("array<string>")
    if shape.derives_timestamp:
        merged["timestamp"] = F.nullif(
            F.concat_ws(" ", merged["date"], merged["time"]), F.lit("")
        )
        # neither part in a row: that row has no timestamp at all
        absences = F.when(
            merged["date"].isNull() & merged["time"].isNull(),
            F.array(*[F.lit(c) for c in [*absent, "timestamp"]]),
        ).otherwise(absences)
    return df.select(
        *keep,
        "source_file",
        *[merged.get(c, F.lit(None)).cast("string").alias(c) for c in EVENT_COLUMNS],
        absences.alias(ABSENT),
    )


def read_events(spark: SparkSession, files: list[SourceFile]) -> DataFrame:
    """All rows of all files as strings, with source_file and the absent columns of each row.

    A file without a readable header gives one row per line, with all columns absent.
    """
    files = [f for f in files if f.size]
    kinds = file_kinds(spark, files) if files else {}
    frames = []
    for (shape, folder), group in _by_header(files).items():
        for kind in (PLAIN, ORDERED, RECORDS):
            # without a header each line is a rejected row
            some = [f for f in group if kind == (kinds.get(f.path, ORDERED) if shape.headers else ORDERED)]
            if some:
                frames.append(_read_shape(spark, shape, folder, some, kind))
    if not frames:
        columns = ["source_file", *EVENT_COLUMNS]
        empty = ", ".join(f"`{c}` string" for c in columns)
        return spark.createDataFrame([], f"{empty}, {ABSENT} array<string>")
    return reduce(DataFrame.unionByName, frames)
