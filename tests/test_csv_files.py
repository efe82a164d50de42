import csv
import json
import os
import random
import re
from contextlib import contextmanager
from datetime import date, datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clickloom.operators import validate
from clickloom.plans import build, ingest, monitors
from clickloom.sources import csv_files, csv_records
from clickloom.sources.csv_files import HeaderShape, event_column, parse_header
from clickloom.sources.tables import CatalogTables, TableFolder

HEADER = "client_id,page_url,referrer,timestamp,event_name,event_data,user_agent"


def put(folder, name, content):
    with open(os.path.join(folder, name), "w", encoding="utf-8", newline="") as f:
        f.write(content)


def read(spark, folder, **options):
    return csv_files.read_events(spark, csv_files.discover(spark, f"{folder}/*.csv"), **options)


def test_header_names():
    assert [event_column(n) for n in ("\ufeffClientId", " EVENT_NAME ", "pageUrl", "Extra ", None)] == [
        "client_id", "event_name", "page_url", "Extra", ""]


def test_header_shapes():
    both = parse_header("client_id,Date,time")
    assert both.derives_timestamp and both.effective == {"client_id", "timestamp"}
    only_date = parse_header("date,client_id")
    assert only_date.targets == ("timestamp", "client_id") and not only_date.derives_timestamp
    with_stamp = parse_header("timestamp,date,time,foo")
    assert with_stamp.extra_columns == ["date", "foo", "time"]
    assert parse_header("").missing_core == sorted(csv_files.CORE_COLUMNS)


def test_quotes_bom_ragged_rows_and_null_tokens(spark, folder):
    data = json.dumps({"note": 'a "b", c\nd'}).replace('"', '""')
    put(folder, "a b+c%20.csv", "\ufeff" + HEADER + "\n"
        + f'c1,u,null,2024-01-01T00:00:00Z,page_viewed,"{data}",ua\n'
        + "c2,u,None\n"
        + "c3,u,r,t,e,d,ua,surplus\n\n"
        + 'c4,NULL,"",t,e,nUll,ua\n')
    rows = {r["client_id"]: r for r in read(spark, folder).collect()}
    assert set(rows) == {"c1", "c2", "c3", "c4"}
    assert json.loads(rows["c1"]["event_data"])["note"] == 'a "b", c\nd'
    assert rows["c1"]["referrer"] is None and rows["c2"]["referrer"] is None
    assert rows["c2"]["user_agent"] is None and rows["c3"]["user_agent"] == "ua"
    assert rows["c4"]["page_url"] is None and rows["c4"]["referrer"] is None and rows["c4"]["event_data"] == "nUll"
    assert {r["source_file"] for r in rows.values()} == {"a b+c%20.csv"}


def test_shapes_are_read_together(spark, folder):
    put(folder, "1.csv", HEADER + "\nc1,u,r,2024-01-01T00:00:00Z,page_viewed,{},ua\n")
    put(folder, "2.csv", "userAgent,eventData,eventName,date,time,pageUrl,clientId,x\n"
        "ua,{},page_viewed,2024-01-02,03:04:05,u,c2,1\nua,{},page_viewed,,,u,c3,1\nua,{},page_viewed,2024-01-03,,u,c4,\n")
    put(folder, "3.csv", "client_id,time\nc5,2024-01-04 01:00\n")
    put(folder, "4.csv", "")
    put(folder, "5.csv", HEADER + "\n")
    files = csv_files.discover(spark, f"{folder}/*.csv")
    rows = {r["client_id"]: r for r in validate.annotate(csv_files.read_events(spark, files)).select(
        "raw_client_id", "client_id", "timestamp", "errors", "source_file").collect()}
    assert rows["c1"]["errors"] == [] and rows["c2"]["timestamp"] == datetime(2024, 1, 2, 3, 4, 5)
    assert rows["c3"]["errors"] == ["timestamp: Field required"]
    assert rows["c4"]["timestamp"] == datetime(2024, 1, 3)
    assert rows["c5"]["timestamp"] == datetime(2024, 1, 4, 1)
    assert rows["c5"]["errors"] == [
        f"{c}: Field required" for c in ("event_name", "event_data", "page_url", "user_agent")]
    report = {r["source_file"]: r for r in csv_files.header_report(spark, files).collect()}
    assert report["2.csv"]["extra_columns"] == ["x"] and report["2.csv"]["missing_core"] == []
    assert report["4.csv"]["missing_core"] == sorted(csv_files.CORE_COLUMNS) and report["4.csv"]["headers"] == []
    assert report["5.csv"]["missing_core"] == []


def test_aliases_first_non_blank_wins(spark, folder):
    put(folder, "1.csv", "client_id,clientId,CLIENTID\n,  ,x\n a ,b,c\nNone,b,c\n")
    assert sorted(r["client_id"] for r in read(spark, folder).collect()) == [" a ", "b", "x"]


def test_repeated_header_is_extra(spark, folder):
    put(folder, "1.csv", "client_id,client_id\n,second\n")
    assert read(spark, folder).first()["client_id"] is None


@contextmanager
def blocks_of(spark, size):
    """Files are read in blocks of so many bytes."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_only_files_with_inner_line_breaks_are_read_by_records(spark, folder):
    put(folder, "flat.csv", HEADER + "\n" + 'c1,"u,""x""",r,t,e,"{""a"":1}",ua\n' * 50)
    put(folder, "inner.csv", HEADER + "\n" + 'c2,"u\nv",r,t,e,{},ua\n' * 50)
    files = csv_files.discover(spark, f"{folder}/*.csv")
    kinds = csv_files.file_kinds(spark, files)
    assert {p.rsplit("/", 1)[1]: kind for p, kind in kinds.items()} == {"flat.csv": "plain", "inner.csv": "records"}
    rows = read(spark, folder)
    assert rows.count() == 100
    assert set(r["page_url"] for r in rows.select("page_url").distinct().collect()) == {'u,"x"', "u\nv"}


def test_a_plain_file_is_scanned_once_without_order(spark, folder):
    put(folder, "flat.csv", HEADER.replace("client_id", ' "client_id"') + "\r\n" + 'c1,"u,""x""",r,t,e,"{""a"":1}",ua\r\n' * 3)
    plan = read(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1
    assert "Window" not in plan and "Exchange" not in plan and "Join" not in plan
    for name, end in (("again.csv", HEADER + "\n"), ("blank.csv", " \n")):
        put(folder, name, HEADER + "\nc1,u,r,t,e,{},ua\n" + end)
    kinds = csv_files.file_kinds(spark, csv_files.discover(spark, f"{folder}/*.csv"))
    assert {p.rsplit("/", 1)[1]: kind for p, kind in kinds.items()} == {"flat.csv": "plain", "again.csv": "ordered", "blank.csv": "ordered"}
    assert read(spark, folder).count() == 3 + 2 + 2


# content of a file, and the client_id cells of its rows in order; OTHER is a file that is always there
CASES = {
    "blank lines before the header": ("\n  \n\ufeff" + HEADER + "\nc1,u,r,t,e,{},ua\n", ["c1"]),
    "empty first line": ("\n" + HEADER + "\nc1,u,r,t,e,{},ua\nc2,u,r,t,e,{},ua\n", ["c1", "c2"]),
    "carriage returns before the header": ("\r\n\r\n" + HEADER + "\r\nc1,u,r,t,e,{},ua\r\n\r\n", ["c1"]),
    "a line of blanks is a row": (HEADER + "\nc1,u,r,t,e,{},ua\n   \n\nc2,u,r,t,e,{},ua\n", ["c1", "   ", "c2"]),
    "the header again is a row": (HEADER + "\nc1,u,r,t,e,{},ua\n" + HEADER + "\n", ["c1", "client_id"]),
    "CRLF inside quotes stays": (HEADER + '\r\n"c\r\n1",u,r,t,e,{},ua\r\nc2,u,r,t,e,{},ua\r\n', ["c\r\n1", "c2"]),
    "unterminated last cell of one line": (HEADER + '\nc1,u,r,t,e,{},ua\nc2,u,r,t,e,{},"ua\n', ["c1", "c2"]),
    "unterminated tail of lines": (HEADER + '\nc1,u,r,t,e,{},ua\n"c2,u\nc3,u,r,t,e,{},ua\nc4', ["c1", None, None, None]),
    "a stray quote in the header": ('client_id",page_url\nc1,u\nc2,u\n', [None, None]),
    "an unclosed quote in the header": ('"client_id,page_url\nc1,u\nc2,u\n', [None, None, None]),
    "quoted header over two lines": ('client_id,"page\nurl"\nc1,u\nc2,v\n', ["c1", "c2"]),
    "no rows": (HEADER, []),
    "nothing": ("", []),
    "only blanks": ("\n  \n", [None]),
}


@pytest.mark.parametrize("size", [None, 7, 60])
@pytest.mark.parametrize("name", list(CASES))
def test_one_grammar_for_every_size(spark, folder, name, size):
    content, expected = CASES[name]
    put(folder, "case.csv", content)
    put(folder, "other.csv", HEADER + "\nx,u,r,t,e,{},ua\n")
    with blocks_of(spark, size or 1 << 27):
        rows = read(spark, folder).select("source_file", "client_id").collect()
    assert [r["client_id"] for r in rows if r["source_file"] == "other.csv"] == ["x"]
    got = [r["client_id"] for r in rows if r["source_file"] == "case.csv"]
    assert sorted(map(str, got)) == sorted(map(str, expected))


@pytest.mark.parametrize("block_bytes", [90, 400])
def test_records_across_blocks(spark, folder, block_bytes):
    """Random cells with quotes and line breaks, in blocks smaller than some records."""
    rng = random.Random(block_bytes)
    pieces = ["a", "b c", ",", '"', '""', "\n", "\n\n", "x,y", "'", "line\nbreak", ""]
    rows = [["".join(rng.choices(pieces, k=rng.randrange(1, 7))) + "." for _ in range(7)] for _ in range(120)]
    rows[60][5] = "\n".join(f'long "{i}", line' for i in range(60))
    for name, part, end in (("a.csv", rows[:70], "\n"), ("b.csv", rows[70:], "\r\n")):
        with open(os.path.join(folder, name), "w", encoding="utf-8", newline="") as f:
            f.write(HEADER + end)
            csv.writer(f, lineterminator=end).writerows(part)
            f.write(f'last{name},stray"quote,,,,,ua')
    with blocks_of(spark, block_bytes):
        df = read(spark, folder)
        got = sorted(tuple(r[c] for c in csv_files.EVENT_COLUMNS) for r in df.collect())
    order = [HEADER.split(",").index(c) for c in csv_files.EVENT_COLUMNS]
    expected = [tuple(row[i] for i in order) for row in rows]
    assert [r for r in got if r[1] != 'stray"quote'] == sorted(expected)
    assert len(got) == len(rows) + 2


@pytest.mark.parametrize("line,ends_open", [
    ('a,b', False), ('"a', True), ('"a"', False), ('"a""', True), ('x,"a,b', True), ('x,"a,b"', False),
    ('a"b,c', False), ('a"b,"c', True), ('"a"",b', True), ('"",""', False), ('"a,"",b",c', False),
])
def test_quote_state_at_line_end(spark, line, ends_open):
    df = spark.createDataFrame([(line,)], "v string")
    assert df.select(csv_records.open_after(F.col("v"), False).alias("o")).first()["o"] is ends_open


def day_file(folder, name, day, rejects=1):
    rows = [f'c{i},https://x/?utm_source=s,,{day}T10:{i:02d}:00Z,page_viewed,{{}},Chrome' for i in range(5)]
    purchase = json.dumps({"transaction_id": f"T{day}", "revenue": 5.0, "items": [
        {"item_id": "i", "item_name": "n", "item_price": 2.5, "quantity": 2}]}).replace('"', '""')
    rows.append(f'c1,https://x/,,{day}T10:20:00Z,checkout_completed,"{purchase}",Chrome')
    rows += [f",https://x/,,{day}T11:00:00Z,page_viewed,{{}},Chrome"] * rejects
    put(folder, name, HEADER + "\n" + "\n".join(rows) + "\n")


def test_ingest_is_idempotent_and_replaces(spark, folder):
    base = folder + "/tables"
    day_file(folder, "events_20240101.csv", "2024-01-01")
    day_file(folder, "events_20240102.csv", "2024-01-02", rejects=0)
    put(folder, "zero.csv", HEADER + "\n")
    for _ in range(2):
        log = ingest.ingest(spark, f"{folder}/*.csv", base, run_timestamp=datetime(2024, 1, 2, 5))
        got = {r["filename"]: (r["rows_read"], r["rows_inserted"], r["rows_quarantined"], r["status"])
               for r in log.collect()}
        assert got == {"events_20240101.csv": (7, 6, 1, "partial_failure"),
                       "events_20240102.csv": (6, 6, 0, "COMPLETED"), "zero.csv": (0, 0, 0, "COMPLETED")}
    tables = TableFolder(spark, base)
    assert ingest.raw_events(tables).count() == 12
    assert tables["pipeline_logs"].count() == 6
    rejected = ingest.quarantine(tables).collect()
    assert [(r["source_file"], r["client_id"], r["error_reason"]) for r in rejected] == [
        ("events_20240101.csv", None, "client_id: Input should be a valid string")]
    assert os.listdir(base + "/quarantine_csv/source_file=events_20240101.csv")

    # the first file is mended and the second emptied: nothing of the old rows may stay
    day_file(folder, "events_20240101.csv", "2024-01-01", rejects=0)
    put(folder, "events_20240102.csv", HEADER + "\n")
    ingest.ingest(spark, f"{folder}/*.csv", base)
    assert ingest.raw_events(tables).count() == 6 and ingest.quarantine(tables).count() == 0
    assert not os.path.exists(base + "/quarantine_csv/source_file=events_20240101.csv")

    ingest.ingest(spark, f"{folder}/*.csv", base, mode="append")
    assert ingest.raw_events(tables).count() == 12


def test_files_of_equal_names_in_folders(spark, folder):
    base = folder + "/tables"
    for day in ("d1", "d2"):
        os.mkdir(f"{folder}/{day}")
        day_file(f"{folder}/{day}", "ev.csv", "2024-01-01", rejects=1 if day == "d1" else 2)
    for _ in range(2):
        log = ingest.ingest(spark, f"{folder}/d*/ev.csv", base)
        assert {r["filename"]: r["rows_read"] for r in log.collect()} == {"d1/ev.csv": 7, "d2/ev.csv": 8}
    tables = TableFolder(spark, base)
    assert ingest.raw_events(tables).count() == 12 and ingest.quarantine(tables).count() == 3
    # one of them alone replaces its own rows only
    day_file(f"{folder}/d2", "ev.csv", "2024-01-02", rejects=0)
    ingest.ingest(spark, f"{folder}/d*/ev.csv", base)
    assert ingest.raw_events(tables).count() == 12 and ingest.quarantine(tables).count() == 1


def test_quarantine_csv_holds_this_run_only(spark, folder):
    base = folder + "/tables"
    day_file(folder, "a.csv", "2024-01-01", rejects=1)
    for _ in range(2):
        ingest.ingest(spark, f"{folder}/*.csv", base, mode="append")
    assert spark.read.option("header", True).csv(base + "/quarantine_csv").count() == 1
    assert ingest.quarantine(TableFolder(spark, base)).count() == 2


def test_a_run_that_breaks_off_changes_nothing(spark, folder, monkeypatch):
    base = folder + "/tables"
    tables = TableFolder(spark, base)
    kept, lose = TableFolder.append, lambda *_: (_ for _ in ()).throw(RuntimeError("lost"))
    day_file(folder, "a.csv", "2024-01-01")

    monkeypatch.setattr(TableFolder, "append", lose)  # rows are written, their log is not
    with pytest.raises(RuntimeError, match="lost"):
        ingest.ingest(spark, f"{folder}/*.csv", base)
    assert ingest.raw_events(tables).count() == 0 and ingest.log(tables).count() == 0

    monkeypatch.setattr(TableFolder, "append", kept)
    ingest.ingest(spark, f"{folder}/*.csv", base)
    before = sorted(ingest.landed(tables).collect(), key=str)
    assert len(before) == 7

    day_file(folder, "a.csv", "2024-01-05", rejects=3)
    for mode in ("replace", "append"):
        monkeypatch.setattr(TableFolder, "append", lose)
        with pytest.raises(RuntimeError, match="lost"):
            ingest.ingest(spark, f"{folder}/*.csv", base, mode=mode)
        assert sorted(ingest.landed(tables).collect(), key=str) == before and ingest.log(tables).count() == 1

    # the rows of what broke off lie there until they are cleared away
    parts = lambda: sorted(p for p in os.listdir(base + "/landed_events") if p.startswith("run_id=") and os.listdir(f"{base}/landed_events/{p}"))
    assert len(parts()) == 4
    ingest.vacuum(spark, base)
    assert len(parts()) == 1 and sorted(ingest.landed(tables).collect(), key=str) == before

    monkeypatch.setattr(TableFolder, "append", kept)
    ingest.ingest(spark, f"{folder}/*.csv", base)
    assert ingest.raw_events(tables).count() == 6 and ingest.quarantine(tables).count() == 3 and len(parts()) == 1


def test_what_counts_after_replacing_and_adding(spark):
    runs = spark.createDataFrame([("r1", "a", "replace", 1), ("r2", "a", "append", 2), ("r3", "a", "replace", 3), ("r4", "a", "append", 4),
                                  ("r2", "b", "append", 2), ("r4", "b", "append", 4)], "run_id string, filename string, load_mode string, load_no long")
    assert sorted(map(tuple, ingest.current(runs).collect())) == [("r2", "b"), ("r3", "a"), ("r4", "a"), ("r4", "b")]


def test_run_opens_only_its_files_partitions(spark, folder):
    base = folder + "/tables"
    for name in ("a.csv", "b.csv"):
        day_file(folder, name, "2024-01-01")
    ingest.ingest(spark, f"{folder}/*.csv", base)
    rows = ingest.landed(TableFolder(spark, base)).where(F.col("source_file").isin(["a.csv"]) & (F.col("run_id") == "x"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*source_file", plan)


def test_run_from_files_to_monitors(spark, folder):
    base = folder + "/tables"
    for day in ("2024-01-01", "2024-01-02"):
        day_file(folder, f"events_{day.replace('-', '')}.csv", day)
    ingest.ingest(spark, f"{folder}/*.csv", base, run_timestamp=datetime(2024, 1, 2, 5))
    made = build.run(spark, base, date(2024, 1, 2))
    assert made["dim_sessions"].count() == 10 and made["fct_attribution"].count() == 2
    assert made["fct_order_items"].select(F.sum("line_total")).first()[0] == 10.0
    assert {r["status"] for r in made["check_summary"].collect()} == {"PASS"}
    assert made["report_outcome"].where("error IS NOT NULL").count() == 0
    assert spark.read.parquet(base + "/report/daily_kpi").count() == 2
    passed = {r["name"]: r["passed"] for r in made["monitor_summary"].collect()}
    assert passed == {"logs_present": True, "quarantine_rate": False, "quarantine_files": False, "freshness": True,
                      "volume_anomaly": True, "missing_revenue": True, "funnel_health": True, "unattributed": True}
    assert spark.table("rpt_funnel_metrics").first()["total_sessions"] == 10

    tables = TableFolder(spark, base)
    assert {"stg_events", "dim_sessions", "pipeline_logs", "check_summary"} <= set(tables)
    tables.register()
    by_name = monitors.monitor_summary(monitors.monitor_results(spark, CatalogTables(spark), date(2024, 1, 2)))
    assert {r["name"]: r["passed"] for r in by_name.collect()} == {**passed, "quarantine_files": True}
    for name in [*tables, "rpt_funnel_metrics", "rpt_lead_velocity"]:
        spark.catalog.dropTempView(name)


def test_dry_run(spark, folder):
    day_file(folder, "a.csv", "2024-01-01", rejects=3)
    put(folder, "b.csv", HEADER + "\n")
    report, totals, errors = ingest.dry_run(spark, f"{folder}/*.csv")
    assert report.count() == 2
    assert tuple(totals.first()) == (2, 6, 3)
    assert [tuple(r) for r in errors.collect()] == [("client_id: Input should be a valid string", 3)]


def test_no_files(spark, folder):
    report, totals, errors = ingest.dry_run(spark, f"{folder}/*.csv")
    assert report.count() == 0 and tuple(totals.first()) == (0, 0, 0) and errors.count() == 0
    log = ingest.ingest(spark, f"{folder}/*.csv", folder + "/tables")
    assert log.count() == 0


def test_headers_are_read_by_tasks_a_few_lines_each(spark, folder):
    """One task a file, whatever its size; the driver's session keeps its settings."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    header = '"client_id","event\nname"'
    contents = {
        "a.csv": "client_id,timestamp\n" + "x,y\n" * 200_000,
        "b.csv": f"\n \n{header}\nx,y\n",
        "c.csv": "\ufeffclient_id,time\r\n",
        "d.csv": "",
        "e.csv": "\n\n",
        "f.csv": '"never closed\n' + "x\n" * 20,
        "g.csv": "x" * (csv_files.HEADER_BYTES + 1) + "\n",
        "h.csv": "client_id",
        "i.csv": "\n" * 3000 + "client_id,date\nx,y\n",
    }
    for name, content in contents.items():
        put(folder, name, content)
    shapes = {f.name: f.shape.headers for f in csv_files.discover(spark, f"{folder}/*.csv")}
    assert shapes == {
        "a.csv": ("client_id", "timestamp"), "b.csv": ("client_id", "event\nname"), "c.csv": ("client_id", "time"), "d.csv": (),
        "e.csv": (), "f.csv": (), "g.csv": (), "h.csv": ("client_id",), "i.csv": ("client_id", "date")}
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_little_is_taken_from_a_long_file():
    """A task's iterator is left where its header is complete."""
    taken = []

    def batches():
        for i in range(100):
            taken.append(i)
            yield pa.RecordBatch.from_pydict({"path": ["p"] * 2, "line": [b"a,b", b"1,2"]})

    assert [b.to_pylist() for b in csv_files._first_records(batches())] == [[{"path": "p", "record": "a,b"}]]
    assert taken == [0]
