"""Schemas, sources, sinks, what is displayed, and the streaming forms."""

from __future__ import annotations

import datetime as dt
import hashlib
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gleaner import schema
from gleaner.operators import display, ranking
from gleaner.plans import reports
from gleaner.sources import tables as S
from gleaner.streaming import jobs as streaming

AT = dt.datetime(2024, 5, 1, 12, 30, 15)


def test_ids_follow_the_largest(spark):
    old = spark.createDataFrame([(7, "x")], "id int, k string")
    new = spark.createDataFrame([(f"k{i * 37 % 101:03}",) for i in range(101)], "k string").repartition(5)
    got = sorted((r["k"], r["id"]) for r in schema.next_ids(new, old, "k").collect())
    assert [i for _, i in got] == list(range(8, 109)) and dict(schema.next_ids(new, old, "k").dtypes)["id"] == "int"
    assert schema.next_ids(new.limit(0), old, "k").count() == 0
    assert [r["id"] for r in schema.next_ids(new.limit(1), old.limit(0), "k").collect()] == [1]


def test_schema_checks_and_cascades(spark):
    venues = spark.createDataFrame([(1, "wine_list_found", None), (2, "odd", "3-stars"), (3, "error", "5-stars")], "id int, crawl_status string, distinction string")
    assert sorted((r["id"], r["column"], r["value"]) for r in schema.violations(venues, "venues").collect()) == [(2, "crawl_status", "odd"), (3, "distinction", "5-stars")]
    assert schema.violations(venues, "lists").count() == 0
    row = schema.with_defaults(spark.createDataFrame([(1,)], "id int").withColumns({"country": F.lit(None).cast("string"), "pages_visited": F.lit(None).cast("int")}), "venues").first()
    assert (row["country"], row["pages_visited"]) == ("USA", 0)
    small = {
        "sites": spark.createDataFrame([(1,), (2,)], "id int"), "venues": spark.createDataFrame([(1, 1), (2, 2)], "id int, site_id int"), "lists": spark.createDataFrame([(1, 1), (2, 2), (3, 1)], "id int, venue_id int"),
        "items": spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "id int, list_id int"), "jobs": spark.createDataFrame([(1, 1), (2, 2)], "id int, site_id int"),
    }
    left = schema.delete_cascade(small, "sites", spark.createDataFrame([(1,)], "id int"))
    assert {k: sorted(r["id"] for r in v.collect()) for k, v in left.items()} == {"sites": [2], "venues": [2], "lists": [2], "items": [2], "jobs": [1, 2]}
    assert {r["id"]: r["site_id"] for r in left["jobs"].collect()} == {1: None, 2: 2}


def test_stored_tables(spark):
    schema.reset(spark)
    try:
        assert spark.table("items").dtypes == schema.empty(spark, "items").dtypes and spark.table("jobs").count() == 0
        schema.create(spark, "jobs")
    finally:
        for name in schema.SCHEMAS:
            schema.drop(spark, name)
    assert not spark.catalog.tableExists("jobs")


@pytest.fixture
def folder(tmp_path):
    page = "<html><body>" + "<p>Chablis Grand Cru 2019</p>" * 12 + "</body></html>"
    for name, content in (("a/wine_list.pdf", b"%PDF"), ("a/b.pdf", b"x"), ("b/z.pdf", b"z"), ("b/y.pdf", b"y"), ("b/list.HTML", page.encode()), ("c/t.txt", b"t")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(content)
    return tmp_path


def test_files_and_their_texts(spark, folder):
    found = S.files(spark, str(folder)).withColumn("folder", F.element_at(F.split("path", "/"), -2))
    got = {r["path"].split(str(folder))[1]: r for r in S.file_texts(found).collect()}
    assert got["/a/b.pdf"]["size"] == 1 and got["/a/b.pdf"]["sha256"] == hashlib.sha256(b"x").hexdigest() and got["/a/b.pdf"]["error"] == "no reader for documents"
    assert got["/b/list.HTML"]["text"].startswith("Chablis Grand Cru 2019\nChablis") and got["/b/list.HTML"]["error"] is None and got["/c/t.txt"]["error"] == "Unsupported file type: .txt"
    chosen = {r["folder"]: r["path"].split("/")[-1] for r in S.preferred_file(found).collect()}
    assert chosen == {"a": "wine_list.pdf", "b": "y.pdf"}
    wanted = spark.createDataFrame([(f"file:{folder}/a/b.pdf",), ("file:/none.pdf",)], "path string")
    assert {r["path"].split("/")[-1]: r["error"] for r in S.wanted_files(found, wanted).collect()} == {"b.pdf": None, "none.pdf": "File not found: file:/none.pdf"}


def test_texts_are_written_beside_their_names(spark, tmp_path):
    texts = spark.createDataFrame([("/d/a.pdf", "line\nline2"), ("/d/b.html", "x"), ("/d/c.pdf", None)], "path string, text string")
    S.write_texts(texts, str(tmp_path / "out"))
    back = spark.read.text(str(tmp_path / "out"), wholetext=True)
    assert sorted((r["name"], r["value"].rstrip("\n")) for r in back.collect()) == [("a.txt", "line\nline2"), ("b.txt", "x")]
    assert [r[0] for r in texts.select(S.text_path(F.col("path"))).collect()] == ["/d/a.txt", "/d/b.txt", "/d/c.txt"]


def test_downloads(spark):
    html = "<p>é</p>".encode("latin-1")
    rows = [("le-bar", "https://s.com/list.pdf", bytearray(b"%PDF"), "application/pdf"), ("a/b", "https://s.com/l", bytearray(html), "text/html")]
    got = S.downloads(spark.createDataFrame(rows, "slug string, url string, content binary, content_type string"), "data").collect()
    assert [(r["local_file_path"], r["file_size"]) for r in got] == [("data/le-bar/list.pdf", 4), ("data/a_b/wine_list.html", 10)] and got[1]["file_hash"] == hashlib.sha256(html).hexdigest()
    known = S.known_content(spark.createDataFrame([("h1",), ("h2",)], "file_hash string"), spark.createDataFrame([("h2", 1), ("h2", 2)], "file_hash string, id int"))
    assert [r[0] for r in known.collect()] == ["h2"]


def test_snapshots_may_be_made_from_the_one_before(spark, tmp_path):
    state = S.snapshot(spark.range(3), str(tmp_path))
    state = S.snapshot(state.select((F.col("id") + 1).alias("id")), str(tmp_path))
    assert sorted(r[0] for r in state.collect()) == [1, 2, 3]


def test_settings_and_shared_folder(spark):
    got = S.Settings.from_environment(environment={"GLEANER_LEVEL": "2", "gleaner_site_pages": "7", "GLEANER_USE_SEARCH": "no", "OTHER": "x"})
    assert got == S.Settings(level="2", site_pages=7, use_search=False) and S.Settings().site_depth == 4
    assert S.shared_folder(spark) and S.own_folder("local[4]") and S.own_folder("local")
    with pytest.raises(RuntimeError):
        S.own_folder("spark://host:7077")


def test_jdbc_options(spark):
    with pytest.raises(Exception, match="(?i)driver"):  # there is no database here: the reader is built, then finds no driver
        S.jdbc_table(spark, "jdbc:none://x", "t", "id", 0, 10, 2)


def test_displayed_rows(spark):
    sites = spark.createDataFrame([(1, "Michelin Guide USA", "u", None, AT, None)], schema.SCHEMAS["sites"])
    venues = schema.empty(spark, "venues")
    rows = spark.createDataFrame([(1, "A", 1, "wine_list_found", "l", Decimal("75.00"), 5, 2, AT), (2, "B", 9, "pending", "", None, None, None, None)], "id int, name string, site_id int, crawl_status string, list_url string, crawl_duration_seconds decimal(10,2), llm_tokens_used int, pages_visited int, last_crawled_at timestamp")
    shown = display.venues(venues.unionByName(rows, allowMissingColumns=True), sites).orderBy("id").collect()
    assert [tuple(r[k] for k in ("site", "city", "has_list", "crawl_time", "llm_tokens", "pages", "last_crawled")) for r in shown] == [("Michelin Guide USA", "", "✓", "1.2m", 5, 2, "2024-05-01"), ("—", "", "✗", "", 0, 0, "Never")]
    jobs = spark.createDataFrame([(1, "crawler", None, "running", 3, 4, 2, AT, AT, Decimal("0.00"), 1), (2, "crawler", "2", "failed", 0, 0, 0, AT, None, Decimal("63.20"), None)], "id int, job_type string, level string, status string, venues_processed int, venues_found int, lists_downloaded int, started_at timestamp, completed_at timestamp, duration_seconds decimal(10,2), site_id int")
    got = display.jobs(jobs, sites).orderBy("id").collect()
    assert [tuple(r[k] for k in ("site", "level", "progress", "duration", "started")) for r in got] == [("Michelin Guide USA", "N/A", "3/4", "", "2024-05-01 12:30"), ("N/A", "2", "0/0", "1m 3s", "2024-05-01 12:30")]
    assert [tuple(r)[1:] for r in display.job_details(jobs).orderBy("id").collect()] == [("2024-05-01 12:30:15", "2024-05-01 12:30:15", "0s", "75.0% complete"), ("2024-05-01 12:30:15", "", "1m 3s", None)]
    items = spark.createDataFrame([(1, "Opus", None, Decimal("500.00"), "V")], "id int, name string, maker string, price decimal(10,2), venue string")
    items = items.withColumns({c: F.lit(None).cast("string") for c in ("varietal", "item_type", "vintage", "country", "region")})
    assert tuple(display.items(items).first()) == (1, "Opus", "", "", "", "", "", "", "$500.00", "V")
    lists = spark.createDataFrame([(1, "", "manual", "/p", None, "abcdef0123", 0, AT)], "id int, list_name string, source_url string, local_file_path string, text_file_path string, file_hash string, item_count int, downloaded_at timestamp")
    assert tuple(display.lists(lists).first()) == (1, "Unnamed", "manual", "/p", None, 0, "2024-05-01", "abcdef01...")
    assert tuple(display.sites(sites).first()) == (1, "Michelin Guide USA", "u", "", "2024-05-01", "Never")


def test_names_are_resolved_by_tiers(spark):
    venues = spark.createDataFrame([(1, "Per Se", 1), (2, "per se", 2), (3, "Le Per Se Bar", 1), (42, "Smyth", 2)], "id int, name string, site_id int")
    one = lambda text, site=None: [r["id"] for r in reports.resolve(venues, text, site).collect()]
    assert one("PER SE") == [1] and one(" per se ", 2) == [2] and one("bar") == [3] and one("42", 1) == [42] and one("  ") == [] and one("none") == [] and one("SM_TH") == [42]
    sites = spark.createDataFrame([(1, "Michelin Guide USA"), (2, "USA"), (3, "Guide South USA")], "id int, site_name string")
    wanted = spark.createDataFrame([("usa",), ("south usa",), (" Michelin guide usa",), ("",), ("  ",), ("sa",)], "wanted string")
    assert {r["wanted"]: r["id"] for r in reports.resolve_sites(sites, wanted).collect()} == {"usa": 2, "south usa": 3, " Michelin guide usa": 1}
    rows = spark.createDataFrame([(1, "A", 1.0, "x", 1)], "c_custkey int, c_name string, c_acctbal double, c_mktsegment string, c_nationkey int")
    nations = spark.createDataFrame([(1, "PERU"), (2, "ITALY")], "n_nationkey int, n_name string")
    assert [reports.filtered(rows, site_name=n, sites=nations).count() for n in ("PERU", "ITALY", "NOWHERE", None)] == [1, 0, 1, 1]


def test_ranking(spark):
    rows = [("w1", 1, "3-stars"), ("w1", 1, "3-stars"), ("w1", 2, "1-star"), ("w1", 3, "1-star"), ("w1", 4, "1-star"), *[("w1", k, "bib-gourmand") for k in range(5, 10)], ("w2", 1, "3-stars"), ("w3", 9, None)]
    df = spark.createDataFrame(rows, "item string, venue int, kind string")
    got = {r["item"]: (float(r["score"]), r["n"]) for r in ranking.scores(df, "item", "venue", "kind").collect()}
    assert got == {"w1": (12.9, 10), "w2": (1.5, 1), "w3": (1.0, 1)}
    venues = ranking.scores(df, "item", "venue", "kind", mode="venues")
    assert {r["item"]: float(r["score"]) for r in venues.collect()} == {"w1": 11.4, "w2": 1.5, "w3": 1.0}
    scaled = {r["item"]: r["rank_1_10"] for r in ranking.normalised(venues).collect()}
    assert scaled["w1"] == 10.0 and scaled["w3"] == 1.0 and 1.0 < scaled["w2"] < 2.0
    assert {r["item"]: (r["place"], r["share_below"]) for r in ranking.places(venues, "item").collect()} == {"w1": (1, 1.0), "w2": (2, 0.5), "w3": (3, 0.0)}


def test_streams(spark, tmp_path):
    rows = [(1, k, "error" if k in (0, 1, 2, 4, 5, 6) else "ok", AT) for k in range(8)] + [(2, 9, "ok", AT)]
    events = spark.createDataFrame(rows, "job int, event_id long, event_type string, ts timestamp")
    for part in (events.where("event_id < 5"), events.where("event_id >= 5")):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = streaming.read_events(spark, str(tmp_path / "in"), "job int, event_id long, event_type string, ts timestamp", 1)
    run = lambda df, name, mode: df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).option("checkpointLocation", str(tmp_path / name)).start().awaitTermination()
    run(streaming.rollup(stream, "job", "event_type = 'error'"), "rolled", "complete")
    assert {r["job"]: (r["attempts"], r["failures"]) for r in spark.table("rolled").collect()} == {1: (8, 6), 2: (1, 0)}
    run(streaming.trips(stream, "job", "event_type = 'error'"), "tripped", "append")
    assert sorted((r["job"], r["event_id"]) for r in spark.table("tripped").collect()) == [(1, 2), (1, 6)]


EVENTS = "job int, event_id long, event_type string, value double, ts timestamp"


def test_a_batch_that_runs_again_counts_once(spark, tmp_path):
    """The stream breaks off after a batch was written but before Spark noted it: the batch runs again, and counts once."""
    rows = [(k % 3, k, "error" if k % 4 == 0 else "ok", float(k), AT) for k in range(30)]
    events = spark.createDataFrame(rows, EVENTS)
    for k in range(3):
        events.where(f"event_id % 3 = {k}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = streaming.read_events(spark, str(tmp_path / "in"), EVENTS, 1)
    totals, checkpoint = str(tmp_path / "totals"), tmp_path / "checkpoint"
    run = lambda: streaming.rollup_into(stream, totals, str(checkpoint), "job", "event_type = 'error'", "value").awaitTermination()
    run()
    for name in ("commits/2", "commits/.2.crc"):
        (checkpoint / name).unlink(missing_ok=True)
    run()
    got = {r["job"]: (r["attempts"], r["failures"], float(r["total"])) for r in streaming.rolled_up(spark, totals, "job").collect()}
    assert got == {j: (10, sum(k % 4 == 0 for k in range(j, 30, 3)), float(sum(range(j, 30, 3)))) for j in range(3)}
    events.limit(1).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    assert streaming.rolled_up(spark, totals, "job").groupBy().sum("attempts").first()[0] == 31


def test_trips_follow_event_time(spark, tmp_path):
    """Files in any order, within the delay; the stream's answer is the one of all rows in their order."""
    rng = random.Random(5)
    rows = [(k % 4, k, "error" if rng.random() < 0.6 else "ok", 0.0, AT + dt.timedelta(minutes=k)) for k in range(200)]
    order = sorted(range(200), key=lambda k: k + rng.uniform(-20, 20))
    for n in range(8):
        part = [rows[k] for k in order[25 * n : 25 * n + 25]]
        spark.createDataFrame(part, EVENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    last = [(9, 999, "ok", 0.0, AT + dt.timedelta(days=30))]  # moves the watermark past all others
    spark.createDataFrame(last, EVENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = streaming.read_events(spark, str(tmp_path / "in"), EVENTS, 1)
    found = streaming.trips_in_order(stream, "job", "event_type = 'error'", "2 hours")
    found.writeStream.format("memory").queryName("in_order").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start().awaitTermination()
    want = []
    for job in range(4):
        count = 0
        for j, event, kind, *_ in rows:
            if j == job:
                count = count + 1 if kind == "error" else 0
                if count == 3:
                    want.append((job, event))
                    count = 0
    assert sorted((r["job"], r["event_id"]) for r in spark.table("in_order").collect()) == sorted(want)
