"""Landing area, bookmarks, sinks, streams and repeated runs."""

import csv
import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from eventweft.models.hospitality import HOSPITALITY
from eventweft.models.orders import ORDERS
from eventweft.plans.run import open_batch
from eventweft.sources import landing as L
from eventweft.sources import sinks, tables
from eventweft.streaming import ingest

DAY = dt.date(2025, 1, 31)


def event(i, name="orderCreate", **order):
    body = {"orderKey": i, "placed": {"date": "2025-01-05"}, "total": "$1,000.50", "customer": {"custKey": i % 3, "name": f"C{i % 3}"}}
    body |= {"refs": [{"number": f"R{i}", "source": "web"}, {"number": None, "source": "desk"}]} | order
    return {"messageHeader": {"timestamp": f"2025-01-05 08:07:{i % 60:02d}192Z"}, "eventInfo": {"name": name}, "order": body}


def write_file(base, day, start, end, docs, name=None):
    folder = os.path.join(base, f"year={day:%Y}", f"month={day:%m}", f"day={day:%d}")
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name or f"raw_data_{start}-{end}.csv")
    with open(path, "w", newline="") as f:
        out = csv.writer(f, quoting=csv.QUOTE_ALL)
        out.writerow(x.name for x in L.LANDING_SCHEMA)
        for i, doc in docs:
            text = doc if isinstance(doc, str) else json.dumps(doc, indent=1)
            out.writerow([i, "", "", "", "", "", text, "", "", "", ""])


@pytest.fixture
def base(tmp_path):
    root = str(tmp_path / "landing")
    write_file(root, DAY, 1, 10, [(i, event(i)) for i in range(1, 11)])
    write_file(root, DAY + dt.timedelta(1), 11, 20, [(i, event(i)) for i in range(11, 21)])
    # A gap, then a file of the next month whose name range is wider than its rows.
    write_file(root, DAY + dt.timedelta(1), 31, 60, [(i, event(i)) for i in range(31, 36)])
    write_file(root, DAY, 0, 0, [(1, event(1))], name="notes.csv")
    return root


def test_scan_csv_keeps_cells_that_span_lines(spark, base):
    rows = L.scan_csv(spark, base + "/*/*/*/raw_data_1-10.csv").collect()
    assert len(rows) == 10 and json.loads(rows[0]["raw"]) == event(rows[0]["id"])


def test_manifest_ignores_other_names(spark, base):
    got = sorted((r["start"], r["end"], r["month"], r["day"]) for r in L.manifest(spark, base).collect())
    assert got == [(1, 10, "01", "31"), (11, 20, "02", "01"), (31, 60, "02", "01")]
    assert L.manifest(spark, base, since=dt.date(2025, 2, 1)).count() == 2


@pytest.mark.parametrize("last, budget, want", [(0, 10, [1]), (0, 11, [1, 11]), (5, 5, [1]), (5, 6, [1, 11]), (20, 1, [31]), (60, 9, []), (0, 1000, [1, 11, 31])])
def test_file_budget(spark, base, last, budget, want):
    assert sorted(r["start"] for r in L.within_budget(L.manifest(spark, base), last, budget).collect()) == want


def test_calendar_rolls_over(spark):
    row = spark.sql("select date'2024-12-30' a, date'2025-01-02' b").select(L.calendar(F.col("a"), F.col("b")).alias("d"), L.calendar(F.col("b"), F.col("a")).alias("none"))
    got = row.select(F.transform("d", L.day_folder).alias("d"), "none").first()
    assert got["d"] == ["year=2024/month=12/day=30", "year=2024/month=12/day=31", "year=2025/month=01/day=01", "year=2025/month=01/day=02"]
    assert got["none"] == []


def test_next_chunk(spark):
    frame = spark.range(0, 100).repartition(7)
    assert sorted(r["id"] for r in L.next_chunk(frame, 20, 10).collect()) == list(range(21, 31))
    assert L.next_chunk(frame, 99, 10).count() == 0


@pytest.mark.parametrize(
    "ids, limit, kept", [([1, 1, 2, 3], 1, 2), ([1, 2, 2, 2, 3], 3, 4), ([0], 5, 1), ([5, 5, 5], 1, 3), ([], 4, 0)]
)
def test_next_chunk_splits_no_id(spark, ids, limit, kept):
    frame = spark.createDataFrame([(i,) for i in ids], "id long")
    assert L.next_chunk(frame, -1, limit).count() == kept


def test_increments_walk_through_all_files(spark, base, tmp_path):
    state, seen = str(tmp_path / "state"), []
    for _ in range(10):
        step = L.next_increment(spark, base, state, budget=8)
        if step is None:
            break
        got = [r["id"] for r in step.events.collect()]
        # A crash before the bookmark is saved gives the same batch again.
        assert [r["id"] for r in L.next_increment(spark, base, state, budget=8).events.collect()] == got
        assert (min(got), max(got)) == (step.first_id, step.last_id)
        seen += got
        L.save_progress(spark, state, step)
    assert sorted(seen) == [*range(1, 21), *range(31, 36)]
    mark = L.read_bookmark(spark, state)
    assert mark == L.Bookmark("2025", "02", "01", "raw_data_31-60.csv", 35)


def test_only_days_since_the_bookmark_are_listed_and_late_files_are_read(spark, base, tmp_path):
    state, seen = str(tmp_path / "state"), []
    write_file(base, dt.date(2024, 6, 1), 900, 900, [(900, event(900))])

    def run(until):
        while (step := L.next_increment(spark, base, state, budget=30, until=until)) is not None:
            seen.extend(r["id"] for r in step.events.collect())
            L.save_progress(spark, state, step)

    run(dt.date(2025, 2, 2))
    assert sorted(seen) == [*range(1, 21), *range(31, 36), 900]
    # The bookmark is where the greatest id was; later runs list from a week before.
    L.save_bookmark(spark, state, L.Bookmark("2025", "02", "01", "raw_data_31-60.csv", 901))
    old = os.path.join(base, "year=2024")
    os.chmod(old, 0)
    write_file(base, DAY, 21, 25, [(i, event(i)) for i in range(21, 26)])  # late, in an old day, below the bookmark
    write_file(base, dt.date(2025, 2, 3), 910, 912, [(i, event(i)) for i in range(910, 913)])
    listed = L.manifest(spark, base, dt.date(2025, 1, 25), dt.date(2025, 2, 3))
    assert sorted({r["year"] for r in listed.select("year").collect()}) == ["2025"]
    seen.clear()
    run(dt.date(2025, 2, 3))
    os.chmod(old, 0o755)
    assert sorted(seen) == [*range(21, 26), *range(910, 913)]
    seen.clear()
    run(dt.date(2025, 2, 3))
    assert seen == []
    assert L.next_increment(spark, base, state, until=dt.date(2025, 1, 1)) is None


def test_day_globs_name_only_their_days(spark):
    glob = L.day_globs(spark, "/base", dt.date(2024, 12, 31), dt.date(2025, 1, 1))
    assert glob == "/base/{year=2024/month=12/day=31,year=2025/month=01/day=01}"


def test_headers_come_from_the_mended_document(spark, base):
    write_file(base, DAY, 61, 61, [(61, json.dumps(event(61)).replace('"', '""'))])
    row = L.with_headers(L.scan_csv(spark, base + "/*/*/*/raw_data_61-61.csv")).select(
        "event_name", F.date_format("event_timestamp", "HH:mm:ss.SSS").alias("t")
    )
    assert tuple(row.first()) == ("orderCreate", "08:07:01.192")


def test_no_file_for_an_id_is_an_error(spark, base):
    with pytest.raises(LookupError):
        L.advance(L.manifest(spark, base), 25)


# Stores


def landed(spark, ids, **more):
    rows = [(i, dt.datetime(2025, 1, 5, 8, 0, i % 60), "orderCreate", json.dumps(event(i, **more))) for i in ids]
    return spark.createDataFrame(rows, "id long, event_timestamp timestamp, event_name string, raw string")


def totals(written):
    return {(w.table, w.status): w.rows for w in written if w.rows}


def test_batches_add_only_new_rows_and_repeats_add_none(spark, tmp_path):
    base, part = str(tmp_path / "store"), ORDERS.only("purchase", "reference", "purchaseReferenceLink")
    appended = []
    append = lambda name, rows, n: appended.append((name, rows.count(), n))
    first = sinks.write_batch(open_batch(landed(spark, range(1, 7)), part), base, DAY, 1, 6, append)
    assert totals(first) == {
        ("customer", "succeeded"): 3, ("purchase", "succeeded"): 6, ("reference", "succeeded"): 6,
        ("reference", "failed"): 6, ("purchaseReferenceLink", "succeeded"): 6,
    }
    assert all(a == b for _, a, b in appended) and [n for n, _, _ in appended] == ["customer", "reference", "purchase", "purchaseReferenceLink"]
    again = sinks.write_batch(open_batch(landed(spark, range(1, 7)), part), base, DAY, 1, 6)
    assert totals(again) == totals(first)
    # The next batch knows two of its customers' rows and half of its orders.
    second = sinks.write_batch(open_batch(landed(spark, range(4, 9)), part, stage=True), base, DAY, 4, 8)
    assert totals(second)[("purchase", "succeeded")] == 2 and ("customer", "succeeded") not in totals(second)
    # Children still find parents stored before: the two new orders carry their customer's id.
    stored = tables.scan_stored(spark, sinks.stored_glob(base, "purchase"), ORDERS.table("purchase").schema())
    assert stored.count() == 8 and stored.filter("customer_id is null").count() == 0
    assert stored.select("id").distinct().count() == 8


def test_tables_without_rows_leave_no_folder(spark, tmp_path):
    base = str(tmp_path / "store")
    out = sinks.write_batch(open_batch(landed(spark, range(1, 4), refs=[]), ORDERS, stage=True), base, DAY, 1, 3)
    folders = {(d.parent.name, d.name) for d in (tmp_path / "store").glob("year=*/month=*/day=*/batch=*/status=*/table_name=*")}
    assert folders == {(f"status={w.status}", f"table_name={w.table}") for w in out}
    assert {w.table for w in out} == {"customer", "purchase"} and all(w.rows for w in out)
    assert sinks.write_batch(open_batch(landed(spark, []), ORDERS), base, DAY, 4, 9) == []


def test_jobs_of_a_write_do_not_follow_the_number_of_tables(spark, tmp_path):
    tracker, ran = spark.sparkContext.statusTracker(), []
    for n, part in enumerate((ORDERS.only("customer"), ORDERS)):
        batch = open_batch(landed(spark, range(1, 40)), part, stage=True)
        spark.sparkContext.setJobGroup(f"write-{n}", "")
        sinks.write_batch(batch, str(tmp_path / f"store{n}"), DAY, 1, 39)
        ran.append(len(tracker.getJobIdsForGroup(f"write-{n}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(ORDERS.write_order) == 11 and ran[1] < ran[0] + 11


def test_groups_of_tables_agree_in_types():
    for model, most in ((ORDERS, 2), (HOSPITALITY, 4)):
        groups = sinks.alike(model)
        assert sorted(n for g in groups for n in g) == sorted(model.write_order) and len(groups) <= most
        for names in groups:
            kinds = {}
            for name in names:
                for f in model.table(name).schema():
                    assert kinds.setdefault(f.name, f.dataType) == f.dataType


def test_a_store_that_cannot_be_read_is_an_error(spark, tmp_path):
    schema = ORDERS.table("customer").schema()
    assert tables.scan_stored(spark, str(tmp_path / "none"), schema).count() == 0
    broken = tmp_path / "broken.parquet"
    broken.write_text("not parquet")
    with pytest.raises(Exception):
        tables.scan_stored(spark, str(broken), schema).count()


def test_jdbc_options():
    schema = ORDERS.table("reference").schema()
    options = tables.jdbc_table_options({"url": "jdbc:x"}, 'shop.my"orders', schema, ("source_id", 1, 100, 8))
    assert options["dbtable"] == '"shop"."my""orders"' and options["numPartitions"] == "8"
    assert "`number` string" in options["customSchema"]
    assert [sinks.batch_size(n) for n in (1, 9_999, 10_000, 99_999, 100_000)] == [1000, 1000, 5000, 5000, 10000]
    assert sinks.jdbc_write_options({}, "t", 20_000)["batchsize"] == "5000"


# Streams


def test_stream_takes_each_file_once(spark, base, tmp_path):
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    run = lambda: ingest.run_available(ingest.landing_stream(spark, base, 1), mark, ingest.write_numbered(out))
    run()
    run()
    # As in the manifest, the file with another name does not count.
    ids = sorted(r["id"] for r in spark.read.parquet(out).collect())
    assert ids == sorted([*range(1, 21), *range(31, 36)])
    write_file(base, DAY, 61, 62, [(61, event(61))])
    run()
    assert spark.read.parquet(out).filter("id = 61").count() == 1


def test_model_per_stream_batch(spark, base, tmp_path):
    store, part = str(tmp_path / "store"), ORDERS.only("purchase")

    def write(batch, number):
        sinks.write_batch(batch, store, DAY, number, number)

    ingest.run_model(ingest.landing_stream(spark, base, 2), part, str(tmp_path / "mark"), write)
    stored = spark.read.parquet(sinks.stored_glob(store, "purchase"))
    assert stored.count() == stored.select("id").distinct().count() == 25


def test_lanes_take_each_file_once_wherever_it_lies(spark, base, tmp_path):
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    for k in range(20, 30):
        write_file(base, dt.date(2025, 3, k), 100 + k, 100 + k, [(100 + k, event(k))])
    for i, folder in ((200, "."), (201, "old"), (202, "old/er"), (203, "year=2025/month=03/day=07/hour=01"), (204, "a/b/c/d")):
        os.makedirs(os.path.join(base, folder), exist_ok=True)
        write_file(base, dt.date(2025, 3, 9), i, i, [(i, event(i))], name="moved.csv")
        os.replace(os.path.join(base, "year=2025/month=03/day=09/moved.csv"), os.path.join(base, folder, f"raw_data_{i}-{i}.csv"))

    def run():
        lanes = ingest.landing_lanes(spark, base, 1)
        done = ingest.run_lanes(lanes, mark, ingest.write_lanes(out))
        return sum(any(p["numInputRows"] for p in q.recentProgress) for q in done)

    assert run() == 10  # side by side: each lane has files of its own
    want = [*range(1, 21), *range(31, 36), *range(120, 130), *range(200, 205)]
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == want
    write_file(base, DAY, 61, 62, [(61, event(61))])
    assert run() == 1
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == sorted([*want, 61])


def test_a_failure_in_one_lane_is_raised_and_loses_nothing(spark, base, tmp_path):
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")

    def broken(lane):
        def write(batch, number):
            raise RuntimeError("disk full")

        return write if lane == 1 else ingest.write_numbered(f"{out}/lane={lane}")

    with pytest.raises(Exception, match="disk full"):
        ingest.run_lanes(ingest.landing_lanes(spark, base), mark, broken)
    assert not spark.streams.active
    ingest.run_lanes(ingest.landing_lanes(spark, base), mark, ingest.write_lanes(out))
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [*range(1, 21), *range(31, 36)]


# The hospitality model


def test_the_model_has_all_tables():
    m = HOSPITALITY
    assert (len(m.entities), len(m.links), len(m.foreign_keys), len(m.events)) == (39, 38, 13, 22)
    assert len(m.levels) == 3 and m.write_order.index("hotel") < m.write_order.index("reservation")
    assert m.sources("reservationModify", "hotel")[0].rows_from == "reservation.hotel"
    assert len(m.sources("reservationCheckOut", "confirmationNumber")) == 2
    assert sum("never filled" in n for n in m.validate()) == 6


HOTEL = {"hotelId": 7, "hotelCode": "H7", "propertyCode": "P", "timeOffsetFromUTC": "0", "propertyName": "Grand River Inn", "brandCode": "B", "currencyCode": "EUR"}


def stays(spark, *docs):
    rows = [(i, dt.datetime(2025, 1, 5, 8, 0, i), name, json.dumps({"eventInfo": {"name": name, "version": "2"}, **doc})) for i, (name, doc) in enumerate(docs)]
    return spark.createDataFrame(rows, "id long, event_timestamp timestamp, event_name string, raw string")


def test_two_places_fill_one_table(spark):
    doc = {"emailConfirmation": {"hotel": HOTEL, "customer": {"contacts": [{"emailAddress": "a@x"}]}, "emailAddresses": ["b@x", " ", "c@x"]}}
    rows = open_batch(stays(spark, ("reservationEmailConfirmation", doc)), HOSPITALITY).lookup("contact")
    assert sorted(r["emailAddress"] for r in rows.collect()) == ["a@x", "b@x", "c@x"]


def test_hotel_children_and_abbreviation(spark):
    unit = {"startDate": "2025-01-05", "endDate": "2025-01-06", "inventoryCode": "K1", "itemType": "room", "quantity": "1,200"}
    good = {"inventoryUpdate": {"hotel": HOTEL, "inventoryAvailableCounts": [unit, {**unit, "quantity": None}]}}
    test = {"inventoryUpdate": {"hotel": HOTEL | {"propertyName": "Old TEST Inn"}, "inventoryAvailableCounts": [unit]}}
    batch = open_batch(stays(spark, ("inventoryUpdate", good), ("inventoryUpdate", test)), HOSPITALITY)
    assert batch.succeeded("hotel").first()["propertyName_abbrev"] == "GR Inn"
    counts = batch.succeeded("inventoryAvailableCount").collect()
    assert [(r["quantity"], r["source_id"]) for r in counts] == [(1200, 0)]
    why = {tuple(r["_reasons"]) for r in batch.failed("inventoryAvailableCount").collect()}
    assert why == {("null:quantity",), ("null:hotel_id",)}


def test_groups_rates_and_folios(spark):
    docs = [
        ("groupModify", {"group": {"hotel": HOTEL, "groupId": "G1", "name": "Choir", "groupInfo": {"isElastic": "Y"}, "travelagent": {"name": "T"}}}),
        ("fixedRateUpdate", {"recap": True, "messageHeader": {"timestamp": "2025-01-05 08:07:19"}, "fixedRateUpdate": {"hotel": HOTEL, "amountFixedRates": [{"startDate": "2025/01/05", "onePersonRate": "$99.5", "limitToDaysOfWeek": {"sunday": "no"}}]}}),
        ("folioGuestIncrementalUpdate", {"folioGuestCreate": {"hotel": HOTEL, "roomNumber": 12, "arrivalDate": "2025-01-05", "folioTransactions": [{"transactionAmount": "1.005", "toAccountNumber": 5}]}}),
    ]
    batch = open_batch(stays(spark, *docs), HOSPITALITY)
    group = batch.lookup("group").first()
    assert group["hotel_id"] and group["travelagent_id"] and group["company_id"] is None and group["groupInfo_isElastic"] is True
    rate = batch.lookup("amountFixedRate").first()
    assert (str(rate["startDate"]), float(rate["onePersonRate"]), rate["limitToDaysOfWeek_sunday"]) == ("2025-01-05", 99.5, False)
    assert batch.succeeded("rateAmountFixedRateLink").count() == 1
    entry = batch.lookup("folioItem").first()
    assert (float(entry["transactionAmount"]), entry["toAccountTransfer_account"]) == (1.01, "5")
    # Folio events yield no room rows, so the room stays as told.
    stay = batch.all_rows("reservation").filter("source_id = 2").first()
    assert stay["reservedRoom"] == "12"
