"""Business events made from star tables: orders with their line items, and parts.

A landing row has ``id``, ``event_timestamp``, ``event_name`` and ``raw``, the JSON document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweft.session import staged

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(value: Column, kind: str = "decimal(12,2)") -> Column:
    return value.cast(kind)


#: Bytes of stored tables told in one partition of documents, which are some ten times as large.
PART_BYTES = 4 << 20


def document_parts(spark: SparkSession, sf_dir: str, *names: str) -> int:
    """Partitions for documents made from these tables: their number follows the tables' bytes, so that what a task
    sorts stays as small as it is; at least as many as Spark's shuffles have."""
    told = sum(_version(spark, sf_dir, name)[1] or 0 for name in names)
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-told // PART_BYTES))


def _item_lists(spark: SparkSession, sf_dir: str, parts: int) -> DataFrame:
    """Line items gathered per order: one order is one document, whatever its size, so the list is as
    long as the document has to be. Flat rows are dealt; the nested ones are made where they are gathered."""
    lines = table(spark, sf_dir, "lineitem").repartition(parts, "l_orderkey")
    charge = lambda kind, amount: F.struct(F.lit(kind).alias("kind"), money(F.col(amount), "decimal(5,2)").alias("amount"))
    charges = F.filter(
        F.array(charge("discount", "l_discount"), charge("tax", "l_tax")), lambda c: c["amount"] > F.lit(0)
    )
    item = F.struct(
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("partKey"),
        F.col("l_suppkey").alias("suppKey"),
        F.col("l_quantity").cast("int").alias("qty"),
        money(F.col("l_extendedprice")).alias("price"),
        F.struct(
            F.date_format("l_shipdate", "dd/MM/yyyy").alias("date"),
            F.array("l_returnflag", "l_linestatus").alias("flags"),
        ).alias("ship"),
        charges.alias("charges"),
    )
    return lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("items"))


def header_text(day: Column, millis: Column) -> Column:
    """A header time whose fraction has lost its point, as ``1995-01-01 08:07:19042Z``."""
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 08:07:19"), F.lpad((millis % 1000).cast("string"), 3, "0"), F.lit("Z"))


def _envelope(name: Column, time_text: Column, body: str, content: Column) -> Column:
    return F.to_json(
        F.struct(
            F.struct(time_text.alias("timestamp")).alias("messageHeader"),
            F.struct(name.alias("name"), F.lit("1.0").alias("version")).alias("eventInfo"),
            content.alias(body),
        )
    )


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    return table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))


def _spread(rows: DataFrame, parts: int, key: str) -> DataFrame:
    """Making and reading documents costs CPU out of proportion to their bytes. The number of partitions
    is named, which keeps adaptive execution from joining them by their bytes."""
    return rows.repartition(parts, key)


def make_order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orderCreate`` for every order, ``orderModify`` for every tenth key, ``orderCancel`` for status F."""
    # customers first, while an order is a short row; then spread by the key that the join with line items needs
    parts = document_parts(spark, sf_dir, "orders", "lineitem")
    short = table(spark, sf_dir, "orders").join(_people(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
    full = _spread(short, parts, "o_orderkey").join(_item_lists(spark, sf_dir, parts), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    key = F.col("o_orderkey")
    kinds = F.filter(
        F.array(
            F.struct(F.lit(1).alias("n"), F.lit("orderCreate").alias("name")),
            F.when(key % 10 == 0, F.struct(F.lit(2).alias("n"), F.lit("orderModify").alias("name"))),
            F.when(F.col("o_orderstatus") == "F", F.struct(F.lit(3).alias("n"), F.lit("orderCancel").alias("name"))),
        ),
        lambda k: k.isNotNull(),
    )
    typed = full.withColumn("event", F.explode(kinds))
    n, name = F.col("event.n"), F.col("event.name")
    day = F.col("o_orderdate") + F.make_dt_interval(n - 1)
    customer = F.struct(
        F.col("c_custkey").alias("custKey"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        F.when(F.col("c_acctbal") > 0, F.lit("yes")).otherwise(F.lit("no")).alias("vip"),
        F.struct(F.col("n_name").alias("name")).alias("nation"),
    )
    stamp = lambda days: F.date_format(F.col("o_orderdate") + F.make_dt_interval(F.lit(days)), "yyyy-MM-dd'T'HH:mm:ss")
    statuses = F.array(
        F.struct(F.lit("o").alias("code"), stamp(0).alias("at")),
        F.struct(F.col("o_orderstatus").alias("code"), stamp(2).alias("at")),
    )
    number = F.concat(F.lit("R"), key.cast("string"))
    refs = F.filter(
        F.array(
            F.struct(number.alias("number"), F.lit("web").alias("source")),
            F.when(key % 5 == 0, F.struct(F.lit(None).cast("string").alias("number"), F.lit("desk").alias("source"))),
            F.when(key % 3 == 0, F.struct(F.concat(number, F.lit("-s")).alias("number"), F.lit("store").alias("source"))),
        ),
        lambda r: r.isNotNull(),
    )
    order = F.struct(
        key.alias("orderKey"),
        F.struct(
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
            F.when(key % 7 != 0, F.col("o_orderpriority")).alias("priority"),
        ).alias("placed"),
        F.concat(F.lit("$"), F.format_number(money(F.col("o_totalprice")), 2)).alias("total"),
        customer.alias("customer"),
        F.col("items"),
        refs.alias("refs"),
        statuses.alias("statuses"),
    )
    cancel = F.struct(
        F.struct(key.alias("orderKey")).alias("order"),
        F.struct(F.col("c_custkey").alias("custKey"), F.col("c_name").alias("name")).alias("customer"),
        F.struct(F.col("o_orderstatus").alias("code"), stamp(2).alias("at")).alias("status"),
        F.lit("n/a").alias("reason"),
    )
    text = header_text(day, key)
    raw = F.when(n == 3, _envelope(name, text, "cancellation", cancel)).otherwise(_envelope(name, text, "order", order))
    return typed.select(
        (key * 10 + n).alias("id"),
        (day + F.make_dt_interval(F.lit(0), F.lit(8), F.lit(7), F.lit(19) + (key % 1000).cast("decimal(18,6)") / 1000))
        .cast("timestamp")
        .alias("event_timestamp"),
        name.alias("event_name"),
        raw.alias("raw"),
    )


def make_part_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``partUpdate`` for every part; its name is two words and the brand."""
    parts = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    day = F.lit("2002-01-01").cast("timestamp_ntz")
    body = F.struct(
        key.alias("partKey"),
        F.concat_ws(" ", "p_name", "p_brand").alias("name"),
        F.col("p_size").alias("size"),
        money(F.col("p_retailprice")).alias("retail"),
    )
    return parts.select(
        (key * 10 + 4).alias("id"),
        F.lit("2002-01-01 08:07:19").cast("timestamp").alias("event_timestamp"),
        F.lit("partUpdate").alias("event_name"),
        _envelope(F.lit("partUpdate"), header_text(day, F.lit(0)), "part", body).alias("raw"),
    )


_LANDED: dict[tuple, DataFrame] = {}


def _version(spark: SparkSession, sf_dir: str, name: str) -> tuple:
    """What tells whether a table's files are still the same; the listing reads no content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{sf_dir}/{name}.parquet")
    return tuple(files.agg(F.count(F.lit(1)), F.sum("length"), F.max("modificationTime")).first())


def _landed(spark: SparkSession, sf_dir: str, make, *tables: str) -> DataFrame:
    """Events as a run finds them, stored: made once per session for each state of the tables."""
    versions = [_version(spark, sf_dir, name) for name in tables]
    key = (spark.sparkContext.applicationId, sf_dir, make.__name__, *versions)
    if key not in _LANDED:
        _LANDED[key] = staged(make(spark, sf_dir), "events")
    return _LANDED[key]


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, sf_dir, make_order_events, "orders", "lineitem", "customer", "nation")


def part_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, sf_dir, make_part_events, "part")


def stay_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, sf_dir, make_stay_events, "orders", "customer", "nation")


def all_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_events(spark, sf_dir).unionByName(part_events(spark, sf_dir))


def damaged(events: DataFrame) -> DataFrame:
    """The same events as careless exports leave them: quotes doubled, wrapped, text cut off or more
    text after the document."""
    doubled = F.replace(F.col("raw"), F.lit('"'), F.lit('""'))
    pick = F.col("id") % 10 + F.floor(F.col("id") / 10) % 7
    return events.withColumn(
        "raw",
        F.when(F.floor(F.col("id") / 10) % 13 == 0, F.substr(F.col("raw"), F.lit(1), F.length("raw") - 5))
        .when(F.floor(F.col("id") / 10) % 13 == 1, F.concat("raw", "raw"))
        .when(F.floor(F.col("id") / 10) % 13 == 2, F.concat("raw", F.lit(" and more")))
        .when(pick == 2, doubled)
        .when(pick == 3, F.concat(F.lit('"'), doubled, F.lit('"')))
        .otherwise(F.col("raw")),
    )


def make_stay_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders told as hotel stays: created, checked in (status O) or cancelled (status F).

    The nation is the hotel, every seventh without a currency; the customer is the guest.
    """
    full = table(spark, sf_dir, "orders").join(_people(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
    full = _spread(full, document_parts(spark, sf_dir, "orders"), "o_orderkey")
    key, nation = F.col("o_orderkey"), F.col("n_nationkey")
    kinds = F.array(
        F.struct(F.lit(1).alias("n"), F.lit("reservationCreate").alias("name"), F.lit("reservation").alias("body")),
        F.when(F.col("o_orderstatus") == "O", F.struct(F.lit(2).alias("n"), F.lit("reservationCheckIn").alias("name"), F.lit("checkIn").alias("body"))),
        F.when(F.col("o_orderstatus") == "F", F.struct(F.lit(3).alias("n"), F.lit("reservationCancel").alias("name"), F.lit("cancellation").alias("body"))),
    )
    typed = full.withColumn("event", F.explode(F.filter(kinds, lambda k: k.isNotNull())))
    n = F.col("event.n")
    date = lambda days: F.date_format(F.date_add(F.col("o_orderdate").cast("date"), days), "yyyy-MM-dd")
    hotel = F.struct(
        nation.alias("hotelId"),
        F.concat(F.lit("H"), nation.cast("string")).alias("hotelCode"),
        F.lit("P").alias("propertyCode"),
        F.lit("+00:00").alias("timeOffsetFromUTC"),
        F.concat(F.lit("Grand River "), F.when(nation == 3, F.lit("Test ")).otherwise(F.lit("")), F.col("n_name")).alias("propertyName"),
        F.lit("B").alias("brandCode"),
        F.when(nation % 7 != 0, F.lit("USD")).alias("currencyCode"),
    )
    contacts = F.array(
        F.struct(
            F.lit("true").alias("contactIsPrimary"),
            F.array(F.lit("home"), F.lit("billing")).alias("contactPurposes"),
            F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("emailAddress"),
            F.struct(F.col("n_name").alias("city")).alias("postalAddress"),
        ),
        F.struct(F.lit("false").alias("contactIsPrimary"), F.lit(None).cast("array<string>").alias("contactPurposes"),
                 F.lit(None).cast("string").alias("emailAddress"), F.struct(F.lit("elsewhere").alias("city")).alias("postalAddress")),
    )
    guest = F.struct(F.col("c_name").alias("lastName"), F.lit("Ada").alias("firstName"), contacts.alias("contacts"))
    room = F.struct(date(0).alias("startDate"), date(2).alias("endDate"), (key % 400).alias("roomNumber"))
    numbers = F.array(F.struct(key.alias("confirmationNumber"), F.lit("web").alias("source")))
    status = F.struct(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("statusTimestamp"), F.lit("RESERVED").alias("reservationStatus"), key.alias("confirmationId")
    )
    card = lambda digits: F.struct(F.lit("V").alias("cardType"), digits.cast("string").alias("lastFourDigits"))
    created = F.struct(
        hotel.alias("hotel"),
        key.alias("reservationId"),
        date(0).alias("arrivalDate"),
        date(2).alias("departureDate"),
        numbers.alias("reservationConfirmationNumbers"),
        F.array(status).alias("reservationStatuses"),
        F.array(F.struct(F.lit(True).alias("customerIsPrimary"), guest.alias("customer"))).alias("reservationCustomers"),
        F.array(F.struct(date(0).alias("startDate"), date(2).alias("endDate"), F.lit("room").alias("itemType"), F.array(room).alias("reservedRooms"))).alias("reservationItems"),
        F.struct(F.lit("card").alias("guaranteeType"), card(key % 10000).alias("creditCard")).alias("guarantee"),
        F.array(F.struct(F.lit("1").alias("folioId"), card(key % 10000 + 1).alias("creditCard"))).alias("paymentMethods"),
        F.struct(F.concat(F.lit("$"), F.format_number(money(F.col("o_totalprice")), 2)).alias("totalTaxAmount")).alias("costSummary"),
    )
    short = F.struct(
        hotel.alias("hotel"), date(0).alias("arrivalDate"), date(2).alias("departureDate"), numbers.alias("reservationConfirmationNumbers"),
        status.alias("reservationStatus"), guest.alias("customer"), room.alias("reservedRoom"),
    )
    text = header_text(F.col("o_orderdate"), key)
    raw = F.when(n == 1, _envelope(F.col("event.name"), text, "reservation", created)).when(
        n == 2, _envelope(F.col("event.name"), text, "checkIn", short)
    ).otherwise(_envelope(F.col("event.name"), text, "cancellation", short))
    return typed.select(
        (key * 10 + n).alias("id"),
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(8), F.lit(7), F.lit(19) + (key % 1000).cast("decimal(18,6)") / 1000))
        .cast("timestamp").alias("event_timestamp"),
        F.col("event.name").alias("event_name"),
        raw.alias("raw"),
    )
