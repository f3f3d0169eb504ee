"""Column functions over whole tables: texts are made from typed columns and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventweft.checks.registry import EVENTS, day, query, sql_stamp, stamp, with_parts
from eventweft.functions import coerce as C
from eventweft.functions import paths
from eventweft.functions import text as X
from eventweft.models.orders import STATUS_LABELS
from eventweft.operators import extract as E
from eventweft.sources.corpus import damaged, order_events, table
from eventweft.spec import Column, Entity, Source



def _lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem")


def _spelled(pick, *texts):
    """One of several spellings, by the remainder of a key."""
    out = F.when(pick == 0, texts[0])
    for i, t in enumerate(texts[1:], 1):
        out = out.when(pick == i, t)
    return out


@query(
    "coerce_string",
    """SELECT l_orderkey, l_linenumber, CASE l_partkey % 4 WHEN 0 THEN l_returnflag WHEN 1 THEN l_linestatus END AS value FROM lineitem""",
)
def coerce_string(spark, sf_dir):
    pick = F.col("l_partkey") % 4
    text = _spelled(
        pick, F.concat(F.lit("  "), F.col("l_returnflag"), F.lit(" ")), F.col("l_linestatus"), F.lit(" N/A "), F.lit("NULL")
    )
    return _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", C.coerce(text, "string").alias("value"))


_INT_TEXTS = lambda n: (
    F.concat(F.lit(" "), n.cast("string")),
    F.concat(n.cast("string"), F.lit(".9")),
    F.format_number(n * 1000, 0),
    F.concat(F.lit("-"), n.cast("string"), F.lit(".9")),
    F.lit("none"),
    F.concat(n.cast("string"), F.lit("e1")),
)
_INT_SQL = "CASE l_partkey % 6 WHEN 0 THEN l_partkey WHEN 1 THEN l_partkey WHEN 2 THEN l_partkey * 1000 WHEN 3 THEN -l_partkey END"


@query("coerce_int", f"SELECT l_orderkey, l_linenumber, CAST({_INT_SQL} AS INT) AS value FROM lineitem")
def coerce_int(spark, sf_dir):
    text = _spelled(F.col("l_partkey") % 6, *_INT_TEXTS(F.col("l_partkey")))
    return _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", C.coerce(text, "int").alias("value"))


@query(
    "coerce_long",
    """SELECT l_orderkey, l_linenumber, CASE l_partkey % 3 WHEN 0 THEN 9007199254740993 + l_partkey WHEN 1 THEN 3000000000 + l_partkey END AS value
    FROM lineitem""",
)
def coerce_long(spark, sf_dir):
    n = F.col("l_partkey")
    text = _spelled(
        n % 3,
        F.concat((n + F.lit(9007199254740993)).cast("string"), F.lit(".7")),
        F.format_number(n + F.lit(3000000000), 0),
        F.concat(F.lit("9223372036854775807"), n.cast("string")),
    )
    return _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", C.coerce(text, "bigint").alias("value"))


@query(
    "coerce_decimal",
    """SELECT l_orderkey, l_linenumber, CAST(CASE l_partkey % 4
         WHEN 0 THEN CAST(l_extendedprice AS DECIMAL(12,2)) WHEN 1 THEN CAST(l_extendedprice AS DECIMAL(12,2))
         WHEN 2 THEN CAST(l_quantity AS DECIMAL(12,2)) + 0.01 END AS DOUBLE) AS value FROM lineitem""",
)
def coerce_decimal(spark, sf_dir):
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    text = _spelled(
        F.col("l_partkey") % 4,
        F.concat(F.lit("$"), F.format_number(price, 2)),
        F.concat(F.lit("€ "), price.cast("string")),
        F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(".005")),
        F.lit("NaN"),
    )
    return _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", C.coerce(text, "decimal(12,2)").cast("double").alias("value"))


@query(
    "coerce_bool",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 14 < 6 THEN TRUE WHEN l_partkey % 14 < 12 THEN FALSE
         WHEN l_partkey % 14 = 12 AND l_linenumber = 1 THEN TRUE END AS value FROM lineitem""",
)
def coerce_bool(spark, sf_dir):
    words = [F.lit(w.upper() if i % 2 else w) for i, w in enumerate((*C.TRUE_WORDS, *C.FALSE_WORDS))]
    text = _spelled(F.col("l_partkey") % 14, *words, F.col("l_linenumber").cast("string"), F.lit("maybe"))
    return _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", C.coerce(text, "boolean").alias("value"))


_DATE_FORMS = ("yyyy-MM-dd", "yyyy/M/d", "dd-MM-yyyy", "d/M/yyyy", "yyyyMMdd", "yyyy-MM-dd'T'HH:mm:ss'Z'")


@query(
    "coerce_date",
    """SELECT l_orderkey, l_linenumber, CASE
         WHEN l_partkey % 8 < 6 THEN strftime(l_shipdate, '%Y-%m-%d')
         WHEN l_partkey % 8 = 6 THEN CASE WHEN day(l_shipdate) > 12 THEN strftime(l_shipdate, '%Y-%m-%d')
           ELSE strftime(make_date(year(l_shipdate), day(l_shipdate), month(l_shipdate)), '%Y-%m-%d') END
         END AS value FROM lineitem""",
)
def coerce_date(spark, sf_dir):
    """Month-first text is read day-first where that is a date."""
    ship = F.col("l_shipdate")
    texts = [F.date_format(ship, f) for f in (*_DATE_FORMS, "MM/dd/yyyy")]
    text = _spelled(F.col("l_partkey") % 8, *texts, F.concat(F.date_format(ship, "yyyy-MM-dd"), F.lit(" soon")))
    return _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", day(C.coerce(text, "date")).alias("value"))


@query(
    "coerce_timestamp",
    f"""SELECT o_orderkey, {sql_stamp('''CASE o_orderkey % 10
        WHEN 0 THEN t WHEN 1 THEN t WHEN 2 THEN t WHEN 3 THEN t WHEN 4 THEN t WHEN 5 THEN t - INTERVAL 5 HOUR
        WHEN 6 THEN t WHEN 7 THEN CAST(o_orderdate AS TIMESTAMP) END''')} AS value
    FROM (SELECT o_orderkey, o_orderdate, CAST(o_orderdate AS TIMESTAMP) + INTERVAL 29239 SECOND
            + CASE WHEN o_orderkey % 10 IN (2, 3, 5) THEN INTERVAL 42 MILLISECOND ELSE INTERVAL 0 SECOND END AS t FROM orders)""",
)
def coerce_timestamp(spark, sf_dir):
    date = F.col("o_orderdate")
    form = lambda f: F.date_format(date + F.make_dt_interval(F.lit(0), F.lit(8), F.lit(7), F.lit(19)), f)
    text = _spelled(
        F.col("o_orderkey") % 10,
        form("yyyy-MM-dd HH:mm:ss"),
        form("yyyy-MM-dd'T'HH:mm:ss"),
        F.concat(form("yyyy-MM-dd HH:mm:ss"), F.lit(".042")),
        F.concat(form("yyyy-MM-dd HH:mm:ss"), F.lit("042Z")),
        form("dd-MM-yyyy HH:mm:ss"),
        F.concat(form("yyyy-MM-dd'T'HH:mm:ss"), F.lit(".042+05:00")),
        form("yyyy/MM/dd HH:mm:ss"),
        F.concat(form("yyyy-MM-dd"), F.lit(" in the morning")),
        F.unix_timestamp(form("yyyy-MM-dd HH:mm:ss")).cast("string"),
        F.concat(F.lit("on "), form("yyyy-MM-dd")),
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", stamp(C.coerce(text, "timestamp")).alias("value"))


_KINDS = Entity(
    "reading",
    (
        Column("whole", "int"), Column("wide", "bigint"), Column("amount", "decimal(12,2)"),
        Column("yes", "boolean"), Column("at", "timestamp"), Column("seen", "string"),
    ),
    key=("seen",),
    sources=(
        Source("reading", "", {
            "whole": "r.flag", "wide": "r.flag", "amount": "r.flag", "yes": "r.count", "at": "r.seconds", "seen": "r.count",
        }),
    ),
)


@query(
    "coerce_json_kinds",
    f"""WITH k AS (SELECT *, CASE WHEN l_partkey % 4 = 0 THEN 1 WHEN l_partkey % 4 = 1 THEN 0 END AS flag FROM lineitem)
    SELECT l_orderkey AS orderkey, l_linenumber AS linenumber, l_partkey AS partkey, flag AS whole, CAST(flag AS BIGINT) AS wide,
      CAST(flag AS DOUBLE) AS amount,
      CASE WHEN l_partkey % 2 = 0 THEN l_linenumber > 1 WHEN l_linenumber = 1 THEN FALSE WHEN l_linenumber = 2 THEN TRUE END AS yes,
      CASE WHEN l_partkey % 2 = 0 THEN {sql_stamp("CAST(l_shipdate AS TIMESTAMP)")} END AS at,
      CAST(l_linenumber - 1 AS VARCHAR) AS seen FROM k""",
)
def coerce_json_kinds(spark, sf_dir):
    """The same letters as a JSON number or boolean, and as a JSON text."""
    quoted = lambda c, when: F.when(when, F.concat(F.lit('"'), c, F.lit('"'))).otherwise(c)
    part, odd = F.col("l_partkey"), F.col("l_partkey") % 2 == 1
    flag = quoted(F.when(part % 2 == 0, "true").otherwise("false"), part % 4 > 1)
    count = quoted((F.col("l_linenumber") - 1).cast("string"), odd)
    seconds = quoted(F.unix_timestamp("l_shipdate").cast("string"), odd)
    raw = F.concat(F.lit('{"r":{"flag":'), flag, F.lit(',"count":'), count, F.lit(',"seconds":'), seconds, F.lit("}}"))
    told = _lines(spark, sf_dir).select(
        F.struct("l_orderkey", "l_linenumber", "l_partkey").alias("source_id"), F.lit("reading").alias("event_name"),
        F.lit(None).cast("timestamp").alias("event_time"), raw.alias("raw"),
    )
    rows = E.extract(paths.with_document(told, "raw", E.model_shape([_KINDS])), _KINDS)
    return rows.select(
        F.col("source_id.l_orderkey").alias("orderkey"), F.col("source_id.l_linenumber").alias("linenumber"),
        F.col("source_id.l_partkey").alias("partkey"), "whole", "wide", F.col("amount").cast("double").alias("amount"),
        "yes", stamp("at").alias("at"), "seen",
    )


@query(
    "coerce_binary",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN 'order' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') ELSE 'key ' || o_orderkey END AS value FROM orders""",
)
def coerce_binary(spark, sf_dir):
    plain = F.concat(F.lit("key "), F.col("o_orderkey").cast("string"))
    text = _spelled(
        F.col("o_orderkey") % 3,
        F.lower(F.hex(F.encode(plain, "UTF-8"))),
        F.base64(F.encode(plain, "UTF-8")),
        F.concat(F.lit("order"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")),
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", F.decode(C.coerce(text, "binary"), "UTF-8").alias("value"))


@query(
    "abbreviate_name",
    """SELECT p_partkey, p_name || ' ' || p_brand AS name,
      CASE WHEN regexp_matches(p_name || ' ' || p_brand, '^[A-Za-z]+ [A-Za-z]+ ')
        THEN upper(p_name[1]) || upper(split_part(p_name, ' ', 2)[1]) || ' ' || p_brand ELSE p_name || ' ' || p_brand END AS short
    FROM part""",
)
def abbreviate_name(spark, sf_dir):
    name = F.concat_ws(" ", "p_name", "p_brand")
    return table(spark, sf_dir, "part").select("p_partkey", name.alias("name"), X.abbreviate_name(name).alias("short"))


@query(
    "normalize_code",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN 'X' || o_orderstatus
      WHEN o_orderstatus = 'O' THEN 'Open' WHEN o_orderstatus = 'F' THEN 'Fulfilled' ELSE 'Pending' END AS label FROM orders""",
)
def normalize_code(spark, sf_dir):
    status = F.col("o_orderstatus")
    code = _spelled(F.col("o_orderkey") % 4, status, F.lower(status), status, F.concat(F.lit("X"), status))
    return table(spark, sf_dir, "orders").select("o_orderkey", X.normalise_code(code, STATUS_LABELS).alias("label"))


@query(
    "header_fields",
    f"""{with_parts(EVENTS)} SELECT source_id AS id, {sql_stamp("received_at")} AS event_timestamp, event_name FROM ev""",
)
def header_fields(spark, sf_dir):
    events = order_events(spark, sf_dir).select("id", "raw")
    doc = paths.with_document(events, "raw", paths.shape([X.TIME_PATH, X.NAME_PATH]))
    time, name = X.header_fields("doc")
    return doc.select("id", stamp(time).alias("event_timestamp"), name)


@query(
    "raw_repair",
    """SELECT n % 10 AS kind, count(*) AS n_events, count_if(k % 13 > 2) AS n_sound FROM (
      SELECT o_orderkey AS k, o_orderkey * 10 + 1 AS n FROM orders
      UNION ALL SELECT o_orderkey, o_orderkey * 10 + 2 FROM orders WHERE o_orderkey % 10 = 0
      UNION ALL SELECT o_orderkey, o_orderkey * 10 + 3 FROM orders WHERE o_orderstatus = 'F') GROUP BY 1""",
)
def raw_repair(spark, sf_dir):
    """Damaged texts, once mended, equal the texts they came from; those cut off or with more text after them cannot be mended."""
    sound = order_events(spark, sf_dir).select("id", "raw", F.col("raw").alias("sound"))
    mended = damaged(sound).select("id", "sound", X.repair_raw("raw").alias("mended"))
    return mended.groupBy((F.col("id") % 10).alias("kind")).agg(
        F.count(F.lit(1)).alias("n_events"), F.count_if(F.col("mended") == F.col("sound")).alias("n_sound")
    )


