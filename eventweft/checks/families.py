"""The hospitality families besides creation, check-in and cancellation: rows, ids, reasons and links of each.

A result row tells its table, event and id, some columns as one text, and whether the row is sound. A link tells both sides.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventweft.checks.registry import query, sql_id
from eventweft.models.hospitality import HOSPITALITY
from eventweft.operators import quality as Q
from eventweft.plans.run import open_batch
from eventweft.sources.families import family_events
from eventweft.spec import Link


def _told(family: str, entities: dict[str, str], *links: str):
    """All rows of the tables, columns as text, of one batch staged once."""

    def run(spark, sf_dir):
        part = HOSPITALITY.only(*entities, *links)
        batch = open_batch(family_events(spark, sf_dir, family), part, stage=True)
        parts = []
        for name in (*entities, *links):
            t = HOSPITALITY.table(name)
            columns = [t.left_column, t.right_column] if isinstance(t, Link) else entities[name].split()
            texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
            parts.append(batch.all_rows(name).select(
                F.lit(name).alias("table_name"), "source_id", "id", F.concat_ws("|", *texts).alias("told"), Q.passes().alias("valid")
            ))
        return reduce(DataFrame.unionByName, parts)

    return run


# The same in SQL. Base rows have the key k, the hotel's number n and id hid (NULL if the hotel fails), days d0 and d2.

_HID = f"n.n_nationkey AS n, n_name, CASE WHEN n.n_nationkey % 7 <> 0 AND n.n_nationkey <> 3 THEN {sql_id('n.n_nationkey', "'H' || n.n_nationkey")} END AS hid"
_DAYS = "strftime({0}, '%Y-%m-%d') AS d0, strftime(CAST({0} AS TIMESTAMP) + INTERVAL 2 DAY, '%Y-%m-%d') AS d2"
_FROM_KEY = _DAYS.format("(TIMESTAMP '2024-01-01' + INTERVAL ({0} % 300) DAY)")
_BASES = {
    "orders": f"SELECT o_orderkey AS k, c.*, {_HID}, {_DAYS.format('o_orderdate')} FROM orders JOIN customer c ON o_custkey = c_custkey JOIN nation n ON c_nationkey = n_nationkey",
    "customer": f"SELECT c_custkey AS k, c.*, {_HID}, {_FROM_KEY.format('c_custkey')} FROM customer c JOIN nation n ON c_nationkey = n_nationkey",
    "part": f"SELECT p_partkey AS k, {_HID}, {_FROM_KEY.format('p_partkey')} FROM part JOIN nation n ON p_partkey % 25 = n_nationkey",
}


def _rows(table: str, source: str, key: list[str], told: list[str], valid: str = "TRUE") -> str:
    texts = ", ".join(f"coalesce(CAST({t} AS VARCHAR), '')" for t in told)
    return f"SELECT '{table}' AS table_name, source_id, {sql_id(*key)} AS id, concat_ws('|', {texts}) AS told, {valid} AS valid FROM {source}"


def _pairs(link: str, source: str, left: str, right: str) -> str:
    return _rows(link, source, [left, right], [left, right])


def _answer(base: str, steps: dict[str, str], *parts: str) -> str:
    named = {"b": _BASES[base], **steps}
    return "WITH " + ", ".join(f"{name} AS ({sql})" for name, sql in named.items()) + " " + " UNION ALL ".join(parts)


def _money(value: str, kind: str = "DECIMAL(12,2)") -> str:
    return f"CAST({value} AS {kind})"


_AGENT, _COMPANY = sql_id("'T' || n", "'Trips'"), sql_id("'C' || c_custkey", "c_name")
_ROOM, _NUMBER = sql_id("d0", "d2", "k % 400"), sql_id("k", "'web'")
_AT_10, _AT_11 = "d0 || ' 10:00:00'", "d0 || ' 11:00:00'"
_SOUND = "hid IS NOT NULL"

# reservationModify, through the alias of reservationCreate
_AMOUNT = _money("(k % 1000) || '.5'")
_modify = _answer(
    "orders",
    {
        "e": f"""SELECT *, k * 10 + 1 AS source_id, {sql_id("k", "hid", "'reservationModify'", "d0", "d2", _AT_10, _COMPANY, _AGENT)} AS rid,
          {sql_id("d0", "d2", "'room'", "1", "k % 4")} AS iid, {sql_id("c_name", "'Ada'", "k % 4 = 0")} AS gid FROM b WHERE k % 6 = 0""",
    },
    _rows("reservation", "e", ["k", "hid", "'reservationModify'", "d0", "d2", _AT_10, _COMPANY, _AGENT],
          ["k", "c_mktsegment", "hid", _COMPANY, _AGENT, "'op' || (k % 5)"], _SOUND),
    _rows("reservationItem", "e", ["d0", "d2", "'room'", "1", "k % 4"], ["d0", "d2", "k % 4"]),
    _rows("reservedInventory", "e", ["d0", "d2", "'K' || (k % 9)"], ["'K' || (k % 9)"]),
    _rows("reservedRate", "e", ["d0", "d2", "'BAR'", _AMOUNT, "FALSE"], [_AMOUNT, "'BAR'", "FALSE"]),
    _rows("specialRequest", "e", ["'CRIB'", "'a crib'"], ["c_name"]),
    _rows("travelAgent", "e", ["'T' || n", "'Trips'"], ["'Trips'"]),
    _rows("company", "e", ["'C' || c_custkey", "c_name"], ["c_name"]),
    _rows("linkedReservation", "e", ["'L' || k", "'desk'"], ["'L' || k"]),
    _rows("customer", "e", ["c_name", "'Ada'", "k % 4 = 0"], ["c_name", "k % 4 = 0"]),
    _rows("loyaltyRewardsMembership", "e", ["c_custkey", "'gold'"], ["c_custkey", "'gold'"]),
    _pairs("reservationItemLink", f"e WHERE {_SOUND}", "rid", "iid"),
    _pairs("reservationLinkedReservationLink", f"e WHERE {_SOUND}", "rid", sql_id("'L' || k", "'desk'")),
    _pairs("reservationCustomerLink", f"e WHERE {_SOUND}", "rid", "gid"),
    _pairs("reservationItemReservedInventoryLink", "e", "iid", sql_id("d0", "d2", "'K' || (k % 9)")),
    _pairs("reservationItemReservedRateLink", "e", "iid", sql_id("d0", "d2", "'BAR'", _AMOUNT, "FALSE")),
    _pairs("reservationItemSpecialRequestLink", "e", "iid", sql_id("'CRIB'", "'a crib'")),
    _pairs("customerLoyaltyRewardsMembershipLink", "e", "gid", sql_id("c_custkey", "'gold'")),
)
query("stays_modify", _modify)(_told(
    "modify",
    {
        "reservation": "reservationId marketSegment hotels_id associations_company_id associations_travelAgent_id reservationLastUpdateOperatorId",
        "reservationItem": "startDate endDate adultCount", "reservedInventory": "inventoryCode", "reservedRate": "rateAmount ratePlanCode rateIsPackage",
        "specialRequest": "notes", "travelAgent": "name", "company": "name", "linkedReservation": "confirmationNumber",
        "customer": "lastName customerIsVIP", "loyaltyRewardsMembership": "loyaltyNumber loyaltyType",
    },
    "reservationItemLink", "reservationLinkedReservationLink", "reservationCustomerLink", "reservationItemReservedInventoryLink",
    "reservationItemReservedRateLink", "reservationItemSpecialRequestLink", "customerLoyaltyRewardsMembershipLink",
))

_TOTAL = _money("(k % 1000) || '.25'")
_checkout = _answer(
    "orders",
    {
        "e": f"""SELECT *, k * 10 + 2 AS source_id, {sql_id("hid", "'reservationCheckOut'", "d0", "d2", _ROOM)} AS rid,
          {sql_id("'G' || (k % 50)", "hid", "c_name")} AS gid, {sql_id("'room'", _TOTAL)} AS sid FROM b WHERE k % 6 = 1""",
    },
    _rows("reservation", "e", ["hid", "'reservationCheckOut'", "d0", "d2", _ROOM], [_ROOM, "d0", "d2"], _SOUND),
    _rows("reservedRoom", "e", ["d0", "d2", "k % 400"], ["k % 400"]),
    _rows("folioSummary", "e", ["'room'", _TOTAL], ["'room'", _TOTAL]),
    _rows("folioSummary", "e", ["'tax'"], ["'tax'", "NULL"], "FALSE"),
    _rows("group", "e", ["'G' || (k % 50)", "hid", "c_name"], ["'G' || (k % 50)", "c_name", "hid"]),
    _rows("confirmationNumber", "e", ["k", "'web'"], ["k"]),
    _rows("confirmationNumber", "e", ["'G' || k", "'desk'"], ["'G' || k"]),
    _pairs("reservationFolioSummaryLink", f"e WHERE {_SOUND}", "rid", "sid"),
    _pairs("groupFolioSummaryLink", "e", "gid", "sid"),
    _pairs("groupConfirmationNumberLink", "e", "gid", _NUMBER),
    _pairs("groupConfirmationNumberLink", "e", "gid", sql_id("'G' || k", "'desk'")),
)
query("stays_checkout", _checkout)(_told(
    "checkout",
    {
        "reservation": "reservedRoom arrivalDate departureDate", "reservedRoom": "roomNumber", "folioSummary": "transactionType totalTransactionTypeAmount",
        "group": "groupId name hotel_id", "confirmationNumber": "confirmationNumber",
    },
    "reservationFolioSummaryLink", "groupFolioSummaryLink", "groupConfirmationNumberLink",
))

_EVENT = "CASE WHEN k % 6 = 2 THEN 'reservationRoomAssigned' ELSE 'reservationRoomChange' END"
_rooms = _answer(
    "orders",
    {"e": f"SELECT *, k * 10 + k % 6 + 1 AS source_id, {sql_id('hid', _EVENT, 'd0', 'd2', _AT_10, _ROOM)} AS rid FROM b WHERE k % 6 IN (2, 3)"},
    _rows("reservation", "e", ["hid", _EVENT, "d0", "d2", _AT_10, _ROOM], ["CASE WHEN k % 6 = 2 THEN 'clean' END", "'op' || (k % 5)", _ROOM], _SOUND),
    _rows("reservedRoom", "e", ["d0", "d2", "k % 400"], ["d0", "d2", "k % 400"]),
    _rows("reservationStatus", "e", [_AT_11, "'INHOUSE'", "k"], [_AT_11, "'In House'", "k"]),
    _pairs("reservationStatusLink", f"e WHERE {_SOUND}", "rid", sql_id(_AT_11, "'INHOUSE'", "k")),
)
query("stays_rooms", _rooms)(_told(
    "rooms",
    {
        "reservation": "roomCondition reservationLastUpdateOperatorId reservedRoom", "reservedRoom": "startDate endDate roomNumber",
        "reservationStatus": "statusTimestamp reservationStatus confirmationId",
    },
    "reservationStatusLink",
))

_MAIL = "'c' || k || '@example.com'"
_arrivals = _answer(
    "orders",
    {
        "e": "SELECT *, k * 10 + 5 AS source_id FROM b WHERE k % 6 = 4",
        "m": f"""SELECT *, k * 10 + 6 AS source_id, {sql_id("hid", "'reservationEmailConfirmation'", _AT_10)} AS rid, {sql_id("c_name", "'Ada'")} AS gid
          FROM b WHERE k % 6 = 5""",
        "a": f"""SELECT *, {sql_id(_MAIL, "TRUE")} AS cid FROM m UNION ALL SELECT *, {sql_id("'a' || k || '@example.com'")} FROM m
          UNION ALL SELECT *, {sql_id("'b' || k || '@example.com'")} FROM m""",
    },
    _rows("reservation", "e", ["hid", "'reservationECheckIn'"], ["c_name", "TRUE", "'clean'", "NULL"], _SOUND),
    _rows("reservation", "m", ["hid", "'reservationEmailConfirmation'", _AT_10], ["NULL", "NULL", "NULL", "'op' || (k % 5)"], _SOUND),
    _rows("confirmationNumber", "e", ["k", "'web'"], ["k"]),
    _rows("housekeepingStatus", "e", ["hid", "TRUE"], ["hid", "TRUE"], "FALSE"),
    _rows("customer", "m", ["c_name", "'Ada'"], ["c_name"]),
    _rows("contact", "m", [_MAIL, "TRUE"], [_MAIL, "TRUE"]),
    _rows("contact", "m", ["'a' || k || '@example.com'"], ["'a' || k || '@example.com'", "NULL"]),
    _rows("contact", "m", ["'b' || k || '@example.com'"], ["'b' || k || '@example.com'", "NULL"]),
    _rows("contactPurpose", "m", ["'home'"], ["'home'"]),
    _pairs("reservationEmailAddressLink", f"a WHERE {_SOUND}", "rid", "cid"),
    _pairs("customerContactLink", "a", "gid", "cid"),
    _pairs("contactContactPurposeLink", "a", "cid", sql_id("'home'")),
    _pairs("reservationConfirmationNumberLink", f"e WHERE {_SOUND}", sql_id("hid", "'reservationECheckIn'"), _NUMBER),
)
query("stays_arrivals", _arrivals)(_told(
    "arrivals",
    {
        "reservation": "eCheckIn_guestLastName eCheckIn_eCheckInProcessed roomCondition reservationLastUpdateOperatorId",
        "confirmationNumber": "confirmationNumber", "housekeepingStatus": "hotel_id checkInReady", "customer": "lastName",
        "contact": "emailAddress contactIsPrimary", "contactPurpose": "purpose",
    },
    "reservationEmailAddressLink", "customerContactLink", "contactContactPurposeLink", "reservationConfirmationNumberLink",
))

_GROUP_EVENT = "CASE WHEN k % 4 = 0 THEN 'groupModify' ELSE 'groupCreate' END"
_CREATED = ["'G' || k", "hid", "c_name", _GROUP_EVENT, _AT_10, "TRUE", "FALSE", "c_name"]
_ENDED = lambda event, *more: ["'G' || k", "hid", "c_name", event, _AT_10, "TRUE", *more]
_ACCOUNT = ["d0 || ' 12:00:00'", "'open'", "'op1'", "'G' || k"]
_RATE_1 = _money("(k % 100) || '.5'")
_BLOCKS = [["d0", "'K1'", "k % 30"], ["d2", "'K2'", "k % 30"]]
_groups = _answer(
    "customer",
    {
        "g": f"SELECT *, k * 10 + 1 AS source_id, {sql_id(*_CREATED)} AS gid FROM b",
        "x": f"SELECT *, k * 10 + 2 AS source_id, {sql_id(*_ENDED("NULL", "'storm'"))} AS gid FROM b WHERE k % 5 = 0",
        "o": f"SELECT *, k * 10 + 3 AS source_id, {sql_id(*_ENDED("NULL"))} AS gid FROM b WHERE k % 3 = 0",
    },
    _rows("group", "g", _CREATED, ["'G' || k", "hid", _COMPANY, _AGENT, "d0", "d2", "10.00", "NULL", "FALSE"]),
    _rows("group", "x", _ENDED("NULL", "'storm'"), ["'G' || k", "hid", "NULL", "NULL", "d0", "d2", "NULL", "'storm'", "NULL"]),
    _rows("group", "o", _ENDED("NULL"), ["'G' || k", "hid", "NULL", "NULL", "d0", "d2", "NULL", "NULL", "NULL"]),
    _rows("accountStatus", "g", _ACCOUNT, ["'open'", "'Ada'"]),
    _rows("accountStatus", "x", _ACCOUNT, ["'open'", "NULL"]),
    _rows("groupBlock", "g", _BLOCKS[0], ["k % 30", "1000"]),
    _rows("groupBlock", "g", _BLOCKS[1], ["k % 30", "2"]),
    _rows("groupRate", "g", ["d0", "d2", "'K1'", _RATE_1, "12.00"], [_RATE_1, "12.00"]),
    _rows("paymentMethod", "g", ["k", "'main'", "'card'"], ["'main'"]),
    _rows("creditCard", "g", ["'V'", "k % 10000"], ["'V'"]),
    _rows("creditCard", "g", ["'M'", "k % 10000"], ["'M'"]),
    _rows("folioSummary", "o", ["'room'", _money("k")], [_money("k")]),
    *[_pairs("groupGroupBlockLink", "g", "gid", sql_id(*key)) for key in _BLOCKS],
    _pairs("groupGroupRateLink", "g", "gid", sql_id("d0", "d2", "'K1'", _RATE_1, "12.00")),
    _pairs("groupAccountStatusLink", "g", "gid", sql_id(*_ACCOUNT)),
    _pairs("groupAccountStatusLink", "x", "gid", sql_id(*_ACCOUNT)),
    _pairs("groupPaymentMethodLink", "g", "gid", sql_id("k", "'main'", "'card'")),
    _pairs("groupLoyaltyRewardsMembershipLink", "g", "gid", sql_id("k", "'gold'")),
    _pairs("groupContactLink", "g", "gid", sql_id("'g' || k || '@example.com'")),
    *[_pairs(link, "g", "gid", sql_id(card, "k % 10000")) for link in ("groupPlannerCreditCardLink", "groupGuestCreditCardLink") for card in ("'V'", "'M'")],
)
query("stays_groups", _groups)(_told(
    "groups",
    {
        "group": "groupId hotel_id company_id travelagent_id groupStayInfo_arrivalDate groupStayInfo_departureDate "
        "groupGuarantee_groupPlannerGuarantee_depositDueAmount cancelReason groupInfo_isElastic",
        "accountStatus": "status callerName", "groupBlock": "quantity pickupQuantity", "groupRate": "onePersonRate extrapersonRate",
        "paymentMethod": "folioName", "creditCard": "cardType", "folioSummary": "totalTransactionTypeAmount",
    },
    "groupGroupBlockLink", "groupGroupRateLink", "groupAccountStatusLink", "groupPaymentMethodLink", "groupLoyaltyRewardsMembershipLink",
    "groupContactLink", "groupPlannerCreditCardLink", "groupGuestCreditCardLink",
))

_RATE_EVENT = "['appliedRateUpdate', 'discountRateUpdate', 'fixedRateUpdate', 'bestAvailableRateUpdate'][k % 4 + 1]"
_RATE = ["hid", _RATE_EVENT, "d0 || ' 08:07:19'", "TRUE", "CASE WHEN k % 4 = 3 THEN TRUE END"]
_LISTS = {"amountOffRate": "DECIMAL(12,2)", "percentOffRate": "DECIMAL(5,2)", "amountAboveRate": "DECIMAL(12,2)", "percentAboveRate": "DECIMAL(5,2)"}
_LIST_KEYS = {
    name: ["d0", "d2", "'K' || (k % 9)", "'BAR'", "2", _money("(k % 40) || '.5'", kind), "90.00", "FALSE", "TRUE"] for name, kind in _LISTS.items()
} | {"amountFixedRate": ["d0", "d2", "'K' || (k % 9)", "2", _money("k % 500"), "FALSE", "TRUE"]}
_CHARGE = ["d0", "d2", "'bed'"]
_link = lambda name: f"rate{name[0].upper()}{name[1:]}Link"
_rates = _answer(
    "part",
    {"e": f"SELECT *, k * 10 + k % 4 + 1 AS source_id, {sql_id(*_RATE)} AS rid FROM b"},
    _rows("rate", "e", _RATE, ["hid", "TRUE", _RATE[-1]], _SOUND),
    _rows("ratePlanCode", "e", ["'P' || (k % 20)", "FALSE"], ["'P' || (k % 20)"]),
    *[_rows(name, "e", key, ["2", key[-3] if name == "amountFixedRate" else key[5], "FALSE"]) for name, key in _LIST_KEYS.items()],
    _rows("extraCharge", "e", _CHARGE, ["NULL", "'bed'", _money("k % 60")]),
    *[_pairs(_link(name), f"e WHERE {_SOUND}", "rid", sql_id(*key)) for name, key in _LIST_KEYS.items()],
    _pairs("rateRatePlanCodeLink", f"e WHERE {_SOUND}", "rid", sql_id("'P' || (k % 20)", "FALSE")),
    _pairs("rateExtraChargeLink", f"e WHERE {_SOUND}", "rid", sql_id(*_CHARGE)),
)
query("stays_rates", _rates)(_told(
    "rates",
    {
        "rate": "hotel_id recap isTaxInclusive", "ratePlanCode": "ratePlanCode",
        "amountOffRate": "losMin onePersonAmountOff limitToDaysOfWeek_sunday", "percentOffRate": "losMin onePersonPercentOff limitToDaysOfWeek_sunday",
        "amountAboveRate": "losMin onePersonAmountAbove limitToDaysOfWeek_sunday", "percentAboveRate": "losMin onePersonPercentAbove limitToDaysOfWeek_sunday",
        "amountFixedRate": "losMin onePersonRate limitToDaysOfWeek_sunday", "extraCharge": "rate_id extraChargeType rateAmount",
    },
    *[_link(name) for name in _LIST_KEYS], "rateRatePlanCodeLink", "rateExtraChargeLink",
))

_STOCK = ["hid", "d0", "d2", "'K' || (k % 9)", "'room'"]
_LIMIT = "CASE WHEN k % 3 = 0 AND x = 2 THEN NULL ELSE 5 END"
_OUT = "CASE WHEN k % 3 <> 0 THEN 4 END"
_inventory = _answer(
    "part",
    {
        "e": "SELECT b.*, x, k * 10 + 5 AS source_id FROM b, (VALUES (1), (2)) v(x)",
        "u": "SELECT *, k * 10 + 6 AS source_id FROM b WHERE k % 2 = 0",
    },
    _rows("inventoryBatch", "e", [*_STOCK, "x", "0", "1200", "k % 7", "0", _LIMIT], ["hid", "x", "1200", "k % 7", _LIMIT], f"{_SOUND} AND ({_LIMIT}) IS NOT NULL"),
    _rows("inventoryAvailableCount", "u", [*_STOCK, "k % 50"], ["hid", "k % 50"], _SOUND),
    _rows("inventoryOutOfOrderCount", "u", [*_STOCK, _OUT], ["hid", _OUT], f"{_SOUND} AND k % 3 <> 0"),
    _rows("inventoryPhysicalCount", "u", [*_STOCK, "60"], ["hid", "60"], _SOUND),
    _rows("inventoryPhysicalCount", "u", [*_STOCK, "61"], ["hid", "61"], _SOUND),
)
query("stays_inventory", _inventory)(_told(
    "inventory",
    {
        "inventoryBatch": "hotel_id availableCount physicalCount soldCount overbookingLimit", "inventoryAvailableCount": "hotel_id quantity",
        "inventoryOutOfOrderCount": "hotel_id quantity", "inventoryPhysicalCount": "hotel_id quantity",
    },
))

_BEFORE = "CASE WHEN k % 6 <> 0 THEN 'dirty' END"
_CLEANED = ["hid", "k % 400", "d0 || ' 09:00:00'", "'op2'", "'clean'", _BEFORE, "TRUE"]
_housekeeping = _answer(
    "customer",
    {"e": f"SELECT *, k * 10 + 4 AS source_id, {_SOUND} AND k % 6 <> 0 AS sound FROM b"},
    _rows("housekeepingStatus", "e", _CLEANED, ["hid", "k % 400", _BEFORE, "TRUE"], "sound"),
    _rows("confirmationNumber", "e", ["k", "'web'"], ["k"]),
    _pairs("housekeepingStatusConfirmationNumberLink", "e WHERE sound", sql_id(*_CLEANED), _NUMBER),
)
query("stays_housekeeping", _housekeeping)(_told(
    "housekeeping",
    {"housekeepingStatus": "hotel_id roomNumber previousRoomCondition checkInReady", "confirmationNumber": "confirmationNumber"},
    "housekeepingStatusConfirmationNumberLink",
))

_PAID = "CASE x WHEN 1 THEN 1.01 ELSE 2.01 END"
_ENTRY = ["d0 || ' 0' || x || ':00:00'", "d0", "'t' || (k % 8)", "'room'", "k", _PAID, "FALSE"]
_MANUAL = ["'t' || (k % 8)", "'room'", _money("k % 90")]
_CHANGED = ["d2 || ' 06:00:00'", "d2", "'t' || (k % 8)", "'room'", "7.00"]
_folios = _answer(
    "orders",
    {
        "f": "SELECT *, k * 10 + 7 AS source_id FROM b",
        "t": "SELECT f.*, x FROM f, (VALUES (1), (2)) v(x)",
        "i": "SELECT *, k * 10 + 8 AS source_id FROM b WHERE k % 5 = 0",
    },
    _rows("folioItem", "t", _ENTRY, ["d0", _PAID, "k", "FALSE", "'guest'", "x"]),
    _rows("folioItem", "i", _MANUAL, ["NULL", _MANUAL[2], "NULL", "NULL", "NULL", "NULL"]),
    _rows("folioItem", "i", _CHANGED, ["d2", "7.00", "NULL", "NULL", "NULL", "NULL"]),
    _rows("company", "f", ["'C' || c_custkey", "c_name"], ["c_name"]),
    _rows("company", "i", ["'C' || c_custkey", "c_name"], ["c_name"]),
    _rows("customer", "f WHERE k % 3 = 0", ["c_name", "'Ada'"], ["c_name"]),
    _rows("group", "f WHERE k % 3 = 1", ["hid"], ["hid", _COMPANY, "d0"]),
    _rows("reservation", "f WHERE k % 3 = 0", ["hid", "d0", "d2", "'R' || (k % 400)", _COMPANY], ["hid", _COMPANY, "'R' || (k % 400)"], _SOUND),
    _pairs("groupFolioItemLink", "t WHERE k % 3 = 1", sql_id("hid"), sql_id(*_ENTRY)),
)
query("stays_folios", _folios)(_told(
    "folios",
    {
        "folioItem": "transactionBusinessDate transactionAmount folioId isHotelViewOnly fromAccountTransfer_accountType toAccountTransfer_account",
        "company": "name", "customer": "lastName", "group": "hotel_id company_id groupStayInfo_arrivalDate",
        "reservation": "hotels_id associations_company_id reservedRoom",
    },
    "groupFolioItemLink",
))
