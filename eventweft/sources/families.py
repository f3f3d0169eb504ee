"""Events of the other hospitality families, made from star tables: one landing row per event.

Each family is a list of event kinds over one frame of base rows. A kind has a number, a condition, an
event name and a body, all SQL texts over the base row; the event id is ten times the row's key plus the number.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweft.sources.corpus import table

_HOTEL = """named_struct('hotelId', n, 'hotelCode', concat('H', n), 'propertyCode', 'P', 'timeOffsetFromUTC', '+00:00',
  'propertyName', concat('Grand River ', if(n = 3, 'Test ', ''), n_name), 'brandCode', 'B', 'currencyCode', if(n % 7 <> 0, 'USD', NULL))"""
_STAY = f"'hotel', {_HOTEL}, 'arrivalDate', d0, 'departureDate', d2"
_UPDATED = "'reservationLastUpdateTimestamp', concat(d0, ' 10:00:00'), 'reservationLastUpdateOperatorId', concat('op', k % 5)"
_ROOM = "named_struct('startDate', d0, 'endDate', d2, 'roomNumber', k % 400)"
_STATUS = "named_struct('statusTimestamp', concat(d0, ' 11:00:00'), 'reservationStatus', 'INHOUSE', 'confirmationId', k)"
_NUMBERS = "array(named_struct('confirmationNumber', k, 'source', 'web'))"
_PERIOD = "'startDate', d0, 'endDate', d2"
_COMPANY = "named_struct('name', c_name, 'companyId', concat('C', c_custkey))"
_AGENT = "named_struct('name', 'Trips', 'agentIataId', concat('T', n))"

_MODIFY = f"""named_struct({_STAY}, {_UPDATED}, 'reservationId', k, 'marketSegment', c_mktsegment,
  'associations', array(named_struct('travelAgent', {_AGENT}, 'company', {_COMPANY})),
  'linkedReservations', array(named_struct('confirmationNumber', concat('L', k), 'source', 'desk')),
  'reservationCustomers', array(named_struct('customerIsVIP', if(k % 4 = 0, 'yes', 'no'), 'customer',
    named_struct('lastName', c_name, 'firstName', 'Ada'),
    'loyaltyRewardsMemberships', array(named_struct('loyaltyType', 'gold', 'loyaltyNumber', c_custkey)))),
  'reservationItems', array(named_struct({_PERIOD}, 'itemType', 'room', 'quantity', '1', 'adultCount', k % 4,
    'reservedInventories', array(named_struct({_PERIOD}, 'inventoryCode', concat('K', k % 9))),
    'reservedRates', array(named_struct({_PERIOD}, 'rateAmount', concat('$', k % 1000, '.5'), 'ratePlanCode', 'BAR', 'rateIsPackage', 'N')),
    'specialRequests', array(named_struct('code', 'CRIB', 'description', 'a crib', 'notes', c_name)))))"""
_CHECK_OUT = f"""named_struct({_STAY}, 'checkedOutRoom', {_ROOM}, 'reservationConfirmationNumbers', {_NUMBERS},
  'folioSummary', array(named_struct('transactionType', 'room', 'totalTransactionTypeAmount', concat(k % 1000, '.25')),
                        named_struct('transactionType', 'tax', 'totalTransactionTypeAmount', CAST(NULL AS STRING))),
  'group', named_struct('groupId', concat('G', k % 50), 'name', c_name,
    'confirmationNumbers', array(named_struct('confirmationNumber', concat('G', k), 'source', 'desk'))))"""
_ROOM_ASSIGNED = f"named_struct({_STAY}, {_UPDATED}, 'roomCondition', 'clean', 'reservedRoom', {_ROOM}, 'reservationStatus', {_STATUS})"
_ROOM_CHANGE = f"named_struct({_STAY}, {_UPDATED}, 'reservedRoom', {_ROOM}, 'reservationStatus', {_STATUS})"
_E_CHECK_IN = f"""named_struct('hotel', {_HOTEL}, 'guestLastName', c_name, 'eCheckInProcessed', 'Y', 'checkInReady', 'true',
  'roomCondition', 'clean', 'confirmationNumbers', {_NUMBERS})"""
_EMAIL = f"""named_struct('hotel', {_HOTEL}, {_UPDATED}, 'emailAddresses', array(concat('a', k, '@example.com'), concat('b', k, '@example.com')),
  'customer', named_struct('lastName', c_name, 'firstName', 'Ada', 'contacts',
    array(named_struct('contactIsPrimary', 'true', 'contactPurposes', array('home'), 'emailAddress', concat('c', k, '@example.com')))))"""

_GROUP = f"""'hotel', {_HOTEL}, 'groupId', concat('G', k), 'name', c_name, 'groupStayInfo', named_struct('arrivalDate', d0, 'departureDate', d2),
  'groupInfo', named_struct('groupLastUpdateTimestamp', concat(d0, ' 10:00:00'), 'isGroupWithCompany', 'yes', 'isElastic', 'no')"""
_ACCOUNT = "'statusTimestamp', concat(d0, ' 12:00:00'), 'status', 'open', 'operatorId', 'op1', 'confirmationNumber', concat('G', k)"
_GROUP_CREATE = f"""named_struct({_GROUP}, 'company', {_COMPANY}, 'travelagent', {_AGENT}, 'groupContact', named_struct('lastName', c_name),
  'confirmationNumbers', {_NUMBERS}, 'accountStatuses', array(named_struct({_ACCOUNT}, 'callerName', 'Ada')),
  'groupBlocks', array(named_struct('date', d0, 'inventoryCode', 'K1', 'quantity', k % 30, 'pickupQuantity', '1,000'),
                       named_struct('date', d2, 'inventoryCode', 'K2', 'quantity', k % 30, 'pickupQuantity', '2')),
  'groupRates', array(named_struct({_PERIOD}, 'inventoryType', 'K1', 'onePersonRate', concat(k % 100, '.5'), 'extraPersonRate', '12')),
  'paymentMethods', array(named_struct('folioId', k, 'folioName', 'main', 'paymentType', 'card')),
  'loyaltyRewardsMemberships', array(named_struct('loyaltyType', 'gold', 'loyaltyNumber', k)),
  'contacts', array(named_struct('emailAddress', concat('g', k, '@example.com'), 'contactPurposes', array('billing'))),
  'groupGuarantee', named_struct('groupPlannerGuarantee', named_struct('guaranteeType', 'card', 'depositDueAmount', '10',
      'creditCard', named_struct('cardType', 'V', 'lastFourDigits', k % 10000)),
    'guestGuarantee', named_struct('creditCard', named_struct('cardType', 'M', 'lastFourDigits', k % 10000))))"""
_GROUP_CANCEL = f"named_struct('group', named_struct({_GROUP}, 'cancelReason', 'storm', 'accountStatuses', array(named_struct({_ACCOUNT}))))"
_GROUP_CHECK_OUT = f"""named_struct('group', named_struct({_GROUP.replace("'isElastic', 'no'", "'isElastic', 'no', 'folioSummary', array(named_struct('transactionType', 'room', 'totalTransactionTypeAmount', k))")}))"""

_LIMITS = f"{_PERIOD}, 'inventoryCode', concat('K', k % 9), 'losMin', 2, 'limitToDaysOfWeek', named_struct('sunday', 'no', 'friday', 'yes')"


def _rate_list(change: str) -> str:
    told = f"'onePerson{change}', concat(k % 40, '.5'), 'baseRatePlan', 'BAR', 'baseOnePersonRate', 90" if change else "'onePersonRate', concat('$', k % 500)"
    return f"array(named_struct({_LIMITS}, {told}))"


_RATES = f"""named_struct('hotel', {_HOTEL}, 'isTaxInclusive', 'yes', 'ratePlanCodes', array(named_struct('ratePlanCode', concat('P', k % 20), 'isTaxInclusive', 'no')),
  'amountOffRates', {_rate_list("AmountOff")}, 'percentOffRates', {_rate_list("PercentOff")}, 'amountAboveRates', {_rate_list("AmountAbove")},
  'percentAboveRates', {_rate_list("PercentAbove")}, 'amountFixedRates', {_rate_list("")},
  'extraCharges', array(named_struct({_PERIOD}, 'extraChargeType', 'bed', 'rateAmount', k % 60)))"""

_STOCK = f"{_PERIOD}, 'inventoryCode', concat('K', k % 9), 'itemType', 'room'"
_BATCH = f"""named_struct('hotel', {_HOTEL}, 'inventories', transform(array(1, 2), x -> named_struct({_STOCK}, 'availableCount', x,
  'outOfOrderCount', 0, 'physicalCount', '1,200', 'soldCount', k % 7, 'groupPickUpCount', 0, 'overbookingLimit', if(k % 3 = 0 AND x = 2, NULL, 5))))"""
_UPDATE = f"""named_struct('hotel', {_HOTEL}, 'inventoryAvailableCounts', array(named_struct({_STOCK}, 'quantity', k % 50)),
  'inventoryOutOfOrderCounts', array(named_struct({_STOCK}, 'quantity', if(k % 3 = 0, NULL, 4))),
  'inventoryPhysicalCounts', array(named_struct({_STOCK}, 'quantity', 60), named_struct({_STOCK}, 'quantity', 61)))"""

_CLEANED = f"""named_struct('hotel', {_HOTEL}, 'roomNumber', k % 400, 'currentRoomCondition', 'clean', 'previousRoomCondition', if(k % 6 = 0, NULL, 'dirty'),
  'roomStatusUpdateTimestamp', concat(d0, ' 09:00:00'), 'roomStatusUpdateOperatorId', 'op2', 'checkInReady', 'Y', 'confirmationNumbers', {_NUMBERS})"""

_ENTRY = "'transactionCode', concat('t', k % 8), 'transactionDescription', 'night', 'transactionType', 'room'"
_FOLIO = f"""named_struct('hotel', {_HOTEL}, 'arrivalDate', d0, 'departureDate', d2, 'roomNumber', concat('R', k % 400), 'company', {_COMPANY},
  'personName', named_struct('lastName', c_name, 'firstName', 'Ada'), 'folioTransactions', transform(array(1, 2), x -> named_struct({_ENTRY},
    'transactionAmount', concat(x, '.005'), 'taxItem', 'no', 'transactionBusinessDate', d0, 'transactionActualDate', concat(d0, ' 0', x, ':00:00'),
    'folioId', k, 'isHotelViewOnly', 'no', 'fromAccountType', 'guest', 'toAccountNumber', x)))"""
_INVOICE = f"""named_struct('hotel', {_HOTEL}, 'company', {_COMPANY}, 'invoiceManualTransactions', array(named_struct({_ENTRY}, 'transactionAmount', k % 90)),
  'invoiceUpdateTransactions', array(named_struct({_ENTRY}, 'transactionAmount', '7', 'invoiceUpdateDate', d2, 'lastUpdateTimestamp', concat(d2, ' 06:00:00'))))"""

#: family -> base rows, and (number, condition, event name, name of the body, body)
FAMILIES = {
    "modify": ("orders", [(1, "k % 6 = 0", "'reservationModify'", "reservation", _MODIFY)]),
    "checkout": ("orders", [(2, "k % 6 = 1", "'reservationCheckOut'", "checkOut", _CHECK_OUT)]),
    "rooms": ("orders", [
        (3, "k % 6 = 2", "'reservationRoomAssigned'", "roomAssignment", _ROOM_ASSIGNED),
        (4, "k % 6 = 3", "'reservationRoomChange'", "roomChange", _ROOM_CHANGE),
    ]),
    "arrivals": ("orders", [
        (5, "k % 6 = 4", "'reservationECheckIn'", "eCheckIn", _E_CHECK_IN),
        (6, "k % 6 = 5", "'reservationEmailConfirmation'", "emailConfirmation", _EMAIL),
    ]),
    "groups": ("customer", [
        (1, "TRUE", "if(k % 4 = 0, 'groupModify', 'groupCreate')", "group", _GROUP_CREATE),
        (2, "k % 5 = 0", "'groupCancel'", "groupCancel", _GROUP_CANCEL),
        (3, "k % 3 = 0", "'groupCheckOut'", "groupCheckOut", _GROUP_CHECK_OUT),
    ]),
    "rates": ("part", [
        (n + 1, f"k % 4 = {n}", f"'{name}'", name, _RATES)
        for n, name in enumerate(("appliedRateUpdate", "discountRateUpdate", "fixedRateUpdate", "bestAvailableRateUpdate"))
    ]),
    "inventory": ("part", [
        (5, "TRUE", "'inventoryBatch'", "inventoryBatch", _BATCH),
        (6, "k % 2 = 0", "'inventoryUpdate'", "inventoryUpdate", _UPDATE),
    ]),
    "housekeeping": ("customer", [(4, "TRUE", "'housekeepingStatus'", "housekeepingStatus", _CLEANED)]),
    "folios": ("orders", [
        (7, "k % 3 = 0", "if(k % 2 = 0, 'folioGuestIncrementalUpdate', 'folioGuestCreate')", "folioGuestCreate", _FOLIO),
        (7, "k % 3 = 1", "if(k % 2 = 0, 'folioGroupIncrementalUpdate', 'folioGroupCreate')", "folioGroupCreate", _FOLIO),
        (7, "k % 3 = 2", "if(k % 2 = 0, 'folioHouseAccountIncrementalUpdate', 'folioHouseAccountCreate')", "folioHouseAccountCreate", _FOLIO),
        (8, "k % 5 = 0", "if(k % 2 = 0, 'invoiceIncrementalUpdate', 'invoiceCreate')", "invoiceCreate", _INVOICE),
    ]),
}


#: Rows whose documents one task makes and reads.
PART_ROWS = 20_000


def _base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Rows with a key k, a nation n (the hotel) and two days d0 and d2, dealt by the key: a small table lies in few
    files, yet its documents are a hundred times as large. The number of rows is read off the footers."""
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-table(spark, sf_dir, name).count() // PART_ROWS))
    nations, customers = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    if name == "orders":
        rows = table(spark, sf_dir, "orders").join(customers, F.expr("o_custkey = c_custkey"))
        key, nation, day = "o_orderkey", "c_nationkey", "CAST(o_orderdate AS DATE)"
    elif name == "customer":
        rows, key, nation, day = customers, "c_custkey", "c_nationkey", "date_add(DATE'2024-01-01', CAST(c_custkey % 300 AS INT))"
    else:
        rows, key, nation, day = table(spark, sf_dir, "part"), "p_partkey", "p_partkey % 25", "date_add(DATE'2024-01-01', CAST(p_partkey % 300 AS INT))"
    rows = rows.join(nations, F.expr(f"{nation} = n_nationkey")).repartition(parts, key)
    return rows.withColumns(
        {"k": F.col(key), "n": F.col("n_nationkey"), "d0": F.expr(f"date_format({day}, 'yyyy-MM-dd')"), "d2": F.expr(f"date_format(date_add({day}, 2), 'yyyy-MM-dd')")}
    )


def family_events(spark: SparkSession, sf_dir: str, family: str) -> DataFrame:
    base, kinds = FAMILIES[family]
    rows = _base(spark, sf_dir, base)
    header = "named_struct('timestamp', concat(d0, ' 08:07:19.000'))"
    return reduce(
        DataFrame.unionByName,
        [
            rows.filter(when).selectExpr(
                f"k * 10 + {number} AS id", "CAST(concat(d0, ' 08:07:19') AS TIMESTAMP) AS event_timestamp", f"{name} AS event_name",
                f"to_json(named_struct('messageHeader', {header}, 'recap', true, 'eventInfo', named_struct('name', {name}, 'version', '1.0'), '{at}', {body})) AS raw",
            )
            for number, when, name, at, body in kinds
        ],
    )
