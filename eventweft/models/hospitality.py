"""A model of hotel reservation, group, rate, inventory, housekeeping and folio events.

Fixed values: table, column, key and event names and document paths, as the events define them.
"""

from __future__ import annotations

from collections.abc import Mapping

from eventweft.functions.text import abbreviate_name, normalise_code
from eventweft.spec import Column, Entity, ForeignKey, Link, Model, Reject, Source


def below(places: Mapping[str, str], *columns: str) -> list[Source]:
    """The same columns from rows of several event types; ``a_b`` lies at ``a.b`` below the row."""
    return [Source(event, rows, {c: f"{rows}.{c.replace('_', '.')}" for c in columns}) for event, rows in places.items()]


ALIASES = {
    "reservationModify": "reservationCreate",
    "groupModify": "groupCreate",
    "folioGuestIncrementalUpdate": "folioGuestCreate",
    "folioGroupIncrementalUpdate": "folioGroupCreate",
    "folioHouseAccountIncrementalUpdate": "folioHouseAccountCreate",
    "invoiceIncrementalUpdate": "invoiceCreate",
}

STATUS_LABELS = {
    "inhouse": "In House",
    "cancelled": "Cancelled",
    "checkedout": "Checked Out",
    "noshowed": "No Showed",
    "reserved": "Reserved",
}

HOTEL = Entity(
    "hotel",
    (
        Column("hotelId", required=True), Column("hotelCode", required=True), Column("propertyCode", required=True),
        Column("timeOffsetFromUTC", required=True), Column("propertyName", required=True),
        Column("brandCode", required=True), Column("currencyCode", required=True), Column("propertyName_abbrev"),
    ),
    key=("hotelId", "hotelCode"),
    sources=(
        *below(
            {
                "reservationCreate": "reservation.hotel", "reservationCancel": "cancellation.hotel",
                "reservationCheckIn": "checkIn.hotel", "reservationCheckOut": "checkOut.hotel",
                "reservationRoomAssigned": "roomAssignment.hotel", "reservationRoomChange": "roomChange.hotel",
                "reservationECheckIn": "eCheckIn.hotel", "reservationEmailConfirmation": "emailConfirmation.hotel",
                "groupCreate": "group.hotel", "groupCancel": "groupCancel.group.hotel",
                "groupCheckOut": "groupCheckOut.group.hotel", "appliedRateUpdate": "appliedRateUpdate.hotel",
                "discountRateUpdate": "discountRateUpdate.hotel", "fixedRateUpdate": "fixedRateUpdate.hotel",
                "bestAvailableRateUpdate": "bestAvailableRateUpdate.hotel", "inventoryBatch": "inventoryBatch.hotel",
                "inventoryUpdate": "inventoryUpdate.hotel", "housekeepingStatus": "housekeepingStatus.hotel",
                "folioGuestCreate": "folioGuestCreate.hotel", "folioGroupCreate": "folioGroupCreate.hotel",
                "folioHouseAccountCreate": "folioHouseAccountCreate.hotel", "invoiceCreate": "invoiceCreate.hotel",
            },
            "hotelId", "hotelCode", "propertyCode", "timeOffsetFromUTC", "propertyName", "brandCode", "currencyCode",
        ),
    ),
    rejects=(Reject("propertyName", "test"),),
    derived={"propertyName_abbrev": ("propertyName", abbreviate_name)},
)

CONFIRMATION_NUMBER = Entity(
    "confirmationNumber",
    (
        Column("confirmationNumber", required=True), Column("source", required=True), Column("import_source"),
        Column("import_batch_id"),
    ),
    key=("confirmationNumber", "source"),
    sources=(
        *below(
            {
                "reservationCreate": "reservation.reservationConfirmationNumbers[]",
                "reservationCancel": "cancellation.reservationConfirmationNumbers[]",
                "reservationCheckIn": "checkIn.reservationConfirmationNumbers[]",
                "reservationCheckOut": "checkOut.reservationConfirmationNumbers[]",
                "reservationRoomAssigned": "roomAssignment.reservationConfirmationNumbers[]",
                "reservationRoomChange": "roomChange.reservationConfirmationNumbers[]",
                "reservationEmailConfirmation": "emailConfirmation.reservationConfirmationNumbers[]",
                "reservationECheckIn": "eCheckIn.confirmationNumbers[]",
            },
            "confirmationNumber", "source",
        ),
        *below(
            {
                "reservationCheckOut": "checkOut.group.confirmationNumbers[]",
                "groupCreate": "group.confirmationNumbers[]",
                "groupCancel": "groupCancel.group.confirmationNumbers[]",
                "groupCheckOut": "groupCheckOut.group.confirmationNumbers[]",
                "housekeepingStatus": "housekeepingStatus.confirmationNumbers[]",
            },
            "confirmationNumber", "source",
        ),
    ),
)

RESERVATION_STATUS = Entity(
    "reservationStatus",
    (
        Column("statusTimestamp", "timestamp", True), Column("reservationStatus", required=True),
        Column("operatorId"), Column("confirmationId", "int"), Column("callerName"), Column("import_source"),
        Column("import_batch_id"),
    ),
    key=("statusTimestamp", "reservationStatus", "confirmationId"),
    sources=(
        *below(
            {
                "reservationCreate": "reservation.reservationStatuses[]",
                "reservationCheckIn": "checkIn.reservationStatus",
                "reservationCheckOut": "checkOut.reservationStatus",
                "reservationRoomAssigned": "roomAssignment.reservationStatus",
                "reservationRoomChange": "roomChange.reservationStatus",
                "reservationECheckIn": "eCheckIn.reservationStatus",
            },
            "statusTimestamp", "reservationStatus", "operatorId", "confirmationId", "callerName",
        ),
    ),
    time_column="statusTimestamp",
    derived={"reservationStatus": ("reservationStatus", lambda code: normalise_code(code, STATUS_LABELS))},
)

CUSTOMER = Entity(
    "customer",
    (
        Column("customerIsPrimary", "boolean"), Column("title"), Column("lastName", required=True),
        Column("firstName", required=True), Column("middleName"), Column("languagePreference"),
        Column("customerIsSharing", "boolean"), Column("customerHasTaxExemption", "boolean"),
        Column("customerIsVIP", "boolean"), Column("import_source"), Column("import_batch_id"),
    ),
    key=(
        "lastName", "firstName", "customerIsPrimary", "customerIsSharing", "customerHasTaxExemption", "customerIsVIP",
    ),
    sources=(
        Source(
            "reservationCreate",
            "reservation.reservationCustomers[]",
            {
                "customerIsPrimary": "reservation.reservationCustomers[].customerIsPrimary",
                "title": "reservation.reservationCustomers[].customer.title",
                "lastName": "reservation.reservationCustomers[].customer.lastName",
                "firstName": "reservation.reservationCustomers[].customer.firstName",
                "middleName": "reservation.reservationCustomers[].customer.middleName",
                "languagePreference": "reservation.reservationCustomers[].customer.languagePreference",
                "customerIsSharing": "reservation.reservationCustomers[].customerIsSharing",
                "customerHasTaxExemption": "reservation.reservationCustomers[].customerHasTaxExemption",
                "customerIsVIP": "reservation.reservationCustomers[].customerIsVIP",
            },
        ),
        *below(
            {
                "reservationCancel": "cancellation.customer", "reservationCheckIn": "checkIn.customer",
                "reservationCheckOut": "checkOut.customer", "reservationRoomAssigned": "roomAssignment.customer",
                "reservationRoomChange": "roomChange.customer",
                "reservationEmailConfirmation": "emailConfirmation.customer",
            },
            "lastName", "firstName", "languagePreference",
        ),
        *below(
            {
                "folioGuestCreate": "folioGuestCreate.personName",
            },
            "lastName", "firstName",
        ),
    ),
)

CONTACT = Entity(
    "contact",
    (
        Column("contactIsPrimary", "boolean"), Column("postalAddress_addressLine1"),
        Column("postalAddress_addressLine2"), Column("postalAddress_addressLine3"), Column("postalAddress_city"),
        Column("postalAddress_state"), Column("postalAddress_postalCode"), Column("postalAddress_county"),
        Column("postalAddress_country"), Column("telephoneNumber_type"), Column("telephoneNumber_number"),
        Column("emailAddress"), Column("optedIn", "boolean"), Column("import_source"), Column("import_batch_id"),
    ),
    key=(
        "emailAddress", "telephoneNumber_number", "postalAddress_postalCode", "contactIsPrimary",
        "postalAddress_addressLine1", "postalAddress_addressLine2", "postalAddress_addressLine3",
    ),
    sources=(
        *below(
            {
                "reservationCreate": "reservation.reservationCustomers[].customer.contacts[]",
                "reservationCancel": "cancellation.customer.contacts[]",
                "reservationCheckIn": "checkIn.customer.contacts[]",
                "reservationCheckOut": "checkOut.customer.contacts[]",
                "reservationRoomAssigned": "roomAssignment.customer.contacts[]",
                "reservationRoomChange": "roomChange.customer.contacts[]",
                "reservationEmailConfirmation": "emailConfirmation.customer.contacts[]",
                "groupCreate": "group.contacts[]",
            },
            "contactIsPrimary", "postalAddress_addressLine1", "postalAddress_addressLine2",
            "postalAddress_addressLine3", "postalAddress_city", "postalAddress_state", "postalAddress_postalCode",
            "postalAddress_county", "postalAddress_country", "telephoneNumber_type", "telephoneNumber_number",
            "emailAddress",
        ),
        Source(
            "reservationEmailConfirmation",
            "emailConfirmation.emailAddresses[]",
            {
                "emailAddress": "emailConfirmation.emailAddresses[]",
            },
        ),
    ),
)

CONTACT_PURPOSE = Entity(
    "contactPurpose",
    (
        Column("purpose", required=True),
    ),
    key=("purpose",),
    sources=(
        Source(
            "reservationCreate",
            "reservation.reservationCustomers[].customer.contacts[]",
            {
                "purpose": "reservation.reservationCustomers[].customer.contacts[].contactPurposes[0]",
            },
        ),
        Source(
            "reservationCancel",
            "cancellation.customer.contacts[]",
            {
                "purpose": "cancellation.customer.contacts[].contactPurposes[0]",
            },
        ),
        Source(
            "reservationCheckIn",
            "checkIn.customer.contacts[]",
            {
                "purpose": "checkIn.customer.contacts[].contactPurposes[0]",
            },
        ),
        Source(
            "reservationCheckOut",
            "checkOut.customer.contacts[]",
            {
                "purpose": "checkOut.customer.contacts[].contactPurposes[0]",
            },
        ),
        Source(
            "reservationRoomAssigned",
            "roomAssignment.customer.contacts[]",
            {
                "purpose": "roomAssignment.customer.contacts[].contactPurposes[0]",
            },
        ),
        Source(
            "reservationRoomChange",
            "roomChange.customer.contacts[]",
            {
                "purpose": "roomChange.customer.contacts[].contactPurposes[0]",
            },
        ),
        Source(
            "reservationEmailConfirmation",
            "emailConfirmation.customer.contacts[]",
            {
                "purpose": "emailConfirmation.customer.contacts[].contactPurposes[0]",
            },
        ),
        Source(
            "groupCreate",
            "group.contacts[]",
            {
                "purpose": "group.contacts[].contactPurposes[0]",
            },
        ),
    ),
)

TRAVEL_AGENT = Entity(
    "travelAgent",
    (
        Column("name"), Column("agentIataId"),
    ),
    key=("agentIataId", "name"),
    sources=(
        *below(
            {
                "reservationCreate": "reservation.associations[].travelAgent", "groupCreate": "group.travelagent",
            },
            "name", "agentIataId",
        ),
    ),
)

COMPANY = Entity(
    "company",
    (
        Column("name"), Column("companyId"), Column("corporateId"), Column("import_source"),
        Column("import_batch_id"),
    ),
    key=("companyId", "corporateId", "name"),
    sources=(
        *below(
            {
                "reservationCreate": "reservation.associations[].company",
                "reservationCancel": "cancellation.company", "reservationCheckIn": "checkIn.company",
                "reservationCheckOut": "checkOut.company", "groupCreate": "group.company",
                "groupCancel": "groupCancel.group.company", "groupCheckOut": "groupCheckOut.group.company",
                "folioGuestCreate": "folioGuestCreate.company", "folioGroupCreate": "folioGroupCreate.company",
                "folioHouseAccountCreate": "folioHouseAccountCreate.company",
                "invoiceCreate": "invoiceCreate.company",
            },
            "name", "companyId", "corporateId",
        ),
    ),
)

RESERVED_ROOM = Entity(
    "reservedRoom",
    (
        Column("startDate", "date", True), Column("endDate", "date", True), Column("roomNumber", required=True),
        Column("import_source"), Column("import_batch_id"),
    ),
    key=("startDate", "endDate", "roomNumber"),
    sources=(
        *below(
            {
                "reservationCreate": "reservation.reservationItems[].reservedRooms[]",
                "reservationCancel": "cancellation.reservedRoom", "reservationCheckIn": "checkIn.reservedRoom",
                "reservationRoomAssigned": "roomAssignment.reservedRoom",
                "reservationRoomChange": "roomChange.reservedRoom", "reservationECheckIn": "eCheckIn.reservedRoom",
                "reservationCheckOut": "checkOut.checkedOutRoom",
            },
            "startDate", "endDate", "roomNumber",
        ),
    ),
)

RESERVATION_ITEM = Entity(
    "reservationItem",
    (
        Column("startDate", "date", True), Column("endDate", "date", True), Column("itemType"),
        Column("quantity", "int"), Column("adultCount", "int"), Column("childCount", "int"), Column("import_source"),
        Column("import_batch_id"),
    ),
    key=("startDate", "endDate", "itemType", "quantity", "adultCount", "childCount"),
    sources=(
        *below(
            {
                "reservationCreate": "reservation.reservationItems[]",
            },
            "startDate", "endDate", "itemType", "quantity", "adultCount", "childCount",
        ),
    ),
)

RESERVED_INVENTORY = Entity(
    "reservedInventory",
    (
        Column("startDate", "date", True), Column("endDate", "date", True), Column("inventoryCode", required=True),
        Column("import_source"), Column("import_batch_id"),
    ),
    key=("startDate", "endDate", "inventoryCode"),
    sources=(
        *below(
            {
                "reservationCreate": "reservation.reservationItems[].reservedInventories[]",
            },
            "startDate", "endDate", "inventoryCode",
        ),
    ),
)

RESERVED_RATE = Entity(
    "reservedRate",
    (
        Column("startDate", "date", True), Column("endDate", "date", True), Column("rateAmount", "decimal(12,2)"),
        Column("ratePlanCode"), Column("ratePlanDescription"), Column("rateIsAwardEligible", "boolean"),
        Column("rateIsConfidential", "boolean"), Column("rateIsPackage", "boolean"),
        Column("packageNetRoomRateAmount", "decimal(12,2)"), Column("rateIsCommissionable", "boolean"),
        Column("import_source"), Column("import_batch_id"),
    ),
    key=(
        "startDate", "endDate", "ratePlanCode", "rateAmount", "rateIsAwardEligible", "rateIsConfidential",
        "rateIsPackage", "packageNetRoomRateAmount", "rateIsCommissionable",
    ),
    sources=(
        *below(
            {
                "reservationCreate": "reservation.reservationItems[].reservedRates[]",
            },
            "startDate", "endDate", "rateAmount", "ratePlanCode", "ratePlanDescription", "rateIsAwardEligible",
            "rateIsConfidential", "rateIsPackage", "packageNetRoomRateAmount", "rateIsCommissionable",
        ),
    ),
)

SPECIAL_REQUEST = Entity(
    "specialRequest",
    (
        Column("code"), Column("description"), Column("notes"), Column("import_source"), Column("import_batch_id"),
    ),
    key=("code", "description"),
    sources=(
        *below(
            {
                "reservationCreate": "reservation.reservationItems[].specialRequests[]",
            },
            "code", "description", "notes",
        ),
    ),
)

CREDIT_CARD = Entity(
    "creditCard",
    (
        Column("cardIsVirtual", "boolean"), Column("cardType"), Column("lastFourDigits"),
    ),
    key=("cardType", "lastFourDigits", "cardIsVirtual"),
    sources=(
        *below(
            {
                "reservationCreate": "reservation.guarantee.creditCard",
            },
            "cardIsVirtual", "cardType", "lastFourDigits",
        ),
        *below(
            {
                "reservationCreate": "reservation.paymentMethods[].creditCard",
                "groupCreate": "group.groupGuarantee.groupPlannerGuarantee.creditCard",
            },
            "cardIsVirtual", "cardType", "lastFourDigits",
        ),
        *below(
            {
                "groupCreate": "group.groupGuarantee.guestGuarantee.creditCard",
            },
            "cardIsVirtual", "cardType", "lastFourDigits",
        ),
    ),
)

GUARANTEE = Entity(
    "guarantee",
    (
        Column("guaranteeType"), Column("depositDueAmount", "decimal(12,2)"), Column("depositDueDate", "date"),
        Column("import_source"), Column("import_batch_id"),
    ),
    key=("guaranteeType", "depositDueAmount", "depositDueDate"),
    sources=(
        *below(
            {
                "reservationCreate": "reservation.guarantee",
            },
            "guaranteeType", "depositDueAmount", "depositDueDate",
        ),
    ),
)

PAYMENT_METHOD = Entity(
    "paymentMethod",
    (
        Column("folioId"), Column("folioName"), Column("paymentType"),
    ),
    key=("folioId", "folioName", "paymentType"),
    sources=(
        *below(
            {
                "reservationCreate": "reservation.paymentMethods[]", "groupCreate": "group.paymentMethods[]",
            },
            "folioId", "folioName", "paymentType",
        ),
    ),
)

MEMBERSHIP = Entity(
    "loyaltyRewardsMembership",
    (
        Column("loyaltyType"), Column("loyaltyNumber"), Column("loyaltyLevel"),
    ),
    key=("loyaltyNumber", "loyaltyType", "loyaltyLevel"),
    sources=(
        *below(
            {
                "reservationCreate": "reservation.reservationCustomers[].loyaltyRewardsMemberships[]",
                "groupCreate": "group.loyaltyRewardsMemberships[]",
            },
            "loyaltyType", "loyaltyNumber", "loyaltyLevel",
        ),
    ),
)

LINKED_RESERVATION = Entity(
    "linkedReservation",
    (
        Column("confirmationNumber", required=True), Column("source", required=True),
    ),
    key=("confirmationNumber", "source"),
    sources=(
        *below(
            {
                "reservationCreate": "reservation.linkedReservations[]",
            },
            "confirmationNumber", "source",
        ),
    ),
)

FOLIO_SUMMARY = Entity(
    "folioSummary",
    (
        Column("transactionType", required=True), Column("totalTransactionTypeAmount", "decimal(12,2)", True),
    ),
    key=("transactionType", "totalTransactionTypeAmount"),
    sources=(
        *below(
            {
                "reservationCheckOut": "checkOut.folioSummary[]",
                "groupCheckOut": "groupCheckOut.group.groupInfo.folioSummary[]",
            },
            "transactionType", "totalTransactionTypeAmount",
        ),
    ),
)

FOLIO_ITEM = Entity(
    "folioItem",
    (
        Column("transactionTimestamp", "timestamp"), Column("transactionBusinessDate", "date"),
        Column("transactionCode"), Column("transactionDescription"), Column("transactionComments"),
        Column("transactionType"), Column("folioId"), Column("transactionAmount", "decimal(12,2)"),
        Column("taxItem", "boolean"), Column("isHotelViewOnly", "boolean"), Column("fromAccountTransfer_account"),
        Column("fromAccountTransfer_accountType"), Column("toAccountTransfer_account"),
        Column("toAccountTransfer_accountType"),
    ),
    key=(
        "transactionTimestamp", "transactionBusinessDate", "transactionCode", "transactionType", "folioId",
        "transactionAmount", "taxItem",
    ),
    sources=(
        Source(
            "folioGuestCreate",
            "folioGuestCreate.folioTransactions[]",
            {
                "transactionCode": "folioGuestCreate.folioTransactions[].transactionCode",
                "transactionDescription": "folioGuestCreate.folioTransactions[].transactionDescription",
                "transactionComments": "folioGuestCreate.folioTransactions[].transactionComments",
                "transactionAmount": "folioGuestCreate.folioTransactions[].transactionAmount",
                "taxItem": "folioGuestCreate.folioTransactions[].taxItem",
                "transactionType": "folioGuestCreate.folioTransactions[].transactionType",
                "transactionBusinessDate": "folioGuestCreate.folioTransactions[].transactionBusinessDate",
                "transactionTimestamp": "folioGuestCreate.folioTransactions[].transactionActualDate",
                "isHotelViewOnly": "folioGuestCreate.folioTransactions[].isHotelViewOnly",
                "folioId": "folioGuestCreate.folioTransactions[].folioId",
                "fromAccountTransfer_accountType": "folioGuestCreate.folioTransactions[].fromAccountType",
                "toAccountTransfer_account": "folioGuestCreate.folioTransactions[].toAccountNumber",
                "toAccountTransfer_accountType": "folioGuestCreate.folioTransactions[].toAccountType",
            },
        ),
        Source(
            "folioGroupCreate",
            "folioGroupCreate.folioTransactions[]",
            {
                "transactionCode": "folioGroupCreate.folioTransactions[].transactionCode",
                "transactionDescription": "folioGroupCreate.folioTransactions[].transactionDescription",
                "transactionComments": "folioGroupCreate.folioTransactions[].transactionComments",
                "transactionAmount": "folioGroupCreate.folioTransactions[].transactionAmount",
                "taxItem": "folioGroupCreate.folioTransactions[].taxItem",
                "transactionType": "folioGroupCreate.folioTransactions[].transactionType",
                "transactionBusinessDate": "folioGroupCreate.folioTransactions[].transactionBusinessDate",
                "transactionTimestamp": "folioGroupCreate.folioTransactions[].transactionActualDate",
                "isHotelViewOnly": "folioGroupCreate.folioTransactions[].isHotelViewOnly",
                "folioId": "folioGroupCreate.folioTransactions[].folioId",
                "fromAccountTransfer_accountType": "folioGroupCreate.folioTransactions[].fromAccountType",
                "toAccountTransfer_account": "folioGroupCreate.folioTransactions[].toAccountNumber",
                "toAccountTransfer_accountType": "folioGroupCreate.folioTransactions[].toAccountType",
            },
        ),
        Source(
            "folioHouseAccountCreate",
            "folioHouseAccountCreate.folioTransactions[]",
            {
                "transactionCode": "folioHouseAccountCreate.folioTransactions[].transactionCode",
                "transactionDescription": "folioHouseAccountCreate.folioTransactions[].transactionDescription",
                "transactionComments": "folioHouseAccountCreate.folioTransactions[].transactionComments",
                "transactionAmount": "folioHouseAccountCreate.folioTransactions[].transactionAmount",
                "taxItem": "folioHouseAccountCreate.folioTransactions[].taxItem",
                "transactionType": "folioHouseAccountCreate.folioTransactions[].transactionType",
                "transactionBusinessDate": "folioHouseAccountCreate.folioTransactions[].transactionBusinessDate",
                "transactionTimestamp": "folioHouseAccountCreate.folioTransactions[].transactionActualDate",
                "isHotelViewOnly": "folioHouseAccountCreate.folioTransactions[].isHotelViewOnly",
                "folioId": "folioHouseAccountCreate.folioTransactions[].folioId",
                "fromAccountTransfer_accountType": "folioHouseAccountCreate.folioTransactions[].fromAccountType",
                "toAccountTransfer_account": "folioHouseAccountCreate.folioTransactions[].toAccountNumber",
                "toAccountTransfer_accountType": "folioHouseAccountCreate.folioTransactions[].toAccountType",
            },
        ),
        *below(
            {
                "invoiceCreate": "invoiceCreate.invoiceManualTransactions[]",
            },
            "transactionCode", "transactionDescription", "transactionComments", "transactionAmount", "taxItem",
            "transactionType",
        ),
        Source(
            "invoiceCreate",
            "invoiceCreate.invoiceUpdateTransactions[]",
            {
                "transactionCode": "invoiceCreate.invoiceUpdateTransactions[].transactionCode",
                "transactionDescription": "invoiceCreate.invoiceUpdateTransactions[].transactionDescription",
                "transactionComments": "invoiceCreate.invoiceUpdateTransactions[].transactionComments",
                "transactionAmount": "invoiceCreate.invoiceUpdateTransactions[].transactionAmount",
                "taxItem": "invoiceCreate.invoiceUpdateTransactions[].taxItem",
                "transactionType": "invoiceCreate.invoiceUpdateTransactions[].transactionType",
                "transactionBusinessDate": "invoiceCreate.invoiceUpdateTransactions[].invoiceUpdateDate",
                "transactionTimestamp": "invoiceCreate.invoiceUpdateTransactions[].lastUpdateTimestamp",
            },
        ),
    ),
)

ACCOUNT_STATUS = Entity(
    "accountStatus",
    (
        Column("linkTable"), Column("linkId"), Column("statusTimestamp", "timestamp", True),
        Column("status", required=True), Column("operatorId", required=True),
        Column("confirmationNumber", required=True), Column("callerName"),
    ),
    key=("linkTable", "linkId", "statusTimestamp", "status", "operatorId", "confirmationNumber"),
    sources=(
        *below(
            {
                "groupCreate": "group.accountStatuses[]",
            },
            "statusTimestamp", "status", "operatorId", "confirmationNumber", "callerName",
        ),
        *below(
            {
                "groupCancel": "groupCancel.group.accountStatuses[]",
                "groupCheckOut": "groupCheckOut.group.accountStatuses[]",
            },
            "statusTimestamp", "status", "operatorId", "confirmationNumber",
        ),
    ),
)

GROUP_BLOCK = Entity(
    "groupBlock",
    (
        Column("date", "date"), Column("inventoryCode"), Column("quantity", "int"), Column("pickupQuantity", "int"),
    ),
    key=("date", "inventoryCode", "quantity"),
    sources=(
        *below(
            {
                "groupCreate": "group.groupBlocks[]",
            },
            "date", "inventoryCode", "quantity", "pickupQuantity",
        ),
    ),
)

GROUP_RATE = Entity(
    "groupRate",
    (
        Column("startDate", "date"), Column("endDate", "date"), Column("inventoryType"),
        Column("onePersonRate", "decimal(12,2)"), Column("twoPersonRate", "decimal(12,2)"),
        Column("extrapersonRate", "decimal(12,2)"),
    ),
    key=("startDate", "endDate", "inventoryType", "onePersonRate", "twoPersonRate", "extrapersonRate"),
    sources=(
        Source(
            "groupCreate",
            "group.groupRates[]",
            {
                "startDate": "group.groupRates[].startDate", "endDate": "group.groupRates[].endDate",
                "inventoryType": "group.groupRates[].inventoryType",
                "onePersonRate": "group.groupRates[].onePersonRate",
                "twoPersonRate": "group.groupRates[].twoPersonRate",
                "extrapersonRate": "group.groupRates[].extraPersonRate",
            },
        ),
    ),
)

CLEANING_SCHEDULE = Entity(
    "cleaningSchedule",
    (
        Column("startDate", "date", True), Column("endDate", "date", True), Column("cleaningType", required=True),
    ),
    key=("startDate", "endDate", "cleaningType"),
    sources=(),
)

RATE_PLAN_CODE = Entity(
    "ratePlanCode",
    (
        Column("ratePlanCode"), Column("isTaxInclusive", "boolean"),
    ),
    key=("ratePlanCode", "isTaxInclusive"),
    sources=(
        *below(
            {
                "appliedRateUpdate": "appliedRateUpdate.ratePlanCodes[]",
                "discountRateUpdate": "discountRateUpdate.ratePlanCodes[]",
                "fixedRateUpdate": "fixedRateUpdate.ratePlanCodes[]",
                "bestAvailableRateUpdate": "bestAvailableRateUpdate.ratePlanCodes[]",
            },
            "ratePlanCode", "isTaxInclusive",
        ),
    ),
)

AMOUNT_OFF_RATE = Entity(
    "amountOffRate",
    (
        Column("startDate", "date"), Column("endDate", "date"), Column("inventoryCode"), Column("baseRatePlan"),
        Column("losMin", "int"), Column("losMax", "int"), Column("onePersonRate", "decimal(12,2)"),
        Column("twoPersonRate", "decimal(12,2)"), Column("onePersonAmountOff", "decimal(12,2)"),
        Column("twoPersonAmountOff", "decimal(12,2)"), Column("baseOnePersonRate", "decimal(12,2)"),
        Column("baseTwoPersonRate", "decimal(12,2)"), Column("limitToDaysOfWeek_sunday", "boolean"),
        Column("limitToDaysOfWeek_monday", "boolean"), Column("limitToDaysOfWeek_tuesday", "boolean"),
        Column("limitToDaysOfWeek_wednesday", "boolean"), Column("limitToDaysOfWeek_thursday", "boolean"),
        Column("limitToDaysOfWeek_friday", "boolean"), Column("limitToDaysOfWeek_saturday", "boolean"),
    ),
    key=(
        "startDate", "endDate", "inventoryCode", "baseRatePlan", "losMin", "losMax", "onePersonRate", "twoPersonRate",
        "onePersonAmountOff", "twoPersonAmountOff", "baseOnePersonRate", "baseTwoPersonRate",
        "limitToDaysOfWeek_sunday", "limitToDaysOfWeek_monday", "limitToDaysOfWeek_tuesday",
        "limitToDaysOfWeek_wednesday", "limitToDaysOfWeek_thursday", "limitToDaysOfWeek_friday",
        "limitToDaysOfWeek_saturday",
    ),
    sources=(
        *below(
            {
                "appliedRateUpdate": "appliedRateUpdate.amountOffRates[]",
                "discountRateUpdate": "discountRateUpdate.amountOffRates[]",
                "fixedRateUpdate": "fixedRateUpdate.amountOffRates[]",
                "bestAvailableRateUpdate": "bestAvailableRateUpdate.amountOffRates[]",
            },
            "startDate", "endDate", "inventoryCode", "baseRatePlan", "losMin", "losMax", "onePersonRate",
            "twoPersonRate", "onePersonAmountOff", "twoPersonAmountOff", "baseOnePersonRate", "baseTwoPersonRate",
            "limitToDaysOfWeek_sunday", "limitToDaysOfWeek_monday", "limitToDaysOfWeek_tuesday",
            "limitToDaysOfWeek_wednesday", "limitToDaysOfWeek_thursday", "limitToDaysOfWeek_friday",
            "limitToDaysOfWeek_saturday",
        ),
    ),
)

PERCENT_OFF_RATE = Entity(
    "percentOffRate",
    (
        Column("startDate", "date"), Column("endDate", "date"), Column("inventoryCode"), Column("baseRatePlan"),
        Column("losMin", "int"), Column("losMax", "int"), Column("onePersonRate", "decimal(12,2)"),
        Column("twoPersonRate", "decimal(12,2)"), Column("onePersonPercentOff", "decimal(5,2)"),
        Column("twoPersonPercentOff", "decimal(5,2)"), Column("baseOnePersonRate", "decimal(12,2)"),
        Column("baseTwoPersonRate", "decimal(12,2)"), Column("limitToDaysOfWeek_sunday", "boolean"),
        Column("limitToDaysOfWeek_monday", "boolean"), Column("limitToDaysOfWeek_tuesday", "boolean"),
        Column("limitToDaysOfWeek_wednesday", "boolean"), Column("limitToDaysOfWeek_thursday", "boolean"),
        Column("limitToDaysOfWeek_friday", "boolean"), Column("limitToDaysOfWeek_saturday", "boolean"),
    ),
    key=(
        "startDate", "endDate", "inventoryCode", "baseRatePlan", "losMin", "losMax", "onePersonRate", "twoPersonRate",
        "onePersonPercentOff", "twoPersonPercentOff", "baseOnePersonRate", "baseTwoPersonRate",
        "limitToDaysOfWeek_sunday", "limitToDaysOfWeek_monday", "limitToDaysOfWeek_tuesday",
        "limitToDaysOfWeek_wednesday", "limitToDaysOfWeek_thursday", "limitToDaysOfWeek_friday",
        "limitToDaysOfWeek_saturday",
    ),
    sources=(
        *below(
            {
                "appliedRateUpdate": "appliedRateUpdate.percentOffRates[]",
                "discountRateUpdate": "discountRateUpdate.percentOffRates[]",
                "fixedRateUpdate": "fixedRateUpdate.percentOffRates[]",
                "bestAvailableRateUpdate": "bestAvailableRateUpdate.percentOffRates[]",
            },
            "startDate", "endDate", "inventoryCode", "baseRatePlan", "losMin", "losMax", "onePersonRate",
            "twoPersonRate", "onePersonPercentOff", "twoPersonPercentOff", "baseOnePersonRate", "baseTwoPersonRate",
            "limitToDaysOfWeek_sunday", "limitToDaysOfWeek_monday", "limitToDaysOfWeek_tuesday",
            "limitToDaysOfWeek_wednesday", "limitToDaysOfWeek_thursday", "limitToDaysOfWeek_friday",
            "limitToDaysOfWeek_saturday",
        ),
    ),
)

AMOUNT_ABOVE_RATE = Entity(
    "amountAboveRate",
    (
        Column("startDate", "date"), Column("endDate", "date"), Column("inventoryCode"), Column("baseRatePlan"),
        Column("losMin", "int"), Column("losMax", "int"), Column("onePersonRate", "decimal(12,2)"),
        Column("twoPersonRate", "decimal(12,2)"), Column("onePersonAmountAbove", "decimal(12,2)"),
        Column("twoPersonAmountAbove", "decimal(12,2)"), Column("baseOnePersonRate", "decimal(12,2)"),
        Column("baseTwoPersonRate", "decimal(12,2)"), Column("limitToDaysOfWeek_sunday", "boolean"),
        Column("limitToDaysOfWeek_monday", "boolean"), Column("limitToDaysOfWeek_tuesday", "boolean"),
        Column("limitToDaysOfWeek_wednesday", "boolean"), Column("limitToDaysOfWeek_thursday", "boolean"),
        Column("limitToDaysOfWeek_friday", "boolean"), Column("limitToDaysOfWeek_saturday", "boolean"),
    ),
    key=(
        "startDate", "endDate", "inventoryCode", "baseRatePlan", "losMin", "losMax", "onePersonRate", "twoPersonRate",
        "onePersonAmountAbove", "twoPersonAmountAbove", "baseOnePersonRate", "baseTwoPersonRate",
        "limitToDaysOfWeek_sunday", "limitToDaysOfWeek_monday", "limitToDaysOfWeek_tuesday",
        "limitToDaysOfWeek_wednesday", "limitToDaysOfWeek_thursday", "limitToDaysOfWeek_friday",
        "limitToDaysOfWeek_saturday",
    ),
    sources=(
        *below(
            {
                "appliedRateUpdate": "appliedRateUpdate.amountAboveRates[]",
                "discountRateUpdate": "discountRateUpdate.amountAboveRates[]",
                "fixedRateUpdate": "fixedRateUpdate.amountAboveRates[]",
                "bestAvailableRateUpdate": "bestAvailableRateUpdate.amountAboveRates[]",
            },
            "startDate", "endDate", "inventoryCode", "baseRatePlan", "losMin", "losMax", "onePersonRate",
            "twoPersonRate", "onePersonAmountAbove", "twoPersonAmountAbove", "baseOnePersonRate", "baseTwoPersonRate",
            "limitToDaysOfWeek_sunday", "limitToDaysOfWeek_monday", "limitToDaysOfWeek_tuesday",
            "limitToDaysOfWeek_wednesday", "limitToDaysOfWeek_thursday", "limitToDaysOfWeek_friday",
            "limitToDaysOfWeek_saturday",
        ),
    ),
)

PERCENT_ABOVE_RATE = Entity(
    "percentAboveRate",
    (
        Column("startDate", "date"), Column("endDate", "date"), Column("inventoryCode"), Column("baseRatePlan"),
        Column("losMin", "int"), Column("losMax", "int"), Column("onePersonRate", "decimal(12,2)"),
        Column("twoPersonRate", "decimal(12,2)"), Column("onePersonPercentAbove", "decimal(5,2)"),
        Column("twoPersonPercentAbove", "decimal(5,2)"), Column("baseOnePersonRate", "decimal(12,2)"),
        Column("baseTwoPersonRate", "decimal(12,2)"), Column("limitToDaysOfWeek_sunday", "boolean"),
        Column("limitToDaysOfWeek_monday", "boolean"), Column("limitToDaysOfWeek_tuesday", "boolean"),
        Column("limitToDaysOfWeek_wednesday", "boolean"), Column("limitToDaysOfWeek_thursday", "boolean"),
        Column("limitToDaysOfWeek_friday", "boolean"), Column("limitToDaysOfWeek_saturday", "boolean"),
    ),
    key=(
        "startDate", "endDate", "inventoryCode", "baseRatePlan", "losMin", "losMax", "onePersonRate", "twoPersonRate",
        "onePersonPercentAbove", "twoPersonPercentAbove", "baseOnePersonRate", "baseTwoPersonRate",
        "limitToDaysOfWeek_sunday", "limitToDaysOfWeek_monday", "limitToDaysOfWeek_tuesday",
        "limitToDaysOfWeek_wednesday", "limitToDaysOfWeek_thursday", "limitToDaysOfWeek_friday",
        "limitToDaysOfWeek_saturday",
    ),
    sources=(
        *below(
            {
                "appliedRateUpdate": "appliedRateUpdate.percentAboveRates[]",
                "discountRateUpdate": "discountRateUpdate.percentAboveRates[]",
                "fixedRateUpdate": "fixedRateUpdate.percentAboveRates[]",
                "bestAvailableRateUpdate": "bestAvailableRateUpdate.percentAboveRates[]",
            },
            "startDate", "endDate", "inventoryCode", "baseRatePlan", "losMin", "losMax", "onePersonRate",
            "twoPersonRate", "onePersonPercentAbove", "twoPersonPercentAbove", "baseOnePersonRate",
            "baseTwoPersonRate", "limitToDaysOfWeek_sunday", "limitToDaysOfWeek_monday", "limitToDaysOfWeek_tuesday",
            "limitToDaysOfWeek_wednesday", "limitToDaysOfWeek_thursday", "limitToDaysOfWeek_friday",
            "limitToDaysOfWeek_saturday",
        ),
    ),
)

AMOUNT_FIXED_RATE = Entity(
    "amountFixedRate",
    (
        Column("startDate", "date"), Column("endDate", "date"), Column("inventoryCode"), Column("losMin", "int"),
        Column("losMax", "int"), Column("onePersonRate", "decimal(12,2)"), Column("twoPersonRate", "decimal(12,2)"),
        Column("limitToDaysOfWeek_sunday", "boolean"), Column("limitToDaysOfWeek_monday", "boolean"),
        Column("limitToDaysOfWeek_tuesday", "boolean"), Column("limitToDaysOfWeek_wednesday", "boolean"),
        Column("limitToDaysOfWeek_thursday", "boolean"), Column("limitToDaysOfWeek_friday", "boolean"),
        Column("limitToDaysOfWeek_saturday", "boolean"),
    ),
    key=(
        "startDate", "endDate", "inventoryCode", "losMin", "losMax", "onePersonRate", "twoPersonRate",
        "limitToDaysOfWeek_sunday", "limitToDaysOfWeek_monday", "limitToDaysOfWeek_tuesday",
        "limitToDaysOfWeek_wednesday", "limitToDaysOfWeek_thursday", "limitToDaysOfWeek_friday",
        "limitToDaysOfWeek_saturday",
    ),
    sources=(
        *below(
            {
                "appliedRateUpdate": "appliedRateUpdate.amountFixedRates[]",
                "discountRateUpdate": "discountRateUpdate.amountFixedRates[]",
                "fixedRateUpdate": "fixedRateUpdate.amountFixedRates[]",
                "bestAvailableRateUpdate": "bestAvailableRateUpdate.amountFixedRates[]",
            },
            "startDate", "endDate", "inventoryCode", "losMin", "losMax", "onePersonRate", "twoPersonRate",
            "limitToDaysOfWeek_sunday", "limitToDaysOfWeek_monday", "limitToDaysOfWeek_tuesday",
            "limitToDaysOfWeek_wednesday", "limitToDaysOfWeek_thursday", "limitToDaysOfWeek_friday",
            "limitToDaysOfWeek_saturday",
        ),
    ),
)

EXTRA_CHARGE = Entity(
    "extraCharge",
    (
        Column("rate_id"), Column("startDate", "date"), Column("endDate", "date"), Column("extraChargeType"),
        Column("rateAmount", "decimal(12,2)"),
    ),
    key=("rate_id", "startDate", "endDate", "extraChargeType", "onePersonRate", "twoPersonRate"),
    sources=(
        *below(
            {
                "appliedRateUpdate": "appliedRateUpdate.extraCharges[]",
                "discountRateUpdate": "discountRateUpdate.extraCharges[]",
                "fixedRateUpdate": "fixedRateUpdate.extraCharges[]",
                "bestAvailableRateUpdate": "bestAvailableRateUpdate.extraCharges[]",
            },
            "startDate", "endDate", "extraChargeType", "rateAmount",
        ),
    ),
)

GROUP = Entity(
    "group",
    (
        Column("eventInfo_name"), Column("eventInfo_version"), Column("groupId"), Column("name"), Column("hotel_id"),
        Column("company_id"), Column("travelagent_id"), Column("cancelReason"),
        Column("groupStayInfo_arrivalDate", "date"), Column("groupStayInfo_departureDate", "date"),
        Column("groupStayInfo_expectedArrivalTime"), Column("groupStayInfo_expectedDepartureTime"),
        Column("groupInfo_groupLastUpdateTimestamp", "timestamp"), Column("groupInfo_groupLastUpdateOperatorId"),
        Column("groupInfo_isGroupWithCompany", "boolean"), Column("hotelPolicy_guaranteePolicy"),
        Column("hotelPolicy_cancellationPolicy"), Column("groupInfo_groupChargeRouting"),
        Column("groupInfo_languagePreference"), Column("groupInfo_salesManagerName"),
        Column("groupInfo_groupMarketCode"), Column("groupInfo_groupTrackingCode"),
        Column("groupInfo_groupRollingCutoffNumberOfDays"), Column("groupInfo_groupNonRoomPackageName"),
        Column("groupContact_lastName"), Column("groupContact_firstName"),
        Column("groupGuarantee_groupPlannerGuarantee_guaranteeType"),
        Column("groupGuarantee_guestGuarantee_guaranteeType"), Column("note_noteType"), Column("note_noteText"),
        Column("groupInfo_groupContractDueDate", "date"), Column("groupInfo_groupRoomingListDueDate", "date"),
        Column("groupInfo_groupContractReceivedDate", "date"), Column("groupInfo_groupFixedCutoffDate", "date"),
        Column("groupGuarantee_groupPlannerGuarantee_depositDueDate", "date"),
        Column("groupGuarantee_guestGuarantee_depositDueDate", "date"),
        Column("groupInfo_isGroupFolioActive", "boolean"), Column("groupInfo_isCommissionable", "boolean"),
        Column("groupInfo_isGroupRateSupressed", "boolean"), Column("groupInfo_isGroupTaxExempt", "boolean"),
        Column("groupInfo_isGroupWithRecurringCharges", "boolean"),
        Column("groupInfo_isGroupBlockAutoDrop", "boolean"), Column("groupInfo_isRateAwardEligible", "boolean"),
        Column("groupInfo_isElastic", "boolean"),
        Column("groupGuarantee_groupPlannerGuarantee_depositDueAmount", "decimal(12,2)"),
        Column("groupGuarantee_guestGuarantee_depositDueAmount", "decimal(12,2)"),
    ),
    key=(
        "groupId", "hotel_id", "name", "eventInfo_name", "groupInfo_groupLastUpdateTimestamp",
        "groupInfo_isGroupBlockAutoDrop", "groupInfo_isRateAwardEligible", "groupInfo_isGroupWithCompany",
        "groupInfo_isElastic", "groupContact_lastName", "groupContact_firstName", "cancelReason",
    ),
    sources=(
        *below(
            {
                "reservationCreate": "reservation.associations[].group", "reservationCheckOut": "checkOut.group",
            },
            "groupId", "name",
        ),
        Source(
            "groupCreate",
            "",
            {
                "eventInfo_name": "eventInfo.name", "eventInfo_version": "eventInfo.version",
                "groupId": "group.groupId", "name": "group.name",
                "groupStayInfo_arrivalDate": "group.groupStayInfo.arrivalDate",
                "groupStayInfo_departureDate": "group.groupStayInfo.departureDate",
                "groupStayInfo_expectedArrivalTime": "group.groupStayInfo.expectedArrivalTime",
                "groupStayInfo_expectedDepartureTime": "group.groupStayInfo.expectedDepartureTime",
                "groupInfo_groupLastUpdateTimestamp": "group.groupInfo.groupLastUpdateTimestamp",
                "groupInfo_groupLastUpdateOperatorId": "group.groupInfo.groupLastUpdateOperatorId",
                "groupInfo_isGroupWithCompany": "group.groupInfo.isGroupWithCompany",
                "hotelPolicy_guaranteePolicy": "group.hotelPolicy.guaranteePolicy",
                "hotelPolicy_cancellationPolicy": "group.hotelPolicy.cancellationPolicy",
                "groupInfo_groupChargeRouting": "group.groupInfo.groupChargeRouting",
                "groupInfo_languagePreference": "group.groupInfo.languagePreference",
                "groupInfo_salesManagerName": "group.groupInfo.salesManagerName",
                "groupInfo_groupMarketCode": "group.groupInfo.groupMarketCode",
                "groupInfo_groupTrackingCode": "group.groupInfo.groupTrackingCode",
                "groupInfo_groupRollingCutoffNumberOfDays": "group.groupInfo.groupRollingCutoffNumberOfDays",
                "groupInfo_groupNonRoomPackageName": "group.groupInfo.groupNonRoomPackageName",
                "groupContact_lastName": "group.groupContact.lastName",
                "groupContact_firstName": "group.groupContact.firstName",
                "groupGuarantee_groupPlannerGuarantee_guaranteeType": "group.groupGuarantee.groupPlannerGuarantee.guaranteeType",
                "groupGuarantee_guestGuarantee_guaranteeType": "group.groupGuarantee.guestGuarantee.guaranteeType",
                "note_noteType": "group.note.noteType", "note_noteText": "group.note.noteText",
                "groupInfo_groupContractDueDate": "group.groupInfo.groupContractDueDate",
                "groupInfo_groupRoomingListDueDate": "group.groupInfo.groupRoomingListDueDate",
                "groupInfo_groupContractReceivedDate": "group.groupInfo.groupContractReceivedDate",
                "groupInfo_groupFixedCutoffDate": "group.groupInfo.groupFixedCutoffDate",
                "groupGuarantee_groupPlannerGuarantee_depositDueDate": "group.groupGuarantee.groupPlannerGuarantee.depositDueDate",
                "groupGuarantee_guestGuarantee_depositDueDate": "group.groupGuarantee.guestGuarantee.depositDueDate",
                "groupInfo_isGroupFolioActive": "group.groupInfo.isGroupFolioActive",
                "groupInfo_isCommissionable": "group.groupInfo.isCommissionable",
                "groupInfo_isGroupRateSupressed": "group.groupInfo.isGroupRateSupressed",
                "groupInfo_isGroupTaxExempt": "group.groupInfo.isGroupTaxExempt",
                "groupInfo_isGroupWithRecurringCharges": "group.groupInfo.isGroupWithRecurringCharges",
                "groupInfo_isGroupBlockAutoDrop": "group.groupInfo.isGroupBlockAutoDrop",
                "groupInfo_isRateAwardEligible": "group.groupInfo.isRateAwardEligible",
                "groupInfo_isElastic": "group.groupInfo.isElastic",
                "groupGuarantee_groupPlannerGuarantee_depositDueAmount": "group.groupGuarantee.groupPlannerGuarantee.depositDueAmount",
                "groupGuarantee_guestGuarantee_depositDueAmount": "group.groupGuarantee.guestGuarantee.depositDueAmount",
            },
        ),
        *below(
            {
                "groupCancel": "groupCancel.group",
            },
            "groupId", "name", "groupStayInfo_arrivalDate", "groupStayInfo_departureDate",
            "groupStayInfo_expectedArrivalTime", "groupStayInfo_expectedDepartureTime",
            "groupInfo_groupLastUpdateTimestamp", "groupInfo_groupLastUpdateOperatorId",
            "groupInfo_isGroupWithCompany", "cancelReason",
        ),
        *below(
            {
                "groupCheckOut": "groupCheckOut.group",
            },
            "groupId", "name", "groupStayInfo_arrivalDate", "groupStayInfo_departureDate",
            "groupStayInfo_expectedArrivalTime", "groupStayInfo_expectedDepartureTime",
            "groupInfo_groupLastUpdateTimestamp", "groupInfo_groupLastUpdateOperatorId",
            "groupInfo_isGroupWithCompany",
        ),
        Source(
            "folioGroupCreate",
            "folioGroupCreate",
            {
                "groupStayInfo_arrivalDate": "folioGroupCreate.arrivalDate",
                "groupStayInfo_departureDate": "folioGroupCreate.departureDate",
            },
        ),
    ),
)

HOUSEKEEPING = Entity(
    "housekeepingStatus",
    (
        Column("eventInfo_name"), Column("eventInfo_version", required=True), Column("hotel_id", required=True),
        Column("roomNumber", required=True), Column("currentRoomCondition", required=True),
        Column("previousRoomCondition", required=True), Column("roomStatusUpdateTimestamp", "timestamp", True),
        Column("roomStatusUpdateOperatorId", required=True), Column("checkInReady", "boolean"),
    ),
    key=(
        "hotel_id", "roomNumber", "roomStatusUpdateTimestamp", "roomStatusUpdateOperatorId", "currentRoomCondition",
        "previousRoomCondition", "checkInReady",
    ),
    sources=(
        *below(
            {
                "reservationECheckIn": "eCheckIn",
            },
            "checkInReady",
        ),
        Source(
            "housekeepingStatus",
            "",
            {
                "eventInfo_name": "eventInfo.name", "eventInfo_version": "eventInfo.version",
                "roomNumber": "housekeepingStatus.roomNumber",
                "currentRoomCondition": "housekeepingStatus.currentRoomCondition",
                "previousRoomCondition": "housekeepingStatus.previousRoomCondition",
                "roomStatusUpdateTimestamp": "housekeepingStatus.roomStatusUpdateTimestamp",
                "roomStatusUpdateOperatorId": "housekeepingStatus.roomStatusUpdateOperatorId",
                "checkInReady": "housekeepingStatus.checkInReady",
            },
        ),
    ),
)

INVENTORY_BATCH = Entity(
    "inventoryBatch",
    (
        Column("hotel_id", required=True), Column("startDate", "date", True), Column("endDate", "date", True),
        Column("inventoryCode", required=True), Column("itemType", required=True),
        Column("availableCount", "int", True), Column("outOfOrderCount", "int", True),
        Column("physicalCount", "int", True), Column("soldCount", "int", True), Column("groupBlockCount", "int"),
        Column("groupPickUpCount", "int", True), Column("overbookingLimit", "int", True),
    ),
    key=(
        "hotel_id", "startDate", "endDate", "inventoryCode", "itemType", "availableCount", "outOfOrderCount",
        "physicalCount", "soldCount", "groupBlockCount", "groupPickUpCount", "overbookingLimit",
    ),
    sources=(
        *below(
            {
                "inventoryBatch": "inventoryBatch.inventories[]",
            },
            "startDate", "endDate", "inventoryCode", "itemType", "availableCount", "outOfOrderCount", "physicalCount",
            "soldCount", "groupBlockCount", "groupPickUpCount", "overbookingLimit",
        ),
    ),
)

INVENTORY_AVAILABLE_COUNT = Entity(
    "inventoryAvailableCount",
    (
        Column("hotel_id", required=True), Column("startDate", "date", True), Column("endDate", "date", True),
        Column("inventoryCode", required=True), Column("itemType", required=True), Column("quantity", "int", True),
    ),
    key=("hotel_id", "startDate", "endDate", "inventoryCode", "itemType", "quantity"),
    sources=(
        *below(
            {
                "inventoryUpdate": "inventoryUpdate.inventoryAvailableCounts[]",
            },
            "startDate", "endDate", "inventoryCode", "itemType", "quantity",
        ),
    ),
)

INVENTORY_OUT_OF_ORDER_COUNT = Entity(
    "inventoryOutOfOrderCount",
    (
        Column("hotel_id", required=True), Column("startDate", "date", True), Column("endDate", "date", True),
        Column("inventoryCode", required=True), Column("itemType", required=True), Column("quantity", "int", True),
    ),
    key=("hotel_id", "startDate", "endDate", "inventoryCode", "itemType", "quantity"),
    sources=(
        *below(
            {
                "inventoryUpdate": "inventoryUpdate.inventoryOutOfOrderCounts[]",
            },
            "startDate", "endDate", "inventoryCode", "itemType", "quantity",
        ),
    ),
)

INVENTORY_PHYSICAL_COUNT = Entity(
    "inventoryPhysicalCount",
    (
        Column("hotel_id", required=True), Column("startDate", "date", True), Column("endDate", "date", True),
        Column("inventoryCode", required=True), Column("itemType", required=True), Column("quantity", "int", True),
    ),
    key=("hotel_id", "startDate", "endDate", "inventoryCode", "itemType", "quantity"),
    sources=(
        *below(
            {
                "inventoryUpdate": "inventoryUpdate.inventoryPhysicalCounts[]",
            },
            "startDate", "endDate", "inventoryCode", "itemType", "quantity",
        ),
    ),
)

RATE = Entity(
    "rate",
    (
        Column("hotel_id", required=True), Column("rate_update_type", required=True),
        Column("timestamp", "timestamp", True), Column("recap", "boolean"), Column("recapType"),
        Column("isTaxInclusive", "boolean"),
    ),
    key=("hotel_id", "rate_update_type", "timestamp", "recap", "recapType", "isTaxInclusive"),
    sources=(
        Source(
            "appliedRateUpdate",
            "",
            {
                "recap": "recap", "timestamp": "messageHeader.timestamp", "rate_update_type": "eventInfo.name",
            },
        ),
        Source(
            "discountRateUpdate",
            "",
            {
                "recap": "recap", "timestamp": "messageHeader.timestamp", "rate_update_type": "eventInfo.name",
            },
        ),
        Source(
            "fixedRateUpdate",
            "",
            {
                "recap": "recap", "timestamp": "messageHeader.timestamp", "rate_update_type": "eventInfo.name",
            },
        ),
        Source(
            "bestAvailableRateUpdate",
            "",
            {
                "recap": "recap", "timestamp": "messageHeader.timestamp", "rate_update_type": "eventInfo.name",
                "isTaxInclusive": "bestAvailableRateUpdate.isTaxInclusive",
            },
        ),
    ),
)

RESERVATION = Entity(
    "reservation",
    (
        Column("eventInfo_name"), Column("eventInfo_version"), Column("hotels_id", required=True),
        Column("reservationId"), Column("arrivalDate", "date"), Column("departureDate", "date"),
        Column("hotelPolicy_guaranteePolicy"), Column("hotelPolicy_cancellationPolicy"), Column("marketSegment"),
        Column("reservedRoom"), Column("associations_travelAgent_id"), Column("associations_groups_id"),
        Column("associations_company_id"), Column("sourceOfBusiness_local", "boolean"),
        Column("sourceOfBusiness_callerName"), Column("sourceOfBusiness_externalSource_sourceId", "int"),
        Column("sourceOfBusiness_externalSource_sourceDescription"),
        Column("sourceOfBusiness_localSource_walkIn", "boolean"),
        Column("costSummary_averageNightlyReservedRateAmountBeforeTax", "decimal(12,2)"),
        Column("costSummary_totalTaxAmount", "decimal(12,2)"),
        Column("costSummary_totalOtherRevenueAmountBeforeTax", "decimal(12,2)"), Column("roomCondition"),
        Column("reservationLastUpdateTimestamp", "timestamp"), Column("reservationLastUpdateOperatorId"),
        Column("cancellationStatus_statusTimestamp", "timestamp"), Column("cancellationStatus_reservationStatus"),
        Column("cancellationStatus_operatorId"), Column("cancellationStatus_confirmationId"),
        Column("cancellationStatus_callerName"), Column("checkedOutRoom_id"), Column("checkOut_group_id"),
        Column("eCheckIn_guestLastName"), Column("eCheckIn_eCheckInProcessed", "boolean"), Column("import_source"),
        Column("import_batch_id"),
    ),
    key=(
        "reservationId", "hotels_id", "eventInfo_name", "arrivalDate", "departureDate",
        "reservationLastUpdateTimestamp", "reservedRoom", "associations_company_id", "checkOut_group_id",
        "associations_travelAgent_id", "associations_groups_id",
        "costSummary_averageNightlyReservedRateAmountBeforeTax", "costSummary_totalTaxAmount",
        "costSummary_totalOtherRevenueAmountBeforeTax", "cancellationStatus_statusTimestamp", "checkedOutRoom_id",
    ),
    sources=(
        Source(
            "reservationCreate",
            "",
            {
                "eventInfo_name": "eventInfo.name", "eventInfo_version": "eventInfo.version",
                "arrivalDate": "reservation.arrivalDate", "departureDate": "reservation.departureDate",
                "reservationId": "reservation.reservationId",
                "hotelPolicy_guaranteePolicy": "reservation.hotelPolicy.guaranteePolicy",
                "hotelPolicy_cancellationPolicy": "reservation.hotelPolicy.cancellationPolicy",
                "marketSegment": "reservation.marketSegment",
                "sourceOfBusiness_local": "reservation.sourceOfBusiness.local",
                "sourceOfBusiness_callerName": "reservation.sourceOfBusiness.callerName",
                "sourceOfBusiness_externalSource_sourceId": "reservation.sourceOfBusiness.externalSource.sourceId",
                "sourceOfBusiness_externalSource_sourceDescription": "reservation.sourceOfBusiness.externalSource.sourceDescription",
                "sourceOfBusiness_localSource_walkIn": "reservation.sourceOfBusiness.localSource.walkIn",
                "costSummary_averageNightlyReservedRateAmountBeforeTax": "reservation.costSummary.averageNightlyReservedRateAmountBeforeTax",
                "costSummary_totalTaxAmount": "reservation.costSummary.totalTaxAmount",
                "costSummary_totalOtherRevenueAmountBeforeTax": "reservation.costSummary.totalOtherRevenueAmountBeforeTax",
                "reservationLastUpdateTimestamp": "reservation.reservationLastUpdateTimestamp",
                "reservationLastUpdateOperatorId": "reservation.reservationLastUpdateOperatorId",
            },
        ),
        Source(
            "reservationCancel",
            "",
            {
                "eventInfo_name": "eventInfo.name", "eventInfo_version": "eventInfo.version",
                "cancellationStatus_statusTimestamp": "cancellation.cancellationStatus.statusTimestamp",
                "cancellationStatus_reservationStatus": "cancellation.cancellationStatus.reservationStatus",
                "cancellationStatus_operatorId": "cancellation.cancellationStatus.operatorId",
                "cancellationStatus_confirmationId": "cancellation.cancellationStatus.confirmationId",
                "cancellationStatus_callerName": "cancellation.cancellationStatus.callerName",
                "hotelPolicy_guaranteePolicy": "cancellation.hotelPolicy.guaranteePolicy",
                "hotelPolicy_cancellationPolicy": "cancellation.hotelPolicy.cancellationPolicy",
            },
        ),
        Source(
            "reservationCheckIn",
            "",
            {
                "eventInfo_name": "eventInfo.name", "eventInfo_version": "eventInfo.version",
                "arrivalDate": "checkIn.arrivalDate", "departureDate": "checkIn.departureDate",
            },
        ),
        Source(
            "reservationCheckOut",
            "",
            {
                "eventInfo_name": "eventInfo.name", "eventInfo_version": "eventInfo.version",
                "arrivalDate": "checkOut.arrivalDate", "departureDate": "checkOut.departureDate",
            },
        ),
        Source(
            "reservationRoomAssigned",
            "",
            {
                "eventInfo_name": "eventInfo.name", "eventInfo_version": "eventInfo.version",
                "arrivalDate": "roomAssignment.arrivalDate", "departureDate": "roomAssignment.departureDate",
                "roomCondition": "roomAssignment.roomCondition",
                "reservationLastUpdateTimestamp": "roomAssignment.reservationLastUpdateTimestamp",
                "reservationLastUpdateOperatorId": "roomAssignment.reservationLastUpdateOperatorId",
            },
        ),
        Source(
            "reservationRoomChange",
            "",
            {
                "eventInfo_name": "eventInfo.name", "eventInfo_version": "eventInfo.version",
                "arrivalDate": "roomChange.arrivalDate", "departureDate": "roomChange.departureDate",
                "reservationLastUpdateTimestamp": "roomChange.reservationLastUpdateTimestamp",
                "reservationLastUpdateOperatorId": "roomChange.reservationLastUpdateOperatorId",
            },
        ),
        Source(
            "reservationECheckIn",
            "",
            {
                "eventInfo_name": "eventInfo.name", "eventInfo_version": "eventInfo.version",
                "eCheckIn_guestLastName": "eCheckIn.guestLastName",
                "eCheckIn_eCheckInProcessed": "eCheckIn.eCheckInProcessed", "roomCondition": "eCheckIn.roomCondition",
            },
        ),
        Source(
            "reservationEmailConfirmation",
            "",
            {
                "eventInfo_name": "eventInfo.name", "eventInfo_version": "eventInfo.version",
                "reservationLastUpdateTimestamp": "emailConfirmation.reservationLastUpdateTimestamp",
                "reservationLastUpdateOperatorId": "emailConfirmation.reservationLastUpdateOperatorId",
            },
        ),
        Source(
            "folioGuestCreate",
            "folioGuestCreate",
            {
                "arrivalDate": "folioGuestCreate.arrivalDate", "departureDate": "folioGuestCreate.departureDate",
                "reservedRoom": "folioGuestCreate.roomNumber",
            },
        ),
    ),
)

ENTITIES = (
    HOTEL, CONFIRMATION_NUMBER, RESERVATION_STATUS, CUSTOMER, CONTACT, CONTACT_PURPOSE, TRAVEL_AGENT, COMPANY,
    RESERVED_ROOM, RESERVATION_ITEM, RESERVED_INVENTORY, RESERVED_RATE, SPECIAL_REQUEST, CREDIT_CARD, GUARANTEE,
    PAYMENT_METHOD, MEMBERSHIP, LINKED_RESERVATION, FOLIO_SUMMARY, FOLIO_ITEM, ACCOUNT_STATUS, GROUP_BLOCK,
    GROUP_RATE, CLEANING_SCHEDULE, RATE_PLAN_CODE, AMOUNT_OFF_RATE, PERCENT_OFF_RATE, AMOUNT_ABOVE_RATE,
    PERCENT_ABOVE_RATE, AMOUNT_FIXED_RATE, EXTRA_CHARGE, GROUP, HOUSEKEEPING, INVENTORY_BATCH,
    INVENTORY_AVAILABLE_COUNT, INVENTORY_OUT_OF_ORDER_COUNT, INVENTORY_PHYSICAL_COUNT, RATE, RESERVATION,
)

FOREIGN_KEYS = (
    ForeignKey("group", "hotel", "hotel_id"),
    ForeignKey("group", "company", "company_id"),
    ForeignKey("group", "travelAgent", "travelagent_id"),
    ForeignKey("reservation", "hotel", "hotels_id"),
    ForeignKey("reservation", "reservedRoom", "reservedRoom"),
    ForeignKey("reservation", "travelAgent", "associations_travelAgent_id"),
    ForeignKey("reservation", "company", "associations_company_id"),
    ForeignKey("rate", "hotel", "hotel_id"),
    ForeignKey("inventoryBatch", "hotel", "hotel_id"),
    ForeignKey("inventoryAvailableCount", "hotel", "hotel_id"),
    ForeignKey("inventoryOutOfOrderCount", "hotel", "hotel_id"),
    ForeignKey("inventoryPhysicalCount", "hotel", "hotel_id"),
    ForeignKey("housekeepingStatus", "hotel", "hotel_id"),
)

LINKS = (
    Link("reservationConfirmationNumberLink", "reservation", "confirmationNumber", "reservation_id", "confirmation_number_id"),
    Link("reservationStatusLink", "reservation", "reservationStatus", "reservation_id", "status_id"),
    Link("reservationCustomerLink", "reservation", "customer", "reservation_id", "customer_id"),
    Link("reservationEmailAddressLink", "reservation", "contact", "reservation_id", "email_address_id"),
    Link("reservationItemLink", "reservation", "reservationItem", "reservation_id", "reservation_item_id"),
    Link("reservationGuaranteeLink", "reservation", "guarantee", "reservation_id", "guarantee_id"),
    Link("reservationPaymentMethodLink", "reservation", "paymentMethod", "reservation_id", "payment_method_id"),
    Link("reservationLinkedReservationLink", "reservation", "linkedReservation", "reservation_id", "linked_reservation_id"),
    Link("reservationFolioSummaryLink", "reservation", "folioSummary", "reservation_id", "folio_summary_id"),
    Link("reservationCleaningScheduleLink", "reservation", "cleaningSchedule", "reservation_id", "cleaning_schedule_id"),
    Link("groupConfirmationNumberLink", "group", "confirmationNumber", "group_id", "confirmation_number_id"),
    Link("groupContactLink", "group", "contact", "group_id", "contact_id"),
    Link("groupFolioSummaryLink", "group", "folioSummary", "group_id", "folio_summary_id"),
    Link("groupAccountStatusLink", "group", "accountStatus", "group_id", "account_status_id"),
    Link("groupGroupBlockLink", "group", "groupBlock", "group_id", "group_block_id"),
    Link("groupGroupRateLink", "group", "groupRate", "group_id", "group_rate_id"),
    Link("groupPlannerCreditCardLink", "group", "creditCard", "group_id", "credit_card_id"),
    Link("groupGuestCreditCardLink", "group", "creditCard", "group_id", "credit_card_id"),
    Link("groupPaymentMethodLink", "group", "paymentMethod", "group_id", "payment_method_id"),
    Link("groupLoyaltyRewardsMembershipLink", "group", "loyaltyRewardsMembership", "group_id", "loyalty_rewards_membership_id"),
    Link("groupFolioItemLink", "group", "folioItem", "group_id", "folio_item_id"),
    Link("reservationItemReservedInventoryLink", "reservationItem", "reservedInventory", "reservation_item_id", "reserved_inventory_id"),
    Link("reservationItemReservedRateLink", "reservationItem", "reservedRate", "reservation_item_id", "reserved_rate_id"),
    Link("reservationItemReservedRoomLink", "reservationItem", "reservedRoom", "reservation_item_id", "reserved_room_id"),
    Link("reservationItemSpecialRequestLink", "reservationItem", "specialRequest", "reservation_item_id", "special_request_id"),
    Link("rateRatePlanCodeLink", "rate", "ratePlanCode", "rate_id", "rate_plan_code_id"),
    Link("rateAmountOffRateLink", "rate", "amountOffRate", "rate_id", "amount_off_rate_id"),
    Link("ratePercentOffRateLink", "rate", "percentOffRate", "rate_id", "percent_off_rate_id"),
    Link("rateAmountAboveRateLink", "rate", "amountAboveRate", "rate_id", "amount_above_rate_id"),
    Link("ratePercentAboveRateLink", "rate", "percentAboveRate", "rate_id", "percent_above_rate_id"),
    Link("rateAmountFixedRateLink", "rate", "amountFixedRate", "rate_id", "amount_fixed_rate_id"),
    Link("rateExtraChargeLink", "rate", "extraCharge", "rate_id", "extra_charge_id"),
    Link("customerLoyaltyRewardsMembershipLink", "customer", "loyaltyRewardsMembership", "customer_id", "loyalty_rewards_membership_id"),
    Link("customerContactLink", "customer", "contact", "customer_id", "contact_id"),
    Link("contactContactPurposeLink", "contact", "contactPurpose", "contact_id", "contact_purpose_id"),
    Link("guaranteeCreditCardLink", "guarantee", "creditCard", "guarantee_id", "credit_card_id"),
    Link("paymentMethodCreditCardLink", "paymentMethod", "creditCard", "payment_method_id", "credit_card_id"),
    Link("housekeepingStatusConfirmationNumberLink", "housekeepingStatus", "confirmationNumber", "house_keeping_status_id", "confirmation_number_id"),
)

HOSPITALITY = Model(ENTITIES, FOREIGN_KEYS, LINKS, ALIASES)
