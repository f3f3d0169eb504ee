"""Text to typed columns. Text that does not fit gives NULL, never an error.

Casts run on reshaped text rather than through a chain of date formatters: a cast that does not
fit is a cheap NULL, while a formatter that does not fit raises inside the task for each value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that mean "no value" and words that mean yes or no.
MISSING_WORDS = ("", "null", "none", "n/a")
TRUE_WORDS = ("true", "t", "yes", "y", "1", "on")
FALSE_WORDS = ("false", "f", "no", "n", "0", "off")
CURRENCY_SIGNS = "$€£,"

# Texts that are a JSON number, or a JSON text of the same signs.
_NUMBER_LIKE = r"^-?[0-9.]+([eE][-+]?[0-9]+)?$"
_LAST_EPOCH_SECOND = 253402300799  # the end of year 9999


def to_text(text: Column) -> Column:
    """Trimmed text; a word for "no value" gives NULL. The other functions expect such text."""
    trimmed = F.trim(text)
    # The words are short; longer text needs no case folding.
    return F.when((F.octet_length(trimmed) > 4) | ~F.lower(trimmed).isin(*MISSING_WORDS), trimmed)


def _whole_number(clean: Column, kind: str) -> Column:
    """Exact whole numbers first; text with a point is cut towards zero."""
    plain = F.translate(clean, ",", "")
    # A cast of a decimal to a whole type cuts towards zero.
    wide = F.coalesce(plain.try_cast("decimal(38,12)"), plain.try_cast("double").try_cast("decimal(38,12)"))
    return F.coalesce(
        plain.try_cast(kind),
        F.when(plain.contains("."), wide.try_cast(kind)),
    )


def to_int(clean: Column) -> Column:
    return _whole_number(clean, "int")


def to_long(clean: Column) -> Column:
    return _whole_number(clean, "bigint")


def to_decimal(clean: Column, precision: int = 12, scale: int = 2) -> Column:
    kind = f"decimal({precision},{scale})"
    return F.translate(clean, CURRENCY_SIGNS, "").try_cast(kind)


def to_double(clean: Column) -> Column:
    return clean.try_cast("double")


def to_boolean(clean: Column) -> Column:
    word = F.lower(clean)
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))


# Accepted date shapes in the order tried. Each reshapes to year-month-day.
DATE_SHAPES = (
    (r"^(\d{4})-(\d{1,2})-(\d{1,2})$", "$1-$2-$3"),
    (r"^(\d{4})/(\d{1,2})/(\d{1,2})$", "$1-$2-$3"),
    (r"^(\d{1,2})-(\d{1,2})-(\d{4})$", "$3-$2-$1"),
    (r"^(\d{1,2})/(\d{1,2})/(\d{4})$", "$3-$2-$1"),
    (r"^(\d{1,2})-(\d{1,2})-(\d{4})$", "$3-$1-$2"),
    (r"^(\d{1,2})/(\d{1,2})/(\d{4})$", "$3-$1-$2"),
    (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
    (r"^(\d{4}-\d{2}-\d{2})[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|[+-]\d{2}:?\d{2})?$", "$1"),
)


def _reshaped(text: Column, shapes, kind: str) -> Column:
    return F.coalesce(
        *[F.when(text.rlike(shape), F.regexp_replace(text, shape, form).try_cast(kind)) for shape, form in shapes]
    )


def to_date(clean: Column) -> Column:
    return _reshaped(clean, DATE_SHAPES, "date")


_CLOCK = r"(\d{1,2}:\d{1,2}:\d{1,2})"
# Accepted time shapes in the order tried. The second mends seconds whose
# fraction lost its point, as in ``08:07:19192Z``.
TIME_SHAPES = (
    (rf"^(\d{{4}}-\d{{1,2}}-\d{{1,2}})[T ]{_CLOCK}(\.\d{{1,6}})?$", "$1 $2$3"),
    (r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})(\d{1,6})Z$", "$1.$2"),
    (r"^(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?)Z$", "$1 $2Z"),
    (r"^(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?)([+-]\d{2}):?(\d{2})$", "$1 $2$3:$4"),
    (rf"^(\d{{4}})/(\d{{1,2}})/(\d{{1,2}}) {_CLOCK}$", "$1-$2-$3 $4"),
    (rf"^(\d{{1,2}})-(\d{{1,2}})-(\d{{4}}) {_CLOCK}$", "$3-$2-$1 $4"),
    (rf"^(\d{{1,2}})-(\d{{1,2}})-(\d{{4}}) {_CLOCK}$", "$3-$1-$2 $4"),
    (r"^(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2})$", "$1 $2:00"),
)


def to_timestamp(clean: Column) -> Column:
    """Known shapes first, then a leading date. Digits alone are no time: only a JSON number counts
    seconds, see ``json_text_sql``."""
    lead = F.substring(clean, 1, 10)
    return F.coalesce(
        _reshaped(clean, TIME_SHAPES, "timestamp"),
        F.when(lead.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), lead.try_cast("date").cast("timestamp")),
    )


def to_binary(clean: Column) -> Column:
    """Hex pairs, else base64, else the bytes of the text."""
    letters = F.regexp_replace(clean, "[^A-Za-z0-9+/=]", "")
    b64 = r"^([A-Za-z0-9+/]{4})*([A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?$"
    return (
        F.when(clean.rlike("^([0-9A-Fa-f]{2})+$"), F.unhex(clean))
        .when(letters.rlike(b64) & (letters != ""), F.unbase64(letters))
        .otherwise(F.encode(clean, "UTF-8"))
    )


_PLAIN: dict[str, Callable[[Column], Column]] = {
    "string": lambda clean: clean,
    "int": to_int,
    "bigint": to_long,
    "double": to_double,
    "boolean": to_boolean,
    "date": to_date,
    "timestamp": to_timestamp,
    "binary": to_binary,
}


def kind_counts(kind: str) -> bool:
    """Whether a column of this type reads a JSON number or boolean otherwise than the same text."""
    return kind in ("int", "bigint", "boolean", "timestamp") or kind.startswith("decimal(")


def json_text_sql(leaf: str, kind: str) -> str:
    """SQL for the text of a document's end, so that coercion of the text gives what the JSON value means.

    In a boolean column a JSON number is true unless zero, in a time column it counts seconds since
    1970, and in a number column a JSON boolean is 1 or 0. A JSON text stays as it is. The end must be
    a VARIANT where ``kind_counts``. What a value is matters for few texts; only for these is it asked.
    """
    text = f"try_cast({leaf} AS string)"
    if not kind_counts(kind):
        return text
    if kind == "boolean":
        doubtful, asked = f"t RLIKE '{_NUMBER_LIKE}' AND t NOT IN ('0', '1')", _is_number(leaf)
        value = f"cast(try_variant_get({leaf}, '$', 'double') <> 0 AS string)"
    elif kind == "timestamp":
        doubtful, asked = f"t RLIKE '{_NUMBER_LIKE}'", _is_number(leaf)
        seconds = f"try_variant_get({leaf}, '$', 'decimal(20,6)')"
        value = f"CASE WHEN abs({seconds}) <= {_LAST_EPOCH_SECOND} THEN cast(cast({seconds} AS timestamp) AS string) END"
    else:
        doubtful, asked = "t IN ('true', 'false')", f"schema_of_variant({leaf}) = 'BOOLEAN'"
        value = "CASE t WHEN 'true' THEN '1' ELSE '0' END"
    return f"get(transform(array({text}), t -> CASE WHEN {doubtful} AND {asked} THEN {value} ELSE t END), 0)"


def _is_number(leaf: str) -> str:
    return f"schema_of_variant({leaf}) <> 'STRING'"


def from_text(clean: Column, kind: str) -> Column:
    """Text already through ``to_text`` to a type given as its SQL name, such as ``decimal(12,2)``."""
    if kind.startswith("decimal("):
        precision, scale = (int(n) for n in kind[8:-1].split(","))
        return to_decimal(clean, precision, scale)
    if kind not in _PLAIN:
        raise ValueError(f"no coercion to {kind!r}")
    return _PLAIN[kind](clean)


def coerce(text: Column, kind: str) -> Column:
    """Any text to a type."""
    return from_text(to_text(text), kind)
