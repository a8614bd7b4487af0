"""Column expressions that turn raw text (or typed) columns into clean values.

Text that cannot be read becomes null, never an error. Columns that already
have a numeric or time type skip the text steps.
"""

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tillroll.schema import PRICE_TYPE

# Fixed value: the characters that count as white space at the ends of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# What Java reads as a number, without type suffixes and hex floats (1d, 0x1p3). A cast that fails costs
# twenty times as much as one that doesn't, so text that it can't read is kept from it.
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_WHOLE = "^[+-]?[0-9]+$"
_YEAR_FIRST = r"^\d{4}-"
# Month-first dates as spreadsheets export them, e.g. 12/1/2010 8:26.
_US_DATE = r"^(\d{1,2})/(\d{1,2})/(\d{4})"
# Year-first dates with slashes, and days before the month's name: 2011/01/05, 5-Jan-2011, 05 January 2011 8:26.
_SLASHED = r"^(\d{4})/(\d{1,2})/(\d{1,2})"
_NAMED_MONTH = r"^(\d{1,2})[ -]([A-Za-z]{3,9})\.?[ -](\d{4})"
# Fixed value: English months, the first three letters of each.
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"


def strip(column: Column) -> Column:
    """Remove white space at both ends; inner spaces and case stay.

    One function and no test of whether there is anything to remove: reading a
    line strips eight texts, and with tests the generated method outgrows the
    8,000 bytes up to which the JVM compiles.
    """
    return F.btrim(column.cast("string"), F.lit(WHITESPACE))


def is_blank(column: Column) -> Column:
    """True for null and for text that is empty or only white space."""
    return column.isNull() | (strip(column) == "")


#: State of a value that is given but cannot be read, and of a number that its type cannot hold.
UNREADABLE, BEYOND = "unreadable", "beyond"

Steps = list[dict[str, Column]]


def _holds(dtype: T.DataType, whole_digits: int, scale: int) -> bool:
    """Whether every value of a numeric type fits into whole_digits before and scale digits behind the point."""
    if isinstance(dtype, T.DecimalType):
        return dtype.precision - dtype.scale <= whole_digits and dtype.scale <= scale
    digits = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
    return digits.get(type(dtype), whole_digits + 1) <= whole_digits


def _number_steps(name: str, dtype: T.DataType) -> Steps:
    """``n_name``, what may be a number, and ``d_name``, the same as DOUBLE."""
    number = F.col(f"n_{name}").try_cast("double").alias(f"d_{name}")
    if isinstance(dtype, T.NumericType):
        return [{}, {f"n_{name}": F.col(f"`{name}`")}, {f"d_{name}": number}]
    text = F.col(f"t_{name}")
    plain = F.when(text.rlike(_NUMBER), text)
    return [{f"t_{name}": strip(F.col(f"`{name}`"))}, {f"n_{name}": plain}, {f"d_{name}": number}]


def _with_state(name: str, dtype: T.DataType, value: Column) -> Steps:
    """``value_name`` and ``state_name``: null, UNREADABLE or BEYOND."""
    double, found = F.col(f"d_{name}"), F.col(f"value_{name}")
    given = F.col(f"`{name}`").isNotNull() if isinstance(dtype, T.NumericType) else F.col(f"t_{name}") != ""
    finite = ~F.isnan(double) & (F.abs(double) < float("inf"))
    state = F.when(found.isNull() & given, F.when(finite, BEYOND).otherwise(UNREADABLE))
    return [{f"value_{name}": value}, {f"state_{name}": state}]


def whole_number_steps(name: str, dtype: T.DataType) -> Steps:
    """BIGINT; fractions are cut off."""
    if isinstance(dtype, T.IntegralType):
        return [{f"value_{name}": F.col(f"`{name}`").cast("bigint"), f"state_{name}": F.lit(None).cast("string")}]
    number = F.col(f"n_{name}")
    if isinstance(dtype, T.DecimalType):
        direct = [number.try_cast("bigint")]
    elif isinstance(dtype, T.NumericType):
        direct = []
    else:
        direct = [F.when(number.rlike(_WHOLE), number).try_cast("bigint")]
    return _number_steps(name, dtype) + _with_state(name, dtype, F.coalesce(*direct, F.col(f"d_{name}").try_cast("bigint")))


def price_steps(name: str, dtype: T.DataType) -> Steps:
    """PRICE_TYPE; a number that would round to nothing is beyond it."""
    if _holds(dtype, PRICE_TYPE.precision - PRICE_TYPE.scale, PRICE_TYPE.scale):
        return [{f"value_{name}": F.col(f"`{name}`").cast(PRICE_TYPE), f"state_{name}": F.lit(None).cast("string")}]
    price = F.col(f"p_{name}")
    held = F.when((price != 0) | (F.col(f"d_{name}") == 0), price)
    return _number_steps(name, dtype) + [{f"p_{name}": F.col(f"n_{name}").try_cast(PRICE_TYPE)}] + _with_state(name, dtype, held)


def timestamp_steps(name: str, dtype: T.DataType) -> Steps:
    """TIMESTAMP_NTZ from ISO, month-first or named-month text.

    ISO text, which is the rule, is read without looking at other notations.
    """
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return [{f"value_{name}": F.col(f"`{name}`").cast("timestamp_ntz"), f"state_{name}": F.lit(None).cast("string")}]
    text, iso = F.col(f"t_{name}"), F.col(f"i_{name}")
    # As the function of an array the other notations are no part of generated code, which they would make too long to be compiled.
    other = F.transform(F.array(text), lambda t: F.coalesce(_iso_text(t), t).try_cast("timestamp_ntz"))
    state = F.when(F.col(f"value_{name}").isNull() & (text != ""), UNREADABLE)
    return [
        {f"t_{name}": strip(F.col(f"`{name}`"))},
        {f"i_{name}": F.when(text.rlike(_YEAR_FIRST), text).try_cast("timestamp_ntz")},
        {f"o_{name}": F.when(iso.isNull(), F.element_at(other, 1))},
        {f"value_{name}": F.coalesce(iso, F.col(f"o_{name}"))},
        {f"state_{name}": state},
    ]


#: How each raw column that isn't text is read.
READERS = {
    "Quantity": whole_number_steps,
    "InvoiceDate": timestamp_steps,
    "UnitPrice": price_steps,
    "CustomerID": whole_number_steps,
}


def with_values(lines: DataFrame) -> DataFrame:
    """The lines with ``value_X`` and ``state_X`` of each column in READERS.

    A state is null where the value was read or the field is blank. Each step
    of reading is a column of its own, which the next step uses by name: the
    optimizer does not copy what is used twice into both places, so that no
    text is stripped, searched or read more than once.
    """
    steps = [read(name, lines.schema[name].dataType) for name, read in READERS.items()]
    for depth in range(max(map(len, steps))):
        lines = lines.withColumns({k: v for own in steps for k, v in (own[depth] if depth < len(own) else {}).items()})
    return lines


def _iso_text(text: Column) -> Column:
    """Year-first text for month-first, slashed and named-month dates; other text gives null."""
    iso = F.when(text.rlike(_US_DATE), F.regexp_replace(text, _US_DATE, "$3-$1-$2"))
    slashed = F.when(text.rlike(_SLASHED), F.regexp_replace(text, _SLASHED, "$1-$2-$3"))
    # Not F.lower: the first use of that in a JVM sets up tables of all alphabets, for seconds.
    letters = F.translate(F.substring(F.regexp_extract(text, _NAMED_MONTH, 2), 1, 3), _MONTHS.upper(), _MONTHS)
    place = F.instr(F.lit(_MONTHS), letters)
    named = F.when(
        text.rlike(_NAMED_MONTH) & (F.pmod(place, F.lit(3)) == 1),
        F.concat(
            F.regexp_extract(text, _NAMED_MONTH, 3),
            F.lit("-"),
            ((place + 2) / 3).cast("int").cast("string"),
            F.lit("-"),
            F.regexp_extract(text, _NAMED_MONTH, 1),
            F.regexp_replace(text, _NAMED_MONTH, ""),
        ),
    )
    return F.coalesce(iso, slashed, named)
