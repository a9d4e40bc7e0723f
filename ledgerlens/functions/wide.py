"""Exact money beyond DECIMAL(38,18), for the rows that need it.

A wide value is plain decimal text with 18 decimals. Factors may have 56 whole digits and 20
decimals, as the source's 256-bit type has; digits after the 20th decimal are cut there too.
Products are exact, then rounded half away from zero. Inside, a number is an array of limbs of
nine digits, lowest first, signed alike; nine products of two limbs fit a BIGINT. Values of 38 digits never take this path: plans compute
them with ``usd_value`` and call these functions under a condition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.functions.decimals import AMOUNT, usd_value

LIMB_DIGITS = 9
#: Whole digits and decimals of a factor, and of a wide value: a product of two factors fits.
FACTOR = (56, 20)
VALUE = (112, 18)
VALUE_LIMBS = -(-sum(VALUE) // LIMB_DIGITS)

_NUMBER = r"^\s*([+-]?)(\d*)\.?(\d*)(?:[eE]([+-]?\d{1,4}))?\s*$"
_LIMB = "bigint"
_TOTAL = "decimal(38,0)"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def _zeros(count: Column) -> Column:
    return F.repeat(F.lit("0"), F.greatest(count, F.lit(0)))


def _limb_count(size: tuple[int, int]) -> int:
    return -(-sum(size) // LIMB_DIGITS)


def _padded(number: Column, size: tuple[int, int]) -> Column:
    """Sign and zero-padded digits of a number's text, a whole number of limbs long; NULL if unreadable or too large."""
    whole_digits, decimals = size

    def placed(text: Column) -> Column:
        part = [F.regexp_extract(text, _NUMBER, i) for i in range(1, 5)]
        shift = F.when(part[3] == "", F.lit(0)).otherwise(part[3].try_cast("int"))
        return F.struct(
            F.when(part[0] == "-", F.lit(-1)).otherwise(F.lit(1)).cast(_LIMB).alias("sign"),
            F.concat(part[1], part[2]).alias("digits"),
            (F.length(part[1]) + shift).alias("point"),
        )

    def cut(number: Column) -> Column:
        digits, point = number["digits"], F.greatest(number["point"], F.lit(0))
        whole = F.ltrim(F.rpad(F.substring(digits, F.lit(1), point), point, F.lit("0")), F.lit("0"))
        rest = F.concat(_zeros(-number["point"]), F.substring(digits, point + 1, F.length(digits)))
        field = F.concat(
            _zeros(F.lit(_limb_count(size) * LIMB_DIGITS - decimals) - F.length(whole)),
            whole,
            F.rpad(rest, F.lit(decimals), F.lit("0")),
        )
        fits = (F.length(digits) > 0) & (F.length(whole) <= whole_digits)
        return F.when(fits, F.struct(number["sign"].alias("sign"), field.alias("field")))

    text = number.cast("string")
    return F.when(text.rlike(_NUMBER), _let(placed(text), cut))


def wide_limbs(number: Column, size: tuple[int, int] = VALUE) -> Column:
    """Signed limbs of a number's text, in units of its last decimal; NULL if unreadable or too large."""
    limbs = _limb_count(size)

    def limb(number: Column, i: Column) -> Column:
        start = F.lit(limbs * LIMB_DIGITS + 1) - (i + 1) * LIMB_DIGITS
        return F.substring(number["field"], start, F.lit(LIMB_DIGITS)).cast(_LIMB) * number["sign"]

    def split(number: Column) -> Column:
        return F.when(number.isNotNull(), F.transform(F.sequence(F.lit(0), F.lit(limbs - 1)), lambda i: limb(number, i)))

    return _let(_padded(number, size), split)


def _carried(limbs: Column, decimals: int, dropped: int = 0, kind: str = _TOTAL) -> Column:
    """Text of non-negative limb sums of type ``kind``, with ``decimals`` decimals after ``dropped`` last digits are left out."""
    base = F.lit(10**LIMB_DIGITS)

    def step(state: Column, limb: Column) -> Column:
        def put(value: Column) -> Column:
            low = F.pmod(value, base.cast(kind))
            whole = F.call_function("div", value, base.cast(_LIMB))
            over = whole if kind == _LIMB else ((value - low).cast(kind) / base.cast("decimal(10,0)")).cast(kind)
            return F.struct(
                over.alias("carry"), F.concat(F.lpad(low.cast("string"), LIMB_DIGITS, "0"), state["text"]).alias("text")
            )

        return _let((limb + state["carry"]).cast(kind), put)

    def shown(state: Column) -> Column:
        digits = F.concat(state["carry"].cast("string"), state["text"])
        kept = F.substring(digits, F.lit(1), F.length(digits) - dropped)
        whole = F.ltrim(F.substring(kept, F.lit(1), F.length(kept) - decimals), F.lit("0"))
        return F.concat(F.when(whole == "", F.lit("0")).otherwise(whole), F.lit("."), F.right(kept, F.lit(decimals)))

    start = F.struct(F.lit(0).cast(kind).alias("carry"), F.lit("").alias("text"))
    return F.aggregate(limbs, start, step, shown)


def _negative(limbs: Column) -> Column:
    """Whether the number is below zero: its carry out of the highest limb is."""
    base = F.lit(10**LIMB_DIGITS).cast("decimal(10,0)")

    def step(carry: Column, limb: Column) -> Column:
        return _let((limb + carry).cast(_TOTAL), lambda v: ((v - F.pmod(v, base)).cast(_TOTAL) / base).cast(_TOTAL))

    return F.aggregate(limbs, F.lit(0).cast(_TOTAL), step) < 0


def wide_text(limbs: Column) -> Column:
    """The wide value of limbs that may have grown past ten digits and differ in sign."""

    def signed(found: Column) -> Column:
        minus = F.transform(found, lambda limb: (-limb).cast(_TOTAL))
        return F.when(_negative(found), F.concat(F.lit("-"), _carried(minus, VALUE[1]))).otherwise(_carried(found, VALUE[1]))

    return F.when(limbs.isNotNull(), _let(F.transform(limbs, lambda limb: limb.cast(_TOTAL)), signed))


#: Last digits of a product that a value has no room for.
_UNUSED = 2 * FACTOR[1] - VALUE[1]


def _product(left: Column, right: Column, use: Callable[[Column, Column], Column]) -> Column:
    """``use(sums, minus)`` of a product's limb sums, half a unit of the last decimal kept added, and its sign."""
    count = _limb_count(FACTOR)

    def product(pair: Column) -> Column:
        a, b = pair["a"], pair["b"]

        def at(k: Column) -> Column:
            first, last = F.greatest(F.lit(0), k - (count - 1)), F.least(k, F.lit(count - 1))
            # Half a unit of the last decimal kept, so that cutting rounds.
            half = F.when(k == (_UNUSED - 1) // LIMB_DIGITS, F.lit(5 * 10 ** ((_UNUSED - 1) % LIMB_DIGITS))).otherwise(F.lit(0))
            pairs = F.sequence(first, last)
            return F.aggregate(pairs, half.cast(_LIMB), lambda total, i: total + F.abs(a[i] * b[k - i]))

        sums = F.transform(F.sequence(F.lit(0), F.lit(2 * count - 2)), at)
        return use(sums, F.exists(a, lambda x: x < 0) != F.exists(b, lambda x: x < 0))

    pair = F.struct(wide_limbs(left, FACTOR).alias("a"), wide_limbs(right, FACTOR).alias("b"))
    return _let(pair, lambda p: F.when(p["a"].isNotNull() & p["b"].isNotNull(), product(p)))


def wide_product(left: Column, right: Column) -> Column:
    """``left * right`` of two numbers or their texts as a wide value; NULL if one is unreadable or too large."""

    def shown(sums: Column, minus: Column) -> Column:
        signed = lambda text: F.when(minus & text.rlike("[1-9]"), F.concat(F.lit("-"), text)).otherwise(text)
        return _let(_carried(sums, VALUE[1], _UNUSED, _LIMB), signed)

    return _product(left, right, shown)


def wide_product_limbs(left: Column, right: Column) -> Column:
    """``wide_limbs(wide_product(left, right))`` without the text between."""
    skipped, cut = divmod(_UNUSED, LIMB_DIGITS)
    base, low, high = F.lit(10**LIMB_DIGITS), F.lit(10**cut), F.lit(10 ** (LIMB_DIGITS - cut))
    start = F.struct(F.lit(0).cast(_LIMB).alias("carry"), F.array().cast(f"array<{_LIMB}>").alias("limbs"))

    def step(state: Column, limb: Column) -> Column:
        def put(value: Column) -> Column:
            carry = F.call_function("div", value, base.cast(_LIMB))
            return F.struct(carry.alias("carry"), F.array_append(state["limbs"], value % base.cast(_LIMB)).alias("limbs"))

        return _let(limb + state["carry"], put)

    def whole(sums: Column) -> Column:
        return F.aggregate(sums, start, step, lambda state: F.array_append(state["limbs"], state["carry"]))

    def cut_off(limbs: Column, sign: Column) -> Column:
        def limb(i: Column) -> Column:
            upper = (limbs[i + skipped + 1] % low.cast(_LIMB)) * high.cast(_LIMB)
            return (F.call_function("div", limbs[i + skipped], low.cast(_LIMB)) + upper) * sign

        return F.transform(F.sequence(F.lit(0), F.lit(VALUE_LIMBS - 1)), limb)

    def value(sums: Column, minus: Column) -> Column:
        sign = F.when(minus, F.lit(-1)).otherwise(F.lit(1)).cast(_LIMB)
        return _let(whole(sums), lambda limbs: cut_off(limbs, sign))

    return _product(left, right, value)


def _beyond(amount: Column, price: Column) -> Column:
    """Whether both numbers (or texts) are there and ``usd_value`` of them is not."""
    fits = usd_value(amount.try_cast(AMOUNT), price.try_cast(AMOUNT)).isNotNull()
    return amount.isNotNull() & price.isNotNull() & ~fits


def wide_usd(amount: Column, price: Column) -> Column:
    """The USD value as a wide value where ``usd_value`` of the two numbers (or texts) has none."""
    return F.when(_beyond(amount, price), wide_product(amount, price))


def wide_usd_limbs(amount: Column, price: Column) -> Column:
    """``wide_limbs(wide_usd(amount, price))`` without the text between."""
    return F.when(_beyond(amount, price), wide_product_limbs(amount, price))


def overflow_reason(amount: Column, price: Column) -> Column:
    """Why two present numbers (or texts) have no USD value of 38 digits; NULL if they have one or one is NULL."""
    small_amount, small_price = amount.try_cast(AMOUNT), price.try_cast(AMOUNT)
    readable = [_padded(value, FACTOR).isNotNull() for value in (amount, price)]
    return F.when(
        amount.isNotNull() & price.isNotNull() & usd_value(small_amount, small_price).isNull(),
        F.when(small_amount.isNull(), F.when(readable[0], F.lit("amount_too_large")).otherwise(F.lit("amount_unreadable")))
        .when(small_price.isNull(), F.when(readable[1], F.lit("price_too_large")).otherwise(F.lit("price_unreadable")))
        .otherwise(F.lit("product_too_large")),
    )
