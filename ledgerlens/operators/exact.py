"""Sums that neither overflow nor lose a digit.

A ``decimal(38,0)`` sum stops at 38 digits, though the numbers it adds may have
38 digits each. Here numbers below 10^``PLAIN_DIGITS`` (wei amounts never reach
it) are summed as they are, larger ones in two limbs, ``hi * 10^20 + lo``, and
of floats the fractions in steps of 2^-62. All of these are plain sums with room
for 10^12 rows and more: every aggregate keeps its map-side combine, sums can be
summed again, nothing depends on the order of the rows, and a limb costs a row
one comparison unless it is needed. Carries are done once, where a sum is shown.

Columns are given as SQL text (a name, mostly): the expressions are large, and
as text they reach the planner in one call each.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Digits of ``lo``; numbers of fewer digits than PLAIN_DIGITS are not cut.
LIMB_DIGITS, PLAIN_DIGITS = 20, 26
#: A fraction is counted in steps of 2^-FRACTION_BITS.
FRACTION_BITS = 62
BASE, UNIT = 10**LIMB_DIGITS, 1 << FRACTION_BITS
_VARS = count()


def _big(sql: str) -> str:
    return f"CAST({sql} AS DECIMAL(38,0))"


def _n(number: int) -> str:
    return _big(f"{number}BD")


def _double(number: int) -> str:
    return f"CAST('{number}' AS DOUBLE)"


def _div(a: str, b: int) -> str:
    """Quotient toward zero, as a decimal (it has to fit a long)."""
    return _big(f"({a}) div {_n(b)}")


def _below(c: str, limit: int) -> str:
    """Whether a decimal is nearer to 0 than ``limit`` (``abs`` and a unary
    minus round decimals to 34 digits)."""
    return f"(({c}) < {_n(limit)} AND ({c}) > {_n(-limit)})"


def _total(c: str) -> str:
    return f"coalesce({_big(f'sum({c})')}, {_n(0)})"


def _term(c: str) -> str:
    """Numbers enter a sum with room for 10^10 times the largest of them."""
    return f"CAST({c} AS DECIMAL(28,0))"


def _whole_limbs(c: str) -> str:
    plain = _below(c, 10**PLAIN_DIGITS)
    small = f"CASE WHEN {plain} THEN {_term(c)} END"
    high = f"CASE WHEN NOT {plain} THEN {_term(_div(c, BASE))} END"
    low = f"CASE WHEN NOT {plain} THEN {_term(f'({c}) % {_n(BASE)}')} END"
    return f"'plain', {_total(small)}, 'hi', {_total(high)}, 'lo', {_total(low)}"


def exact_sum(c: str) -> Column:
    """Aggregate: the sum of whole numbers (``decimal(38,0)`` or integers)."""
    return F.expr(f"named_struct({_whole_limbs(_big(c))})")


def exact_float_sum(c: str) -> Column:
    """Aggregate: the sum of doubles, every bit of them. Fractions finer than
    2^-62 (a full mantissa below 0.001), numbers from 2^126 on, infinite ones
    and nan stop the job."""
    # From 2^53 on a double has no fraction; below, a long holds its whole part.
    whole = f"CASE WHEN abs({c}) < {_double(1 << 53)} THEN CAST(try_cast({c} AS BIGINT) AS DOUBLE) ELSE {c} END"
    steps = f"(({c}) - {whole}) * {_double(UNIT)}"
    fine = f"CASE WHEN {steps} = floor({steps}) THEN try_cast({steps} AS BIGINT) END"
    fine = f"coalesce({fine}, CAST(raise_error(concat('a fraction too fine to add: ', {c})) AS BIGINT))"
    fraction = _total(f"CASE WHEN {steps} != 0 THEN {_term(fine)} END")
    return F.expr(f"named_struct({_whole_limbs(_whole(c))}, 'fr', {fraction})")


def again(total: str, floats: bool = False) -> Column:
    """Aggregate: the sum of such sums."""
    parts = [f"'{k}', {_total(f'({total}).{k}')}" for k in ("plain", "hi", "lo", *(["fr"] if floats else []))]
    return F.expr(f"named_struct({', '.join(parts)})")


def _whole(c: str) -> str:
    half = _double(1 << 63)
    high = f"try_cast(floor(abs({c}) / {half}) AS BIGINT)"
    rest = f"try_cast(abs({c}) - CAST({high} AS DOUBLE) * {half} AS BIGINT)"
    product = _big(f"CAST({high} AS DECIMAL(19,0)) * CAST({1 << 63}BD AS DECIMAL(19,0))")
    wide = _big(f"({product} + {_big(rest)}) * CASE WHEN {c} < 0 THEN -1 ELSE 1 END")
    small = _big(f"try_cast({c} AS BIGINT)")
    out = f"CASE WHEN abs({c}) < {half} THEN {small} WHEN abs({c}) < {_double(1 << 126)} THEN {wide} END"
    failed = f"raise_error(concat('not a number that has a whole part of 38 digits: ', {c}))"
    return f"coalesce({out}, {_big(failed)})"


def whole_part(c: str) -> Column:
    """Python ``int(float)``: the whole part of a double, digit for digit. From
    2^63 on a double is cut into multiples of 2^63 and a rest, both exact."""
    return F.expr(_whole(c))


# --- what a sum is -------------------------------------------------------------------


def _let(value: str, use: Callable[[str], str]) -> str:
    """``use`` of a value that is computed, and written into the plan, once."""
    name = f"v{next(_VARS)}"
    return f"element_at(transform(array({value}), {name} -> {use(name)}), 1)"


def _uncut(total: str, floats: bool) -> str:
    """Whether no number had to be cut, so that the plain sum is the sum."""
    return "(" + " AND ".join(f"({total}).{k} = 0" for k in ("hi", "lo", *(["fr"] if floats else []))) + ")"


def _floored(total: str, floats: bool = False) -> str:
    """struct(hi, lo, fr), carries done: lo and fr are never negative."""
    fr = f"({total}).fr" if floats else _n(0)

    def carry_fraction(x: str) -> str:
        lo = _big(f"({total}).lo + ({total}).plain % {_n(BASE)} + {_div(f'{fr} - {x}', UNIT)}")
        return _let(f"named_struct('lo', {lo}, 'fr', {x})", carry_low)

    def carry_low(x: str) -> str:
        low = _big(f"pmod({x}.lo, {_n(BASE)})")
        hi = _big(f"({total}).hi + {_div(f'({total}).plain', BASE)} + {_div(f'{x}.lo - {low}', BASE)}")
        return f"named_struct('hi', {hi}, 'lo', {low}, 'fr', {x}.fr)"

    return _let(_big(f"pmod({fr}, {_n(UNIT)})"), carry_fraction)


def order_key(total: str) -> Column:
    """What orders as the sums do."""
    return F.expr(_let(_floored(total), lambda x: f"named_struct('hi', {x}.hi, 'lo', {x}.lo)"))


def _digits(x: str) -> str:
    """Decimal text of (hi, lo, fr) as ``_floored`` gives them: turned to a
    number without a sign first, whole limbs and then the fraction."""
    negative = f"({x}.hi < 0)"

    def whole(y: str) -> str:
        hi = _big(f"{y}.hi - CASE WHEN {y}.less AND {y}.lo = 0 THEN 1 ELSE 0 END")
        lo = f"CASE WHEN NOT {y}.less THEN {y}.lo WHEN {y}.lo = 0 THEN {_n(BASE - 1)} ELSE {_big(f'{y}.lo - 1')} END"
        return _let(f"named_struct('hi', {hi}, 'lo', {lo}, 'fr', {y}.fr)", text)

    def text(z: str) -> str:
        lo = f"CAST({z}.lo AS STRING)"
        both = f"concat(CAST({z}.hi AS STRING), lpad({lo}, {LIMB_DIGITS}, '0'))"
        return f"concat(CASE WHEN {z}.hi = 0 THEN {lo} ELSE {both} END, {_fraction(f'{z}.fr')})"

    up = _big(f"{_n(0)} - {x}.hi - CASE WHEN {x}.lo > 0 THEN 1 ELSE 0 END")
    low = _big(f"{_n(BASE)} - {x}.lo")
    part = _big(f"{_n(UNIT)} - {x}.fr")
    turned = (
        f"named_struct('hi', CASE WHEN {negative} THEN {up} ELSE {x}.hi END, "
        f"'lo', CASE WHEN {negative} AND {x}.lo > 0 THEN {low} ELSE {x}.lo END, "
        f"'fr', CASE WHEN {negative} AND {x}.fr > 0 THEN {part} ELSE {x}.fr END, "
        f"'less', {negative} AND {x}.fr > 0)"
    )
    return f"concat(CASE WHEN {negative} THEN '-' ELSE '' END, {_let(turned, whole)})"


def _fraction(fr: str) -> str:
    """``.`` and digits; nothing for 0. 2^62 divides 10^62, so 64 digits are all."""

    def more(x: str) -> str:
        scaled = _big(f"CAST({x}.rest AS DECIMAL(19,0)) * CAST({10**16}BD AS DECIMAL(17,0))")
        return _let(scaled, lambda y: f"named_struct('text', concat({x}.text, lpad(CAST({_div(y, UNIT)} AS STRING), 16, '0')), 'rest', {_big(f'{y} % {_n(UNIT)}')})")

    state = f"named_struct('text', '.', 'rest', {fr})"
    for _ in range(4):
        state = _let(state, more)
    return f"CASE WHEN {fr} = 0 THEN '' ELSE {_let(state, lambda x: f'{x}.text')} END"


def _text(total: str, floats: bool = False) -> str:
    return f"CASE WHEN {_uncut(total, floats)} THEN CAST(({total}).plain AS STRING) ELSE {_let(_floored(total, floats), _digits)} END"


def as_text(total: str, floats: bool = False) -> Column:
    """The sum as decimal text of any length, digit for digit."""
    return F.expr(_text(total, floats))


def _fitting(total: str, dtype: str, message: str) -> str:
    return _let(_text(total), lambda x: f"coalesce(try_cast({x} AS {dtype}), CAST(raise_error(concat('{message}: ', {x})) AS {dtype}))")


def as_decimal(total: str) -> Column:
    """The sum as ``decimal(38,0)``; one of more digits stops the job."""
    fits = _fitting(total, "DECIMAL(38,0)", "a total of more than 38 digits")
    return F.expr(f"CASE WHEN {_uncut(total, False)} THEN ({total}).plain ELSE {fits} END")


def as_long(total: str) -> Column:
    """The sum as ``bigint``; one beyond it stops the job."""
    short = f"{_uncut(total, False)} AND {_below(f'({total}).plain', 1 << 63)}"
    return F.expr(f"CASE WHEN {short} THEN CAST(({total}).plain AS BIGINT) ELSE {_fitting(total, 'BIGINT', 'a total beyond 64 bits')} END")


def as_double(total: str, floats: bool = False) -> Column:
    """The double nearest to the sum."""
    return F.expr(f"CASE WHEN {_uncut(total, floats)} THEN CAST(({total}).plain AS DOUBLE) ELSE CAST({_text(total, floats)} AS DOUBLE) END")
