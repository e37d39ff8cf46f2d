"""Contact details as native ``Column`` expressions (no UDF)."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.rules import PHONE_REGIONS, PhoneRegion


def email(value: Column) -> Column:
    """Lower-cased email without any whitespace; NULL stays NULL."""
    # \s covers the outer blanks too, so a separate trim would change nothing.
    return F.lower(F.regexp_replace(value, r"\s+", ""))


def _after(digits: Column, size: int) -> Column:
    return digits.substr(F.lit(size + 1), F.length(digits))


def _codes(regions: Iterable[PhoneRegion]) -> str:
    return "|".join(sorted({region.calling_code for region in regions}))


def _lengths(lengths: Iterable[int]) -> str:
    return "|".join(rf"\d{{{n}}}" for n in sorted(lengths))


def _possible(regions: Sequence[PhoneRegion]) -> str:
    """A pattern of a calling code and as many digits as a number there has."""
    return "^(?:" + "|".join(f"{r.calling_code}(?:{_lengths(r.possible_lengths)})" for r in regions) + ")$"


def _stray_trunk(regions: Sequence[PhoneRegion]) -> tuple[str, str]:
    """A pattern of calling code and trunk prefix before a whole number, and ``+`` and the code."""
    trunks = sorted({r.trunk_prefix for r in regions} - {""})
    if not trunks:
        return "^$", ""
    whole = "|".join(
        f"{r.calling_code}{r.trunk_prefix}(?:{_lengths(r.lengths)})" for r in regions if r.trunk_prefix
    )
    # Whether there may be a trunk prefix at all is a quick look at a few places.
    places = "|".join(sorted({rf"\d{{{len(r.calling_code)}}}{r.trunk_prefix}" for r in regions if r.trunk_prefix}))
    codes = "|".join(f"({_codes(r for r in regions if r.trunk_prefix == trunk)}){trunk}" for trunk in trunks)
    # Groups that took no part are empty in the replacement.
    return f"^(?={places})(?=(?:{whole})$)(?:{codes})", "+" + "".join(f"${i + 1}" for i in range(len(trunks)))


def _decimals() -> tuple[str, str]:
    """All decimal digits but the ASCII ones, and the ASCII digit of each; wide plus signs."""
    other = [chr(c) for c in range(0x80, 0x10000) if chr(c).isdecimal()]
    return "".join(other) + "\uff0b\ufe62", "".join(str(int(c)) for c in other) + "++"


_DECIMALS = _decimals()


def dialled(value: Column) -> Column:
    """A phone number as dialled: digits and ``+`` only, digits of any script as ASCII."""
    ascii_digits = F.when(
        F.octet_length(value) > F.char_length(value), F.translate(value, *_DECIMALS)
    ).otherwise(value)
    return F.regexp_replace(ascii_digits, "[^0-9+]+", "")


def called(
    number: Column, digits: Column, country: Column, regions: Sequence[PhoneRegion] = PHONE_REGIONS
) -> Column:
    """Calling code and number that a dialled number stands for, or NULL.

    ``digits`` is ``number`` without plus signs at its ends. After a plus, or the
    country's dial-out prefix, the code was dialled. Others are in the country; they may
    carry its own code without a plus. It is taken for one when the digits are too long
    otherwise, or valid only without it.
    """
    found = F.when(digits.contains("+") | (digits == ""), F.lit(None).cast("string")).when(
        number.startswith("+"), digits
    )
    for region in regions:
        if region.country is None:
            continue
        code, trunk, out = region.calling_code, region.trunk_prefix, region.dial_out_prefix
        carries_code = rf"^{code}\d{{{max(region.lengths) + 1 - len(code)},}}$"
        if region.national_pattern:
            valid = f"(?:{region.national_pattern})$"
            carries_code += f"|^(?!{valid}){code}(?:{trunk}|(?!{trunk})){valid}"
        here = (
            F.when(_goes_abroad(number, region), _after(digits, len(out)))
            .when(
                digits.startswith(code) & digits.rlike(carries_code),
                F.regexp_replace(digits, f"^{code}{trunk}", code) if trunk else digits,
            )
            .otherwise(F.concat(F.lit(code), digits))
        )
        found = found.when(country == region.country, here)
    return found


def _goes_abroad(number: Column, region: PhoneRegion) -> Column:
    out = region.dial_out_prefix
    return number.startswith(out) & ~number.startswith(f"{out}0")


def as_dialled(
    number: Column, country: Column, regions: Sequence[PhoneRegion] = PHONE_REGIONS
) -> Column:
    """What a dialled number becomes when it is no possible one.

    A dial-out prefix and a known calling code with enough digits for a number behind it
    become ``+`` and that code; other numbers get the country's own code.
    """
    written = F.when(number == "", F.lit(None).cast("string")).when(number.startswith("+"), number)
    for region in regions:
        if region.country is None:
            continue
        out = region.dial_out_prefix
        abroad = _goes_abroad(number, region) & number.rlike(rf"^{out}(?:{_codes(regions)})\d{{4}}")
        coded = F.concat(F.lit(f"+{region.calling_code}"), number)
        here = F.when(abroad, F.concat(F.lit("+"), _after(number, len(out)))).otherwise(coded)
        written = written.when(country == region.country, here)
    return written.otherwise(number)


def international(
    code_and_number: Column, written: Column, regions: Sequence[PhoneRegion] = PHONE_REGIONS
) -> Column:
    """``+`` with calling code and number (:func:`called`), else ``written``.

    A trunk prefix behind the code is dropped where a whole number is left. No
    calling code may begin with another.
    """
    plus = F.concat(F.lit("+"), code_and_number)
    without_trunk = F.regexp_replace(code_and_number, *_stray_trunk(regions))
    return (
        F.when(without_trunk.startswith("+"), without_trunk)
        # Mostly both are the same, and nothing needs to be looked at.
        .when((written == plus) | ~code_and_number.rlike(_possible(regions)), written)
        .otherwise(F.coalesce(plus, written))
    )


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use).getItem(0)


def phone(
    value: Column, country: Column, regions: Sequence[PhoneRegion] = PHONE_REGIONS
) -> Column:
    """International form of a phone number in any spelling, using the country as context.

    An empty number is NULL. Numbers with a leading ``+`` keep it and lose a stray
    trunk prefix. In a known country, its dial-out prefix and a known calling code
    become ``+`` and that code; other numbers get the country's own code, even when
    they cannot be a complete number. Anything else is returned as it is.

    The steps are lambdas: they keep the code small that Spark compiles for all columns of
    a feed, which the JVM would leave uncompiled beyond 8000 bytes of a method.
    """

    def normal(number: Column) -> Column:
        found = called(number, F.btrim(number, F.lit("+")), country, regions)
        return _with(found, lambda x: international(x, as_dialled(number, country, regions), regions))

    return _with(dialled(value), normal)


def blank_to_null(value: Column) -> Column:
    """NULL for empty or all-space text, the value itself otherwise."""
    return F.when(F.trim(value) != "", value)


def all_present(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in columns])
