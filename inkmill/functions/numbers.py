"""Numbers read as Vietnamese words, and roman numerals."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
DIGITS = ["không", "một", "hai", "ba", "bốn", "năm", "sáu", "bảy", "tám", "chín"]
ROMAN = {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}
#: Roman numerals are spelled up to this.
ROMAN_LIMIT = 20
LARGEST = 10**12 - 1


@cache
def small_words() -> tuple[str, ...]:
    """Readings of 0 to 999, by rule."""
    out = list(DIGITS)
    for n in range(10, 100):
        ten, one = n // 10, n % 10
        last = "" if not one else "mốt" if one == 1 and ten > 1 else "lăm" if one == 5 else DIGITS[one]
        out.append(" ".join(filter(None, ["mười" if ten == 1 else DIGITS[ten] + " mươi", last])))
    for n in range(100, 1000):
        rest = n % 100
        out.append(" ".join(filter(None, [DIGITS[n // 100] + " trăm", "lẻ" if 0 < rest < 10 else "", out[rest] if rest else ""])))
    return tuple(out)


def viet(n: int) -> str:
    """The reading of one number, for constants and Python kernels."""
    table = small_words()
    if n < 0:
        return "-" + viet(-n)
    if n < 1000:
        return table[n]
    if n < 10**6:
        rest = n % 1000
        return table[n // 1000] + " nghìn" + (f" không lẻ {table[rest]}" if 0 < rest < 100 else f" {table[rest]}" if rest else "")
    if n < 10**9:
        return table[n // 10**6] + " triệu" + (f" {viet(n % 10**6)}" if n % 10**6 else "")
    if n > LARGEST:
        raise ValueError(f"{n} is too large to read")
    return f"{table[n // 10**9]} tỷ {table[n // 10**6 % 1000]} triệu {table[n // 1000 % 1000]} nghìn {table[n % 1000]}"


def int_to_viet(c: Column) -> Column:
    """Reading of an integer column; null beyond LARGEST."""
    table = F.array(*map(F.lit, small_words()))
    n = F.abs(c.cast("long"))
    of = lambda k: F.element_at(table, (k % 1000 + 1).cast("int"))
    part = lambda d: F.floor(n / d).cast("long")
    rest = n % 1000
    thousand = lambda: F.concat(of(part(1000)), F.lit(" nghìn"), F.when(rest == 0, "").when(rest < 100, F.concat(F.lit(" không lẻ "), of(rest))).otherwise(F.concat(F.lit(" "), of(rest))))
    low = n % 10**6
    words = (
        F.when(n < 1000, of(n))
        .when(n < 10**6, thousand())
        .when(n < 10**9, F.concat(of(part(10**6)), F.lit(" triệu"), F.when(low == 0, "").when(low < 1000, F.concat(F.lit(" "), of(low))).otherwise(F.concat(F.lit(" "), thousand()))))
        .when(n <= LARGEST, F.concat(of(part(10**9)), F.lit(" tỷ "), of(part(10**6)), F.lit(" triệu "), of(part(1000)), F.lit(" nghìn "), of(n)))
    )
    return F.when(c < 0, F.concat(F.lit("-"), words)).otherwise(words)


def roman_to_int(c: Column) -> Column:
    """Value of a roman numeral read from the right, where what is less than the largest so far counts negative;
    0 for anything else. Any order of its letters is read."""
    value = F.create_map(*[x for k, v in ROMAN.items() for x in (F.lit(k), F.lit(v))])
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("top"))

    def step(s: Column, ch: Column) -> Column:
        v = F.element_at(value, ch)
        return F.struct((s.sum + F.when(v < s.top, -v).otherwise(v)).alias("sum"), F.greatest(s.top, v).alias("top"))

    upper = F.upper(c)
    total = F.aggregate(F.split(F.reverse(upper), ""), start, step, lambda s: s.sum)
    return F.when(upper.rlike(r"\A[IVXLCDM]+\z"), total).otherwise(0)


def roman_value(s: str) -> int:
    total = top = 0
    for v in (ROMAN.get(ch, 0) for ch in reversed(s.upper())):
        if not v:
            return 0
        total, top = total + (v if v >= top else -v), max(top, v)
    return total


def ordinal(n: int) -> str:
    return {1: "nhất", 4: "tư"}.get(n) or viet(n)
