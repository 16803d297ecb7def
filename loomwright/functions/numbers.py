"""Numbers rounded and written as Python does: half to even on the exact binary value.

Built-in rounding works on a number's shortest decimal spelling, so 2.675 would
become 2.68 at two places; its binary value lies below the half and gives 2.67.
``format_number`` with a pattern rounds the binary value half to even, in generated
code; only numbers so large that their digits go beyond a double's shortest spelling
are written from their binary fraction.  Where a value is used often it is bound to
a lambda's variable.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Numbers from here on have no more than one decimal and are passed on as they are.
LARGEST = 1e14
#: Numbers from here on are multiples of 2^-16 and may have more digits than their shortest spelling.
LONG = 1e11
_names = count()


def let(value: str, body: Callable[[str], str]) -> str:
    """SQL text of ``body`` with a name for ``value``."""
    name = f"v{next(_names)}"
    return f"transform(array({value}), {name} -> {body(name)})[0]"


def of(value: Column, body: Callable[[str], str]) -> Column:
    """A column from SQL text about ``value``, which is computed once."""
    name = f"v{next(_names)}"
    return F.call_function("transform", F.array(value), F.expr(f"{name} -> {body(name)}"))[0]


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``value``, which is computed once."""
    return F.transform(F.array(value), use)[0]


def with_steps(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with new columns that later steps read as values.

    Expressions of a plain projection are copied into those that use them, which
    grows without bound in a long chain; a generator's aren't.
    """
    keep = [c for c in df.columns if c not in columns]
    made = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*keep, F.explode(F.array(made)).alias("__step")).select(*keep, "__step.*")


def _pattern(places: int, digit: str) -> str:
    return "'0" + ("." + digit * places if places else "") + "'"


def _half(places: int) -> float | None:
    """Half a step, where its binary value is above the half: the formatter takes this one number down."""
    half = float(f"5e-{places + 1}")
    return half if places and round(half, places) > 0 else None


def sql_formatted(x: str, places: int, digit: str) -> str:
    half = _half(places)
    nudged = x if half is None else f"{x} * case when abs({x}) = {half!r}D then 1.5D else 1D end"
    return f"format_number({nudged}, {_pattern(places, digit)})"


def sql_long(x: str, places: int) -> str:
    """SQL text of abs(``x``), from ``LONG`` to ``LARGEST``, with exactly ``places`` decimals."""
    ten = 10**places
    whole, part = f"cast(abs({x}) as bigint)", f"cast((abs({x}) - floor(abs({x}))) * 65536 as bigint) * {ten}"
    up = f"case when {part} % 65536 > 32768 or ({part} % 65536 = 32768 and ({part} div 65536 + {whole} * {ten}) % 2 = 1) then 1 else 0 end"
    rest = f" || '.' || lpad(cast(@ % {ten} as string), {places}, '0')" if places else ""
    return let(f"{whole} * {ten} + {part} div 65536 + {up}", lambda n: f"cast({n} div {ten} as string){rest.replace('@', n)}")


def sql_rounded(x: str, places: int) -> str:
    return f"coalesce(try_cast({sql_formatted(x, places, '0')} as double) + 0D, {x})"


def sql_fixed(x: str, places: int) -> str:
    sign = f"case when {x} < 0 then '-' else '' end"
    return f"(case when abs({x}) < {LONG}D then {sql_formatted(x, places, '0')} when abs({x}) < {LARGEST}D then {sign} || {sql_long(x, places)} end)"


def sql_short(x: str, places: int) -> str:
    text = sql_formatted(x, places, "#")
    long = f"case when {x} < 0 then '-' else '' end || regexp_replace({sql_long(x, places)}, '[.]?0*$', '')" if places else sql_fixed(x, 0)
    return f"(case when abs({x}) < {LONG}D then case when {text} = '-0' then '0' else {text} end when abs({x}) < {LARGEST}D then {long} end)"


def sql_text(x: str) -> str:
    plain = f"'0.0{'#' * 24}'"
    power = f"lower(format_number({x}, '0.{'#' * 16}E00'))"
    return (
        f"(case when {x} = 0 or (abs({x}) >= 1e-3D and abs({x}) < 1e7D) then cast({x} as string) when abs({x}) >= 1e-4D and abs({x}) < 1e16D then format_number({x}, {plain}) "
        f"when abs({x}) < 1e-4D then {power} when abs({x}) < double('Infinity') then replace({power}, 'e', 'e+') else lower(replace(cast({x} as string), 'Infinity', 'inf')) end)"
    )


def sql_spellings(x: str) -> str:
    def written(p: str) -> str:
        three, two = f"{p}.a", f"{p}.b"
        every = [
            sql_short(x, 4), sql_text(three), sql_text(two), sql_fixed(three, 1), sql_short(two, 2), sql_short(three, 3),
            f"case when {three} = floor({three}) then cast(cast({three} as bigint) as string) end",
        ]
        return f"array_distinct(array_compact(array({', '.join(every)})))"

    return let(f"struct({sql_rounded(x, 3)} as a, {sql_rounded(x, 2)} as b)", written)


def _double(value: Column) -> Column:
    return value.cast("double")


def round_exact(value: Column, places: int) -> Column:
    """``value`` rounded to ``places`` decimals, half to even on its binary value.

    Away from a half the nearest whole number of steps is sure, and the quotient of
    two whole numbers is the double nearest to it; only the rest is written and read.
    """
    x = _double(value)
    steps, ten = x * float(10**places), float(10**places)
    sure = (F.abs(steps) < LONG) & (F.abs(steps - F.rint(steps)) < 0.4999)
    half = _half(places)
    nudged = x if half is None else x * F.when(F.abs(x) == half, 1.5).otherwise(1.0)
    written = F.call_function("format_number", nudged, F.lit("0." + "0" * places if places else "0"))
    # Infinities aren't read back and stay as they are; adding 0 makes a negative 0 positive.
    exact = F.coalesce(written.try_cast("double") + 0.0, x)
    return F.when(sure, F.rint(steps) / ten + 0.0).otherwise(exact)


def fixed_text(value: Column, places: int) -> Column:
    """``value`` with exactly ``places`` decimals."""
    return of(_double(value), lambda x: sql_fixed(x, places))


def short_text(value: Column, places: int) -> Column:
    """``value`` rounded to ``places`` decimals, without trailing zeros; nothing below half a step is 0."""
    return of(_double(value), lambda x: sql_short(x, places))


def float_text(value: Column) -> Column:
    """``value`` as Python writes a float: 10.0, 0.0001, 1e-05, 1e+16."""
    return of(_double(value), sql_text)


def spellings(value: Column) -> Column:
    """The ways in which a text may spell a number: 2, 2.0; 0.125, 0.12, 0.1."""
    return of(_double(value), sql_spellings)
