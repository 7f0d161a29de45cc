"""Rounding, proportions and their confidence bounds."""

from __future__ import annotations

from cohortscope.functions import literal

Z_95 = 1.96

# Splits a double into two halves of 26 bits (2**27 + 1), which makes products exact.
HALF_WORD = "134217729D"


def rounded(value: str, digits: int) -> str:
    """Scale, round to the nearest even integer, scale back."""
    unit = f"{10**digits}D"
    return f"rint(({value}) * {unit}) / {unit}"


def decimal_units(value: str, digits: int) -> str:
    """A non-negative column in units of 10**-digits, as a whole double.

    The exact binary value decides, and exact ties go to the even unit: what Python's
    ``round`` and ``format`` do. ``bround`` works on the shortest decimal text, which
    turns values just beside a tie into ties. The distance from the middle between two
    units is the rounded product plus its exact error, taken from the two halves.
    """
    unit, twice = f"{10**digits}D", f"{2 * 10**digits}D"
    below = f"CAST(floor({value} * {unit}) AS DOUBLE)"
    high = f"({value} * {HALF_WORD} - ({value} * {HALF_WORD} - {value}))"
    error = f"(({high} * {twice} - {value} * {twice}) + ({value} - {high}) * {twice})"
    past = f"(({value} * {twice} - (2 * {below} + 1)) + {error})"
    step = f"CASE WHEN {past} > 0 THEN 1D WHEN {past} < 0 THEN 0D ELSE pmod({below}, 2D) END"
    return f"({below} + {step})"


def rounded_exactly(value: str, digits: int) -> str:
    """Round a non-negative column to the nearest decimal, ties to even."""
    return f"{decimal_units(value, digits)} / {10**digits}D"


def tenths(units: str) -> str:
    """Text with one decimal place of a column that counts tenths."""
    return f"concat(CAST({units} div 10 AS STRING), '.', CAST({units} % 10 AS STRING))"


def wilson(successes: str, trials: str, z: float = Z_95, strict: bool = True) -> str:
    """Struct (lower, upper, center) of the Wilson score interval.

    Impossible counts fail the query, or give null bounds with ``strict=False``.
    """
    k, n = f"CAST({successes} AS DOUBLE)", f"CAST({trials} AS DOUBLE)"
    z2, half_z2, quarter_z2 = (literal(z * z / d) for d in (1.0, 2.0, 4.0))
    center = f"(({k} + {half_z2}) / ({n} + {z2}))"
    half = f"(({literal(z)} / ({n} + {z2})) * sqrt({k} * ({n} - {k}) / {n} + {quarter_z2}))"
    interval = (
        f"named_struct('lower', greatest(0D, {center} - {half}), "
        f"'upper', least(1D, {center} + {half}), 'center', {center})"
    )
    possible = f"{trials} > 0 AND {successes} >= 0 AND {successes} <= {trials}"
    if not strict:
        return f"CASE WHEN {possible} THEN {interval} END"
    return (
        f"CASE WHEN {possible} THEN {interval} "
        f"WHEN {trials} <= 0 THEN raise_error(concat('trials must be > 0, got ', {trials})) "
        f"WHEN {successes} < 0 "
        f"THEN raise_error(concat('successes must be >= 0, got ', {successes})) "
        f"WHEN {successes} > {trials} THEN raise_error(concat('successes (', {successes}, "
        f"') cannot exceed trials (', {trials}, ')')) END"
    )


def equilibrium_shares(frequency: str) -> tuple[str, str, str]:
    """Hardy-Weinberg shares of 0, 1 and 2 copies of an allele."""
    rest = f"(1D - {frequency})"
    return f"{rest} * {rest}", f"2D * {frequency} * {rest}", f"{frequency} * {frequency}"
