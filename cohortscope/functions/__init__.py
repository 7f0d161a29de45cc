"""Expressions as Spark SQL text: numbers, text and genome coordinates.

Every function takes column names or SQL expressions and returns an expression, to be
used with ``selectExpr``, ``where`` or ``F.expr``. Long expressions are then one call to
the JVM instead of one per operator.
"""


def literal(value: object) -> str:
    """A Python value as a Spark SQL literal."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        return f"{value!r}D"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    raise TypeError(f"no literal for {type(value).__name__}")


def literals(values) -> str:
    return ", ".join(literal(v) for v in values)


def lookup(key: str, choices, default: str) -> str:
    """Literal lookup of a short mapping."""
    if not choices:
        return default
    cases = " ".join(f"WHEN {literal(k)} THEN {literal(v)}" for k, v in choices.items())
    return f"CASE {key} {cases} ELSE {default} END"
