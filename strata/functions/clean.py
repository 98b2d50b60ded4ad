"""Column -> Column cleaning and tolerant typing.

Every function takes and returns a ``Column`` and uses built-in expressions
only, so the whole silver projection stays inside one whole-stage-codegen
span.  Text parsing is tolerant (``try_cast``): under ANSI mode a strict cast
of malformed text fails the job, which is opt-in through ``cast(..., on_error=
"fail")``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# ---------------------------------------------------------------------------
# Token lists that must equal the reference's to give the same
# results.  Each list is written in the case it is compared in.
# ---------------------------------------------------------------------------
#: Placeholder tokens of the profile / "silver-ready" cleaner, compared after
#: lower(trim(...)).
PLACEHOLDER_TOKENS = ["null", "n/a", "na", "", "unknown", "none", "not reported",
                      "not available", "tbd", "--", "?"]
#: NULL tokens of the financial silver, compared after upper(trim(...)).
FINANCIAL_NULL_TOKENS = ["", "NULL", "N/A"]
#: NULL tokens of the market silver, compared after lower(trim(...)).
MARKET_NULL_TOKENS = ["null", "n/a", "na", ""]
#: Sentinel of the incidents silver for attribution_confidence (lower case).
INCIDENT_SENTINELS = ["unknown"]
#: Boolean vocabulary of the market silver (lower case).
TRUE_TOKENS = ["true", "1", "yes", "y", "t"]
FALSE_TOKENS = ["false", "0", "no", "n", "f"]
# ---------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim(c: Column | str) -> Column:
    """Strip leading/trailing spaces (tabs and newlines survive, as in SQL TRIM)."""
    return F.trim(_col(c))


def norm(c: Column | str, case: str | None = None) -> Column:
    """``trim`` followed by ``upper``/``lower`` (``case=None`` keeps the case)."""
    t = F.trim(_col(c))
    if case == "upper":
        return F.upper(t)
    if case == "lower":
        return F.lower(t)
    if case is None:
        return t
    raise ValueError(f"case must be 'upper', 'lower' or None, not {case!r}")


def key_case(c: Column | str, case: str | None) -> Column:
    """Optionally fold a business key to one case so that keys of all feeds join."""
    col = _col(c)
    return F.upper(col) if case == "upper" else F.lower(col) if case == "lower" else col


def blank_to_null(c: Column | str) -> Column:
    """Trimmed text, NULL when nothing is left.  Case is kept."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def tokens_to_null(c: Column | str, tokens: Sequence[str], case: str | None = "upper",
                   keep_untrimmed: bool = False) -> Column:
    """NULL when the trimmed value is one of ``tokens``, else the cleaned value.

    ``case="upper"`` / ``"lower"``: the value is trimmed and case-folded, then
    compared with ``tokens`` (written in that case) and returned folded.
    ``case=None``: the comparison is case-insensitive (tokens in lower case) and
    the trimmed value keeps its case; with ``keep_untrimmed`` the original,
    untrimmed value is returned instead (the placeholder cleaner).
    """
    col = _col(c)
    if case in ("upper", "lower"):
        v = norm(col, case)
        return F.when(v.isin(list(tokens)), F.lit(None).cast(StringType())).otherwise(v)
    probe = F.lower(F.trim(col))
    out = col if keep_untrimmed else F.trim(col)
    return F.when(probe.isin([t.lower() for t in tokens]), F.lit(None).cast(StringType())).otherwise(out)


def placeholders_to_null(df: DataFrame, tokens: Sequence[str] = PLACEHOLDER_TOKENS) -> DataFrame:
    """Replace placeholder tokens by NULL in every string column, in one projection.

    Non-matching values are returned untouched (untrimmed, original case).
    """
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, StringType):
            cols.append(tokens_to_null(F.col(f.name), tokens, case=None, keep_untrimmed=True).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def cast(c: Column | str, data_type: str, on_error: str = "null") -> Column:
    """Cast; malformed input gives NULL (``on_error="null"``) or fails (``"fail"``)."""
    col = _col(c)
    if on_error == "null":
        return col.try_cast(data_type)
    if on_error == "fail":
        return col.cast(data_type)
    raise ValueError("on_error must be 'null' or 'fail'")


def to_decimal(text: Column, data_type: str) -> Column:
    """``try_cast(text AS DECIMAL)``, with text that can never parse sent to NULL up front.

    A decimal literal needs at least one digit and never holds a comma; such
    text skips the cast, whose failure path is far slower than a regex test.
    Results are identical to the bare ``try_cast``.
    """
    return F.when(text.rlike(r"\p{Nd}") & ~text.contains(","), text.try_cast(data_type))


def _is_decimal_type(data_type: str) -> bool:
    return data_type.strip().lower().startswith("decimal")


def money(c: Column | str, data_type: str = "decimal(18,2)") -> Column:
    """Trimmed text to a decimal; anything unparsable (incl. thousands commas) is NULL."""
    return to_decimal(F.trim(_col(c).cast("string")), data_type)


def number_text(c: Column | str, tokens: Sequence[str] = MARKET_NULL_TOKENS, strip: str | None = ",") -> Column:
    """First half of ``number``: lower/trim, tokens -> NULL, drop ``strip`` chars, '' -> NULL."""
    v = tokens_to_null(_col(c).cast("string"), tokens, case="lower")
    if strip:
        v = F.translate(v, strip, "")  # drops every character of ``strip``; no regex per value
    return F.nullif(v, F.lit(""))


def parse_number_text(text: Column | str, data_type: str = "decimal(18,2)", lenient_int: bool = False) -> Column:
    """Second half of ``number``: tolerant cast of already-cleaned text.

    Integer targets reject a fractional text such as ``12.0`` (Spark semantics);
    ``lenient_int=True`` goes through DECIMAL first so that ``12.0`` gives 12.
    """
    v = _col(text)
    if lenient_int and data_type.lower() in ("int", "integer", "bigint", "long", "smallint", "tinyint"):
        return to_decimal(v, "decimal(38,6)").try_cast(data_type)
    if _is_decimal_type(data_type):
        return to_decimal(v, data_type)
    return v.try_cast(data_type)


def number(c: Column | str, data_type: str = "decimal(18,2)", tokens: Sequence[str] = MARKET_NULL_TOKENS,
           strip: str | None = ",", lenient_int: bool = False) -> Column:
    """Grouped-number parse: lower/trim, tokens -> NULL, drop ``strip`` chars, tolerant cast.

    For many columns prefer ``number_text`` in one projection and
    ``parse_number_text`` in the next: the cleaned text is then computed once
    instead of once per reference inside the cast's conditions.
    """
    return parse_number_text(number_text(c, tokens, strip), data_type, lenient_int)


def boolean(c: Column | str, true_tokens: Sequence[str] = TRUE_TOKENS,
            false_tokens: Sequence[str] = FALSE_TOKENS,
            null_tokens: Sequence[str] = MARKET_NULL_TOKENS) -> Column:
    """Vocabulary boolean: true/false token lists (lower case), anything else NULL."""
    v = tokens_to_null(_col(c).cast("string"), null_tokens, case="lower")
    return (F.when(v.isin(list(true_tokens)), F.lit(True))
            .when(v.isin(list(false_tokens)), F.lit(False))
            .otherwise(F.lit(None).cast("boolean")))


def timestamp(c: Column | str, tokens: Sequence[str] = MARKET_NULL_TOKENS) -> Column:
    """Tolerant timestamp: ISO ``T`` -> space, trim, lower, tokens -> NULL, then parse.

    Unparsable text (e.g. a trailing ``Z``) gives NULL.
    """
    v = F.replace(_col(c).cast("string"), F.lit("T"), F.lit(" "))
    return F.try_to_timestamp(tokens_to_null(v, tokens, case="lower"))


def cpi_value_text(c: Column | str) -> Column:
    """First parenthesised text of a price-index label ('' when there is none)."""
    return F.regexp_extract(_col(c), r"\(([^)]+)\)", 1)


def cpi(c: Column | str, value_text: Column | str | None = None) -> tuple[Column, Column]:
    """Split a price-index label into (year INT, value DECIMAL(10,2)).

    Year = first run of four digits; value = first parenthesised text.  Pass
    ``value_text`` (a column holding ``cpi_value_text(c)``, computed in an
    earlier projection) to run the extraction once instead of once per
    reference inside the cast's guard.
    """
    col = _col(c)
    year = F.regexp_extract(col, r"(\d{4})", 1).try_cast("int")
    text = cpi_value_text(col) if value_text is None else _col(value_text)
    return year, to_decimal(text, "decimal(10,2)")


def flag_positive(c: Column | str) -> Column:
    """1 when the value is > 0, else 0 (NULL gives 0)."""
    return F.when(_col(c) > 0, F.lit(1)).otherwise(F.lit(0))


def safe_ratio(n: Column | str, d: Column | str, scale: int) -> Column:
    """``round(n / d, scale)``; a zero or NULL divisor gives NULL."""
    return F.round(_col(n) / F.nullif(_col(d), F.lit(0)), scale)


def stamp(df: DataFrame, as_of=None, **literals) -> DataFrame:
    """Append literal columns; ``as_of`` (or the clock) for timestamp columns given as None."""
    cols = {}
    for name, value in literals.items():
        if value is None:
            cols[name] = now(as_of)
        else:
            cols[name] = F.lit(value)
    return df.withColumns(cols)


def now(as_of=None) -> Column:
    """The batch clock: ``as_of`` when given (reproducible runs), else current_timestamp()."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")


def today(as_of=None) -> Column:
    return F.current_date() if as_of is None else now(as_of).cast("date")


def select_cleaned(df: DataFrame, spec: Iterable[tuple[str, Column]]) -> DataFrame:
    """One projection from ``(name, expression)`` pairs."""
    return df.select(*[e.alias(n) for n, e in spec])
