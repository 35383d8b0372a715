"""Column-expression helpers (all built-in Spark functions, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's output labels (calendar names in
# Portuguese), in natural order: month 1..12 and ISO weekday 1 (Monday)..7.
MONTH_NAMES = [
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
]
WEEKDAY_NAMES = [
    "Segunda-feira", "Terça-feira", "Quarta-feira", "Quinta-feira",
    "Sexta-feira", "Sábado", "Domingo",
]


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def varchar(c: str | Column, n: int) -> Column:
    """``cast(x as varchar(n))`` with the warehouse's truncating semantics.

    Spark's own ``varchar(n)`` cast keeps every character, so truncate
    explicitly; nulls stay null.
    """
    return F.substring(col_(c).cast("string"), 1, n)


def date_key(c: str | Column) -> Column:
    """yyyymmdd integer key of a date/timestamp (integer arithmetic, no string format)."""
    c = col_(c)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def key_to_date(c: str | Column) -> Column:
    """Inverse of :func:`date_key` (``to_date(key::text,'YYYYMMDD')``)."""
    c = col_(c)
    return F.make_date(
        (c / 10000).cast("int"), ((c / 100).cast("int") % 100), c % 100
    )


def iso_weekday(c: str | Column) -> Column:
    """ISO day of week, Monday = 1 … Sunday = 7."""
    return (F.weekday(col_(c)) + 1).cast("int")


def iso_week_year(c: str | Column) -> Column:
    return F.expr(f"extract(YEAROFWEEK FROM {_sql(c)})").cast("int")


def _sql(c: str | Column) -> str:
    if isinstance(c, str):
        return f"`{c}`"
    raise TypeError("pass a column name")


def month_name(month_number: str | Column) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), col_(month_number).cast("int"))


def weekday_name(iso_dow: str | Column) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAY_NAMES]), col_(iso_dow).cast("int"))


def padded(c: str | Column, width: int) -> Column:
    """The digits of a key with zeros before them up to ``width``; a longer key stays whole."""
    digits = col_(c).cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))


def uuid_from_key(c: str | Column) -> Column:
    """Deterministic uuid text for a non-negative integer key, well-formed up to 12
    digits and distinct for every key."""
    return F.concat(F.lit("00000000-0000-4000-8000-"), padded(c, 12))


def days_after(ts_literal: str, days: Column) -> Column:
    """``timestamp '<ts_literal>' + days`` as timestamp_ntz."""
    return F.expr(f"timestamp_ntz'{ts_literal}'") + F.make_dt_interval(days.cast("int"))


def as_double(c: str | Column) -> Column:
    return col_(c).cast("double")


def ratio(num: str | Column, den: str | Column) -> Column:
    """``DIVIDE(a, b)``: null when b is 0 or null, computed on doubles."""
    return F.try_divide(as_double(num), as_double(den))


def blank_diff(a: str | Column, b: str | Column) -> Column:
    """``a - b`` where a blank counts as 0 unless both are blank."""
    a, b = col_(a), col_(b)
    return F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(
        F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0))
    )


# ---------------------------------------------------------------- statuses
# Fixed vocabulary of the run/test status normalisation (raw word → state).
STATUS_WORDS = {
    "success": ["success", "pass", "passed"],
    "warning": ["warn", "warning"],
    "failed": ["error", "fail", "failed", "runtime error"],
    "running": ["running", "started"],
    "blocked": ["blocked"],
    "not_applicable": ["skipped", "not_applicable"],
    "unmonitored": ["unmonitored", "not_monitored"],
}


def normalize_status(c: str | Column) -> Column:
    """Map a raw status word to one of 8 states; unknown/null → ``not_started``."""
    lowered = F.lower(F.coalesce(col_(c), F.lit("not_started")))
    expr = None
    for state, words in STATUS_WORDS.items():
        cond = lowered.isin(*words)
        expr = F.when(cond, F.lit(state)) if expr is None else expr.when(cond, F.lit(state))
    return expr.otherwise(F.lit("not_started"))


def trigger_type(run_id: str | Column) -> Column:
    """Trigger of a run from its id prefix (manual / scheduled / other)."""
    r = col_(run_id)
    return (
        F.when(r.isNull() | (r == ""), F.lit(None).cast("string"))
        .when(r.startswith("manual__"), F.lit("manual"))
        .when(r.startswith("scheduled__") | r.startswith("backfill__"), F.lit("scheduled"))
        .otherwise(F.lit("other"))
    )


def layer_of(path: str | Column) -> Column:
    """Model layer from its file path (staging, then intermediate, then analytics)."""
    p = F.translate(F.coalesce(col_(path), F.lit("")), "\\", "/")
    return (
        F.when(p.contains("models/staging/"), F.lit("staging"))
        .when(p.contains("models/intermediate/"), F.lit("intermediate"))
        .when(p.contains("models/analytics/"), F.lit("analytics"))
    )


def try_int(c: str | Column) -> Column:
    """Lenient integer: integral text/number → bigint, anything else → null."""
    return col_(c).cast("string").try_cast("bigint")


def last_dotted(c: str | Column) -> Column:
    """Last dotted part (``sales.customer`` → ``customer``)."""
    return F.element_at(F.split(col_(c), r"\."), -1)
