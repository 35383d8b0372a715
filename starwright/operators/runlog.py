"""Run tables as folded logs.

Writers append a row for each thing that happens (a load finished, a pipeline
started) with ``seq``, its place in the order of events, and ``written``, the
columns that it sets.  ``fold`` gives the table: for each key and column the
value of the last row that wrote the column, a null included, so a later
failure that sets only status and message leaves the row counts of an earlier
success, and a success clears the message of an earlier failure.  Appending
needs no read, no lock and no rewrite; a row appended twice changes nothing;
and one aggregation with partial sums per task folds a key however often it
was written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEQ, WRITTEN = "seq", "written"
MASK_BITS = 62


def writes(*columns: str) -> Column:
    """The ``written`` column of rows that set these columns."""
    return F.array(*(F.lit(c) for c in columns)).cast("array<string>")


def fold(log: DataFrame, keys: list[str], insert_only: tuple[str, ...] = ()) -> DataFrame:
    """One row for each key (a null key is a key): the last written value of every
    other column, null where no row wrote it.

    ``insert_only`` columns are set when a key first appears and by rows that name
    them, as an insert's columns that its update clause leaves out: where no row
    wrote one, the first row's value stands."""
    values = [c for c in log.columns if c not in (*keys, SEQ, WRITTEN)]
    # the aggregation sorts its rows: a bit for each column instead of its name
    masks = [sum((F.when(F.array_contains(WRITTEN, c), F.lit(1 << i)).otherwise(F.lit(0))
                  .cast("bigint") for i, c in enumerate(values[at:at + MASK_BITS])),
                 F.lit(0).cast("bigint")).alias(f"__wrote_{at // MASK_BITS}")
             for at in range(0, len(values), MASK_BITS)]
    log = log.select(*keys, SEQ, *values, *masks)

    def last(c: str) -> Column:
        # rows that don't write the column have no place in its order
        at, bit = divmod(values.index(c), MASK_BITS)
        wrote = F.when(F.getbit(f"__wrote_{at}", F.lit(bit)) == 1, F.col(SEQ))
        newest = F.max_by(F.struct(F.col(c).alias("v")), wrote)
        if c not in insert_only:
            return newest["v"].alias(c)
        oldest = F.min_by(F.struct(F.col(c).alias("v")), SEQ)
        return F.coalesce(newest, oldest)["v"].alias(c)

    return log.groupBy(*keys).agg(*(last(c) for c in values))
