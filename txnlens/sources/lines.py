"""Transactions carried as CSV lines in a ``value`` column, batch or streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlens.schema import CORRUPT, layout, with_corrupt_record


def parse_lines(
    df: DataFrame,
    kind: str = "stream",
    *,
    keep_corrupt: bool = False,
    id_type: T.DataType = T.LongType(),
) -> DataFrame:
    """Columns of the named layout parsed from ``value``, text or bytes.

    The producer's column order decides the layout: a line of the raw export is
    not a line of the saved table. A field that does not parse is NULL;
    ``keep_corrupt`` adds the line itself, for ``split_valid``.
    """
    schema = layout(kind, id_type)
    options = {"mode": "PERMISSIVE"}
    if keep_corrupt:
        schema = with_corrupt_record(schema)
        options["columnNameOfCorruptRecord"] = CORRUPT
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    line = F.from_csv(F.col("value").cast("string"), ddl, options)
    # Filters stay above a generator; pushed below a projection, each would parse every line again.
    return df.select(F.inline(F.array(line)))
