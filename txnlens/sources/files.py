"""CSV files of transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from txnlens.schema import CORRUPT, layout, with_corrupt_record


def read_transactions(
    spark: SparkSession,
    path: str | list[str],
    *,
    kind: str = "raw",
    header: bool = True,
    infer: bool = False,
    id_type: T.DataType = T.LongType(),
) -> DataFrame:
    """Transactions from CSV, with the line of each unparsable record in ``_corrupt_record``.

    With the declared schema the input is read once, by the job that uses it, and
    a header that does not name the expected columns is an error. ``infer=True``
    takes the types from the data, which costs one more pass over all of it, and
    has no ``_corrupt_record``. Either way the exported column ``timestamp``
    becomes ``txn_timestamp``.
    """
    if infer:
        df = spark.read.csv(path, header=header, inferSchema=True)
        return df.withColumnRenamed("timestamp", "txn_timestamp")
    schema = layout(kind, id_type)
    if header:
        # As the exported header has it; checked against the file's own header.
        schema = T.StructType(
            [T.StructField("timestamp" if f.name == "txn_timestamp" and kind == "raw" else f.name, f.dataType) for f in schema]
        )
    df = spark.read.schema(with_corrupt_record(schema)).csv(
        path,
        header=header,
        enforceSchema=not header,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=CORRUPT,
    )
    return df.withColumnRenamed("timestamp", "txn_timestamp")
