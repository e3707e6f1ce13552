"""The alert table: keyed, versioned and log-structured, as Parquet under one path.

Each micro-batch adds a segment ``tail-<batch>``. Compaction folds all of them into
one ``base-<number>``, which holds the last versions of each key only, and names it in a
new manifest, the one step that switches readers. So what is stored is bounded by the
keys and what is listed by the batches between two compactions, however long a stream runs.

Segments are written aside and renamed into place, so none is seen half written. A
stored row names its batch, so segments are sets of versions: reading a segment besides a base
that holds it already adds nothing new. Therefore replaced segments can stay until the
next compaction, for readers that have still to open them, and the catalog's view
need not know the manifest.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnlens.functions.cells import row_key
from txnlens.operators.quality import REASON
from txnlens.schema import ALERT_TABLE, ALERT_VERSIONS
from txnlens.sinks.folders import Folder
from txnlens.sinks.tables import create_database

MANIFESTS = "_manifest"


def _manifest(folder: Folder) -> dict:
    """The current one: its number, the base, the last batch within it, and what that has replaced."""
    names = folder.names(MANIFESTS)
    if not names:
        return {"number": 0, "base": None, "upto": -1, "replaced": []}
    return json.loads(folder.read_text(f"{MANIFESTS}/{names[-1]}"))


def _tails(folder: Folder, after: int) -> list[tuple[int, str]]:
    """(batch, name) of the segments that no base holds."""
    found = [(int(name.removeprefix("tail-")), name) for name in folder.names() if name.startswith("tail-")]
    return [(batch, name) for batch, name in found if batch > after]


def _put(df: DataFrame, folder: Folder, name: str, replace: bool = False) -> None:
    """Writes a segment aside, then renames it into place."""
    draft = f"_staging/{name}-{uuid.uuid4().hex}"
    df.write.parquet(f"{folder.path}/{draft}")
    if replace:
        folder.delete(name)
    folder.move(draft, name)


def write_alert_batch(alerts: DataFrame, batch_id: int, path: str) -> None:
    """Store the alerts of one batch, once per transaction, with its highest count.

    A batch that is run again replaces its segment; the last one of the base is not stored again. An earlier
    one can't come from the stream that filled the table and is an error, as it would be lost unseen.
    """
    folder = Folder(alerts.sparkSession, path)
    upto = _manifest(folder)["upto"]
    if batch_id == upto:
        return
    if batch_id < upto:
        raise ValueError(f"batch {batch_id} of {path} is older than batch {upto}: a new stream needs a table of its own")
    others = [c for c in alerts.columns if c != "transaction_count"]
    highest = alerts.groupBy(*others).agg(F.max("transaction_count").alias("transaction_count"))
    columns = [row_key().alias("row_key"), *alerts.columns, F.lit(batch_id).cast("long").alias("batch_id")]
    _put(highest.select(*columns), folder, f"tail-{batch_id:012d}", replace=True)


def write_late_rows(rows: DataFrame, batch_id: int, path: str) -> None:
    """Keeps the rows of one batch that came behind the watermark; a batch that is run again replaces them."""
    late = rows.select("*", F.lit("late").alias(REASON))
    late.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """All stored versions with the ``batch_id`` that wrote them: the base and the batches since."""
    folder = Folder(spark, path)
    now = _manifest(folder)
    names = [now["base"]] if now["base"] else []
    names += [name for _, name in _tails(folder, now["upto"])]
    return spark.read.parquet(*[f"{folder.path}/{name}" for name in names or [""]])


def compact_alerts(spark: SparkSession, path: str, keep: int = ALERT_VERSIONS) -> int | None:
    """Fold all batches into a new base of at most ``keep`` versions per key; the last batch in it, None without new ones.

    Batches may be written meanwhile. Of two compactions at once the slower has no effect. What this one
    replaces is deleted by the next one.
    """
    folder = Folder(spark, path)
    now = _manifest(folder)
    tails = _tails(folder, now["upto"])
    if not tails:
        return None
    replaced = [name for _, name in tails] + ([now["base"]] if now["base"] else [])
    number, upto = now["number"] + 1, tails[-1][0]
    rows = spark.read.parquet(*[f"{folder.path}/{name}" for name in replaced])
    base = f"base-{number:09d}-{uuid.uuid4().hex[:8]}"
    _put(alert_versions(rows, keep).drop("version"), folder, base)
    new = {"number": number, "base": base, "upto": upto, "replaced": replaced}
    if not folder.write_text(f"{MANIFESTS}/{number:09d}.json", json.dumps(new)):
        folder.delete(base)
        return None
    lost = [name for name in folder.names() if name.startswith("base-") and int(name.split("-")[1]) <= now["number"]]
    for name in {*now["replaced"], *lost} - {now["base"]}:  # lost: of compactions that ended before their manifest
        folder.delete(name)
    for name in folder.names(MANIFESTS)[:-2]:
        folder.delete(f"{MANIFESTS}/{name}")
    return upto


def publish_alerts(spark: SparkSession, path: str, db: str, keep: int = ALERT_VERSIONS) -> str:
    """The table's name in the catalog: a view of the last versions that follows batches and compactions by itself."""
    create_database(spark, db)
    names = read_alerts(spark, path).columns
    columns = ", ".join(f"`{c}`" for c in names)
    versions = f"row_number() OVER (PARTITION BY row_key ORDER BY {', '.join(f'{c} DESC' for c in NEWEST)})"
    spark.sql(
        f"CREATE OR REPLACE VIEW {db}.{ALERT_TABLE} AS SELECT * FROM (SELECT *, {versions} AS version "
        f"FROM (SELECT DISTINCT {columns} FROM parquet.`{path.rstrip('/')}/{{base,tail}}-*`)) WHERE version <= {keep}"
    )
    return f"{db}.{ALERT_TABLE}"


NEWEST = ["batch_id", "transaction_count", "txn_timestamp", "amount"]


def alert_versions(alerts: DataFrame, keep: int = ALERT_VERSIONS) -> DataFrame:
    """The last ``keep`` versions of each key, newest first as ``version`` 1, 2, …

    Spark limits each key to ``keep`` rows per map task before it shuffles, so a
    key written very often does not fill one task.
    """
    newest = Window.partitionBy("row_key").orderBy(*[F.desc(c) for c in NEWEST])
    return alerts.withColumn("version", F.row_number().over(newest)).where(F.col("version") <= keep)


def latest_alerts(alerts: DataFrame) -> DataFrame:
    """The current version of each key."""
    return alert_versions(alerts, 1).drop("version")


def alert_history(alerts: DataFrame, keep: int = ALERT_VERSIONS) -> DataFrame:
    """One row per key: its kept versions as an array of structs, newest first."""
    versions = alert_versions(alerts, keep)
    cells = F.struct("version", *[c for c in versions.columns if c not in ("row_key", "version")])
    return versions.groupBy("row_key").agg(F.sort_array(F.collect_list(cells)).alias("versions"))
