"""Sets of tables that change together.

A run writes all its tables into a folder of its own, an edition. Only when the last
one is complete does a new manifest name the edition, which is the one step that
switches readers. A run that fails leaves the edition before as it was.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from txnlens.sinks.folders import Folder

MANIFESTS = "_manifest"
#: Editions that stay, for readers that have still to open files of the last but one.
KEEP = 2


def _numbers(folder: Folder) -> list[int]:
    return [int(name.removesuffix(".json")) for name in folder.names(MANIFESTS)]


def _named(folder: Folder, number: int) -> dict:
    """The edition's folder and the names of its tables."""
    return json.loads(folder.read_text(f"{MANIFESTS}/{number:09d}.json"))


def publish(tables: Mapping[str, DataFrame], path: str, *, at_once: int = 4) -> int:
    """Writes a set of tables, by name, and makes it the current edition under ``path``; its number.

    ``at_once`` tables are written together, so that executors do not idle at the
    end of each. If one fails nothing is published. Of two runs at once the slower fails.
    Editions before the last are deleted, and so is what runs left that ended early.
    """
    if not tables:
        raise ValueError("an edition without tables")
    folder = Folder(next(iter(tables.values())).sparkSession, path)
    number = max(_numbers(folder), default=0) + 1
    edition = f"edition-{number:09d}-{uuid.uuid4().hex[:8]}"

    def write(name: str) -> None:
        try:
            tables[name].write.parquet(f"{folder.path}/{edition}/{name}")
        except Exception as error:
            error.add_note(f"table {name} was not written, and so none was published")
            raise

    try:
        with ThreadPoolExecutor(at_once) as pool:
            list(pool.map(write, tables))
        if not folder.write_text(f"{MANIFESTS}/{number:09d}.json", json.dumps({"edition": edition, "tables": list(tables)})):
            raise RuntimeError(f"another run has published edition {number} of {path} meanwhile")
    except Exception:
        folder.delete(edition)
        raise
    _delete_old(folder, number)
    return number


def _delete_old(folder: Folder, number: int) -> None:
    """Runs that aim at a number which is taken can't publish any more."""
    kept = [n for n in _numbers(folder) if n > number - KEEP]
    names = {_named(folder, n)["edition"] for n in kept}
    for name in folder.names():
        if name.startswith("edition-") and int(name.split("-")[1]) <= number and name not in names:
            folder.delete(name)
    for n in _numbers(folder):
        if n <= number - KEEP:
            folder.delete(f"{MANIFESTS}/{n:09d}.json")


def published(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables of the current edition by name, all of one run; none before the first."""
    return {name: spark.read.parquet(place) for name, place in _places(spark, path).items()}


def _places(spark: SparkSession, path: str) -> dict[str, str]:
    folder = Folder(spark, path)
    numbers = _numbers(folder)
    if not numbers:
        return {}
    now = _named(folder, max(numbers))
    return {name: f"{folder.path}/{now['edition']}/{name}" for name in now["tables"]}


def name_tables(spark: SparkSession, path: str, db: str) -> list[str]:
    """Points the tables' names in the catalog to the current edition; the names.

    A catalog has no step for several names, so they are changed one after the other, without moving
    data; run again after a failure, it ends with all of them. Readers that need one run's tables take ``published``.
    """
    places = _places(spark, path)
    for name, place in places.items():
        table = f"{db}.{name}"
        if spark.catalog.tableExists(table):
            if spark.read.table(table).schema == spark.read.parquet(place).schema:
                spark.sql(f"ALTER TABLE {table} SET LOCATION '{place}'")
                spark.catalog.refreshTable(table)
                continue
            spark.sql(f"DROP TABLE {table}")
        spark.catalog.createTable(table, path=place, source="parquet")
    return list(places)
