"""What is known of a folder's files, so that each is looked at once.

A ledger is a small table with a row per file: the columns the file has beyond
the declared ones.  Listing a folder needs no footers (the schema is given, and
a file sink's log is followed), so a run reads the footers of files it hasn't
met and no others.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

ROWS = "file string, columns string"


@dataclass
class Arrivals:
    """The schema of a folder, its files that the ledger didn't know, and the
    columns those have beyond the declared ones."""
    schema: T.StructType
    files: list[str]
    extra: T.StructType

    def enter(self, spark: SparkSession, ledger: str) -> None:
        """Put the new files into the ledger."""
        if self.files:
            columns = json.dumps(self.extra.jsonValue())
            spark.createDataFrame([(f, columns) for f in self.files], ROWS).coalesce(1).write.mode("append").parquet(ledger)


def listed(spark: SparkSession, folder: str, declared: T.StructType) -> list[str]:
    return spark.read.schema(declared).parquet(folder).inputFiles()


def footers(spark: SparkSession, files: list[str]) -> T.StructType:
    """The merged schema of ``files``: the one place that reads footers."""
    return spark.read.option("mergeSchema", "true").parquet(*files).schema


def known(spark: SparkSession, ledger: str) -> DataFrame | None:
    try:
        return spark.read.schema(ROWS).parquet(ledger)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def arrivals(spark: SparkSession, folder: str, declared: T.StructType, ledger: str) -> Arrivals:
    """``declared`` plus the columns any file of ``folder`` has beyond it, and
    the files that aren't in the ledger.  A declared column of another type
    fails."""
    rows = known(spark, ledger)
    rows = rows.collect() if rows is not None else []
    seen = {r["file"] for r in rows}
    new = [f for f in listed(spark, folder, declared) if f not in seen]
    extra: dict[str, T.DataType] = {}
    found: list[T.StructField] = []
    for columns in dict.fromkeys(r["columns"] for r in rows):
        extra |= {f.name: f.dataType for f in T.StructType.fromJson(json.loads(columns)).fields}
    if new:
        for f in footers(spark, new).fields:
            if f.name not in declared.names:
                found.append(T.StructField(f.name, f.dataType, True))
            elif f.dataType != declared[f.name].dataType:
                raise ValueError(f"{folder}: column {f.name} is {f.dataType.simpleString()}, "
                                 f"not {declared[f.name].dataType.simpleString()}")
        for f in found:
            if extra.setdefault(f.name, f.dataType) != f.dataType:
                raise ValueError(f"{folder}: column {f.name} is {f.dataType.simpleString()}, "
                                 f"not {extra[f.name].simpleString()}")
    return Arrivals(T.StructType(declared.fields + [T.StructField(n, t, True) for n, t in extra.items()]), new, T.StructType(found))
