"""Stored tables with declared schemas, and declared JSON inputs.

A ``Store`` is a folder of Parquet tables by run: initialising is idempotent,
appending a run again replaces that run and nothing else, and resetting empties
tables in the order given. JSON readers enforce a schema and required fields.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Store:
    """Tables of declared columns in a shared folder, each row with the ``run_id`` that wrote it."""

    def __init__(self, spark: SparkSession, folder: str, schemas: dict[str, str]):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.schemas = {name: T._parse_datatype_string(s) for name, s in schemas.items()}

    def _path(self, name: str, run: str | None = None) -> str:
        if name not in self.schemas:
            raise KeyError(f"{name} isn't declared")
        return f"{self.folder}/{name}" + (f"/run_id={run}" if run else "")

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def init(self) -> list[str]:
        """Create what isn't there yet as empty tables; the names that were created."""
        new = [n for n in self.schemas if not self._exists(self._path(n))]
        for n in new:
            self.spark.createDataFrame([], self.schemas[n]).write.parquet(self._path(n, "none"))
        return new

    def append(self, name: str, rows: DataFrame, run: str) -> None:
        """Write a run's rows, columns checked and cast by the declaration; a run that is written again replaces itself."""
        schema = self.schemas[name]
        if missing := [f.name for f in schema if f.name not in rows.columns]:
            raise ValueError(f"rows for {name} lack {missing}")
        rows.select(*[F.col(f.name).cast(f.dataType) for f in schema]).write.mode("overwrite").parquet(self._path(name, run))

    def read(self, name: str, run: str | None = None) -> DataFrame:
        """All rows with their run, or those of one run."""
        df = self.spark.read.schema(T.StructType([*self.schemas[name], T.StructField("run_id", T.StringType())])).parquet(self._path(name))
        return df if run is None else df.where(F.col("run_id") == run)

    def reset(self, *names: str) -> None:
        """Empty tables in the order given (those that refer to others first)."""
        for n in names:
            self.spark.createDataFrame([], self.schemas[n]).write.mode("overwrite").parquet(self._path(n) + "/run_id=none")
            for run in [r["run_id"] for r in self.read(n).select("run_id").distinct().collect()]:  # one entry for each run
                p = self.spark._jvm.org.apache.hadoop.fs.Path(self._path(n, run))
                p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def read_objects(spark: SparkSession, path: str, schema: str, required: tuple[str, ...] = (), strict: bool = True) -> DataFrame:
    """A JSON file with a list of objects as typed rows.

    A row whose ``required`` fields are null or blank is an error, and so is a file
    that isn't such a list; without ``strict`` such rows are left out and such a file
    has none.
    """
    df = spark.read.option("multiLine", True).option("mode", "FAILFAST" if strict else "PERMISSIVE").schema(schema).json(path)
    complete = F.lit(True)
    for c in required:
        complete = complete & (F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) != "")
    if strict:
        lacking = F.raise_error(F.concat(F.lit(f"{path}: an object lacks one of {list(required)}: "), F.to_json(F.struct(*df.columns))))
        return df.where(F.when(complete, F.lit(True)).otherwise(lacking.cast("boolean")))
    return df.where(complete & F.coalesce(*[F.col(c).isNotNull() for c in df.columns][:1], F.lit(False)))


def read_totals(spark: SparkSession, path: str, field: str = "total_internal_files") -> DataFrame:
    """(title, total) of a JSON object of objects by title; a total that isn't a whole number of 0 or more is an error."""
    text = spark.read.option("wholetext", True).text(path)
    each = text.select(F.explode(F.from_json("value", f"map<string,struct<{field}:variant>>")).alias("title", "v")).select("title", F.col(f"v.{field}").alias("v"))
    whole = F.schema_of_variant("v").isin("BIGINT", "INT", "SMALLINT", "TINYINT")
    total = F.when(whole, F.try_variant_get("v", "$", "bigint"))
    return each.select("title", F.when(total >= 0, total).otherwise(F.raise_error(F.concat(F.lit(f"{path}: no whole {field} for "), F.col("title"))).cast("long")).alias("total"))
