"""Lineage declarations as DataFrames.

A declaration is ``dataset -> upstream[], critical_columns[], description,
transformation``.  It becomes three tables:

* ``datasets(dataset, description, transformation, decl_ord)``
* ``edges(dataset, upstream, ord)``        one row per declared upstream
* ``critical(dataset, column, ord)``       columns of the *upstream* data that
                                           the declaring dataset depends on

Declarations come from records, a JSON file (one object per dataset, or one
``{"datasets": {...}}`` document) or a DataFrame computed from data.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DECLARATION_SCHEMA = T.StructType(
    [
        T.StructField("dataset", T.StringType(), False),
        T.StructField("upstream", T.ArrayType(T.StringType()), True),
        T.StructField("critical_columns", T.ArrayType(T.StringType()), True),
        T.StructField("description", T.StringType(), True),
        T.StructField("transformation", T.StringType(), True),
        T.StructField("decl_ord", T.LongType(), True),
    ]
)


@dataclass(frozen=True)
class LineageGraph:
    datasets: DataFrame
    edges: DataFrame
    critical: DataFrame

    @staticmethod
    def from_declarations(decl: DataFrame) -> "LineageGraph":
        """From a DataFrame in ``DECLARATION_SCHEMA`` (arrays may be NULL)."""
        d = decl.select(*[F.col(f.name) for f in DECLARATION_SCHEMA.fields])
        datasets = d.select("dataset", "description", "transformation", "decl_ord")
        edges = d.select("dataset", F.posexplode("upstream").alias("ord", "upstream")).select(
            "dataset", "upstream", F.col("ord").cast("int").alias("ord")
        )
        critical = d.select("dataset", F.posexplode("critical_columns").alias("ord", "column")).select(
            "dataset", "column", F.col("ord").cast("int").alias("ord")
        )
        return LineageGraph(datasets, edges, critical)

    @staticmethod
    def from_records(spark: SparkSession, records: Iterable[Mapping]) -> "LineageGraph":
        rows = []
        for i, r in enumerate(records):
            rows.append(
                (
                    r["dataset"],
                    list(r.get("upstream") or []),
                    list(r.get("critical_columns") or []),
                    r.get("description"),
                    r.get("transformation"),
                    int(r.get("decl_ord", i)),
                )
            )
        return LineageGraph.from_declarations(spark.createDataFrame(rows, DECLARATION_SCHEMA))

    @staticmethod
    def from_json(spark: SparkSession, path: str) -> "LineageGraph":
        """JSON lines, one declaration per line, or one ``{"datasets": {name: {...}}}``
        document; either in declaration order."""
        fields = [f for f in DECLARATION_SCHEMA.fields if f.name != "decl_ord"]
        body = T.StructType([f for f in fields if f.name != "dataset"])
        document = T.StructType([T.StructField("datasets", T.MapType(T.StringType(), body))])
        raw = spark.read.schema(document).option("multiLine", "true").json(path).where("datasets is not null")
        if not raw.isEmpty():
            decl = raw.select(F.posexplode("datasets").alias("decl_ord", "dataset", "body")).select(
                "dataset", "body.*", F.col("decl_ord").cast("long").alias("decl_ord"))
        else:
            decl = spark.read.schema(T.StructType(fields)).json(path).withColumn("decl_ord", F.monotonically_increasing_id())
        return LineageGraph.from_declarations(decl)

    def materialized(self, with_datasets: bool = True) -> "LineageGraph":
        """The tables written once to the shared checkpoint folder, for plans
        that read the graph from several branches (``datasets`` only when
        asked: the analysis does not read it)."""
        from tideline.session import materialize

        return LineageGraph(
            self.datasets if not with_datasets else materialize(self.datasets, "lineage-datasets"),
            materialize(self.edges, "lineage-edges"),
            materialize(self.critical, "lineage-critical"),
        )

    def union(self, other: "LineageGraph") -> "LineageGraph":
        return LineageGraph(
            self.datasets.unionByName(other.datasets),
            self.edges.unionByName(other.edges),
            self.critical.unionByName(other.critical),
        )
