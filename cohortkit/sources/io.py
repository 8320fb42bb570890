"""Sources and sinks (S1-S7; S8 lives with the models).

CSV is read with an explicit schema (no inference pass); ARFF is read as
text: the ``@attribute`` lines (one per column) define the schema, the data
lines are parsed with ``from_csv`` in parallel.  Writers are plain
DataFrame writers; an ordered export is a global sort before the write.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, sep: str = ",",
             header: bool = True) -> DataFrame:
    """CSV with header; pass a schema at scale (inference costs a pass)."""
    r = spark.read.option("header", header).option("sep", sep)
    if schema is not None:
        return r.schema(schema).csv(path)
    return r.option("inferSchema", True).csv(path)


def read_csv_pair(spark: SparkSession, features_path: str, timelines_path: str,
                  features_schema=None, timelines_schema=None, sep: str = ";") -> tuple[DataFrame, DataFrame]:
    """Two related ``;``-separated files (features, timelines)."""
    return (read_csv(spark, features_path, features_schema, sep),
            read_csv(spark, timelines_path, timelines_schema, sep))


_ATTR = re.compile(r"^@attribute\s+('[^']*'|\"[^\"]*\"|\S+)\s+(.+)$", re.IGNORECASE)


def _arff_type(spec: str):
    s = spec.strip().lower()
    if s in ("numeric", "real", "integer") or s.startswith("numeric") or s.startswith("real"):
        return DoubleType()
    return StringType()  # nominal {..}, string, date as text


def read_arff(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """S3: ARFF relation.  Header attribute lines give the schema (nominal
    and string -> string, numeric -> double); data lines (not starting with
    '@' or '%', not blank) are parsed in parallel; ``?`` is null and single
    quotes delimit quoted values."""
    lines = spark.read.text(path)
    v = F.trim(F.col("value"))
    attrs = lines.where(F.lower(v).startswith("@attribute")).select(v.alias("l"),
                                                                    F.input_file_name().alias("f"),
                                                                    F.monotonically_increasing_id().alias("i"))
    fields = []
    for row in attrs.orderBy("f", "i").collect():  # one row per attribute
        m = _ATTR.match(row["l"])
        name = m.group(1).strip("'\"")
        fields.append(StructField(name, _arff_type(m.group(2))))
    schema = StructType(fields)
    data = lines.where((v != "") & ~v.startswith("@") & ~v.startswith("%"))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = data.select(F.from_csv(v, ddl,
                                    {"nullValue": "?", "quote": "'", "ignoreLeadingWhiteSpace": "true",
                                     "ignoreTrailingWhiteSpace": "true"}).alias("r"))
    return parsed.select("r.*")


def write_csv(df: DataFrame, path: str, sep: str = ",") -> str:
    """S5."""
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    """One JSON object per row (nested arrays / maps kept)."""
    df.write.mode("overwrite").json(path)
    return path


def write_ordered(df: DataFrame, path: str, order_cols: list[str], sep: str = ",") -> str:
    """Globally sorted export (range-partitioned sort; part files in order)."""
    df.orderBy(*order_cols).write.mode("overwrite").option("header", True).option("sep", sep).csv(path)
    return path


def arff_lines(df: DataFrame, relation: str, nominal: dict[str, list[str]] | None = None) -> tuple[DataFrame, DataFrame]:
    """Write helper for ARFF: ``(header_lines, data_lines)`` text frames
    (the header is one line per column; data lines are built per row)."""
    spark = df.sparkSession
    nominal = nominal or {}
    head = [f"@relation {relation}"]
    for name, t in df.dtypes:
        if name in nominal:
            head.append(f"@attribute {name} {{{','.join(nominal[name])}}}")
        elif t in ("double", "float", "int", "bigint", "smallint"):
            head.append(f"@attribute {name} numeric")
        else:
            head.append(f"@attribute {name} string")
    head.append("@data")
    header = spark.createDataFrame([(x,) for x in head], "value string")
    vals = [F.coalesce(F.when(F.lit(t == "string"), F.concat(F.lit("'"), F.col(c).cast("string"), F.lit("'")))
                       .otherwise(F.col(c).cast("string")), F.lit("?")) for c, t in df.dtypes]
    data = df.select(F.concat_ws(",", *vals).alias("value"))
    return header, data
