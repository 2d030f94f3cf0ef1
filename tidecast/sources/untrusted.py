"""CSV files that nobody vouches for: types by whole column, bad lines kept apart.

Lines are read as text and split by Spark's CSV parser, one record per line. ``inferred_types``
looks at every cell of every column (one aggregation) and names the narrowest type that all of them
have. ``read_untrusted`` judges each line by a contract: a line with a wrong number of columns, a cell
that is not of the column's type or an empty cell where the contract allows none is rejected, with its text
and the names of what is wrong; all others come out typed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INT = r"^[+-]?[0-9]{1,19}$"
_NUM = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
CORRUPT = "_corrupt_record"


def _as(cell: Column, kind: str) -> Column:
    """The cell as a value of that type, null if it is not one."""
    if kind in ("int", "bigint"):
        return F.when(cell.rlike(_INT), cell.try_cast(kind))
    if kind == "double":
        return F.when(cell.rlike(_NUM), cell.try_cast("double"))
    if kind == "date":
        d = F.try_to_date(cell, "yyyy-MM-dd")
        return F.when(F.date_format(d, "yyyy-MM-dd") == cell, d)
    if kind == "boolean":
        return F.when(F.lower(cell).isin("true", "false"), F.lower(cell) == "true")
    return cell


def read_lines(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """(line, broken, one text column per name): every line of the files but the header lines; empty cells
    are null, ``broken``: the line has another number of columns or cannot be split."""
    cells = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    lines = spark.read.text(path).select(F.col("value").alias("line")).filter((F.col("line") != ",".join(names)) & (F.trim("line") != ""))
    parsed = lines.select("line", F.from_csv("line", cells.simpleString()[7:-1].replace(":", " "),
                                             {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("c"))
    return parsed.select("line", F.col(f"c.{CORRUPT}").isNotNull().alias("broken"), *[F.col(f"c.{n}").alias(n) for n in names])


def inferred_types(lines: DataFrame, names: list[str]) -> DataFrame:
    """(column_name, inferred_type, cells, empty) over all lines that are not broken: bigint, double, date,
    boolean or string; void for a column without a value."""
    kinds = ("bigint", "double", "date", "boolean")
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, n in enumerate(names):
        aggs += [F.count(n).alias(f"n{i}"), *[F.count(_as(F.col(n), k)).alias(f"{k}{i}") for k in kinds]]
    one = lines.filter(~F.col("broken")).agg(*aggs)

    def of(i):
        best = F.when(F.col(f"n{i}") == 0, "void")
        for k in kinds:
            best = best.when(F.col(f"{k}{i}") == F.col(f"n{i}"), k)
        return best.otherwise("string")
    return one.select(F.inline(F.array(*[F.struct(
        F.lit(n).alias("column_name"), of(i).alias("inferred_type"), F.col("rows").alias("cells"),
        (F.col("rows") - F.col(f"n{i}")).alias("empty")) for i, n in enumerate(names)])))


def read_untrusted(spark: SparkSession, path: str, contract: T.StructType) -> DataFrame:
    """(line, errors, the contract's columns): ``errors`` is empty for an accepted line, whose columns are typed; a
    rejected line has its errors (``columns`` or names of columns) and null columns."""
    lines = read_lines(spark, path, contract.names)
    values = {f.name: _as(F.col(f.name), f.dataType.simpleString()) for f in contract.fields}
    wrong = [F.when((F.col(f.name).isNotNull() & values[f.name].isNull()) | (F.col(f.name).isNull() & F.lit(not f.nullable)), F.lit(f.name))
             for f in contract.fields]
    errors = F.when(F.col("broken"), F.array(F.lit("columns"))).otherwise(F.filter(F.array(*wrong), lambda x: x.isNotNull()))
    judged = lines.select("line", errors.alias("errors"), *[v.alias(n) for n, v in values.items()])
    good = F.size("errors") == 0
    return judged.select("line", "errors", *[F.when(good, F.col(n)).alias(n) for n in contract.names])
