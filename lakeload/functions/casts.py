"""Cast text and Spark types for the column types of the upstream database."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeload.functions.text import safe_identifier

# Fixed values -------------------------------------------------------------------------------
# Source type -> T-SQL expression. {c} is the quoted column, {p} and {s} precision and scale.
# Types that are not listed are selected unchanged.
BASE_CASTS = {
    "decimal": "CAST({c} AS decimal({p},{s}))",
    "numeric": "CAST({c} AS decimal({p},{s}))",
    "money": "CAST({c} AS decimal(19,4))",
    "smallmoney": "CAST({c} AS decimal(10,4))",
    "tinyint": "CAST({c} AS smallint)",
    "smallint": "CAST({c} AS smallint)",
    "int": "CAST({c} AS int)",
    "bigint": "CAST({c} AS bigint)",
    "bit": "CAST({c} AS bit)",
    "float": "CAST({c} AS float)",
    "real": "CAST({c} AS real)",
    "date": "CAST({c} AS date)",
    "datetime": "CAST({c} AS datetime2(3))",
    "smalldatetime": "CAST({c} AS datetime2(0))",
    "datetime2": "CAST({c} AS datetime2(6))",
    "time": "CONVERT(varchar(8), {c}, 108)",
    "datetimeoffset": "CAST(SWITCHOFFSET({c}, '+00:00') AS datetime2(6))",
    "char": "{c}",
    "varchar": "{c}",
    "nchar": "{c}",
    "nvarchar": "{c}",
    "text": "CONVERT(varchar(max), {c})",
    "ntext": "CONVERT(nvarchar(max), {c})",
    "uniqueidentifier": "CONVERT(varchar(36), {c})",
    "xml": "CONVERT(nvarchar(max), {c})",
}
# Further types handled by the in-database generator.
WIDE_CASTS = {
    "binary": "{c}",
    "varbinary": "{c}",
    "image": "CONVERT(varbinary(max), {c})",
    "rowversion": "CAST({c} AS varbinary(8))",
    "timestamp": "CAST({c} AS varbinary(8))",
    "hierarchyid": "{c}.ToString()",
    "geometry": "{c}.STAsBinary()",
    "geography": "{c}.STAsBinary()",
    "sql_variant": "CONVERT(nvarchar(max), {c})",
}
# Source type -> Spark type of the landed column.
SPARK_TYPES = {
    "decimal": "decimal({p},{s})",
    "numeric": "decimal({p},{s})",
    "money": "decimal(19,4)",
    "smallmoney": "decimal(10,4)",
    "tinyint": "smallint",
    "smallint": "smallint",
    "int": "int",
    "bigint": "bigint",
    "bit": "boolean",
    "float": "double",
    "real": "float",
    "date": "date",
    "datetime": "timestamp_ntz",
    "smalldatetime": "timestamp_ntz",
    "datetime2": "timestamp_ntz",
    "datetimeoffset": "timestamp",
    "time": "string",
    "char": "string",
    "varchar": "string",
    "nchar": "string",
    "nvarchar": "string",
    "text": "string",
    "ntext": "string",
    "uniqueidentifier": "string",
    "xml": "string",
    "binary": "binary",
    "varbinary": "binary",
    "image": "binary",
    "rowversion": "binary",
    "timestamp": "binary",
    "hierarchyid": "string",
    "geometry": "binary",
    "geography": "binary",
    "sql_variant": "string",
}
# Sub-second precision kept for the date-time types.
DATETIME_UNITS = {"datetime": "MILLISECOND", "smalldatetime": "SECOND"}
# --------------------------------------------------------------------------------------------


def quote_name(name: Column, escape: bool = False) -> Column:
    """``[name]``; ``escape`` doubles closing brackets."""
    inner = F.replace(name, F.lit("]"), F.lit("]]")) if escape else name
    return F.concat(F.lit("["), inner, F.lit("]"))


def cast_expression(column_name: Column, data_type: Column, precision: Column, scale: Column,
                    wide: bool = False) -> Column:
    """``<cast> AS [<safe name>]`` for one metadata row.

    The type table is a literal map, so the whole lookup is one expression per row; no join and
    no Python. ``wide`` adds the binary and spatial types and escapes brackets in names.
    """
    table = {**BASE_CASTS, **WIDE_CASTS} if wide else BASE_CASTS
    entries = F.create_map(*[F.lit(part) for pair in table.items() for part in pair])
    template = F.coalesce(
        F.try_element_at(entries, F.lower(F.coalesce(data_type, F.lit("")))), F.lit("{c}"))
    for mark, value in (("{p}", precision), ("{s}", scale)):
        number = F.coalesce(value, F.lit(0)).cast("string")
        template = F.replace(template, F.lit(mark), number)
    # The column name goes in last so that braces inside a name are left alone.
    expression = F.replace(template, F.lit("{c}"), quote_name(column_name, wide))
    return F.concat(expression, F.lit(" AS "), quote_name(safe_identifier(column_name), wide))


def spark_cast(column: Column, data_type: str, precision: int | None = None, scale: int | None = None,
               current_type: str = "string") -> Column:
    """Column of the Spark type that stands for a source type; unknown types are unchanged."""
    kind = (data_type or "").lower()
    target = SPARK_TYPES.get(kind)
    if target is None:
        return column
    if kind == "time":
        if current_type.startswith("timestamp"):
            return F.date_format(column, "HH:mm:ss")
        return F.substring(column.cast("string"), 1, 8)
    if kind == "uniqueidentifier":
        return F.substring(column.cast("string"), 1, 36)
    result = column.cast(target.format(p=precision or 0, s=scale or 0))
    unit = DATETIME_UNITS.get(kind)
    return F.date_trunc(unit, result).cast(target) if unit else result
