"""Contract type names and Spark types."""

from __future__ import annotations

import re

from pyspark.sql import types as T

#: Contract type name -> Spark type (fixed values). DECIMAL keeps given (p, s).
SPARK_TYPES: dict[str, T.DataType] = {
    "BIGINT": T.LongType(),
    "INTEGER": T.IntegerType(),
    "SMALLINT": T.ShortType(),
    "TINYINT": T.ByteType(),
    "DOUBLE": T.DoubleType(),
    "REAL": T.FloatType(),
    "DECIMAL": T.DecimalType(18, 2),
    "NUMERIC": T.DecimalType(18, 2),
    "VARCHAR": T.StringType(),
    "CHAR": T.StringType(),
    "TEXT": T.StringType(),
    "UUID": T.StringType(),
    "TIME": T.StringType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "TIMESTAMP WITH TIME ZONE": T.TimestampType(),
    "INTERVAL": T.DayTimeIntervalType(),
    "BLOB": T.BinaryType(),
}

_DECIMAL = re.compile(r"^(?:DECIMAL|NUMERIC)\s*\(\s*(\d+)\s*,\s*(\d+)\s*\)$")


def to_spark_type(name: str) -> T.DataType:
    """Spark type of a contract type; arrays, structs and maps in Spark's own notation. A name that
    is no type is an error."""
    text = name.strip()
    upper = text.upper()
    decimal = _DECIMAL.match(upper)
    if decimal:
        return T.DecimalType(int(decimal.group(1)), int(decimal.group(2)))
    if "<" in text:
        return T.DataType.fromDDL(text)
    base = upper.split("(")[0].strip()
    if base not in SPARK_TYPES:
        raise ValueError(f"{name} is not a contract type")
    return SPARK_TYPES[base]


def to_contract_type(data_type: T.DataType) -> str:
    """Contract type of a Spark type; nested types keep Spark's notation."""
    if isinstance(data_type, T.DecimalType):
        if (data_type.precision, data_type.scale) == (18, 2):
            return "DECIMAL"
        return f"DECIMAL({data_type.precision},{data_type.scale})"
    if isinstance(data_type, (T.ArrayType, T.StructType, T.MapType)):
        return data_type.simpleString()
    if isinstance(data_type, (T.StringType, T.CharType, T.VarcharType)):
        return "VARCHAR"
    if isinstance(data_type, T.TimestampType):
        return "TIMESTAMP WITH TIME ZONE"
    for name, known in SPARK_TYPES.items():
        if isinstance(data_type, type(known)):
            return name
    raise ValueError(f"no contract type for {data_type.simpleString()}")


def same_type(contract_type: str, actual: T.DataType) -> bool:
    """Whether data of type ``actual`` satisfies ``contract_type``.

    A DECIMAL without (p, s) accepts decimals and fractions; TIMESTAMP accepts both timestamp types.
    """
    expected = to_spark_type(contract_type)
    if contract_type.strip().upper() in ("DECIMAL", "NUMERIC"):
        return isinstance(actual, (T.DecimalType, T.DoubleType, T.FloatType))
    if isinstance(expected, T.DecimalType) and isinstance(actual, T.DecimalType):
        return expected == actual
    stamps = (T.TimestampType, T.TimestampNTZType)
    if isinstance(expected, stamps) and isinstance(actual, stamps):
        return True
    if isinstance(expected, T.StringType) and isinstance(actual, T.StringType):
        return True
    return expected == actual
