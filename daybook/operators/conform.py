"""Matching a frame to a declared schema: by name, widening only."""

from pyspark.sql import DataFrame, functions as F, types as T

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
# Digits of the largest value.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_TIMESTAMP = (T.TimestampType, T.TimestampNTZType)


class SchemaMismatch(ValueError):
    """A declared column is missing, ambiguous, or would have to be narrowed."""


def _keeps_type(source: T.DataType, target: T.DataType) -> bool:
    # A declared timestamp accepts both kinds: moving between them would shift
    # values by the session time zone.
    return source == target or (
        isinstance(source, _TIMESTAMP) and isinstance(target, _TIMESTAMP)
    )


def _fits_decimal(source: T.DataType, target: T.DecimalType) -> bool:
    """Whether every value of the source is one of the target, as it stands."""
    if isinstance(source, T.DecimalType):
        whole, scale = source.precision - source.scale, source.scale
    elif type(source) in _DIGITS:
        whole, scale = _DIGITS[type(source)], 0
    else:
        return False
    return target.scale >= scale and target.precision - target.scale >= whole


def _widens(source: T.DataType, target: T.DataType) -> bool:
    if isinstance(source, T.NullType):
        return True
    if isinstance(target, T.StringType):
        return isinstance(source, T.AtomicType)
    if isinstance(target, _TIMESTAMP):
        return isinstance(source, T.DateType)
    if isinstance(target, T.DecimalType):
        return _fits_decimal(source, target)
    if isinstance(source, _NUMERIC) and isinstance(target, _NUMERIC):
        return _NUMERIC.index(type(source)) < _NUMERIC.index(type(target))
    return False


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project df onto the declared columns, in declared order and type.

    Columns resolve by name, under the session's case rule. Only widening casts
    are made; anything else raises SchemaMismatch here, before a job runs.
    Columns that are not declared are left out, so the scan skips them.
    """
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true"

    def spelled(name: str) -> str:
        return name if exact else name.lower()

    problems, columns = [], []
    for field in schema.fields:
        found = [c for c in df.schema.fields if spelled(c.name) == spelled(field.name)]
        if len(found) != 1:
            problems.append(f"{field.name}: {'missing' if not found else 'ambiguous'}")
            continue
        source = found[0].dataType
        column = F.col("`" + found[0].name.replace("`", "``") + "`")
        if _keeps_type(source, field.dataType):
            columns.append(column.alias(field.name))
        elif _widens(source, field.dataType):
            columns.append(column.cast(field.dataType).alias(field.name))
        else:
            problems.append(
                f"{field.name}: {source.simpleString()} does not widen to "
                f"{field.dataType.simpleString()}"
            )
    if problems:
        raise SchemaMismatch("; ".join(problems))
    return df.select(*columns)
