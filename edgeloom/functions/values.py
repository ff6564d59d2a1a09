"""Value types, tolerance comparison and the user-function surface."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

ValueFunction = str | Callable[[Column], Column] | Callable[[object], object]


def simple_type(dtype: T.DataType) -> str:
    """Reduce a Spark type to ``int``, ``float``, ``bool`` or ``str``."""
    if isinstance(dtype, T.IntegralType):
        return "int"
    if isinstance(dtype, (T.FractionalType,)):
        return "float"
    if isinstance(dtype, T.BooleanType):
        return "bool"
    if isinstance(dtype, T.StringType):
        return "str"
    raise TypeError(f"no simple type for {dtype.simpleString()}")


def widest_type(names: list[str]) -> str:
    """The type that holds all of ``names``: float over int over bool, otherwise str."""
    for wide in ("float", "int", "bool"):
        if wide in names and set(names) <= {"float", "int", "bool"}:
            return wide
    return "str"


# Spark type that stands for each simple type.
SPARK_TYPES = {"int": "bigint", "float": "double", "bool": "boolean", "str": "string"}


def values_differ(
    left: Column, right: Column, dtype: T.DataType, rel_tol: float, abs_tol: float
) -> Column:
    """True where two values differ: floats beyond the tolerance, all others unless equal.

    Two nulls agree, a null and a value differ; NaN agrees with NaN only.
    """
    equal = left.eqNullSafe(right)
    if simple_type(dtype) != "float":
        return ~equal
    a, b = left.cast("double"), right.cast("double")
    slack = F.greatest(F.lit(rel_tol) * F.greatest(F.abs(a), F.abs(b)), F.lit(abs_tol))
    infinity = F.lit(float("inf"))
    finite = (F.abs(a) < infinity) & (F.abs(b) < infinity)  # NaN sorts above infinity
    near = F.coalesce(finite & (F.abs(a - b) <= slack), F.lit(False))
    return ~(equal | near)


def apply_function(
    df: DataFrame, column: str, func: ValueFunction, return_type: str | None = None,
    scalar: bool = False, batch: bool = False,
) -> Column:
    """The column ``func(column)``.

    ``func`` is a SQL expression over ``column`` or a function from Column to Column, which
    Catalyst can see. Python functions must be asked for, with a ``return_type``: with
    ``scalar`` over single values (None for null, whole numbers exact), with ``batch`` over
    Arrow arrays. Both get Arrow batches.
    """
    if column not in df.columns:
        raise ValueError(f"there is no column {column}: the edges or nodes have no weights")
    if scalar or batch:
        if return_type is None:
            raise ValueError("a Python function needs a return_type")
        arrow = to_arrow_type(T.DataType.fromDDL(return_type))

        def by_value(values: pa.Array) -> pa.Array:
            return pa.array([func(v) for v in values.to_pylist()], arrow)

        def by_batch(values: pa.Array) -> pa.Array:
            return func(values).cast(arrow)

        return F.arrow_udf(by_batch if batch else by_value, return_type)(F.col(column))
    result = F.expr(func) if isinstance(func, str) else func(F.col(column))
    if not isinstance(result, Column):
        raise TypeError("the function must return a Column; pass scalar=True for Python values")
    return result if return_type is None else result.cast(return_type)
