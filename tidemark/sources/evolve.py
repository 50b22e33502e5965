"""Reading batches whose columns change their type between files (Q3).

Files that agree are read together: Spark merges the footers of a group in one job, and a
group that can't be merged is halved and tried again, down to single files. Drift comes with
time, so batches are halved in their order and the files of a batch by age: k changes of type
among n batches take about k·log n such jobs. Groups of one schema are then put together, each
is one scan, and its columns are cast to the join of their types:

    byte < short < int < long < decimal < double < string,   date < timestamp_ntz < timestamp

Any other pair of atomic types joins to string. Records join field by field, arrays by
element and maps by value (with one key type); a nested value that meets another type becomes
its JSON text. A decimal join keeps all digits of both sides; beyond 38 digits it is a double.
Whole numbers beyond 2^53 and decimals lose digits as a double, so ``exact=True`` joins these
pairs to string instead. Names are matched without regard to case, the first spelling stays.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# decimal digits that hold every value of a whole-number type
WHOLE_DIGITS = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 19}
WHOLE = list(WHOLE_DIGITS)
TIMES = [DateType(), TimestampNTZType(), TimestampType()]
SMALL = (ByteType, ShortType, IntegerType, FloatType)  # a double holds each of their values


def join_types(a: DataType, b: DataType, exact: bool = False) -> DataType:
    """The least type of the lattice above ``a`` and ``b``; the order of the two doesn't matter."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, StructType) and isinstance(b, StructType):
        return join_schemas([a, b], exact)
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(join_types(a.elementType, b.elementType, exact), True)
    if isinstance(a, MapType) and isinstance(b, MapType) and a.keyType == b.keyType:
        return MapType(a.keyType, join_types(a.valueType, b.valueType, exact), True)
    if a in WHOLE and b in WHOLE:
        return max(a, b, key=WHOLE.index)
    if a in TIMES and b in TIMES:
        return max(a, b, key=TIMES.index)
    if (a in WHOLE or isinstance(a, DecimalType)) and (b in WHOLE or isinstance(b, DecimalType)):
        (whole_a, scale_a), (whole_b, scale_b) = _digits(a), _digits(b)
        whole, scale = max(whole_a, whole_b), max(scale_a, scale_b)
        if whole + scale <= 38:
            return DecimalType(whole + scale, scale)
        return StringType() if exact else DoubleType()
    if _number(a) and _number(b):  # one of them is a float or a double
        if exact and not all(isinstance(t, SMALL + (DoubleType,)) for t in (a, b)):
            return StringType()
        return DoubleType()
    return StringType()


def _number(t: DataType) -> bool:
    return t in WHOLE or isinstance(t, (DecimalType, FloatType, DoubleType))


def _digits(t: DataType) -> tuple[int, int]:
    return (t.precision - t.scale, t.scale) if isinstance(t, DecimalType) else (WHOLE_DIGITS[t], 0)


def join_schemas(schemas: Sequence[StructType], exact: bool = False) -> StructType:
    """One nullable column for each name (case apart), in order of first appearance. Decimals are
    joined before doubles and strings, so the result doesn't depend on the order of the schemas."""
    seen: dict[str, tuple[str, list[DataType]]] = {}
    for s in schemas:
        for f in s.fields:
            seen.setdefault(f.name.lower(), (f.name, []))[1].append(f.dataType)
    return StructType([StructField(name, _join_all(types, exact), True) for name, types in seen.values()])


def _join_all(types: list[DataType], exact: bool) -> DataType:
    out: DataType = NullType()
    for t in sorted(types, key=lambda t: (isinstance(t, StringType), not (t in WHOLE or isinstance(t, DecimalType)))):
        out = join_types(out, t, exact)
    return out


def conform(value: Column, have: DataType, want: DataType) -> Column:
    """``value`` of type ``have`` as ``want``, a type at or above it in the lattice."""
    if have == want:
        return value
    if isinstance(have, StructType) and isinstance(want, StructType):
        own = {f.name.lower(): f for f in have.fields}
        parts = []
        for f in want.fields:
            g = own.get(f.name.lower())
            part = F.lit(None).cast(f.dataType) if g is None else conform(value.getField(g.name), g.dataType, f.dataType)
            parts.append(part.alias(f.name))
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(have, ArrayType) and isinstance(want, ArrayType):
        return F.transform(value, lambda x: conform(x, have.elementType, want.elementType))
    if isinstance(have, MapType) and isinstance(want, MapType):
        return F.transform_values(value, lambda _, x: conform(x, have.valueType, want.valueType))
    if isinstance(have, (StructType, ArrayType, MapType)) and isinstance(want, StringType):
        return F.to_json(value)
    return value.cast(want)


def conform_frame(df: DataFrame, want: StructType) -> DataFrame:
    """``df`` with the columns and types of ``want``; a column it lacks is null."""
    own = {f.name.lower(): f for f in df.schema.fields}
    out = []
    for f in want.fields:
        g = own.get(f.name.lower())
        value = F.lit(None).cast(f.dataType) if g is None else conform(F.col(f"`{g.name}`"), g.dataType, f.dataType)
        out.append(value.alias(f.name))
    return df.select(*out)


@dataclass
class SchemaGroup:
    """Files or folders that are read as one, with their common schema."""

    schema: StructType
    paths: list[str] = field(default_factory=list)
    base: str | None = None  # the batch's folder, where ``paths`` are files in it

    def read(self, spark: SparkSession, fmt: str, options: dict) -> DataFrame:
        reader = spark.read.format(fmt).options(**options)
        if self.base is not None:
            reader = reader.option("basePath", self.base)
        return reader.schema(self.schema).load(self.paths)


def schema_groups(spark: SparkSession, fmt: str, paths: Sequence[str], **options) -> list[SchemaGroup]:
    """The batches in groups of files that merge without a change of type (Parquet, ORC)."""
    groups: list[SchemaGroup] = []
    _halve(spark, fmt, list(paths), None, options, groups)
    together: dict[tuple, SchemaGroup] = {}
    for g in groups:
        key = (g.base, tuple((f.name.lower(), f.dataType.json()) for f in g.schema.fields))
        together.setdefault(key, SchemaGroup(g.schema, [], g.base)).paths.extend(g.paths)
    return list(together.values())


def _halve(spark: SparkSession, fmt: str, paths: list[str], base: str | None, options: dict,
           out: list[SchemaGroup]) -> None:
    from .files import list_files

    reader = spark.read.format(fmt).options(**options).option("mergeSchema", "true")
    if base is not None:
        reader = reader.option("basePath", base)
    try:
        out.append(SchemaGroup(reader.load(paths).schema, paths, base))
        return
    except (PySparkException, Py4JJavaError) as e:
        if "CANNOT_MERGE" not in str(e):
            raise
        conflict = e
    if len(paths) == 1 and base is None:  # a batch whose own files differ
        base = paths[0]
        paths = [r.file_path for r in list_files(spark, base).orderBy("modification_time", "file_path").collect()]
    if len(paths) == 1:
        raise conflict
    half = len(paths) // 2
    for part in (paths[:half], paths[half:]):
        _halve(spark, fmt, part, base, options, out)


def read_widened(spark: SparkSession, fmt: str, paths: Sequence[str], exact: bool = False, **options) -> DataFrame:
    """All rows of the batches under the join of their schemas: one scan for each distinct schema.

    The cast reaches no pushed filter of a group whose column already has the joined type, and
    columns that aren't used are pruned in every group. An empty list of batches is refused.
    """
    if not paths:
        raise ValueError("no batches to read")
    groups = schema_groups(spark, fmt, paths, **options)
    want = join_schemas([g.schema for g in groups], exact)
    out = None
    for g in groups:
        df = g.read(spark, fmt, options)
        df = df if len(groups) == 1 else conform_frame(df, want)
        out = df if out is None else out.unionAll(df)
    return out


EVOLUTION_SCHEMA = "column_name string, observed_type string, joined_type string, n_paths bigint"


def type_evolution(spark: SparkSession, fmt: str, paths: Sequence[str], exact: bool = False, **options) -> DataFrame:
    """How columns vary between the batches: one row for each column and type seen, with the type
    it is read as and the number of paths (batches, or files of a mixed batch) that hold it."""
    groups = schema_groups(spark, fmt, paths, **options)
    want = join_schemas([g.schema for g in groups], exact)
    joined = {f.name.lower(): f for f in want.fields}
    counts: dict[tuple[str, str], int] = {}
    for g in groups:
        for f in g.schema.fields:
            k = (f.name.lower(), f.dataType.simpleString())
            counts[k] = counts.get(k, 0) + len(g.paths)
    rows = [(joined[c].name, t, joined[c].dataType.simpleString(), n) for (c, t), n in counts.items()]
    return spark.createDataFrame(rows, EVOLUTION_SCHEMA)
