"""Hot join keys, found by the plan's own inputs.

A key that holds a large share of a side's rows lands in one task of a full outer join, which
adaptive execution can't split. :func:`frequent_keys` finds such keys in one pass over the key
columns: a frequent-items sketch of key hashes, filled by each map task and merged, names the
candidates; only if there are any, a second pass counts those exactly. At most ``1 / share``
keys of a side can hold ``share`` of its rows, which bounds everything kept here.

:func:`in_cells` then deals a hot key over a grid: the target's rows into ``a`` lines, the
source's rows into ``b`` columns, ``a`` and ``b`` in proportion to the rows. A target row goes
to every column of its line, a source row to every line of its column, so each pair of rows
meets in exactly one cell. Keys that aren't hot stay in cell (0, 0): for them it is the plain
join. The place of a row is a hash of its values, so a task that runs again deals it alike;
rows equal in all columns share a cell.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

#: Share of a side's rows from which a key counts as hot.
HOT_SHARE = 0.005
#: Counters of the sketch; its error is about 3.5 / TRACKED of the rows, far below HOT_SHARE.
TRACKED = 10_000


def may_skew(df: DataFrame) -> bool:
    """The planner expects more bytes than the session's limit for a skewed partition.

    A smaller side can't fill a partition beyond that limit, whatever its keys.
    """
    spark = df.sparkSession
    limit = spark.conf.get("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")
    limit = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit)
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) > int(limit)


def frequent_keys(df: DataFrame, names: Sequence[str], share: float = HOT_SHARE) -> DataFrame | None:
    """The keys (columns ``names``, never null) that hold at least ``share`` of the rows, with
    ``splits``: how many partitions of average size their rows fill. ``None`` if there is none.

    Runs one job over the key columns, and a second one if the sketch names candidates. The
    result has at most ``1 / share`` rows and is kept in the checkpoint folder.
    """
    spark = df.sparkSession
    code = F.xxhash64(*[F.col(n) for n in names])
    top = (df.select(code.alias("code"))
           .agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(code, {int(2 / share)}, {TRACKED})").alias("top"))
           .first())
    likely = [r["item"] for r in top["top"] or [] if 2 * r["count"] >= share * top["n"]]
    if not likely:
        return None
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = (df.where(code.isin(likely)).groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
               .where(F.col("n") >= share * top["n"])
               .select(*names, F.ceil(F.col("n") * parts / top["n"]).cast("int").alias("splits"))
               .where("splits > 1"))
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    found = counted.checkpoint(eager=True)
    return None if found.isEmpty() else found


def joint(first: DataFrame | None, second: DataFrame | None, names: Sequence[str]) -> DataFrame | None:
    """Hot keys of two inputs that end up in one table."""
    if first is None or second is None:
        return first if second is None else second
    return first.union(second).groupBy(*names).agg(F.max("splits").alias("splits"))


def grid(target_hot: DataFrame | None, source_hot: DataFrame | None, names: Sequence[str]) -> DataFrame | None:
    """One row a key that is hot on either side: ``names``, lines and columns of its cells."""
    sides = []
    for found, lines in ((target_hot, True), (source_hot, False)):
        if found is not None:
            n, one = F.col("splits"), F.lit(1)
            sides.append(found.select(*names, (n if lines else one).alias("__lines"), (one if lines else n).alias("__cols")))
    if not sides:
        return None
    both = sides[0] if len(sides) == 1 else sides[0].union(sides[1])
    both = both.groupBy(*names).agg(F.max("__lines").alias("__lines"), F.max("__cols").alias("__cols"))
    # a key's matches are spread evenly over as many cells as there are partitions; more would
    # only repeat rows more often
    parts = int(both.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    less = F.least(F.lit(1.0), F.sqrt(F.lit(parts) / (F.col("__lines") * F.col("__cols"))))
    return both.select(*names, F.when(F.col("__cols") == 1, F.col("__lines")).otherwise(F.ceil(F.col("__lines") * less))
                       .cast("int").alias("__lines"),
                       F.when(F.col("__lines") == 1, F.col("__cols")).otherwise(F.ceil(F.col("__cols") * less))
                       .cast("int").alias("__cols"))


def _hashable(t: DataType) -> bool:
    if isinstance(t, (MapType, VariantType)):
        return False
    if isinstance(t, ArrayType):
        return _hashable(t.elementType)
    return all(_hashable(f.dataType) for f in t.fields) if isinstance(t, StructType) else True


def in_cells(df: DataFrame, names: Sequence[str], cells: DataFrame, line_side: bool) -> DataFrame:
    """``df`` dealt over the cells of its hot keys: columns ``__line`` and ``__col``, and
    ``__met``: the key is hot on the other side, so it is known to be there.

    ``cells`` is broadcast: it has at most ``2 / share`` rows.
    """
    place = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if _hashable(f.dataType)])
    key = [F.col(n).alias(f"__cell_{n}") for n in names]
    marks = cells.select(*key, "__lines", "__cols")
    on = [F.col(n) == F.col(f"__cell_{n}") for n in names]
    cond: Column = on[0]
    for c in on[1:]:
        cond = cond & c
    lines, cols = F.coalesce("__lines", F.lit(1)), F.coalesce("__cols", F.lit(1))
    own, other = (lines, cols) if line_side else (cols, lines)
    own_name, other_name = ("__line", "__col") if line_side else ("__col", "__line")
    dealt = df.join(F.broadcast(marks), cond, "left").select(
        *[F.col(f"`{c}`") for c in df.columns], F.pmod(place, own).cast("int").alias(own_name),
        (other > 1).alias("__met"), F.sequence(F.lit(0), other - 1).alias("__all"))
    return dealt.withColumn(other_name, F.explode("__all")).drop("__all")
