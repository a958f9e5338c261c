"""Column roles as data, leak guards, null audits and invariants, all returning rows.

``require_empty`` turns any of them into a failure.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.columns import tally

ROLE_SCHEMA = "column_name string, role string, feature_group string, position int"


def roles_table(
    spark: SparkSession,
    roles: Mapping[str, Sequence[str]],
    features: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """``(column_name, role, feature_group, position)``; features keep their group order."""
    rows: list[tuple] = []
    for role, columns in roles.items():
        rows += [(c, role, None, len(rows) + i) for i, c in enumerate(columns)]
    for group, columns in (features or {}).items():
        rows += [(c, "feature", group, len(rows) + i) for i, c in enumerate(columns)]
    return spark.createDataFrame(rows, ROLE_SCHEMA)


def column_listing(df: DataFrame) -> DataFrame:
    """The columns of a frame as rows."""
    return df.sparkSession.createDataFrame(
        [(c, i) for i, c in enumerate(df.columns)], "column_name string, position int"
    )


def role_problems(df: DataFrame, roles: DataFrame, shared: Sequence[str] = ("key",)) -> DataFrame:
    """Columns without a role, roles without a column, and columns with two roles.

    A key column may also be a feature (hour, entity); the ``shared`` roles are not counted
    against a second one.
    """
    present = column_listing(df).select("column_name")
    declared = roles.select("column_name", "role").distinct()
    undeclared = present.exceptAll(declared.select("column_name").distinct())
    absent = declared.select("column_name").distinct().exceptAll(present)
    single = declared.where(~F.col("role").isin(list(shared)))
    double = single.groupBy("column_name").count().where("count > 1").select("column_name")
    return (
        undeclared.select("column_name", F.lit("undeclared").alias("problem"))
        .unionByName(absent.select("column_name", F.lit("absent").alias("problem")))
        .unionByName(double.select("column_name", F.lit("two roles").alias("problem")))
    )


def leaks(roles: DataFrame, leaking: str = "leak_if_unlagged") -> DataFrame:
    """Declared features that are same-hour outcomes."""
    return (
        roles.where(F.col("role") == "feature")
        .select("column_name")
        .intersect(roles.where(F.col("role") == leaking).select("column_name"))
    )


def collect_features(roles: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Features of the listed groups, first occurrence first, without repeats."""
    wanted = roles.where((F.col("role") == "feature") & F.col("feature_group").isin(list(groups)))
    order = F.array_position(F.array(*[F.lit(g) for g in groups]), F.col("feature_group"))
    return wanted.groupBy("column_name").agg(
        F.min(F.struct(order.alias("g"), "position")).alias("first_seen")
    ).select(
        "column_name",
        F.col("first_seen.g").cast("int").alias("group_position"),
        F.col("first_seen.position").alias("position"),
    )


def null_counts(df: DataFrame) -> DataFrame:
    """``(column_name, nulls, row_count)`` from one pass."""
    names = df.columns
    counted = df.agg(
        F.count("*").alias("_rows"), *[tally(F.col(c).isNull()).alias(c) for c in names]
    )
    return counted.unpivot("_rows", names, "column_name", "nulls").select(
        "column_name", "nulls", F.col("_rows").alias("row_count")
    )


def null_audit(
    df: DataFrame,
    families: Mapping[str, Sequence[str]],
    suffix_families: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Null-bearing columns with the documented family that explains each.

    Families are tried in order, suffixes first; a column no family explains reads
    ``UNEXPLAINED``.
    """
    name = F.col("column_name")
    case = F.lit("UNEXPLAINED")
    for family, members in reversed(list(families.items())):
        case = F.when(name.isin(list(members)), F.lit(family)).otherwise(case)
    for family, suffixes in reversed(list((suffix_families or {}).items())):
        hit = F.lit(False)
        for suffix in suffixes:
            hit = hit | name.endswith(suffix)
        case = F.when(hit, F.lit(family)).otherwise(case)
    return null_counts(df).where(F.col("nulls") > 0).select("*", case.alias("family"))


def audit_summary(audit: DataFrame) -> DataFrame:
    return audit.groupBy("family").agg(
        F.count("*").alias("columns"), F.max("nulls").alias("worst_case_rows")
    )


def invariants(df: DataFrame, violations: Mapping[str, Column]) -> DataFrame:
    """``(check_name, violations)``: rows breaking each row-level rule, in one aggregate."""
    names = list(violations)
    counted = df.agg(*[tally(violations[n]).alias(n) for n in names])
    return counted.unpivot([], names, "check_name", "violations")


def null_disagrees(value: str, denominator: str) -> Column:
    """A statistic must be null exactly where its denominator is zero."""
    return F.col(value).isNull() != (F.col(denominator) == 0)


def out_of_unit(column: str) -> Column:
    """A share outside [0, 1], where it is defined."""
    return F.col(column).isNotNull() & ~F.col(column).between(0, 1)


def conserved(
    source: DataFrame, target: DataFrame, pairs: Mapping[str, tuple[Column, Column]], tolerance: float
) -> DataFrame:
    """Totals before and after a step, and whether they agree within a tolerance.

    Double sums depend on the order of addition, so money is compared with a tolerance.
    """

    def totals(df: DataFrame, side: int, name: str) -> DataFrame:
        names = list(pairs)
        row = df.agg(*[pairs[n][side].cast("double").alias(n) for n in names])
        return row.unpivot([], names, "total", name)

    both = totals(source, 0, "before").join(totals(target, 1, "after"), on="total", how="full")
    return both.select(
        "*",
        F.coalesce(F.abs(F.col("before") - F.col("after")) <= tolerance, F.lit(False)).alias("holds"),
    )


def require_empty(problems: DataFrame, message: str) -> None:
    """Fail with the first few rows when a check returned any."""
    found = problems.take(5)
    if found:
        raise ValueError(f"{message}: {found}")
