"""Data-quality rules and reports.

A rule is data: the table it looks at and what breaks it. A clean table has issue count 0 everywhere.
All row rules of one table are counted in a single pass over it. All uniqueness rules of a suite share one exchange
of keys, for which each table is read once; rules about another table shuffle their key columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierloom.functions import collation


@dataclass(frozen=True)
class RowRule:
    """Rows that meet the SQL condition ``broken_if`` break the rule; unknown does not."""

    table: str
    name: str
    broken_if: str


@dataclass(frozen=True)
class UniqueRule:
    """Every combination of ``keys`` that occurs more than once is one issue; with ``folded``, texts that differ only
    in case or in blanks at the end are one."""

    table: str
    name: str
    keys: tuple[str, ...]
    folded: bool = False


@dataclass(frozen=True)
class ReferenceRule:
    """Rows under ``only_if`` break the rule if their ``foreign_key`` exists in another table
    (``exists=True``), or if it does not."""

    table: str
    name: str
    foreign_key: str
    reference: str
    key: str
    exists: bool = False
    only_if: str = "true"


Rule = RowRule | UniqueRule | ReferenceRule


def _literal(value) -> str:
    return str(value) if isinstance(value, (int, float)) else "'" + value.replace("'", "''") + "'"


def not_null(table: str, column: str, name: str | None = None) -> RowRule:
    return RowRule(table, name or f"NULL {column}", f"{column} IS NULL")


def not_blank(table: str, column: str, name: str) -> RowRule:
    return RowRule(table, name, f"{column} IS NULL OR trim({column}) = ''")


def unique(table: str, *keys: str, folded: bool = False) -> UniqueRule:
    label = keys[0] if len(keys) == 1 else "(" + ", ".join(keys) + ")"
    return UniqueRule(table, f"duplicate {label}", keys, folded)


def in_set(table: str, column: str, values: Sequence, name: str | None = None) -> RowRule:
    """NULL passes, as an unknown comparison does."""
    listed = ", ".join(_literal(v) for v in values)
    return RowRule(table, name or f"invalid {column}", f"{column} NOT IN ({listed})")


def not_before(table: str, end: str, start: str, name: str, only_if: str | None = None) -> RowRule:
    condition = f"{end} < {start}"
    return RowRule(table, name, f"{condition} AND {only_if}" if only_if else condition)


def not_future(table: str, column: str, as_of: str, name: str) -> RowRule:
    """Broken after ``as_of``, a day as text or an SQL expression such as ``current_date()``."""
    day = as_of if as_of.endswith(")") else f"DATE '{as_of}'"
    return RowRule(table, name, f"{column} > {day}")


def bound(table: str, column: str, operator: str, value, name: str) -> RowRule:
    """Broken where ``column operator value`` holds, e.g. ``price <= 0``."""
    return RowRule(table, name, f"{column} {operator} {_literal(value)}")


def consistent(
    table: str, column: str, expression: str, name: str, tolerance: float | None = None
) -> RowRule:
    """A derived column computed again; with a tolerance, by the size of the difference."""
    if tolerance is None:
        return RowRule(table, name, f"{column} <> {expression}")
    return RowRule(table, name, f"abs({column} - {expression}) > {tolerance}")


def references(
    table: str, foreign_key: str, reference: str, key: str, name: str | None = None
) -> ReferenceRule:
    """Every non-NULL foreign key must exist in the other table."""
    return ReferenceRule(
        table, name or f"unresolved {foreign_key}", foreign_key, reference, key,
        only_if=f"{foreign_key} IS NOT NULL",
    )


def _report(name: str, table: str) -> str:
    return f"{table} - {name}"


def _row_issues(df: DataFrame, rules: Sequence[RowRule], label) -> DataFrame:
    """One aggregate over the table, turned from one wide row into a row per rule."""
    counted = df.agg(
        *(F.count_if(F.expr(rule.broken_if)).alias(f"c{i}") for i, rule in enumerate(rules))
    )
    lines = F.array(
        *(
            F.struct(
                F.lit(_report(rule.name, label(rule.table))).alias("check_name"),
                F.col(f"c{i}").alias("issue_count"),
            )
            for i, rule in enumerate(rules)
        )
    )
    return counted.select(F.inline(lines))


#: Keys of more bytes go by their SHA-256 digest.
_LONG_KEY = 32


def _key_text(df: DataFrame, keys: Sequence[str], folded: bool = False) -> Column:
    """A key as one text that no other key has: each part with its length, or a mark for NULL."""
    kinds = dict(df.dtypes)

    def part(name: str) -> Column:
        value = F.col(name) + F.lit(0.0) if kinds.get(name) in ("double", "float") else F.col(name)  # -0.0 is 0.0
        text = collation.folded(value.cast("string")) if folded else value.cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    whole = F.concat(*(part(k) for k in keys))
    return F.when(F.octet_length(whole) > _LONG_KEY, F.sha2(whole.cast("binary"), 256)).otherwise(whole)


def _repeated_keys(tables: Mapping[str, DataFrame], rules: Sequence[UniqueRule], label) -> DataFrame:
    """Issues of all uniqueness rules from one exchange of (rule, key) entries; each table is read once for all its rules.

    Entries are counted before the shuffle, so a hot key is one row per task. Short keys stand for themselves, long ones for
    their digest, so that wide keys do not make wide rows.
    """
    parts = []
    for table in dict.fromkeys(rule.table for rule in rules):
        entries = (
            F.struct(F.lit(i).alias("rule"), _key_text(tables[table], rule.keys, rule.folded).alias("key")) for i, rule in enumerate(rules) if rule.table == table
        )
        parts.append(tables[table].select(F.inline(F.array(*entries))))
    repeated = reduce(DataFrame.unionAll, parts).groupBy("rule", "key").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    counted = repeated.agg(*(F.count_if(F.col("rule") == i).alias(f"c{i}") for i in range(len(rules))))
    lines = (
        F.struct(F.lit(_report(rule.name, label(rule.table))).alias("check_name"), F.col(f"c{i}").alias("issue_count"))
        for i, rule in enumerate(rules)
    )
    return counted.select(F.inline(F.array(*lines)))


def _reference_issues(tables, rule: ReferenceRule, label) -> DataFrame:
    """Rows are counted per key before the join, so a hot foreign key reaches it once per task."""
    rows = (
        tables[rule.table]
        .filter(F.expr(rule.only_if))
        .groupBy(F.col(rule.foreign_key).alias("_foreign_key"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    known = tables[rule.reference].select(F.col(rule.key).alias("_known_key"))
    how = "left_semi" if rule.exists else "left_anti"
    return (
        rows.join(known, F.col("_foreign_key") == F.col("_known_key"), how)
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("issue_count"))
        .select(F.lit(_report(rule.name, label(rule.table))).alias("check_name"), "issue_count")
    )


def run_suite(
    tables: Mapping[str, DataFrame], rules: Sequence[Rule], prefix: str = ""
) -> DataFrame:
    """``check_name`` and ``issue_count`` of every rule; ``prefix`` goes in front of table names."""

    def label(table: str) -> str:
        return prefix + table

    parts = []
    for table in dict.fromkeys(rule.table for rule in rules):
        own = [r for r in rules if r.table == table]
        row_rules = [r for r in own if isinstance(r, RowRule)]
        if row_rules:
            parts.append(_row_issues(tables[table], row_rules, label))
        parts += [_reference_issues(tables, r, label) for r in own if isinstance(r, ReferenceRule)]
    unique_rules = [r for r in rules if isinstance(r, UniqueRule)]
    if unique_rules:
        parts.append(_repeated_keys(tables, unique_rules, label))
    return reduce(DataFrame.unionByName, parts)


def match_rates(fact: DataFrame, total: str, resolved: Mapping[str, str]) -> DataFrame:
    """One row: ``total``, then the matched count and the percentage of every resolved column.

    ``resolved`` maps a plural noun for a dimension to the fact column that is NULL where the join
    found nothing: ``{"products": "product_key"}`` gives ``matched_products`` and
    ``product_match_pct``, a decimal with one place, NULL for an empty fact.
    """
    counts = fact.agg(
        F.count(F.lit(1)).alias(total),
        *(F.count(column).alias(f"matched_{noun}") for noun, column in resolved.items()),
    )
    return counts.select(
        total,
        *(f"matched_{noun}" for noun in resolved),
        *(
            F.try_divide(F.col(f"matched_{noun}") * F.lit(100).cast("decimal(3,0)"), F.col(total))
            .cast("decimal(5,1)")
            .alias(noun.removesuffix("s") + "_match_pct")
            for noun in resolved
        ),
    )


def _pairs(df: DataFrame, columns: Sequence[str], first: int = 0) -> DataFrame:
    """A row for each row and column: the column's number, counted from ``first``, and its value as text."""
    pairs = (
        F.struct(F.lit(i).alias("_column"), F.col(c).cast("string").alias("value")) for i, c in enumerate(columns, first)
    )
    return df.select(F.inline(F.array(*pairs)))


def column_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name``, ``value`` (as text) and ``row_count`` of every value in the columns.

    Columns are laid out as (column, value) pairs, counted per pair and combined before the shuffle.
    This spreads by value, not by column, and is one exchange however many columns there are.
    """
    counts = _pairs(df, columns).groupBy("_column", "value").agg(F.count(F.lit(1)).alias("row_count"))
    return counts.select(F.element_at(F.array(*map(F.lit, columns)), F.col("_column") + 1).alias("column_name"), "value", "row_count")


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: rows, NULLs, blanks, distinct values and rows that repeat another one's value."""
    return column_profiles({"": df}, {"": columns}).drop("table_name")


def column_profiles(tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """``table_name`` and the profile of every column, all tables in one exchange of (column, value) pairs.

    Pairs are counted before they are shuffled, and the pairs of a column are summed up where they are: the second exchange
    has a row for each column and task. See :mod:`tierloom.operators.sketches` for a profile that shuffles no values.
    """
    named = [(table, column) for table, df in tables.items() for column in (columns or {}).get(table, df.columns)]
    parts, first = [], 0
    for table, df in tables.items():
        own = [c for t, c in named if t == table]
        parts.append(_pairs(df, own, first))
        first += len(own)

    def rows_where(condition, rows):
        return F.coalesce(F.sum(F.when(condition, rows)), F.lit(0))

    value, rows = F.col("value"), F.col("row_count")
    counts = reduce(DataFrame.unionAll, parts).groupBy("_column", "value").agg(F.count(F.lit(1)).alias("row_count"))
    profile = counts.groupBy("_column").agg(
        F.sum(rows).alias("row_count"),
        rows_where(value.isNull(), rows).alias("null_count"),
        rows_where(F.trim(value) == "", rows).alias("blank_count"),
        F.count(value).alias("distinct_count"),
        rows_where(value.isNotNull(), rows - 1).alias("repeated_count"),
    )
    names = F.array(*(F.struct(F.lit(t).alias("table_name"), F.lit(c).alias("column_name")) for t, c in named))
    return profile.select(F.element_at(names, F.col("_column") + 1).alias("_name"), "*").select("_name.*", *profile.columns[1:])
