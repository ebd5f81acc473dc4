"""Values of a group joined into one text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import ci_key


#: Bytes in a text cell at most, so that no longer repetition can be asked for.
MAX_CELL = 2_147_483_647


def list_values(rows: DataFrame, keys: list[str], lists: dict[str, str], weight: str = "1", fold: bool = True) -> DataFrame:
    """Per key, list and value the number of rows (``n``): the lists one value per row.

    With ``fold``, spellings that differ in case or accents are one value, shown by the smallest of them.

    The form to use where a key has more values than fit in one text cell.
    """
    entries = ", ".join(
        f"named_struct('list', '{name}', 'value', CAST({column} AS string))" for name, column in lists.items()
    )
    long = rows.selectExpr(*keys, f"CAST({weight} AS bigint) AS n", f"explode(array({entries})) AS entry")
    counted = long.groupBy(*keys, "entry.list", "entry.value").agg(F.sum("n").alias("n"))
    if not fold:
        return counted
    folded = counted.groupBy(*keys, "list", ci_key(F.col("value")).alias("_key"))
    return folded.agg(F.min("value").alias("value"), F.sum("n").alias("n")).drop("_key")


def joined_lists(
    rows: DataFrame,
    keys: list[str],
    lists: dict[str, str],
    distinct: bool = True,
    weight: str = "1",
    row_count: str | None = None,
    value_counts: dict[str, str] | None = None,
    separator: str = ", ",
) -> DataFrame:
    """Per key one text for each named column: its values in order, joined.

    ``lists`` maps an output name to a column. All columns go through one shuffle
    on key, list and value, combined before it, so equal values meet as a count;
    only the values that make up the final text come together for a key. With
    ``distinct=False`` a value is repeated as often as it occurs. NULLs are left
    out; a list without values is NULL. A text longer than a cell can be is an
    error; ``list_values`` gives such lists one value per row.

    ``weight`` is how many rows an input row stands for. ``row_count`` names an
    output with the rows of the key, and ``value_counts`` outputs with the number
    of different values of a list; they come from the same pass.
    """
    counted = list_values(rows, keys, lists, weight, fold=distinct)
    return join_values(counted, keys, list(lists), distinct, row_count, value_counts, separator)


def join_values(
    counted: DataFrame,
    keys: list[str],
    lists: list[str],
    distinct: bool = True,
    row_count: str | None = None,
    value_counts: dict[str, str] | None = None,
    separator: str = ", ",
) -> DataFrame:
    """``joined_lists`` from the values of ``list_values``; ``row_count`` is that of the first of ``lists``."""
    between = separator.replace("\\", "\\\\").replace("'", "\\'")
    too_long = "raise_error('a repeated value does not fit in one cell; use list_values')"
    repeated = f"concat(repeat(concat(value, '{between}'), if(n > {MAX_CELL}, {too_long}, int(n - 1))), value)"
    per_list = counted.withColumn("text", F.col("value") if distinct else F.expr(repeated)).groupBy(*keys, "list").agg(
        F.expr(f"listagg(text, '{between}') WITHIN GROUP (ORDER BY value)").alias("text"),
        F.sum("n").alias("rows"),
        F.count("value").alias("values"),
    )
    shown = [_of(name, "text").alias(name) for name in lists]
    if row_count:
        shown.append(_of(lists[0], "rows").alias(row_count))
    for output, name in (value_counts or {}).items():
        shown.append(_of(name, "values").alias(output))
    return per_list.groupBy(*keys).agg(*shown)


def _of(name: str, column: str) -> Column:
    return F.max(F.when(F.col("list") == name, F.col(column)))
