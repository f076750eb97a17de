"""Table operators over cells (table_id, row, col, text) and over row arrays
(`cells array<array<string>>`, one row a table). Indexes count from 0."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.functions.text import escape_cell


def grid(cells: DataFrame, dims: DataFrame) -> DataFrame:
    """Dense rows (table_id, row, col, text) of tables dims (table_id, rows, cols): the
    last cell by cell_idx wins a place, places without cells are empty, cells outside are dropped."""
    last = cells.groupBy("table_id", "row", "col").agg(F.max_by("text", "cell_idx").alias("text"))
    places = dims.select("table_id", F.explode(F.sequence(F.lit(0), F.col("rows") * F.col("cols") - 1)).alias("at"), "cols")
    places = places.select("table_id", F.floor(F.col("at") / F.col("cols")).cast("int").alias("row"), (F.col("at") % F.col("cols")).cast("int").alias("col"))
    return places.join(last, ["table_id", "row", "col"], "left").withColumn("text", F.coalesce("text", F.lit("")))


def to_rows(dense: DataFrame) -> DataFrame:
    """(table_id, cells) of dense cells."""
    rows = dense.groupBy("table_id", "row").agg(F.array_sort(F.collect_list(F.struct("col", "text"))).alias("r"))
    rows = rows.select("table_id", "row", F.transform("r", lambda x: x["text"]).alias("r"))
    return rows.groupBy("table_id").agg(F.array_sort(F.collect_list(F.struct("row", "r"))).alias("t")).select("table_id", F.transform("t", lambda x: x["r"]).alias("cells"))


def markdown(cells: Column) -> Column:
    """A Markdown table; its first row is the header. Empty without cells."""
    line = lambda r: F.concat(F.lit("| "), F.array_join(F.transform(r, escape_cell), " | "), F.lit(" |"))
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), F.size(cells[0])), " | "), F.lit(" |"))
    lines = F.concat(F.array(line(cells[0]), rule), F.transform(F.slice(cells, 2, F.greatest(F.size(cells) - 1, F.lit(0))), line))
    return F.when((F.size(cells) > 0) & (F.size(cells[0]) > 0), F.array_join(lines, "\n")).otherwise("")


def append_row(cells: Column, texts: Column) -> Column:
    """A row as wide as the last; missing texts empty, extra ones left out."""
    width = F.size(F.element_at(cells, -1))
    new = F.transform(F.sequence(F.lit(0), width - 1), lambda i: F.coalesce(F.get(texts, i), F.lit("")))
    return F.concat(cells, F.array(new))


def delete_row(cells: Column, n: Column) -> Column:
    return F.filter(cells, lambda _, i: i != n)


def append_column(cells: Column, texts: Column) -> Column:
    """Rows without cells stay as they are."""
    return F.transform(cells, lambda r, i: F.when(F.size(r) > 0, F.array_append(r, F.coalesce(F.get(texts, i), F.lit("")))).otherwise(r))


def delete_column(cells: Column, n: Column) -> Column:
    return F.transform(cells, lambda r: F.filter(r, lambda _, i: i != n))


def set_cell(cells: Column, row: Column, col: Column, text: Column) -> Column:
    return F.transform(cells, lambda r, i: F.transform(r, lambda c, j: F.when((i == row) & (j == col), text).otherwise(c)))


def merge_horizontal(cells: Column, row: Column, start: Column, count: Column) -> Column:
    """The next count - 1 cells of the row go."""
    gone = lambda j: (j > start) & (j < start + count)
    return F.transform(cells, lambda r, i: F.when(i == row, F.filter(r, lambda _, j: ~gone(j))).otherwise(r))


def merge_vertical(cells: Column, col: Column, start: Column, count: Column) -> Column:
    """The cell of this column goes from the next count - 1 rows."""
    return F.transform(cells, lambda r, i: F.when((i > start) & (i < start + count), F.filter(r, lambda _, j: j != col)).otherwise(r))
