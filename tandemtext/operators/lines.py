"""Operators on ordered lines of documents: headings, list items, page ranges, entries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tandemtext.operators import ranges

NUMBERED = r"^\s*(?:\([^)]*\)\s*)?(\d+)\.\s"
BULLET = r"^\s*•"


def lines_of(df: DataFrame, key: str, text: str, *keep: str) -> DataFrame:
    """(key, keep..., line_no, line): the lines of each text, numbered from 1."""
    return df.select(key, *keep, F.posexplode(F.split(text, "\n")).alias("p", "line")).select(key, *keep, (F.col("p") + 1).alias("line_no"), "line")


def _running(scope: str | Sequence[str], order: str):
    return Window.partitionBy(scope).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def heading_groups(df: DataFrame, scope: str, order: str, heading: Column, name: str = "group_no") -> DataFrame:
    """``df`` with the number of headings seen so far in its document; the lines before the first are group 0."""
    return df.withColumn(name, F.sum(F.coalesce(heading, F.lit(False)).cast("int")).over(_running(scope, order)))


def carry_heading(df: DataFrame, scope: str, order: str, heading: Column, name: str = "heading") -> DataFrame:
    """``df`` with the last heading line seen; null before the first."""
    return df.withColumn(name, F.last(F.when(heading, F.col("line")), ignorenulls=True).over(_running(scope, order)))


def until_stop(df: DataFrame, scope: str, order: str, stop: Column) -> DataFrame:
    """Lines before the first one that ``stop`` holds for."""
    seen = F.max(F.coalesce(stop, F.lit(False)).cast("int")).over(_running(scope, order))
    return df.withColumn("__s", seen).where("__s = 0").drop("__s")


def group_items(df: DataFrame, scope: str, order: str, start: Column) -> DataFrame:
    """(scope, item_no, text): each start line with the lines that follow it, joined by blanks; the preamble is ignored."""
    grouped = heading_groups(df, scope, order, start, "item_no").where("item_no > 0")
    packed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.trim("line").alias("l"))))
    joined = F.array_join(F.filter(F.transform(packed, lambda x: x["l"]), lambda x: x != ""), " ")
    return grouped.groupBy(scope, "item_no").agg(joined.alias("text"))


def numbered_items(df: DataFrame, scope: str, order: str) -> DataFrame:
    """As :func:`group_items` for ``N.`` lines (a role in brackets may stand before), with the number."""
    items = group_items(df, scope, order, F.col("line").rlike(NUMBERED))
    return items.withColumn("num", F.regexp_extract("text", NUMBERED, 1).try_cast("int"))


def bullet_items(df: DataFrame, scope: str, order: str) -> DataFrame:
    """As :func:`group_items` for bullet lines; it runs on the same lines, independently of numbered items."""
    return group_items(df, scope, order, F.col("line").rlike(BULLET))


def range_of(df: DataFrame, page: str, starts: Sequence[tuple[int, int]], stop: int | None = None, name: str = "chapter_no") -> DataFrame:
    """``df`` with the chapter whose start page is the last one not after the page; pages before all, or after ``stop``, are dropped."""
    found = F.lit(None).cast("int")
    for number, start in sorted(starts, key=lambda s: s[1]):
        found = F.when(F.col(page) >= start, F.lit(number)).otherwise(found)
    out = df.withColumn(name, found).where(F.col(name).isNotNull())
    return out if stop is None else out.where(F.col(page) <= stop)


def join_broken_pages(df: DataFrame, scope: str, page: str, text: str) -> DataFrame:
    """Text with a word broken over a page joined: the first word of the next page moves back to it."""
    window = Window.partitionBy(scope).orderBy(page)
    after = F.lead(text).over(window)
    before = F.lag(text).over(window)
    broken = r"(?U)\w-\s*$"
    tail = F.regexp_extract(after, r"^\s*(\S+)", 1)
    starts = F.when(before.rlike(broken), F.regexp_replace(F.col(text), r"^\s*\S+\s*", "")).otherwise(F.col(text))
    out = df.withColumns({"__body": starts, "__tail": F.when(F.col(text).rlike(broken) & after.isNotNull(), tail)})
    joined = F.when(F.col("__tail").isNotNull(), F.concat(F.regexp_replace("__body", r"-\s*$", ""), "__tail")).otherwise(F.col("__body"))
    return out.withColumn(text, joined).drop("__body", "__tail")


def carry_value(df: DataFrame, scope: str, order: str, value: Column, valid: Column, name: str) -> DataFrame:
    """``df`` with the last valid value of the rows before (not the row's own)."""
    cut = ranges.in_ranges(df, [scope], [order])
    return ranges.last_before(cut, [scope], [order], F.when(valid, value), name).drop(ranges.PART)


def running_offset(df: DataFrame, scope: str | None, order: str, size: str, name: str = "offset") -> DataFrame:
    """``df`` with the summed sizes of the rows before within their scope."""
    scopes = [] if scope is None else [scope]
    return ranges.sum_before(ranges.in_ranges(df, scopes, [order]), scopes, [order], F.col(size), name).drop(ranges.PART)


def chain_examples(pairs: Column) -> Column:
    """Examples from gloss pairs ARRAY<STRUCT<french, english>>: the Moore text of pair j stands in the English of pair j-1."""

    def example(j: Column) -> Column:
        before, own = F.get(pairs, j - 1), F.get(pairs, j)
        return F.struct(F.trim(F.regexp_extract(before["english"], r"(?s)\{e\.g\.\s*([^}]*)\}", 1)).alias("moore"), own["french"].alias("french"), own["english"].alias("english"))

    return F.when(F.size(pairs) > 1, F.transform(F.sequence(F.lit(1), F.size(pairs) - 1), example)).otherwise(F.array().cast("array<struct<moore:string,french:string,english:string>>"))


def columns_of_page(blocks: DataFrame, scope: Sequence[str], columns: int = 2) -> DataFrame:
    """(scope..., text): blocks of a page read column by column; blank and digit-only blocks are left out.

    ``blocks`` has block_no, x0, page_width and text.
    """
    column = F.least(F.floor(F.col("x0") / (F.col("page_width") / columns)), F.lit(columns - 1))
    usable = blocks.where("trim(text) <> ''").where(~F.trim("text").rlike(r"^\d+$"))
    packed = F.array_sort(F.collect_list(F.struct(column.alias("c"), F.col("block_no"), F.col("text"))))
    return usable.groupBy(*scope).agg(F.array_join(F.transform(packed, lambda b: b["text"]), "\n\n").alias("text"))


def split_at_separator(blocks: DataFrame, lines: DataFrame, scope: Sequence[str], least_height: float = 200.0) -> DataFrame:
    """``blocks`` with side 'left' or 'right' of the page's vertical rule (nearest to the centre; the centre where none is drawn).

    ``lines`` has the scope, x0, x1 and height of drawn lines.
    """
    upright = lines.where((F.abs(F.col("x0") - F.col("x1")) < 1) & (F.col("height") > least_height)).select(*scope, F.col("x0").alias("__x"))
    width = blocks.groupBy(*scope).agg(F.max("page_width").alias("__w"))
    rule = width.join(upright, list(scope), "left").groupBy(*scope, "__w").agg(F.min_by("__x", F.abs(F.col("__x") - F.col("__w") / 2)).alias("__x"))
    return blocks.join(rule, list(scope)).withColumn("side", F.when(F.col("x0") < F.coalesce("__x", F.col("__w") / 2), "left").otherwise("right")).drop("__x", "__w")


def best_table(cells: DataFrame, least_columns: int) -> DataFrame:
    """Rows of one table per page: with enough columns and the most non-empty rows; strict settings come before loose ones.

    ``cells`` has doc_id, page, setting, table_no, row_no and cells.
    """
    filled = F.exists("cells", lambda c: F.coalesce(F.trim(c), F.lit("")) != "")
    per_table = cells.groupBy("doc_id", "page", "setting", "table_no").agg(F.count_if(filled).alias("rows"), F.max(F.size("cells")).alias("width"))
    usable = per_table.where(F.col("width") >= least_columns)
    order = Window.partitionBy("doc_id", "page").orderBy((F.col("setting") == "strict").desc(), F.desc("rows"), "table_no")
    chosen = usable.withColumn("__r", F.row_number().over(order)).where("__r = 1").select("doc_id", "page", "setting", "table_no")
    return cells.join(chosen, ["doc_id", "page", "setting", "table_no"])
