"""Writers: JSON lines, JSON trees, text, Parquet by split or source, and rewrites in place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandemtext.functions.text import round4
from tandemtext.operators.columns import drop_all_null, migrate_score, needs_migration, to_json_rows
from tandemtext.sources.readers import exists


def write_json_lines(df: DataFrame, path: str, mode: str = "error") -> None:
    """One JSON object a row, letters unescaped, nulls written."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_pairs(df: DataFrame, path: str, mode: str = "error") -> None:
    """Pair rows in fixed key order, scores to four places; english and score only where any row has them."""
    kept = drop_all_null(df, [c for c in ("english", "laser_score") if c in df.columns])
    if "laser_score" in kept.columns:
        kept = kept.withColumn("laser_score", round4(F.col("laser_score")))
    order = [c for c in ("french", "moore", "english", "laser_score", "source") if c in kept.columns]
    write_json_lines(kept.select(*order), path, mode)


def write_structs(df: DataFrame, path: str, mode: str = "error") -> None:
    """JSON rows without null fields and empty arrays."""
    to_json_rows(df).write.mode(mode).text(path)


def write_lines(df: DataFrame, folder: str, columns: dict[str, str], mode: str = "error") -> None:
    """One text file set per column: {column: suffix}."""
    for column, suffix in columns.items():
        df.select(F.coalesce(F.col(column), F.lit("")).alias("value")).write.mode(mode).text(f"{folder}/{suffix}")


def write_splits(df: DataFrame, path: str, split: str = "split", without: Sequence[str] = ("quality_warnings",), mode: str = "error") -> None:
    """Parquet partitioned by split."""
    df.drop(*without).write.mode(mode).partitionBy(split).parquet(path)


def write_configs(df: DataFrame, path: str, source: str = "source", merged: bool = True, mode: str = "error") -> None:
    """One configuration per source, and 'all' with every row unless ``merged`` is off."""
    one = df.withColumn("config", F.col(source))
    out = one.unionByName(df.withColumn("config", F.lit("all"))) if merged else one
    out.write.mode(mode).partitionBy("config").parquet(path)


def rewrite(df: DataFrame, path: str) -> None:
    """Replace what lies at ``path`` with ``df``, which may read it: written beside it first, then renamed."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    fs_path = jvm.org.apache.hadoop.fs.Path
    target, fresh, old = fs_path(path), fs_path(path + ".new"), fs_path(path + ".old")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(fresh, True)
    fs.delete(old, True)
    write_json_lines(df, path + ".new")
    if fs.exists(target):
        fs.rename(target, old)
    fs.rename(fresh, target)
    fs.delete(old, True)


def migrate_file(spark, path: str, dry_run: bool = False) -> bool:
    """Whether a JSON-lines file needs its score column migrated; unless a dry run, it is rewritten."""
    df = spark.read.json(path)
    needed = needs_migration(df)
    if needed and not dry_run:
        rewrite(migrate_score(df), path)
    return needed


def output_paths(inputs: Sequence[str], output: str | None) -> list[str]:
    """Where scored files go: in place without an output, the output itself for one input, a folder for several."""
    if output is None:
        return list(inputs)
    if len(inputs) == 1:
        return [output]
    return [f"{output.rstrip('/')}/{p.rstrip('/').rsplit('/', 1)[-1]}" for p in inputs]


def annotate_file(spark, path: str, transform, output: str | None = None) -> DataFrame | None:
    """Apply ``transform`` to a JSON-lines file and write it; an empty file is skipped (None)."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    df = spark.read.json(path)
    if not df.columns or df.isEmpty():
        return None
    out = transform(df)
    rewrite(out, output or path)
    return out


def table_dump(cells: DataFrame) -> DataFrame:
    """(value): each extracted table as JSON {page, table_index, columns, rows}; its first row names the columns."""
    packed = F.array_sort(F.collect_list(F.struct("row_no", "cells")))
    tables = cells.groupBy("doc_id", "page", "table_no").agg(F.transform(packed, lambda r: r["cells"]).alias("r"))
    shaped = tables.select(F.col("page"), F.col("table_no").alias("table_index"), F.get("r", F.lit(0)).alias("columns"), F.slice("r", 2, F.greatest(F.size("r") - 1, F.lit(1))).alias("rows"))
    return shaped.select(F.to_json(F.struct("page", "table_index", "columns", "rows")).alias("value"))
