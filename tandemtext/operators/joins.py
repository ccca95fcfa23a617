"""Joins: prioritised lookups, by number, by place, by sequence, and by vector."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tandemtext.functions.text import fold_key

def prioritised_lookup(probe: DataFrame, build: DataFrame, passes: Sequence[tuple[Column, Column]], payload: Sequence[str], order: str) -> DataFrame:
    """Inner join by several keys in order of priority: the first key that finds a row wins.

    ``passes`` are (probe key, build key) pairs. Blank keys find nothing. Of
    build rows with one key the last by ``order`` counts. Lookup sides are not
    hinted: adaptive execution broadcasts them where their measured size allows. Adds ``payload`` and
    ``match_pass`` (1-based); probe rows without a match are dropped.
    """
    out = probe
    for n, (probe_key, build_key) in enumerate(passes, 1):
        last = Window.partitionBy("__k").orderBy(F.desc(order))
        side = build.select(build_key.alias("__k"), order, *payload).where("__k is not null and __k <> ''")
        side = side.withColumn("__r", F.row_number().over(last)).where("__r = 1").select(F.col("__k").alias(f"__k{n}"), F.struct(*payload).alias(f"__hit{n}"))
        out = out.withColumn(f"__p{n}", probe_key).join(side, F.col(f"__p{n}") == F.col(f"__k{n}"), "left").drop(f"__k{n}", f"__p{n}")
    hits = [F.col(f"__hit{n}") for n in range(1, len(passes) + 1)]
    out = out.withColumns({"__hit": F.coalesce(*hits), "match_pass": F.coalesce(*[F.when(h.isNotNull(), F.lit(n)) for n, h in enumerate(hits, 1)])}).where("__hit is not null")
    return out.select(*probe.columns, *[F.col(f"__hit.{c}").alias(c) for c in payload], "match_pass")


def term_keys(term: Column, text: Column) -> list[Column]:
    """Keys of a glossary term: folded, folded text of the first parentheses, folded without blanks."""
    inside = F.regexp_extract(text, r"\(([^)]*)\)", 1)
    return [fold_key(term), fold_key(inside), F.regexp_replace(fold_key(term), r"\s+", "")]


def left_by_number(left: DataFrame, right: DataFrame, key: str, order: str, *texts: str) -> DataFrame:
    """Left join by number; texts of rows without a partner are ''; of duplicate numbers the last by ``order`` counts."""
    last = Window.partitionBy(key).orderBy(F.desc(order))
    side = right.withColumn("__r", F.row_number().over(last)).where("__r = 1").select(key, *texts)
    return left.join(side, key, "left").fillna("", list(texts))


def zip_places(df: DataFrame, arrays: Sequence[str], *keep: str, shortest: bool = True) -> DataFrame:
    """Parallel arrays to rows by place: up to the shortest one, or null-padded to the longest."""
    zipped = F.arrays_zip(*[F.col(a) for a in arrays])
    out = df.select(*keep, F.posexplode(zipped).alias("pos", "__z"), F.least(*[F.size(a) for a in arrays]).alias("__n") if len(arrays) > 1 else F.size(arrays[0]).alias("__n"))
    if shortest:
        out = out.where("pos < __n")
    return out.select(*keep, "pos", *[F.col(f"__z.{a}").alias(a) for a in arrays])


def equal_lengths(df: DataFrame, arrays: Sequence[str]) -> DataFrame:
    """``df``, failing at run time with the sizes of the first row whose arrays differ in length."""
    sizes = [F.size(a) for a in arrays]
    same = F.lit(True)
    for s in sizes[1:]:
        same = same & (s == sizes[0])
    message = F.concat(F.lit("arrays of different lengths: "), F.concat_ws(", ", *[s.cast("string") for s in sizes]))
    return df.withColumn("__ok", F.when(same, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))).where("__ok").drop("__ok")


def semi_words(df: DataFrame, words: Column, listed: DataFrame, key: str) -> DataFrame:
    """Rows of which any word is listed."""
    hits = df.select(key, F.explode(words).alias("word")).join(listed.select("word").distinct(), "word", "left_semi").select(key).distinct()
    return df.join(hits, key, "left_semi")


def unlisted_count(df: DataFrame, words: Column, listed: DataFrame, key: str) -> DataFrame:
    """(key, unlisted): distinct words of each row that are not listed; 0 where all are."""
    rest = df.select(key, F.explode(words).alias("word")).distinct().join(listed.select("word").distinct(), "word", "left_anti")
    counts = rest.groupBy(key).agg(F.count("*").alias("unlisted"))
    return df.select(key).join(counts, key, "left").fillna(0, ["unlisted"])


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays; null where either is zero or empty."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def similar_pairs(queries: DataFrame, rows: DataFrame, scope: str, key: str, vector: str, below: float | None = None, least: float | None = None) -> DataFrame:
    """(scope, key_a, key_b, similarity) of a stated query set against the rows of its scope.

    The join is on the scope (a document or label), never over all rows.
    """
    a = queries.select(scope, F.col(key).alias(f"{key}_a"), F.col(vector).alias("__a"))
    b = rows.select(scope, F.col(key).alias(f"{key}_b"), F.col(vector).alias("__b"))
    out = a.join(b, scope).select(scope, f"{key}_a", f"{key}_b", cosine(F.col("__a"), F.col("__b")).alias("similarity"))
    if below is not None:
        out = out.where(F.col("similarity") < below)
    return out if least is None else out.where(F.col("similarity") >= least)


def cosine_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a = a / np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-12)
    b = b / np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-12)
    return 1.0 - a @ b.T


def dtw_path(cost: np.ndarray) -> list[tuple[int, int]]:
    """Exact time-warping path from the first to the last cell; ties prefer the diagonal. Whole anti-diagonals are filled at once."""
    n, m = cost.shape
    steps = np.zeros((n, m), np.int8)
    older, old = np.full(n + 1, np.inf), np.full(n + 1, np.inf)  # best costs of the last two anti-diagonals; place i + 1 is row i
    for d in range(n + m - 1):
        i = np.arange(max(0, d - m + 1), min(n, d + 1))
        choices = np.stack([older[i] if d else np.zeros(1), old[i], old[i + 1]])
        steps[i, d - i] = choices.argmin(axis=0)
        new = np.full(n + 1, np.inf)
        new[i + 1] = cost[i, d - i] + choices.min(axis=0)
        older, old = old, new
    path, i, j = [], n - 1, m - 1
    while i >= 0 and j >= 0:
        path.append((i, j))
        step = steps[i, j]
        i, j = i - (step != 2), j - (step != 1)
    return path[::-1]


def sequence_join(first: DataFrame, second: DataFrame, scope: str, order: str, vector: str, distance: Callable[[np.ndarray, np.ndarray], np.ndarray] = cosine_distances) -> DataFrame:
    """(scope, order_a, order_b, score): monotone many-to-many path between two vector sequences of each scope.

    Each scope (a document) is one group: both sides are tagged, united and
    grouped once, so nothing but the documents themselves must fit a task.
    Scopes with one side only give no rows.
    """
    kind = first.schema[scope].dataType.simpleString()
    tagged = first.select(scope, F.lit(0).alias("side"), F.col(order).cast("long").alias("ord"), F.col(vector).cast("array<double>").alias("vec"))
    tagged = tagged.unionByName(second.select(scope, F.lit(1).alias("side"), F.col(order).cast("long").alias("ord"), F.col(vector).cast("array<double>").alias("vec")))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        names = [scope, f"{order}_a", f"{order}_b", "score"]
        group = group[group["vec"].notna()].sort_values("ord")
        a, b = group[group["side"] == 0], group[group["side"] == 1]
        if not len(a) or not len(b):
            return pd.DataFrame([], columns=names)
        cost = distance(np.stack(a["vec"].to_list()), np.stack(b["vec"].to_list()))
        out = [(group[scope].iloc[0], int(a["ord"].iloc[i]), int(b["ord"].iloc[j]), float(1.0 - cost[i, j])) for i, j in dtw_path(cost)]
        return pd.DataFrame(out, columns=names)

    return tagged.groupBy(scope).applyInPandas(run, f"`{scope}` {kind}, {order}_a bigint, {order}_b bigint, score double")


def regroup(parts: DataFrame, key: str, place: str, *values: str) -> DataFrame:
    """(key, values as arrays in order of place): scored parts back to their parent."""
    packed = F.array_sort(F.collect_list(F.struct(place, *values)))
    grouped = parts.groupBy(key).agg(packed.alias("__p"))

    def field(name: str) -> Column:
        return F.transform("__p", lambda p: p[name])

    return grouped.select(key, *[field(v).alias(v) for v in values])


def canonical_title(df: DataFrame, line: str, titles: Sequence[tuple[str, str]]) -> DataFrame:
    """``df`` with ``title``: of the (marker, title) rules the first in order whose marker the line starts with."""
    found = F.coalesce(*[F.when(F.lower(F.col(line)).startswith(marker.lower()), F.lit(title)) for marker, title in titles], F.lit(None).cast("string"))
    return df.withColumn("title", found)


def substitute_names(text: Column, names: dict[str, str]) -> Column:
    """Whole-word replacement of all names at once; no replacement is replaced again."""
    marks = {name: chr(0xE000 + k) for k, name in enumerate(sorted(names))}
    for name, mark in marks.items():
        text = F.regexp_replace(text, rf"(?U)\b{name}\b", mark)
    for name, mark in marks.items():
        text = F.replace(text, F.lit(mark), F.lit(names[name]))
    return text
