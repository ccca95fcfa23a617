"""Model operators: any callable that labels or scores batches of texts. No neural model is bundled."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandemtext.functions.text import is_blank, language_label, round4
from tandemtext.operators.columns import label_columns
from tandemtext.operators.dedup import components, repeated
from tandemtext.operators.joins import dot

Identify = Callable[[list[str]], list[tuple[str, float]]]
Score = Callable[[list[str], list[str]], list[float]]
Embed = Callable[[list[str]], np.ndarray]


def identified(df: DataFrame, field: str, identify: Callable[[], Identify], batch: int = 1000) -> DataFrame:
    """``df`` with the language and probability (four places) of a field. ``identify`` makes the model, once per task."""
    lang, prob = label_columns(field)

    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = identify()
        for texts in series:
            flat = [str(t).replace("\n", " ") if t is not None else "" for t in texts]
            found = [pair for k in range(0, len(flat), batch) for pair in model(flat[k : k + batch])]
            yield pd.DataFrame({"lang": [a for a, _ in found], "prob": [float(b) for _, b in found]})

    run.__annotations__ = {"series": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    label = F.pandas_udf(run, "lang string, prob double")(F.col(field))
    return df.withColumn("__l", label).withColumns({lang: language_label(F.col("__l.lang")), prob: round4(F.col("__l.prob"))}).drop("__l")


def identified_units(df: DataFrame, key: str, units: str, identify: Callable[[], Identify]) -> DataFrame:
    """``df`` with arrays of languages and probabilities of the units of rows with more than one unit; null for the others."""
    parts = df.where(F.size(units) > 1).select(key, F.posexplode(units).alias("pos", "unit"))
    scored = identified(parts, "unit", identify)
    lang, prob = label_columns("unit")
    packed = F.array_sort(F.collect_list(F.struct("pos", lang, prob)))
    back = scored.groupBy(key).agg(packed.alias("p")).select(key, F.transform("p", lambda x: x[lang]).alias(f"{units[:-1]}_langs"), F.transform("p", lambda x: x[prob]).alias(f"{units[:-1]}_probs"))
    return df.join(back, key, "left")


def scored(df: DataFrame, source: str, target: str, score: Callable[[], Score], name: str) -> DataFrame:
    """``df`` with a quality estimate of each pair, to four places; null texts count as empty."""

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = score()
        for a, b in batches:
            yield pd.Series(model(a.fillna("").tolist(), b.fillna("").tolist()), dtype="float64")

    run.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.Series]}
    return df.withColumn(name, round4(F.pandas_udf(run, "double")(F.col(source), F.col(target))))


def embedded(df: DataFrame, field: str, embed: Callable[[], Embed], name: str) -> DataFrame:
    """``df`` with unit vectors of a text field."""

    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = embed()
        for texts in series:
            matrix = np.asarray(model(texts.fillna("").tolist()), dtype=np.float64)
            matrix = matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)
            yield pd.Series(list(matrix.astype(np.float32)))

    run.__annotations__ = {"series": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return df.withColumn(name, F.pandas_udf(run, "array<float>")(F.col(field)))


def embedding_score(df: DataFrame, source: str, target: str, embed_source: Callable[[], Embed], embed_target: Callable[[], Embed], name: str = "laser_score") -> DataFrame:
    """``df`` with the dot product of both sides' unit vectors, to four places; no row is dropped."""
    both = embedded(embedded(df, source, embed_source, "__a"), target, embed_target, "__b")
    return both.withColumn(name, round4(dot(F.col("__a"), F.col("__b")))).drop("__a", "__b")


def translated(df: DataFrame, field: str, translate: Callable[[], Callable[[list[str]], list[str]]], name: str, in_flight: int = 128) -> DataFrame:
    """``df`` with translations, order kept; a request that fails gives ''. Up to ``in_flight`` requests run at once in a task."""

    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from concurrent.futures import ThreadPoolExecutor

        model = translate()

        def one(text: str) -> str:
            try:
                return model([text])[0]
            except Exception:  # noqa: BLE001
                return ""

        with ThreadPoolExecutor(in_flight) as pool:
            for texts in series:
                yield pd.Series(list(pool.map(one, texts.fillna("").tolist())), dtype=str)

    run.__annotations__ = {"series": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return df.withColumn(name, F.pandas_udf(run, "string")(F.col(field)))


def deduplicated(df: DataFrame, key: str, source: str, target: str, score: Callable[[], Score], name: str = "comet_qe") -> DataFrame:
    """Best pair of each group that shares a side; only repeated pairs are scored, the others keep a null score."""
    from pyspark.sql import Window

    again = repeated(df, [source, target])
    groups = components(scored(again, source, target, score, name), key, [source, target])
    window = Window.partitionBy("component").orderBy(F.col(name).desc_nulls_last(), key)
    best = groups.withColumn("__r", F.row_number().over(window)).where("__r = 1").drop("__r", "component")
    return best.unionByName(df.join(again.select(key), key, "left_anti").withColumn(name, F.lit(None).cast("double")))


def kept_alignments(df: DataFrame, score: str, least: float, first: str = "french", second: str = "moore") -> DataFrame:
    """Aligned pairs at or above a score with text on both sides."""
    return df.where((F.col(score) >= least) & ~is_blank(F.col(first)) & ~is_blank(F.col(second)))


def first_of(columns: Sequence[str]) -> Column:
    return F.coalesce(*[F.col(c) for c in columns])


def naive_bayes(labelled: DataFrame, text: str, label: str, sizes: Sequence[int] = (1, 2, 3), features: int = 1 << 16):
    """A language identifier trained on labelled texts: multinomial naive Bayes over hashed character n-grams, in the JVM."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import HashingTF, IndexToString, NGram, SQLTransformer, StringIndexer, VectorAssembler

    usable = labelled.where(F.col(text).isNotNull() & F.col(label).isNotNull()).select(F.col(text).alias("__text"), F.col(label).alias("__label"))
    index = StringIndexer(inputCol="__label", outputCol="__y", stringOrderType="alphabetAsc").fit(usable)
    chars = SQLTransformer(statement="SELECT *, split(lower(coalesce(__text, '')), '') AS __chars FROM __THIS__")
    grams = [NGram(n=n, inputCol="__chars", outputCol=f"__g{n}") for n in sizes]
    hashed = [HashingTF(numFeatures=features, inputCol=f"__g{n}", outputCol=f"__h{n}") for n in sizes]
    joined = VectorAssembler(inputCols=[f"__h{n}" for n in sizes], outputCol="__x")
    bayes = NaiveBayes(featuresCol="__x", labelCol="__y", predictionCol="__p", probabilityCol="__probs", rawPredictionCol="__raw")
    told = IndexToString(inputCol="__p", outputCol="__lang", labels=index.labels)
    return Pipeline(stages=[chars, *grams, *hashed, joined, bayes, told]).fit(index.transform(usable))


def identified_by(model, df: DataFrame, field: str) -> DataFrame:
    """``df`` with the language and probability (not rounded) that a model of :func:`naive_bayes` gives a field; null texts count as empty."""
    from pyspark.ml.functions import vector_to_array

    lang, prob = label_columns(field)
    out = model.transform(df.withColumn("__text", F.col(field)))
    return out.withColumns({lang: F.col("__lang"), prob: F.array_max(vector_to_array("__probs"))}).select(*df.columns, lang, prob)
