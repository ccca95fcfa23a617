"""Jobs from a source to aligned, annotated pairs: parse, flatten, align and all of them in a row."""

from __future__ import annotations

import importlib
import zlib
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tandemtext.functions.text import drop_page_references, is_blank, normalize_french, normalize_moore
from tandemtext.operators import filters, joins, models, parsers, segment
from tandemtext.plans import pipelines
from tandemtext.sources import readers

#: Titles, items and bodies of a manual as ``parsers.parse_manual`` gives them.
_LIST = "items array<struct<num:int,text:string>>,bullet_items array<struct<text:string>>,body string"
MANUAL_SCHEMA = f"number int, title string, sections array<struct<title string,raw_text string,subsections array<struct<title string,{_LIST}>>,{_LIST}>>, raw_text string"
#: Page from which a bilingual book has no running text.
LAST_PAGE = 39


def named_factory(name: str) -> Callable:
    """A model factory by its name ``module:function``."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def hashed_embedder(size: int = 256) -> models.Embed:
    """A plain stand-in for a sentence encoder: unit vectors of hashed character trigrams. It knows names and figures, not meanings."""

    def embed(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), size), dtype=np.float64)
        for k, text in enumerate(texts):
            marked = f"  {text.lower()} "
            for i in range(len(marked) - 2):
                out[k, zlib.crc32(marked[i : i + 3].encode()) % size] += 1.0
        return out

    return embed


def parse(pages: DataFrame, kind: str, sections: Sequence[str] = (), stops: Sequence[str] = ()) -> DataFrame:
    """What a parser makes of pages (doc_id, page, text): ``dictionary``, ``columns`` or ``manual``; with ``parse_status``."""
    if kind == "dictionary":
        return parsers.dictionary(pages)
    if kind == "columns":
        return parsers.columns_dictionary(pages)
    if kind == "manual":
        packed = F.array_sort(F.collect_list(F.struct("page", "text")))
        whole = pages.groupBy("doc_id").agg(F.array_join(F.transform(packed, lambda p: F.coalesce(p["text"], F.lit(""))), "\n").alias("text"))
        return parsers.parsed(whole, "doc_id", "text", lambda t: parsers.parse_manual(t, list(sections), stops=list(stops)), MANUAL_SCHEMA)
    raise ValueError(f"unknown kind {kind}")


def flatten_manual_pair(french: DataFrame, moore: DataFrame, names: dict[str, str] | None = None, segmented: bool = True) -> DataFrame:
    """(side, block, chapter, section, place, pos, sentence) of a manual parsed in both languages.

    Titles come first (block 0; of subsections in French only), as anchors of
    the alignment, then the contents (block 1). Page references go, names are
    replaced in French, and lone numbers, addresses and copyright lines are left out.
    """

    def side(df: DataFrame, name: str, normalize: Callable[[Column], Column]) -> DataFrame:
        named = (lambda c: joins.substitute_names(c, names)) if names and name == "french" else (lambda c: c)
        clean = lambda c: named(drop_page_references(c))
        chapters = df.select(F.col("number").alias("chapter"), F.col("title").alias("chapter_title"), "sections")
        own = chapters.select("chapter", F.lit(-1).alias("section"), F.lit(-1).alias("place"), F.col("chapter_title").alias("text"))
        long = chapters.select("chapter", F.posexplode("sections").alias("section", "s"))
        titles = own.unionByName(long.select("chapter", "section", F.lit(-1).alias("place"), F.col("s.title").alias("text")))
        if name == "french":
            inner = long.select("chapter", "section", F.posexplode("s.subsections").alias("place", "sub"))
            titles = titles.unionByName(inner.select("chapter", "section", "place", F.col("sub.title").alias("text")))
        titles = titles.where(~is_blank(F.col("text"))).select(F.lit(0).alias("block"), "chapter", "section", "place", F.lit(0).alias("pos"), normalize(clean(F.col("text"))).alias("sentence"))
        units = long.select("chapter", "section", F.posexplode(segment.manual_units(F.col("s"))).alias("place", "text"))
        cut = segment.segment(clean(F.col("text"))) if segmented else F.array(clean(F.col("text")))
        told = units.select("chapter", "section", "place", F.posexplode(cut).alias("pos", "raw")).where(filters.usable_segment(F.col("raw")))
        contents = told.select(F.lit(1).alias("block"), "chapter", "section", "place", "pos", normalize(F.col("raw")).alias("sentence"))
        return titles.unionByName(contents).select(F.lit(name).alias("side"), "*")

    return side(french, "french", normalize_french).unionByName(side(moore, "moore", normalize_moore))


def as_documents(sentences: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """(key, french, moore): the sentences of each side of a document as an array, in order."""
    packed = lambda name: F.transform(F.array_sort(F.collect_list(F.when(F.col("side") == name, F.struct(*order, "sentence")))), lambda x: x["sentence"])
    return sentences.groupBy(key).agg(packed("french").alias("french"), packed("moore").alias("moore"))


def align(documents: DataFrame, embed_french: Callable[[], models.Embed] | None = None, embed_moore: Callable[[], models.Embed] | None = None, least: float = 0.0, key: str = "doc_id") -> DataFrame:
    """(key, french_pos, moore_pos, french, moore, laser_score): both sides of each document along their warping path.

    ``documents`` has the sentences of both sides as arrays. Each sentence is
    embedded once; pairs below ``least`` or with a blank side are dropped.
    """
    embedders = {"french": embed_french or hashed_embedder, "moore": embed_moore or hashed_embedder}
    sides = {}
    for name, embed in embedders.items():
        long = documents.select(key, F.posexplode(name).alias("pos", "text"))
        sides[name] = models.embedded(long, "text", embed, "vector")
    path = joins.sequence_join(sides["french"], sides["moore"], key, "pos", "vector")
    paired = path.join(documents.select(key, *embedders), key)
    out = paired.select(key, F.col("pos_a").alias("french_pos"), F.col("pos_b").alias("moore_pos"), *[F.trim(F.get(n, F.col(p).cast("int"))).alias(n) for n, p in (("french", "pos_a"), ("moore", "pos_b"))], F.col("score").alias("laser_score"))
    return models.kept_alignments(out, "laser_score", least)


def foreign_lists(sources: dict[str, DataFrame], lexicon: DataFrame, shared: DataFrame | None = None) -> dict[str, DataFrame]:
    """The three word lists of the consistency check: words foreign to the lexicon, those also foreign to a shared list, and the lexicon's own."""
    from tandemtext.operators import wordlists

    foreign = list(sources.values())
    return {
        "foreign": wordlists.foreign_words(foreign, [lexicon]),
        "foreign_strict": wordlists.foreign_words(foreign, [lexicon] + ([shared] if shared is not None else [])),
        "native": wordlists.union_words([lexicon]).orderBy("word"),
    }


def end_to_end(documents: DataFrame, least: float = 0.0, embed: Callable[[], models.Embed] | None = None, key: str = "doc_id", **annotators) -> DataFrame:
    """Aligned pairs of documents, first of each pair kept, with the annotators asked for (see ``pipelines.annotate``)."""
    pairs = align(documents, embed, embed, least, key)
    numbered = pairs.withColumn("line_no", F.concat_ws("/", F.col(key).cast("string"), F.format_string("%09d", "french_pos"), F.format_string("%09d", "moore_pos")))
    unique = pipelines.finalize(numbered, drop_duplicates=True)
    return pipelines.annotate(unique, key="line_no", **annotators).drop("line_no")


def run(spark: SparkSession, args) -> DataFrame:
    """The result of one of the commands parse, flatten, align and e2e."""
    if args.command == "parse":
        return parse(spark.read.json(args.input), args.kind, args.section, args.stop)
    if readers.is_folder(spark, args.input):
        df = spark.read.parquet(args.input)
    elif args.command == "flatten" and args.kind == "entries":
        df = spark.read.schema(parsers.ENTRY_SCHEMA).json(args.input)  # empty lists tell no type
    else:
        df = spark.read.json(args.input)
    if args.command == "flatten":
        jobs = {"news": pipelines.flatten_news, "sessions": pipelines.flatten_sessions, "entries": pipelines.flatten_entries, "book": pipelines.flatten_book}
        return jobs[args.kind](df)
    embed = named_factory(args.embed) if args.embed else None
    if args.command == "align":
        return align(df, embed, embed, args.least, args.key)
    return end_to_end(df, args.least, embed, args.key, warnings=True, len_ratio=True)
