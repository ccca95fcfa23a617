"""Whole jobs: annotate, assemble a corpus, flatten sources, align, and their command line."""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandemtext.functions import quality
from tandemtext.functions.text import is_blank, length_ratio, normalize_french, normalize_moore
from tandemtext.operators import dedup, filters, lexicon, models, report, segment, split
from tandemtext.operators.columns import drop_unrequested

Transform = Callable[[DataFrame], DataFrame]


def annotate(
    df: DataFrame,
    source: str = "french",
    target: str = "moore",
    lid=None,
    warnings: bool = False,
    consistency: bool = False,
    len_ratio: bool = False,
    embed=None,
    estimate=None,
    foreign: DataFrame | None = None,
    key: str | None = None,
) -> DataFrame:
    """The annotators asked for, in fixed order: language, warnings and consistency (one pass), ratio, vector score, estimate.

    Models are factories (see ``models``); consistency needs a word list and a unique key.
    """
    if not any((lid, warnings, consistency, len_ratio, embed, estimate)):
        raise ValueError("choose at least one annotator")
    out = df
    if lid:
        out = models.identified(models.identified(out, source, lid), target, lid)
    if warnings or consistency:
        marked = out
        listed = F.lit(False)
        if foreign is not None and key is not None:
            marked, listed = quality.with_consistency(out, target, foreign, key), F.col("foreign_words")
        else:
            marked = out.withColumn("identification_consistency", F.lit(None).cast("double"))
        labels = quality.warnings(F.col(source), F.col(target))
        with_foreign = F.when(listed, F.filter(F.array(*[F.lit(x) for x in quality.LABELS]), lambda x: F.array_contains(labels, x) | (x == "foreign_words"))).otherwise(labels)
        marked = marked.withColumn("quality_warnings", with_foreign).drop("foreign_words")
        out = drop_unrequested(marked, [c for c, on in (("quality_warnings", warnings), ("identification_consistency", consistency)) if on])
    if len_ratio:
        out = out.withColumn("len_ratio", length_ratio(F.col(source), F.col(target)))
    if embed:
        out = models.embedding_score(out, source, target, embed, embed)
    if estimate:
        out = models.scored(out, source, target, estimate, "comet_qe")
    return out


def assemble(
    parts: Sequence[DataFrame],
    train_only: Sequence[str] = ("lexicon_entries", "digital-terms"),
    keep: Column | None = None,
    dev: int = 500,
    test: int = 500,
    seed: int = 42,
    external: Sequence[tuple[str, DataFrame]] = (),
) -> DataFrame:
    """Corpus with a split column: union in order, first of each pair, quality filter, stratified split, external splits added.

    Each part has french, moore, source and a unique ``line_no``; sources in
    ``train_only`` never enter dev or test. ``external`` are (split, pairs).
    """
    out = None
    for k, part in enumerate(parts):
        tagged = part.withColumn("file_ord", F.lit(k))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    out = dedup.first_wins(out.where(filters.both_sides(F.col("french"), F.col("moore"))), ["french", "moore"], ["file_ord", "line_no"])
    if keep is not None:
        out = out.where(keep)
    only = F.coalesce(F.col("source").isin(*train_only), F.lit(False))
    free = split.stratified_split(out.where(~only), "source", ["french", "moore"], dev, test, seed)
    whole = free.unionByName(out.where(only).withColumn("split", F.lit("train")))
    for name, df in external:
        whole = whole.unionByName(df.where(filters.both_sides(F.col("french"), F.col("moore"))).withColumn("split", F.lit(name)), allowMissingColumns=True)
    return whole.drop("file_ord", "line_no")


def split_totals(corpus: DataFrame) -> DataFrame:
    """(split, source, n) with totals per split and overall (an extension of the per-source report)."""
    return corpus.rollup("split", "source").agg(F.count("*").alias("n")).orderBy(F.col("split").asc_nulls_last(), F.col("source").asc_nulls_last())


def flatten_news(entries: DataFrame, per_entry: bool = False) -> DataFrame:
    """Sentences of news articles: (url,) side, pos, sentence. ``entries`` has url and segments{moore, french}.

    Merged output drops an article only when both sides are empty; per-entry output needs both.
    """
    text = lambda side: F.array_join(F.coalesce(F.col(f"segments.{side}"), F.array().cast("array<string>")), " ")
    df = entries.select("url", text("moore").alias("moore"), text("french").alias("french"))
    check = filters.both_sides if per_entry else filters.any_side
    df = df.where(check(F.col("french"), F.col("moore")))
    sides = F.array(*[F.struct(F.lit(s).alias("side"), segment.segment(n(F.col(s))).alias("units")) for s, n in (("moore", normalize_moore), ("french", normalize_french))])
    return df.select("url", F.explode(sides).alias("s")).select("url", "s.side", F.posexplode("s.units").alias("pos", "sentence"))


def flatten_sessions(sessions: DataFrame) -> DataFrame:
    """Sentences of council sessions (date, side, section_no, pos, sentence): the source side is French where ``src_lang`` is fr, else Moore."""
    both = sessions.where((F.size("src_sections") > 0) & (F.size("tgt_sections") > 0))
    french_first = F.coalesce("src_lang", F.lit("fr")) == "fr"
    sides = F.array(
        F.struct(F.lit("french").alias("side"), F.when(french_first, F.col("src_sections")).otherwise(F.col("tgt_sections")).alias("sections")),
        F.struct(F.lit("moore").alias("side"), F.when(french_first, F.col("tgt_sections")).otherwise(F.col("src_sections")).alias("sections")),
    )
    long = both.select("date", F.explode(sides).alias("s")).select("date", "s.side", F.posexplode("s.sections").alias("section_no", "x"))
    units = F.concat(F.array(F.col("x.title")), F.coalesce("x.sentences", F.array().cast("array<string>")))
    return long.select("date", "side", "section_no", F.posexplode(units).alias("pos", "sentence")).where(filters.usable_sentence(F.col("sentence")))


def flatten_entries(entries: DataFrame, heads: bool = True, examples: bool = True) -> DataFrame:
    """Dictionary entries as rows (french, moore, english, kind): one per sense, and one per example with all three texts."""
    senses = entries.select("lemma", F.explode("senses").alias("s"))
    out = senses.select(F.col("s.french").alias("french"), F.col("lemma").alias("moore"), F.col("s.english").alias("english"), F.lit("entry").alias("kind")).where(filters.both_sides(F.col("french"), F.col("moore")))
    told = senses.select(F.explode("s.examples").alias("e")).select("e.french", "e.moore", "e.english", F.lit("example").alias("kind"))
    told = told.where(filters.both_sides(F.col("french"), F.col("moore")) & ~is_blank(F.col("english")))
    if heads and examples:
        return out.unionByName(told)
    return out if heads else told


def flatten_book(chapters: DataFrame, key: str = "chapter_number", before: int | None = None) -> DataFrame:
    """Sentences of a bilingual book (key, side, block, part, pos, sentence): titles, pages in order, then numbered questions.

    ``before`` leaves out pages (by their ``page_number``) from that number on.
    """
    if before is not None:
        chapters = chapters.withColumn("pages", F.filter("pages", lambda p: p["page_number"] < before))

    def side(name: str) -> Column:
        none = F.array().cast("array<string>")
        title = F.struct(F.lit(0).alias("block"), F.array(F.col(f"title_{name}")).alias("texts"))
        pages = F.struct(F.lit(1).alias("block"), F.coalesce(F.transform("pages", lambda p: p[f"{name}_text"]), none).alias("texts"))
        enums = F.struct(F.lit(2).alias("block"), F.coalesce(F.transform("enums", lambda e: F.concat_ws("\n", e[f"{name}_title"], e[f"{name}_text"])), none).alias("texts"))
        return F.struct(F.lit(name).alias("side"), F.array(title, pages, enums).alias("blocks"))

    long = chapters.select(key, F.explode(F.array(side("french"), side("moore"))).alias("s")).select(key, "s.side", F.explode("s.blocks").alias("b"))
    parts = long.select(key, "side", "b.block", F.posexplode("b.texts").alias("part", "text"))
    out = parts.select(key, "side", "block", "part", F.posexplode(segment.segment(F.col("text"))).alias("pos", "sentence"))
    return out.where(filters.usable_segment(F.col("sentence")))


def clean_then_report(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cleaned lexicon rows and (rows_in, rows_out, notes): counts of the job."""
    stripped = lexicon.strip_proverbs(df)
    out = lexicon.explode_synonyms(stripped)
    a = df.agg(F.count("*").alias("rows_in"))
    b = out.agg(F.count("*").alias("rows_out"), F.count("synonym_no").alias("synonyms"))
    return out, a.join(F.broadcast(b))


def finalize(df: DataFrame, drop_duplicates: bool = False, postprocess: Transform | None = None, key: str = "line_no") -> DataFrame:
    """Aligned rows ready to write: optionally first of each pair, then a hook."""
    out = dedup.first_wins(df, ["french", "moore"], [key]) if drop_duplicates else df
    return postprocess(out) if postprocess else out


def main(argv: Sequence[str] | None = None) -> int:
    """Command line: parse, flatten, align, e2e, annotate, filter, clean-lexicon, assemble, report, wordlists."""
    from tandemtext.operators import wordlists
    from tandemtext.plans import jobs
    from tandemtext.session import get_spark
    from tandemtext.sources import readers, sinks

    parser = argparse.ArgumentParser(prog="tandemtext")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("annotate", "filter", "clean-lexicon", "report"):
        one = commands.add_parser(name)
        one.add_argument("input")
        one.add_argument("--output")
    commands.choices["annotate"].add_argument("--warnings", action="store_true")
    commands.choices["annotate"].add_argument("--len-ratio", action="store_true")
    commands.choices["annotate"].add_argument("--all", action="store_true")
    for option in ("--lid", "--embed", "--estimate"):
        commands.choices["annotate"].add_argument(option, help="model factory, as module:function")
    commands.choices["annotate"].add_argument("--foreign", help="word list for the consistency score")
    commands.choices["annotate"].add_argument("--key", default="pair_id")
    for name, kinds in (("parse", ["dictionary", "columns", "manual"]), ("flatten", ["news", "sessions", "entries", "book"]), ("align", []), ("e2e", [])):
        one = commands.add_parser(name)
        one.add_argument("input")
        one.add_argument("--output", required=True)
        if kinds:
            one.add_argument("--kind", choices=kinds, required=True)
        else:
            one.add_argument("--embed", help="model factory, as module:function")
            one.add_argument("--least", type=float, default=0.0)
            one.add_argument("--key", default="doc_id")
    commands.choices["parse"].add_argument("--section", action="append", default=[])
    commands.choices["parse"].add_argument("--stop", action="append", default=[])
    commands.choices["filter"].add_argument("--len-ratio", type=float, default=0.0)
    commands.choices["clean-lexicon"].add_argument("--proverbs", action="store_true")
    commands.choices["clean-lexicon"].add_argument("--synonyms", action="store_true")
    built = commands.add_parser("assemble")
    built.add_argument("inputs", nargs="+", help="source=path")
    built.add_argument("--output", required=True)
    built.add_argument("--dev", type=int, default=500)
    built.add_argument("--test", type=int, default=500)
    built.add_argument("--seed", type=int, default=42)
    listed = commands.add_parser("wordlists")
    listed.add_argument("--foreign", nargs="*", default=[])
    listed.add_argument("--native", nargs="*", default=[])
    listed.add_argument("--output", required=True)
    args = parser.parse_args(argv)
    spark = get_spark(None)
    if args.command in ("parse", "flatten", "align", "e2e"):
        sinks.write_json_lines(jobs.run(spark, args), args.output)
    elif args.command == "annotate":
        foreign = wordlists.list_words(readers.optional_lists(spark, [args.foreign])[0]) if args.foreign else None
        chosen = {name: jobs.named_factory(value) for name, value in (("lid", args.lid), ("embed", args.embed), ("estimate", args.estimate)) if value}
        out = annotate(
            readers.dataset(spark, args.input), warnings=args.warnings or args.all, len_ratio=args.len_ratio or args.all,
            consistency=foreign is not None, foreign=foreign, key=args.key if foreign is not None else None, **chosen,
        )
        sinks.rewrite(out, args.output or args.input)
    elif args.command == "filter":
        df = readers.dataset(spark, args.input)
        stages = filters.known(df, {"warnings": ("quality_warnings", filters.free_of(["emoji", "dots_asymmetry", "foreign_words"])), "len_ratio": ("len_ratio", filters.at_least_or_zero("len_ratio", args.len_ratio))})
        if stages:
            filters.cascade_counts(df, stages).show(truncate=False)
            df = filters.cascade(df, stages).where("first_failed is null").drop("first_failed")
        sinks.rewrite(df, args.output or args.input)
    elif args.command == "clean-lexicon":
        sinks.rewrite(lexicon.clean_lexicon(readers.dataset(spark, args.input), args.proverbs, args.synonyms), args.output or args.input)
    elif args.command == "report":
        df = readers.dataset(spark, args.input)
        report.counts(df, "source").show(truncate=False)
    elif args.command == "wordlists":
        lists = [[wordlists.list_words(x) for x in readers.optional_lists(spark, paths)] for paths in (args.foreign, args.native)]
        sinks.write_json_lines(wordlists.foreign_words(lists[0], lists[1], spark), args.output)
    else:
        # the file and the place in it, not the cut of the scan, tell which of two equal pairs comes first
        place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
        parts = [readers.pairs(spark, path, source, place=place) for source, _, path in (x.partition("=") for x in args.inputs)]
        corpus = assemble(parts, dev=args.dev, test=args.test, seed=args.seed)
        sinks.write_splits(corpus, args.output)
        split_totals(corpus).show(truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
