"""Readers: JSON lines, JSON trees, bitext tables, text, web pages, extracted pages and tables."""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from functools import reduce
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tandemtext.functions.text import expand_ligatures, is_blank, strip

PAIR_SCHEMA = "french string, moore string, english string, laser_score double, comet_qe double, len_ratio double, source string"
BITEXT_COLUMNS = ("eng_Latn", "mos_Latn", "laser_score", "source_sentence_lid", "target_sentence_lid", "source_sentence_source", "source_sentence_url", "target_sentence_source", "target_sentence_url")
BITEXT_NUMBERS = ("laser_score", "source_sentence_lid", "target_sentence_lid")
CORPUS_SCHEMA = "french array<string>, moore array<string>, english array<string>, scores array<double>, source string"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path of any file system is there."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a path of any file system is a folder of Parquet files."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/*.parquet")
    return len(target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(target) or ()) > 0


def json_lines(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON lines with a fixed schema; blank lines are skipped, a missing path fails. Without a schema it is inferred."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    if schema is None:
        return spark.read.json(path)
    lines = spark.read.text(path).where(~is_blank(F.col("value")))
    return lines.select(F.from_json("value", schema).alias("r")).select("r.*")


def dataset(spark: SparkSession, uri: str, schema: str | None = None, split: str = "train") -> DataFrame:
    """A data set by address: ``hf://`` stands for a local mirror (TANDEMTEXT_HUB, a folder per owner/name), else a path.

    Folders are read as Parquet, with the sub-folder ``split`` where there is one; files as JSON lines.
    """
    if uri.startswith("hf://"):
        root = os.environ.get("TANDEMTEXT_HUB")
        if not root:
            raise ValueError("hub addresses need TANDEMTEXT_HUB, a folder with the mirrored sets")
        uri = f"{root}/{uri[5:]}"
    if uri.endswith((".jsonl", ".json", ".jsonl.gz")):
        return json_lines(spark, uri, schema)
    inner = f"{uri}/{split}"
    return spark.read.parquet(inner if exists(spark, inner) else uri)


def pairs(spark: SparkSession, path: str, source: str | None = None, place: Column | None = None) -> DataFrame:
    """Pair rows: sides stripped, rows with a blank side dropped, the source optionally set, and ``place`` of the scan as ``line_no``."""
    df = json_lines(spark, path, PAIR_SCHEMA)
    if place is not None:
        df = df.withColumn("line_no", place)
    df = df.withColumns({"french": strip(F.col("french")), "moore": strip(F.col("moore"))}).where(~is_blank(F.col("french")) & ~is_blank(F.col("moore")))
    return df if source is None else df.withColumn("source", F.lit(source))


def registry(spark: SparkSession, files: Sequence[tuple[str, str]]) -> DataFrame:
    """Union of (source, path) files in fixed order, with ``file_ord``; files that are not there are skipped."""
    parts = [pairs(spark, path, source).withColumn("file_ord", F.lit(k)) for k, (source, path) in enumerate(files) if exists(spark, path)]
    if not parts:
        return spark.createDataFrame([], PAIR_SCHEMA + ", file_ord int")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def aligned_records(spark: SparkSession, path: str, source: str, with_english: bool = False) -> DataFrame:
    """Pairs of a JSON-lines file or of an aligned corpus in one JSON tree (arrays cut to the shortest; missing scores are 1.0)."""
    if path.endswith(".jsonl"):
        return json_lines(spark, path, PAIR_SCHEMA).withColumn("source", F.coalesce("source", F.lit(source)))
    tree = spark.read.schema(CORPUS_SCHEMA).json(path, multiLine=True)
    n = F.least(F.size("french"), F.size("moore"))
    english = F.when(F.size(F.coalesce("english", F.array().cast("array<string>"))) > 0, F.col("english")) if with_english else F.lit(None).cast("array<string>")
    rows = tree.withColumn("english", english).select("*", F.posexplode(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))).alias("pos", "at"))
    return rows.select(
        F.get("french", "at").alias("french"), F.get("moore", "at").alias("moore"), F.get("english", "at").alias("english"),
        F.when(F.col("scores").isNull(), F.lit(1.0)).otherwise(F.get("scores", "at")).alias("laser_score"), F.coalesce("source", F.lit(source)).alias("source"), "pos",
    )


def bitext_table(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated bitext (gzip too): positional columns; empty texts, zeros and bad numbers become null; rows of one field are dropped."""
    fields = F.split(F.col("value"), "\t", -1)
    lines = spark.read.text(path).select(fields.alias("f")).where(F.size("f") >= 2)
    return lines.select(*[bitext_field(name, F.get("f", F.lit(k))).alias(name) for k, name in enumerate(BITEXT_COLUMNS)])


def bitext_field(name: str, value):
    return F.nullif(value.try_cast("double"), F.lit(0.0)) if name in BITEXT_NUMBERS else F.nullif(value, F.lit(""))


def json_tree(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A typed tree, one JSON document a file."""
    return spark.read.schema(schema).json(path, multiLine=True)


def whole_text(spark: SparkSession, path: str) -> DataFrame:
    """(path, text): each file whole."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def language_of_path(path):
    """fra_Latn or mos_Latn by a file name's mark; null without one."""
    low = F.lower(F.element_at(F.split(path, "/"), -1))
    return F.when(low.rlike(r"(?:^|[_\-. ])(?:fr|fra|french|francais|français)(?:[_\-. ]|$)"), "fra_Latn").when(low.rlike(r"(?:^|[_\-. ])(?:mo|mos|moore|mooré)(?:[_\-. ]|$)"), "mos_Latn")


def page_texts(blocks: DataFrame, first: int | None = None, last: int | None = None, separator: str | None = None) -> DataFrame:
    """(doc_id, text): blocks of a page range (1-based, both ends, clamped) joined by blank lines, pages by a separator if given.

    ``blocks`` has doc_id, page, block_no and text; ligatures are expanded.
    """
    usable = blocks.where(~is_blank(F.col("text")))
    if first is not None:
        usable = usable.where(F.col("page") >= max(1, first))
    if last is not None:
        usable = usable.where(F.col("page") <= last)
    packed = F.array_sort(F.collect_list(F.struct("block_no", expand_ligatures(F.col("text")).alias("text"))))
    pages = usable.groupBy("doc_id", "page").agg(F.array_join(F.transform(packed, lambda b: b["text"]), "\n\n").alias("text"))
    ordered = F.array_sort(F.collect_list(F.struct("page", "text")))
    return pages.groupBy("doc_id").agg(F.array_join(F.transform(ordered, lambda p: p["text"]), "\n\n" if separator is None else f"\n\n{separator}\n\n").alias("text"))


def binary_pages(spark: SparkSession, path: str, decode) -> DataFrame:
    """Page blocks of binary files; ``decode(bytes)`` yields (page, block_no, x0, page_width, text). No decoder is bundled."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(p, *block) for p, content in zip(batch["path"], batch["content"]) for block in decode(content)]
            yield pd.DataFrame(rows, columns=["doc_id", "page", "block_no", "x0", "page_width", "text"])

    return files.mapInPandas(run, "doc_id string, page int, block_no int, x0 double, page_width double, text string")


class _Article(HTMLParser):
    """Title, paragraphs of the entry content, and links of listed articles."""

    SKIP = {"figure", "script", "style"}
    VOID = {"img", "br", "hr", "meta", "link", "input", "source", "wbr", "area", "base", "col", "embed", "track"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.title: str | None = None
        self.paragraphs: list[str] = []
        self.links: list[str] = []
        self.stack: list[tuple[str, bool]] = []
        self.buffer: list[str] | None = None
        self.in_title = False

    def handle_starttag(self, tag: str, attrs) -> None:
        values = dict(attrs)
        names = (values.get("class") or "").split()
        if tag == "img":
            if "attachment-bam-featured" in names:
                link = next((h for t, h in reversed(self.anchors) if h), None) if self.anchors else None
                if link:
                    self.links.append(link)
            return
        if tag in self.VOID:
            return
        self.stack.append((tag, tag == "div" and "entry-content" in names))
        if tag == "a":
            self.anchors.append((tag, values.get("href")))
        if tag == "h1" and self.title is None:
            self.in_title, self.title = True, ""
        if tag == "p" and self._inside():
            self.buffer = []

    @property
    def anchors(self) -> list:
        if not hasattr(self, "_anchors"):
            self._anchors: list = []
        return self._anchors

    def _inside(self) -> bool:
        return any(content for _, content in self.stack) and not any(t in self.SKIP for t, _ in self.stack)

    def handle_endtag(self, tag: str) -> None:
        if tag == "h1":
            self.in_title = False
        if tag == "a" and self.anchors:
            self.anchors.pop()
        if tag == "p" and self.buffer is not None:
            text = " ".join("".join(self.buffer).split())
            if text:
                self.paragraphs.append(text)
            self.buffer = None
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                del self.stack[k:]
                break

    def handle_data(self, data: str) -> None:
        if self.in_title:
            self.title = (self.title or "") + data
        if self.buffer is not None and not any(t in self.SKIP for t, _ in self.stack):
            self.buffer.append(data)


def parse_article(html: str | None) -> tuple[str, list[str], list[str]]:
    parser = _Article()
    parser.feed(html or "")
    parser.close()
    return (parser.title or "").strip() or "No Title", parser.paragraphs, parser.links


def articles(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(url, title, text_units, links): first heading (or 'No Title'), paragraphs of the entry content, links of listed articles."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(u, *parse_article(h)) for u, h in zip(batch[url], batch[html])]
            yield pd.DataFrame(rows, columns=["url", "title", "text_units", "links"])

    return pages.select(url, html).mapInPandas(run, "url string, title string, text_units array<string>, links array<string>")


def listed_links(pages: DataFrame) -> DataFrame:
    """Distinct article links of listing pages."""
    return articles(pages).select(F.explode("links").alias("url")).distinct()


def optional_lists(spark: SparkSession, paths: Sequence[str]) -> list[DataFrame]:
    """Those word lists that are there, as JSON lines or Parquet."""
    return [spark.read.parquet(p) if is_folder(spark, p) else spark.read.json(p) for p in paths if exists(spark, p)]


def moore_glossary_rows(cells: DataFrame) -> DataFrame:
    """(page, num, fr_term, mos_term, mos_definition) from table rows of pages after 4: four columns, or three without the French term."""
    header = F.lower(F.array_join("cells", " ")).rlike(r"\b(?:n°|num|terme|sebre|gom-bil)\b") & (F.col("row_no") == 0)
    rows = cells.where((F.col("page") > 4) & ~header & (F.size("cells") >= 3))
    four = F.size("cells") >= 4
    at = lambda k: F.get("cells", F.lit(k))
    return rows.select("page", at(0).alias("num"), F.when(four, at(1)).alias("fr_term"), F.when(four, at(2)).otherwise(at(1)).alias("mos_term"), F.when(four, at(3)).otherwise(at(2)).alias("mos_definition"))


def french_glossary_rows(cells: DataFrame, first: int = 6, last: int = 86) -> DataFrame:
    """(page, num, fr_term, fr_definition) from rows of three cells or more with a term."""
    at = lambda k: F.get("cells", F.lit(k))
    rows = cells.where((F.col("page") >= first) & (F.col("page") <= last) & (F.size("cells") >= 3))
    return rows.select("page", at(0).alias("num"), at(1).alias("fr_term"), at(2).alias("fr_definition")).where(~is_blank(F.col("fr_term")))
