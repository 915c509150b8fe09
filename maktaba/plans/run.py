"""A full run over files: extraction, cleaning, parsing; each phase a table with one row per document (articles: per article)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.replies import parse_reply
from ..operators import assembly, cleaning, correction, headers, models, structure
from ..session import stored
from ..sources import files


@dataclass(frozen=True)
class Run:
    extraction: DataFrame
    cleaning: DataFrame | None = None
    headers: DataFrame | None = None
    rough: DataFrame | None = None
    articles: DataFrame | None = None
    results: DataFrame | None = None  # of the parsing: counts and warnings per document


@dataclass(frozen=True)
class Model:
    """A model that answers prompts: its name, a client, and how it is called. Each prompt is asked once a run.

    With `listed`, a function that gives the names of the models at hand, corrections are only asked for if the model is
    among them or answers a trial call. Corrections come by chunks of max_chunk characters, and one whose length differs
    by more than max_length_change from its chunk's is rejected.
    """

    name: str = "gemma3:4b"
    client: models.Client | None = None
    timeout: float = 180.0
    attempts: int = 3
    listed: Callable[[], list[str]] | None = None
    max_chunk: int = correction.MAX_CHUNK
    max_length_change: float = correction.MAX_LENGTH_CHANGE

    @cached_property
    def available(self) -> bool:
        """Whether the client can be asked; found out once."""
        return self.client is not None and (self.listed is None or models.answers(self.client, self.name, self.listed, self.timeout))

    def ask(self, prompts: DataFrame, what: str, *, attempts: int | None = None) -> DataFrame | None:
        return None if self.client is None else stored(models.ask(prompts, self.client, timeout=self.timeout, attempts=attempts or self.attempts), what)


def clean(extracted: DataFrame, replies: DataFrame | None = None, *, model: Model = Model(), skip: bool = False) -> DataFrame:
    """Per doc_id of extracted: the cleaning result, after the corrections in replies, or else those that the model's client gives.

    With skip the correction layer is left out; without replies and without an available client it passes, with a warning.
    """
    ruled = cleaning.rule_clean(extracted.select("doc_id", F.col("full_text").alias("text")))
    if not skip and (replies is not None or model.available):
        ruled = stored(ruled, "ruled")  # for the chunks, the prompts and the result
    if replies is None and not skip and model.available:
        replies = model.ask(models.chunk_prompts(correction.chunk_table(ruled, limit=model.max_chunk)), "corrections")
    return correction.clean_with_replies(ruled, None if skip else replies, model=model.name, skipped=skip, max_chunk=model.max_chunk, max_change=model.max_length_change)


def parse(
    cleaned: DataFrame, header_replies: DataFrame | None = None, article_replies: DataFrame | None = None, *, model: Model = Model()
) -> tuple[DataFrame, DataFrame, DataFrame | None, DataFrame | None]:
    """Headers, rough articles, and, if there are replies (doc_id[, ord], raw_reply) or a client, articles and results.

    A header reply that isn't there or can't be read gives way to the header that the text shows.
    """
    shown = headers.regex_headers(cleaned, text_column="french_text")
    empty = F.array().cast("array<string>")
    names = ("jurisdiction", "institution", "institution_primary", "institution_secondary", "institutions", "law_type", "law_number", "year", "title_french", "title_arabic", "publication_date", "effective_date", "source_name", "source_number", "source_date", "parent_document_id")
    own = {"jurisdiction": F.lit("TUNISIA"), "institutions": empty, **{c: F.col(c) for c in ("law_type", "law_number", "year", "parent_document_id")}}
    rows = shown.select("doc_id", "preamble_text", *[own.get(c, F.lit(None).cast("string")).alias(c) for c in names])
    if header_replies is None:
        header_replies = model.ask(models.header_prompts(shown), "headers", attempts=1)
    if header_replies is not None:
        read = header_replies.select("doc_id", headers.reply_headers(parse_reply(F.col("raw_reply"), headers.REPLY, quotes=False)).alias("_h"), parse_reply(F.col("raw_reply"), headers.REPLY, quotes=False).isNotNull().alias("_ok"))
        rows = rows.join(read, "doc_id", "left").select("doc_id", "preamble_text", *[F.when(F.coalesce("_ok", F.lit(False)), F.col(f"_h.{c}")).otherwise(F.col(c)).alias(c) for c in names])
    rough = structure.split_articles(cleaned, text_column="french_text")
    if article_replies is None:
        article_replies = model.ask(models.article_prompts(rough, rows), "articles", attempts=1)
    if article_replies is None:
        return rows, rough, None, None
    read = rough.select("doc_id", "ord").join(article_replies, ["doc_id", "ord"], "left").select("doc_id", "ord", parse_reply(F.col("raw_reply"), assembly.ARTICLE_REPLY).alias("reply"))
    articles = assembly.assemble(rows, read)
    return rows, rough, articles, assembly.parse_results(articles, rough, cleaned)


def run(
    spark: SparkSession, paths: list[str], phase: int = 3, *, force_ocr: bool = False, replies: dict[str, DataFrame] | None = None, model: Model | str = Model(), skip_llm: bool = False, **readers
) -> Run:
    """Phases 1 to `phase` over files. replies: chunks, headers and articles tables, any of them; doc_id is the file's path."""
    replies, model = replies or {}, Model(model) if isinstance(model, str) else model
    extracted = files.extract(spark, paths, force_ocr=force_ocr, **readers).withColumn("doc_id", F.col("file_path"))
    if phase < 2:
        return Run(extracted)
    extracted = stored(extracted, "extraction")  # files are read once
    cleaned = clean(extracted, replies.get("chunks"), model=model, skip=skip_llm)
    if phase < 3:
        return Run(extracted, cleaned)
    cleaned = stored(cleaned, "cleaning")
    return Run(extracted, cleaned, *parse(cleaned, replies.get("headers"), replies.get("articles"), model=model))
