"""Assembly: header and article rows joined into one article table, numbered, linked, hashed and given search text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .structure import chapter_key

TEXTS = ("content_french", "content_arabic", "summary", "summary_french", "summary_arabic")
LISTS = ("keywords", "legal_domains", "target_audience", "related_laws", "entity_names", "entity_types", "entity_ids", "relation_target_ids", "relation_types")
FLAGS = ("has_obligations", "has_penalties", "has_deadlines", "has_exceptions", "is_abrogation", "is_transitional")
NULLABLE = ("section", "article_type", "community_label", "community_summary", "community_id")
#: The fields of an article in a model's reply. An explicit null counts like a missing field.
ARTICLE_REPLY = ", ".join(
    [f"{c} string" for c in ("chapter", "chapter_normalized", "article_number", *NULLABLE, *TEXTS, "business_impact", "ambiguity_level")]
    + [f"{c} array<string>" for c in LISTS] + [f"{c} boolean" for c in FLAGS] + ["graph_level int"]
)
#: The columns of the article table, in order.
ARTICLE_COLUMNS = (
    "jurisdiction", "institution", "institution_primary", "institution_secondary", "institutions", "law_type", "law_number", "year", "title_french", "title_arabic",
    "chapter", "chapter_normalized", "section", "article_number", "article_order", "article_type", "content_french", "content_arabic", "content_combined", "summary",
    "summary_french", "summary_arabic", "search_content", "content_hash_sha256", "parent_document_id", "preceding_article_id", "following_article_id", "keywords",
    "legal_domains", "business_impact", "target_audience", "related_laws", "community_label", "community_summary", "community_id", "graph_level", "entity_names",
    "entity_types", "entity_ids", "relation_target_ids", "relation_types", "has_obligations", "has_penalties", "has_deadlines", "has_exceptions", "is_abrogation",
    "is_transitional", "ambiguity_level", "status", "version", "effective_date", "publication_date", "repeal_date", "superseded_by_id", "supersedes_id", "last_checked",
    "next_check", "source_name", "source_number", "source_date", "source_url",
)


def article_order(number: Column, ord_: Column) -> Column:
    """The number's leading digits, else the article's place."""
    return F.coalesce(F.regexp_extract(number, r"\A(\p{Nd}+)", 1).try_cast("int"), ord_.cast("int"))


def iso_date(date: Column) -> Column:
    return F.when((date != "") & ~date.contains("T"), F.concat(date, F.lit("T00:00:00Z"))).otherwise(date)


def article_id(parent: Column, number: Column, order: Column) -> Column:
    name = F.concat(F.lit("art-"), F.coalesce(T.nonempty(number), order.cast("string")))
    return F.when(T.nonempty(parent).isNotNull(), F.concat(parent, F.lit("-"), name)).otherwise(name)


def link(articles: DataFrame) -> DataFrame:
    """articles with article_id and the ids of their neighbours in document order."""
    order = Window.partitionBy("doc_id").orderBy("ord")
    out = articles.withColumn("article_id", article_id(F.col("parent_document_id"), F.col("article_number"), F.col("article_order")))
    return out.withColumn("preceding_article_id", F.lag("article_id").over(order)).withColumn("following_article_id", F.lead("article_id").over(order))


def combined(french: Column, arabic: Column) -> Column:
    return F.concat_ws(" ", T.nonempty(french), T.nonempty(arabic))


def content_hash(french: Column, arabic: Column) -> Column:
    return F.sha2(F.concat(french, arabic), 256)


def search_text(law_type: Column, number: Column, keywords: Column, french: Column, arabic: Column) -> Column:
    """Law, keywords, and the first 200 characters of either text."""
    law = F.when(T.nonempty(law_type).isNotNull() & T.nonempty(number).isNotNull(), F.concat(law_type, F.lit(" "), number))
    return F.array_join(F.concat(F.array(law), keywords, F.array(F.substring(T.nonempty(french), 1, 200), F.substring(T.nonempty(arabic), 1, 200))), ", ")


def assemble(headers: DataFrame, replies: DataFrame, *, checked_at: Column | None = None) -> DataFrame:
    """The article table, from headers (one row per doc_id) and replies (doc_id, ord, reply as an ARTICLE_REPLY struct).

    Replies that are null give no article. Headers and articles are co-located by doc_id, which the links need as well.
    """
    r = F.col("reply")
    rows = replies.filter(F.col("reply").isNotNull()).join(headers, "doc_id")
    text = lambda c: F.coalesce(r[c], F.lit(""))
    order = article_order(r["article_number"], F.col("ord"))
    made = {c: text(c) for c in TEXTS} | {c: F.coalesce(r[c], F.array().cast("array<string>")) for c in LISTS} | {c: F.coalesce(r[c], F.lit(False)) for c in FLAGS} | {c: r[c] for c in NULLABLE}
    made |= {
        "chapter": T.nonempty(r["chapter"]), "article_number": T.nonempty(r["article_number"]), "article_order": order,
        "chapter_normalized": F.coalesce(T.nonempty(r["chapter_normalized"]), chapter_key(T.nonempty(r["chapter"]))),
        "business_impact": F.coalesce(r["business_impact"], F.lit("LOW")), "ambiguity_level": F.coalesce(r["ambiguity_level"], F.lit("LOW")),
        "graph_level": F.coalesce(r["graph_level"], F.lit(1)), "status": F.lit("ACTIVE"), "version": F.lit(1),
        "content_combined": combined(text("content_french"), text("content_arabic")), "content_hash_sha256": content_hash(text("content_french"), text("content_arabic")),
        "effective_date": iso_date(F.col("effective_date")), "publication_date": iso_date(F.col("publication_date")),
        "last_checked": checked_at if checked_at is not None else F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
    }
    made["search_content"] = search_text(F.col("law_type"), F.col("law_number"), made["keywords"], made["content_french"], made["content_arabic"])
    made |= {c: F.lit(None).cast("string") for c in ("repeal_date", "superseded_by_id", "supersedes_id", "next_check", "source_url")}
    rows = link(rows.withColumns(made))
    return rows.select("doc_id", "ord", "article_id", *ARTICLE_COLUMNS)


NO_ARTICLES = "No articles found in document text."


def parse_results(articles: DataFrame, rough: DataFrame, documents: DataFrame | None = None) -> DataFrame:
    """Per document: total_articles, rough_chunks, llm_calls (one for the header, one per rough article), failed, warnings.

    Documents are those of `documents` (doc_id), else those with a rough article; one without articles has a warning.
    Articles and rough articles meet in one aggregation by document.
    """
    rows = rough.select("doc_id", "ord").join(articles.select("doc_id", "ord", F.lit(True).alias("_done")), ["doc_id", "ord"], "left")
    failed = F.transform(F.sort_array(F.collect_list(F.when(F.col("_done").isNull(), F.col("ord")))), lambda o: F.format_string("Article %d: extraction failed, skipped.", o))
    found = rows.groupBy("doc_id").agg(F.count("_done").alias("total_articles"), F.count("*").alias("rough_chunks"), failed.alias("warnings"))
    if documents is not None:
        found = documents.select("doc_id").distinct().join(found, "doc_id", "left")
    total, chunks = F.coalesce("total_articles", F.lit(0)), F.coalesce("rough_chunks", F.lit(0))
    return found.select(
        "doc_id", total.alias("total_articles"), chunks.alias("rough_chunks"), (chunks + 1).alias("llm_calls"), (chunks - total).alias("failed"),
        F.coalesce("warnings", F.array(F.lit(NO_ARTICLES))).alias("warnings"),
    )
