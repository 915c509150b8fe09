"""Sinks: JSON lines by partitions, one pretty JSON file for small results, previews and report lines."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_json(df: DataFrame, folder: str) -> None:
    """One JSON object per line, as many files as partitions; nulls are written."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(folder)


def write_pretty(df: DataFrame, path: str | None, *, limit: int = 100_000) -> str | None:
    """A JSON array in one local file (or as text without a path). For results of a few documents: more rows than limit are refused."""
    rows = df.limit(limit + 1).toJSON().collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows; use write_json")
    text = json.dumps([json.loads(r) for r in rows], ensure_ascii=False, indent=2)
    if path is None:
        return text
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return None


def write_texts(df: DataFrame, path: str, *, limit: int = 100_000) -> None:
    """The JSON texts of the only column in one local file: the object itself if there is one, else an array of all."""
    rows = [json.loads(r[0]) for r in df.limit(limit + 1).collect()]
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows; use write_json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(rows[0] if len(rows) == 1 else rows, f, ensure_ascii=False, indent=2)


def preview(text: Column, shown: int = 1500) -> Column:
    """The first characters, and how many more there are."""
    more = F.length(text) - shown
    return F.concat(F.substring(text, 1, shown), F.when(more > 0, F.format_string("\n\n... (%,d more characters)", more)).otherwise(""))


def envelope(phase: int, extraction: DataFrame, cleaning: DataFrame | None = None, parsing: DataFrame | None = None) -> DataFrame:
    """doc_id and the JSON envelope of a run up to a phase. Each table has one row per doc_id."""
    out = extraction.select("doc_id", F.struct(*[c for c in extraction.columns if c != "doc_id"]).alias("extraction"))
    for name, table in (("cleaning", cleaning), ("parsing", parsing)):
        if table is not None:
            out = out.join(table.select("doc_id", F.struct(*[c for c in table.columns if c != "doc_id"]).alias(name)), "doc_id", "left")
    return out.select("doc_id", F.to_json(F.struct(F.lit(phase).alias("phase"), *[c for c in out.columns if c != "doc_id"]), {"ignoreNullFields": "false"}).alias("envelope"))


def log_line(articles: DataFrame) -> DataFrame:
    """doc_id, ord and a line per article: id, type, which texts it has, and the start of its summary."""
    mark = lambda c: F.when(F.trim(c) != "", F.lit("yes")).otherwise(F.lit("no"))
    line = F.concat(F.col("article_id"), F.lit(" ["), F.coalesce("article_type", F.lit("None")), F.lit("] FR="), mark(F.col("content_french")), F.lit(" AR="), mark(F.col("content_arabic")), F.lit(" | "), F.substring("summary_french", 1, 60))
    return articles.select("doc_id", "ord", line.alias("line"))


def report(articles: DataFrame) -> DataFrame:
    """doc_id, ord and a block of text per article."""
    text = F.format_string(
        "── Article %s (order: %d) ──\n%s%sSummary: %s...\nKeywords: %s\nImpact: %s\nObligations: %s | Penalties: %s\nPrev: %s\nNext: %s",
        F.coalesce("article_number", F.lit("None")), "article_order",
        F.when(F.col("chapter").isNotNull(), F.concat(F.lit("Chapter: "), "chapter", F.lit("\n"))).otherwise(""), F.when(F.col("section").isNotNull(), F.concat(F.lit("Section: "), "section", F.lit("\n"))).otherwise(""),
        F.substring("summary_french", 1, 100), F.array_join("keywords", ", "), "business_impact", F.initcap(F.col("has_obligations").cast("string")), F.initcap(F.col("has_penalties").cast("string")),
        F.coalesce("preceding_article_id", F.lit("None")), F.coalesce("following_article_id", F.lit("None")),
    )
    return articles.select("doc_id", "ord", text.alias("report"))
