"""Page tables to documents: page concatenation, language flags, confidence, scanned test, choice between native and OCR text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

# File name extensions and their formats.
FORMATS = {".pdf": "pdf", ".docx": "docx", ".doc": "docx", ".txt": "txt", ".text": "txt"}
SHORT_PAGE = 50
SCANNED = "Document appears to be scanned ({short}/{pages} pages with <" + str(SHORT_PAGE) + " chars). Consider using OCR extractor."


def file_format(path: Column) -> Column:
    """The format by the extension of the last path part; a name that starts with its only dot has none."""
    name = F.regexp_extract(path, r"([^/]*)\z", 1)
    extension = F.lower(F.regexp_extract(name, r"[^.].*?(\.[^.]*)\z", 1))
    chain = F.lit("unknown")
    for ext, kind in FORMATS.items():
        chain = F.when(extension == ext, F.lit(kind)).otherwise(chain)
    return chain


def page_table(pages: DataFrame, *, text_column: str = "text") -> DataFrame:
    """pages with has_arabic and has_french of the raw text, and the text cleaned."""
    raw = F.col(text_column)
    return pages.withColumn("has_arabic", T.has_arabic(raw)).withColumn("has_french", T.has_french(raw)).withColumn(text_column, T.clean_text(raw))


def word_confidence(values: Column) -> Column:
    """The mean of the word confidences that are whole numbers above zero, as a share with three digits; 0 if there is none."""
    whole = F.filter(values, lambda x: x.rlike(r"\A-*\p{Nd}+\z") & (x.try_cast("int") > 0))
    total = F.aggregate(whole, F.lit(0).cast("long"), lambda s, x: s + x.cast("long"))
    return F.when(F.size(whole) > 0, F.bround(total / F.size(whole) / 100, 3)).otherwise(F.lit(0.0))


def documents(pages: DataFrame, more: dict[str, Column] | None = None) -> DataFrame:
    """Per doc_id of a page table (doc_id, page_number, text, confidence): text, counts, flags, mean confidence, scanned test.

    A row without a page number is no page; `more` names further aggregates of the same rows.
    """
    short = F.col("page_number").isNotNull() & (F.length(T.strip(F.col("text"))) < SHORT_PAGE)
    ordered = F.sort_array(F.collect_list(F.when(~T.is_blank(F.col("text")), F.struct("page_number", "text"))))
    rows = pages.groupBy("doc_id").agg(
        ordered.alias("_p"), F.count("page_number").alias("total_pages"), F.count_if(short).alias("short_pages"), F.avg("confidence").alias("avg_confidence"),
        F.sum(F.length(T.strip(F.col("text")))).alias("stripped_chars"),
        *[c.alias(n) for n, c in (more or {}).items()],
    )
    full = T.clean_text(F.array_join(F.transform("_p", lambda p: p["text"]), "\n\n"))
    rows = rows.withColumn("full_text", full).withColumn("is_scanned", F.coalesce(F.col("short_pages") / F.nullif("total_pages", F.lit(0)) > 0.5, F.lit(False)))
    rows = rows.withColumn("has_arabic_content", T.has_arabic(F.col("full_text"))).withColumn("has_french_content", T.has_french(F.col("full_text")))
    before, after = SCANNED.split("{short}/{pages}")
    warning = F.concat(F.lit(before), "short_pages", F.lit("/"), "total_pages", F.lit(after))
    rows = rows.withColumn("warnings", F.when(F.col("is_scanned"), F.array(warning)).otherwise(F.array().cast("array<string>")))
    return rows.drop("_p")


def choose_text(native: DataFrame, ocr: DataFrame) -> DataFrame:
    """Per doc_id of native: the OCR document if the native one is scanned and the OCR text is longer, else the native one."""
    o = ocr.select("doc_id", F.col("full_text").alias("_text"), F.col("avg_confidence").alias("_confidence"))
    rows = native.join(o, "doc_id", "left")
    use = F.coalesce(F.col("is_scanned") & (F.length("_text") > F.length("full_text")), F.lit(False))
    return rows.select(
        "doc_id", F.when(use, F.col("_text")).otherwise(F.col("full_text")).alias("full_text"), F.when(use, F.col("_confidence")).otherwise(F.col("avg_confidence")).alias("avg_confidence"),
        F.when(use, F.lit("ocr")).otherwise(F.lit("native_pdf")).alias("extraction_method"), "is_scanned",
    )


def get_text(full_text: Column, pages: Column) -> Column:
    """full_text, else the pages' texts that aren't blank."""
    return F.coalesce(T.nonempty(full_text), F.array_join(F.filter(F.transform(pages, lambda p: p["text"]), lambda t: ~T.is_blank(t)), "\n\n"))
