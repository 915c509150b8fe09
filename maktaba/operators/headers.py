"""Document headers: law number, type, year and parent id from the text, and header rows from model replies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .structure import header_prefix

# Types in order of priority, with the pattern that shows each.
LAW_TYPES = (
    ("Décret-loi", r"[Dd]écret[-\s\xa0]loi"), ("Loi organique", r"[Ll]oi[\s\xa0]+organique"), ("Loi", "[Ll]oi"),
    ("Décret", "[Dd]écret"), ("Arrêté", "[Aa]rrêté"), ("Circulaire", "[Cc]irculaire"),
)


def law_number(text: Column) -> Column:
    found = F.regexp_extract(text, r"(?iu)n°[\s\xa0]*(\p{Nd}{2,4}[-–]?\p{Nd}*)", 1)
    return T.nonempty(F.regexp_replace(found, r"\s*[-–]\s*", "-"))


def law_type(text: Column) -> Column:
    return F.coalesce(*[F.when(text.rlike(pattern), F.lit(name)) for name, pattern in LAW_TYPES])


def law_year(text: Column, number: Column, *, strict: bool = True) -> Column:
    """The year from a number like 66-27 (above 30: 19xx, else 20xx), else the first four digits of the text.

    strict keeps the customary reading of a four-digit prefix, which adds 1900 to it; otherwise the prefix is the year.
    """
    prefix = F.split_part(number, F.lit("-"), F.lit(1)).try_cast("int")
    long_prefix = prefix + 1900 if strict else prefix
    short = F.when(prefix > 30, prefix + 1900).otherwise(prefix + 2000)
    first = F.regexp_extract(text, r"(\p{Nd}{4})", 1).try_cast("int")
    return F.when(number.contains("-"), F.when(prefix >= 100, long_prefix).otherwise(short)).when(number.isNotNull(), first)


def parent_id(type_: Column, number: Column) -> Column:
    """An id like tn-loi-66-27; null if either part is missing."""
    slug = F.translate(F.lower(T.nonempty(type_)), " éèêàû", "-eeeau")
    return F.concat(F.lit("tn-"), slug, F.lit("-"), T.nonempty(number))


def regex_headers(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: law_type, law_number, year, parent_document_id, preamble_text."""
    rows = docs.select(F.col(id_column).alias("doc_id"), header_prefix(F.coalesce(F.col(text_column), F.lit(""))).alias("preamble_text"))
    rows = rows.withColumn("law_number", law_number(F.col("preamble_text"))).withColumn("law_type", law_type(F.col("preamble_text")))
    rows = rows.withColumn("year", law_year(F.col("preamble_text"), F.col("law_number")))
    return rows.withColumn("parent_document_id", parent_id(F.col("law_type"), F.col("law_number")))


REPLY = (
    "institution string, institutions array<string>, law_type string, law_number string, year int, title_french string, title_arabic string, "
    "publication_date string, effective_date string, source_name string, source_number string, source_date string"
)


def reply_headers(reply: Column) -> Column:
    """The header struct of a parsed model reply: institutions, their names, dates and parent id filled from one another."""
    some = lambda c: T.nonempty(reply[c])
    listed = F.filter(F.transform(F.split(some("institution"), ","), T.strip), lambda x: x != "")
    institutions = F.coalesce(F.when(F.size(reply["institutions"]) > 0, reply["institutions"]), listed, F.array().cast("array<string>"))
    return F.struct(
        F.lit("TUNISIA").alias("jurisdiction"),
        F.coalesce(some("institution"), F.when(F.size(institutions) > 0, F.array_join(institutions, ", "))).alias("institution"),
        F.try_element_at(institutions, F.lit(1)).alias("institution_primary"),
        F.try_element_at(institutions, F.lit(2)).alias("institution_secondary"),
        institutions.alias("institutions"),
        reply["law_type"].alias("law_type"), some("law_number").alias("law_number"), reply["year"].alias("year"),
        reply["title_french"].alias("title_french"), reply["title_arabic"].alias("title_arabic"),
        reply["publication_date"].alias("publication_date"), F.coalesce(some("effective_date"), reply["publication_date"]).alias("effective_date"),
        reply["source_name"].alias("source_name"), some("source_number").alias("source_number"), reply["source_date"].alias("source_date"),
        parent_id(reply["law_type"], reply["law_number"]).alias("parent_document_id"),
    )
