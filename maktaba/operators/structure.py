"""Document structure: header prefix, article split, offsets, chapter and section carry, heading removal, chapter keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.unicode import without_accents

# Markers and headings.
_W = T.WHITE
ARTICLE = rf"(?iu)a?rticle{_W}+(?:premier|1er|\p{{Nd}}+{_W}*(?:bis|ter|quater|quinquies|sexies|septies|octies|novies|decies)?){_W}*[.\-–:]"
FIRST_ARTICLE = rf"(?iu)a?rticle{_W}+(?:premier|1er|1){_W}*[.\-–:]"
CHAPTER = rf"(?dm)(?:CHAPITRE|Chapitre){_W}+(PREMIER|PREMIÈRE|[IVXLC]+|\p{{Nd}}+)(?:{_W}*[-–:]{_W}*(.+?))?$"
SECTION = rf"(?dm)(?:SECTION|Section){_W}+(PREMIÈRE|PREMIERE|PREMIER|[IVXLC]+|\p{{Nd}}+)(?:{_W}*[-–:]{_W}*(.+?))?$"
#: Where an article begins: with its "a", or with the "r" that lacks it.
BEFORE_ARTICLE = rf"(?iu)(?=a?r)(?:(?={ARTICLE[5:].replace('a?', 'a', 1)})|(?<!a)(?={ARTICLE[5:].replace('a?', '', 1)}))"
HEADER_CHARS = 2000


def header_prefix(text: Column) -> Column:
    """What stands before the first article, else the first 2000 characters; stripped."""
    return T.strip(F.when(text.rlike(FIRST_ARTICLE), F.split(text, FIRST_ARTICLE, 2)[0]).otherwise(F.substring(text, 1, HEADER_CHARS)))


def heading(text: Column, pattern: str, name: str) -> Column:
    """The first heading of the pattern as "NAME n" or "NAME n - title"; null if there is none."""
    number, title = F.regexp_extract(text, pattern, 1), T.strip(F.regexp_extract(text, pattern, 2))
    found = F.concat(F.lit(f"{name} "), number, F.when(title != "", F.concat(F.lit(" - "), title)).otherwise(""))
    return F.when(number != "", found)


def strip_headings(text: Column) -> Column:
    text = F.regexp_replace(F.regexp_replace(text, CHAPTER, ""), SECTION, "")
    return T.strip(F.regexp_replace(text, r"\n{3,}", "\n\n"))


def split_articles(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per article: doc_id, ord (from 1), article_marker, raw_text, chapter and section, start_pos and end_pos.

    A heading before an article counts for that article and, as it stands at the end of the article before, for that one
    too. A chapter or section holds until the next one. One exchange on the document's id serves all windows.
    """
    # A split drops an empty first part before a match without width, so a blank stands before it and goes again.
    parts = F.split(F.concat(F.lit(" "), F.coalesce(F.col(text_column), F.lit(""))), BEFORE_ARTICLE)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.posexplode(parts).alias("ord", "_part"))
    rows = rows.withColumn("_part", F.when(F.col("ord") == 0, F.expr("substring(_part, 2)")).otherwise(F.col("_part")))
    order = Window.partitionBy("doc_id").orderBy("ord")
    rows = rows.withColumn("start_pos", F.coalesce(F.sum(F.length("_part")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("int"))
    rows = rows.withColumn("article_marker", F.when(F.col("ord") > 0, F.regexp_extract("_part", rf"\A({ARTICLE})", 1)).otherwise(""))
    tail = F.expr("substring(_part, length(article_marker) + 1)")
    rows = rows.withColumn("_between", F.lag(tail).over(order)).withColumn("_raw", T.strip(F.col("_part")))
    inside = lambda p, n: F.when(F.col("ord") > 0, F.coalesce(heading(F.col("_raw"), p, n), heading(F.col("_between"), p, n)))
    rows = rows.withColumn("_chapter", inside(CHAPTER, "CHAPITRE")).withColumn("_section", inside(SECTION, "SECTION"))
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("chapter_detected", F.last("_chapter", ignorenulls=True).over(so_far)).withColumn("section_detected", F.last("_section", ignorenulls=True).over(so_far))
    rows = rows.filter("ord > 0").withColumn("end_pos", (F.col("start_pos") + F.length("_part")).cast("int"))
    return rows.select("doc_id", "ord", "article_marker", strip_headings(F.col("_raw")).alias("raw_text"), "chapter_detected", "section_detected", "start_pos", "end_pos")


def chapter_key(name: Column) -> Column:
    """A chapter's name for indexing: no accents, lower case, words joined by underscores."""
    plain = F.regexp_replace(F.lower(without_accents(name)), "[-–:]+", " ")
    plain = F.regexp_replace(plain, rf"(?:(?!{_W})[^a-z0-9])", "")
    return F.regexp_replace(T.strip(plain), f"{_W}+", "_")
