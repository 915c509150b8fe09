"""A table of legal-shaped, noisy texts made from the documents table by the same expression in Spark and in DuckDB.

Ten documents in a row make one text: a header line, then an article per document, with headings, noise lines, typographic
characters and Arabic lines by the remainder of the document's id. The queries of the operators run on it, whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

K = "CAST(doc_id % 10 + 1 AS INT)"
ROMAN = "CASE CAST(doc_id % 10 + 1 AS INT) WHEN 1 THEN 'PREMIER' WHEN 2 THEN 'II' WHEN 3 THEN 'III' WHEN 4 THEN 'IV' WHEN 5 THEN 'V' ELSE 'X' END"
NL = "chr(10)"


def _if(divisor: int, rest: int, value: str) -> str:
    return f"CASE WHEN doc_id % {divisor} = {rest} THEN {value} ELSE '' END"


#: One document's part of a text, in SQL that both engines read alike.
PIECE = " || ".join(
    [
        _if(4, 0, f"'CHAPITRE ' || {ROMAN} || ' - TITRE DES DISPOSITIONS' || {NL}"),
        _if(3, 0, f"'SECTION ' || {ROMAN} || {NL}"),
        f"'Article ' || CASE WHEN {K} = 1 THEN 'premier' WHEN doc_id % 7 = 0 THEN CAST({K} AS STRING) || ' bis' ELSE CAST({K} AS STRING) END || '.- '",
        "coalesce(text, '')",
        _if(8, 3, "' loi n° 12. 06'"),
        _if(5, 0, f"{NL} || '&@#'"), _if(6, 1, f"{NL} || '06'"), _if(7, 2, f"{NL} || 'LS'"), _if(9, 4, f"{NL} || ';.,'"),
        _if(9, 0, f"{NL} || 'le mot B mot ,mot.Mot 1\" essai'"), _if(10, 3, f"{NL} || '“mot” – l’article ‏qui suit'"),
        _if(11, 0, f"{NL} || 'يضبط هذا القانون شروط ممارسة المهنة 12'"), _if(12, 5, f"{NL} || 'les dispositions de la présente loi sont applicables قانون dans tous les cas prévus'"),
        _if(13, 6, f"{NL} || 'loi قانون 14 avril'"), _if(14, 1, f"{NL} || {NL} || {NL} || {NL} || {NL} || 'café et  deux   espaces'"), _if(15, 2, f"{NL} || 'voir l''article 5. et 5-2 116'"),
    ]
)
LAW = "CAST(floor(doc_id / 10) AS BIGINT)"
HEADER = (
    "CASE law_id % 6 WHEN 0 THEN 'Loi n° ' || CAST(60 + law_id % 40 AS STRING) || '-' || CAST(law_id AS STRING) || ' du 30 avril 1966' "
    "WHEN 1 THEN 'Décret-loi n° ' || CAST(10 + law_id % 15 AS STRING) || '–' || CAST(law_id AS STRING) WHEN 2 THEN 'Loi organique n° 2017-51 du 27 juillet' "
    "WHEN 3 THEN 'Décret n° 123 du 5 mai 1999' WHEN 4 THEN 'Arrêté portant emploi n° 14-5' ELSE 'Circulaire sans numéro' END"
)
SEPARATOR = f"CASE WHEN law_id % 2 = 0 THEN {NL} ELSE {NL} || {NL} END"
#: The table for DuckDB: WITH <LAWS_SQL> SELECT ... FROM laws.
LAWS_SQL = (
    f"pieces AS (SELECT {LAW} AS law_id, doc_id AS piece_id, {PIECE} AS piece FROM documents), "
    f"bodies AS (SELECT law_id, string_agg(piece, {NL} ORDER BY piece_id) AS one, string_agg(piece, {NL} || {NL} ORDER BY piece_id) AS two FROM pieces GROUP BY law_id), "
    f"laws AS (SELECT law_id AS doc_id, {HEADER} || {SEPARATOR} || CASE WHEN law_id % 2 = 0 THEN one ELSE two END AS text FROM bodies)"
)


def laws(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr(f"{LAW} AS law_id", "doc_id AS piece_id", f"{PIECE.replace(chr(39) * 2 + 'article', chr(92) + chr(39) + 'article')} AS piece")
    parts = F.transform(F.sort_array(F.collect_list(F.struct("piece_id", "piece"))), lambda p: p["piece"])
    bodies = docs.groupBy("law_id").agg(parts.alias("parts")).withColumn("separator", F.expr(SEPARATOR))
    return bodies.select(F.col("law_id").alias("doc_id"), F.concat(F.expr(HEADER), F.col("separator"), F.array_join("parts", "\u0002")).alias("text"), "separator").select("doc_id", F.expr("replace(text, chr(2), separator)").alias("text"))
