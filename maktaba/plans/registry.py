"""Every query of the document engine by name, and its SQL for DuckDB.

The SQL restates each operator for RE2, which has no look-around and reads classes as ASCII, so patterns name their
characters. Where SQL has no equal (Unicode decomposition, lenient JSON), the query runs on input whose result SQL can state.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import replies as R
from ..functions import text as T
from ..operators import assembly, cleaning, correction, extraction, headers, models, structure
from ..session import stored
from ..sources import sinks
from .laws import LAWS_SQL, laws

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

W = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WB = W.replace(r"\t-\r", r"\t\x0b-\r")
AR = r"[\x{600}-\x{6ff}\x{750}-\x{77f}\x{8a0}-\x{8ff}\x{fb50}-\x{fdff}\x{fe70}-\x{feff}]"
AR1 = r"[\x{600}-\x{6ff}\x{750}-\x{77f}]"
LA = "[a-zA-ZÀ-ÿœæŒÆ]"
N = "chr(10)"


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def on_laws(select: str, more: str = "") -> str:
    return f"WITH {LAWS_SQL}{', ' + more if more else ''} {select}"


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '\A{W}+|{W}+\z', '', 'g')"


def _lines(x: str) -> str:
    return rf"string_split(regexp_replace(regexp_replace({x}, '\r\n|[\n\x0b\x0c\r\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]', {N}, 'g'), '\n\z', ''), {N})"


def _blank(x: str) -> str:
    return f"NOT regexp_matches({x}, '{W.replace('[', '[^', 1)}')"


def _clean(x: str) -> str:
    inner = rf"regexp_replace(regexp_replace({x}, '{WB}+', ' ', 'g'), '\n{{4,}}', {N} || {N} || {N}, 'g')"
    return _strip(f"array_to_string(list_transform({_lines(inner)}, lambda l: {_strip('l')}), {N})")


def _has_arabic(x: str) -> str:
    return f"regexp_matches({x}, '{AR1}')"


def _has_french(x: str) -> str:
    words = "les|des|une|dans|pour|avec|sur|par|est|sont|aux|cette|entre"
    return rf"(regexp_matches({x}, '(?i)[àâäéèêëïîôùûüÿçœæ]') OR regexp_matches({x}, '(?i)(^|[^\p{{L}}\p{{N}}_])({words})($|[^\p{{L}}\p{{N}}_])'))"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# Languages and page text


@query("detect_languages", f"SELECT doc_id, {_has_arabic('text')} AS has_arabic, {_has_french('text')} AS has_french FROM documents")
def detect_languages(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", T.has_arabic(F.col("text")).alias("has_arabic"), T.has_french(F.col("text")).alias("has_french"))


@query("clean_text", on_laws(f"SELECT doc_id, {_clean('text')} AS cleaned FROM laws"))
def clean_text(spark, sf_dir):
    return laws(spark, sf_dir).select("doc_id", T.clean_text(F.col("text")).alias("cleaned"))


@query(
    "language_stats",
    f"SELECT lang, count(*) AS n, count(*) FILTER ({_has_french('text')}) AS n_french, count(*) FILTER ({_has_arabic('text')}) AS n_arabic, CAST(sum(length({_clean('text')})) AS BIGINT) AS clean_chars FROM documents GROUP BY lang",
)
def language_stats(spark, sf_dir):
    rows = _documents(spark, sf_dir).select("lang", T.has_french(F.col("text")).alias("f"), T.has_arabic(F.col("text")).alias("a"), F.length(T.clean_text(F.col("text"))).alias("c"))
    return rows.groupBy("lang").agg(F.count("*").alias("n"), F.count_if("f").alias("n_french"), F.count_if("a").alias("n_arabic"), F.sum("c").alias("clean_chars"))


# Rule-based cleaning

_REPLACED = f"translate(text, '{cleaning.REPLACED}{cleaning.DELETED}', '{cleaning.REPLACEMENTS.replace(chr(39), chr(39) * 2)}')"
_NORMAL = f"nfc_normalize({_REPLACED})"


@query("normalize_characters", on_laws(f"SELECT doc_id, {_NORMAL} AS normalized FROM laws"))
def normalize_characters(spark, sf_dir):
    return laws(spark, sf_dir).select("doc_id", cleaning.normalize_characters(F.col("text")).alias("normalized"))


def _noise(x: str) -> str:
    return (
        rf"(regexp_matches({x}, '\A[^\p{{L}}\p{{N}}_]{{0,5}}\z') OR regexp_matches({x}, '\A\.{W}*\p{{Nd}}{{1,3}}{W}*\z') OR regexp_matches({x}, '\A[&@#%^*]+\z') "
        rf"OR regexp_matches({x}, '\A[A-Z]{{1,2}}\z') OR regexp_matches({x}, '\A[.,;:]+\z') OR (NOT regexp_matches({x}, '{AR}') AND NOT regexp_matches({x}, '{LA}') AND length({x}) < 10))"
    )


def _kept(x: str) -> str:
    return f"list_filter({_lines(x)}, lambda l: {_blank('l')} OR NOT {_noise(_strip('l'))})"


def _denoised(x: str) -> str:
    return f"array_to_string(list_transform({_kept(x)}, lambda l: CASE WHEN {_blank('l')} THEN '' ELSE l END), {N})"


@query("noise_lines", on_laws(f"SELECT doc_id, {_denoised('text')} AS kept, CAST(len({_lines('text')}) - len({_kept('text')}) AS INT) AS removed FROM laws"))
def noise_lines(spark, sf_dir):
    kept, removed = cleaning.remove_noise_lines(F.col("text"))
    return laws(spark, sf_dir).select("doc_id", kept.alias("kept"), removed.alias("removed"))


def _artifacts(x: str) -> str:
    l = rf"regexp_replace(l, '\.{W}*\p{{Nd}}{{1,3}}{W}*\z', '')"  # noqa: E741
    l = rf"regexp_replace({l}, '{W}+[&@#]+{W}*\z', '')"  # noqa: E741
    l = rf"regexp_replace({l}, '{W}+\p{{Nd}}{{1,2}}-\p{{Nd}}{{1,2}}{W}+\p{{Nd}}{{2,3}}{W}*\z', '')"  # noqa: E741
    l = f"regexp_replace({l}, '{W}+[B-DF-HJ-NP-TV-Z]{W}+', ' ', 'g')"  # noqa: E741
    return f"array_to_string(list_transform({_lines(x)}, lambda l: {l}), {N})"


@query("stray_artifacts", on_laws(f"SELECT doc_id, {_artifacts('text')} AS cleaned FROM laws"))
def stray_artifacts(spark, sf_dir):
    return laws(spark, sf_dir).select("doc_id", cleaning.clean_artifacts(F.col("text")).alias("cleaned"))


def _count(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, '{pattern}'))"


@query("script_counts", on_laws(f"SELECT doc_id, {_count('text', AR)} AS arabic, {_count('text', LA)} AS latin FROM laws"))
def script_counts(spark, sf_dir):
    arabic, latin = cleaning.script_counts(F.col("text"))
    return laws(spark, sf_dir).select("doc_id", arabic.cast("long").alias("arabic"), latin.cast("long").alias("latin"))


def _without(x: str, script: str) -> str:
    return _strip(f"regexp_replace(regexp_replace({x}, '{script}', '', 'g'), '{W}{{2,}}', ' ', 'g')")


def _routed(x: str) -> str:
    a, l = _count("l", AR), _count("l", LA)  # noqa: E741
    fr = f"CASE WHEN {_blank('l')} THEN '' WHEN {a} + {l} = 0 THEN l WHEN {a} / ({a} + {l}) > 0.6 THEN NULL WHEN {a} / ({a} + {l}) < 0.15 THEN {_without('l', AR)} ELSE nullif({_without('l', AR)}, '') END"
    ar = f"CASE WHEN {_blank('l')} THEN '' WHEN {a} + {l} = 0 THEN NULL WHEN {a} / ({a} + {l}) > 0.6 THEN l WHEN {a} / ({a} + {l}) < 0.15 THEN NULL ELSE nullif({_without('l', LA)}, '') END"
    side = lambda c: f"coalesce(array_to_string(list_filter(list_transform({_lines(x)}, lambda l: {c}), lambda y: y IS NOT NULL), {N}), '')"
    return f"{side(fr)} AS french, {side(ar)} AS arabic"


@query("separate_languages", on_laws(f"SELECT doc_id, {_routed('text')} FROM laws"))
def separate_languages(spark, sf_dir):
    return laws(spark, sf_dir).select("doc_id", cleaning.separate_languages(F.col("text")).alias("p")).select("doc_id", F.col("p.fr").alias("french"), F.col("p.ar").alias("arabic"))


def _spaces(x: str) -> str:
    return rf"regexp_replace(regexp_replace(regexp_replace(translate({x}, chr(9), ' '), '{WB}+', ' ', 'g'), '(?m)^ +| +$', '', 'g'), '\n{{4,}}', {N} || {N} || {N}, 'g')"


@query("normalize_whitespace", on_laws(f"SELECT doc_id, {_spaces('text')} AS normalized FROM laws"))
def normalize_whitespace(spark, sf_dir):
    return laws(spark, sf_dir).select("doc_id", cleaning.normalize_whitespace(F.col("text")).alias("normalized"))


def _punctuation(x: str) -> str:
    x = rf"regexp_replace({x}, '(^|[^\p{{L}}\p{{N}}_])1\"{W}', '\11er ', 'g')"
    x = rf"regexp_replace({x}, '\.([A-Z])', '. \1', 'g')"
    x = rf"regexp_replace({x}, '\.{W}*-{W}*', '.- ', 'g')"
    x = rf"regexp_replace({x}, '{W}+([,.])', '\1', 'g')"
    return rf"regexp_replace({x}, '([,.])([a-zA-ZÀ-ÿ])', '\1 \2', 'g')"


@query("fix_punctuation", on_laws(f"SELECT doc_id, {_punctuation('text')} AS fixed FROM laws"))
def fix_punctuation(spark, sf_dir):
    return laws(spark, sf_dir).select("doc_id", cleaning.fix_punctuation(F.col("text")).alias("fixed"))


_RULES = (
    f"norm AS (SELECT doc_id, text, {_NORMAL} AS t FROM laws), "
    f"kept AS (SELECT doc_id, text, {_denoised('t')} AS t, CAST(len({_lines('t')}) - len({_kept('t')}) AS INT) AS noise FROM norm), "
    f"art AS (SELECT doc_id, text, noise, {_artifacts('t')} AS t FROM kept), "
    f"sep AS (SELECT doc_id, text, noise, {_routed('t')} FROM art), "
    f"ws AS (SELECT doc_id, text, noise, {_spaces('french')} AS fr, {_spaces('arabic')} AS ar FROM sep), "
    f"fixed AS (SELECT doc_id, text, noise, {_strip(_punctuation('fr'))} AS fr, {_strip('ar')} AS ar FROM ws), "
    f"cleaned AS (SELECT doc_id, concat_ws({N} || {N}, nullif(fr, ''), nullif(ar, '')) AS cleaned_text, fr AS french_text, ar AS arabic_text, noise AS noise_lines_removed, text FROM fixed)"
)


@query("rule_clean", on_laws("SELECT doc_id, cleaned_text, french_text, arabic_text, noise_lines_removed, CAST(greatest(0, length(text) - length(cleaned_text)) AS INT) AS noise_chars_removed FROM cleaned", _RULES))
def rule_clean(spark, sf_dir):
    return cleaning.rule_clean(laws(spark, sf_dir)).select("doc_id", "cleaned_text", "french_text", "arabic_text", "noise_lines_removed", "noise_chars_removed")


# Structure

_ART = rf"(?i)a?rticle{W}+(?:premier|1er|\p{{Nd}}+{W}*(?:bis|ter|quater|quinquies|sexies|septies|octies|novies|decies)?){W}*[.\-–:]"
_CHAPTER = rf"(?m)(?:CHAPITRE|Chapitre){W}+(PREMIER|PREMIÈRE|[IVXLC]+|\p{{Nd}}+)(?:{W}*[-–:]{W}*(.+?))?$"
_SECTION = rf"(?m)(?:SECTION|Section){W}+(PREMIÈRE|PREMIERE|PREMIER|[IVXLC]+|\p{{Nd}}+)(?:{W}*[-–:]{W}*(.+?))?$"


def _heading(x: str, pattern: str, name: str) -> str:
    title = _strip(f"regexp_extract({x}, '{pattern}', 2)")
    return f"CASE WHEN regexp_extract({x}, '{pattern}', 1) <> '' THEN '{name} ' || regexp_extract({x}, '{pattern}', 1) || CASE WHEN {title} <> '' THEN ' - ' || {title} ELSE '' END END"


def _no_headings(x: str) -> str:
    return _strip(rf"regexp_replace(regexp_replace(regexp_replace({x}, '{_CHAPTER}', '', 'g'), '{_SECTION}', '', 'g'), '\n{{3,}}', {N} || {N}, 'g')")


_ARTICLES = (
    rf"parts AS (SELECT doc_id, generate_subscripts(p, 1) - 1 AS ord, unnest(p) AS part FROM (SELECT doc_id, string_split(regexp_replace(text, '{_ART}', chr(1) || '\0', 'g'), chr(1)) AS p FROM laws)), "
    rf"marks AS (SELECT *, CASE WHEN ord > 0 THEN regexp_extract(part, '{_ART}') ELSE '' END AS mark FROM parts), "
    f"tails AS (SELECT *, lag(substr(part, length(mark) + 1)) OVER w AS gap, {_strip('part')} AS raw, coalesce(sum(length(part)) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM marks WINDOW w AS (PARTITION BY doc_id ORDER BY ord)), "
    f"heads AS (SELECT *, CASE WHEN ord > 0 THEN coalesce({_heading('raw', _CHAPTER, 'CHAPITRE')}, {_heading('gap', _CHAPTER, 'CHAPITRE')}) END AS ch, CASE WHEN ord > 0 THEN coalesce({_heading('raw', _SECTION, 'SECTION')}, {_heading('gap', _SECTION, 'SECTION')}) END AS se FROM tails), "
    f"carried AS (SELECT *, last_value(ch IGNORE NULLS) OVER w AS chapter_detected, last_value(se IGNORE NULLS) OVER w AS section_detected FROM heads WINDOW w AS (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), "
    f"articles AS (SELECT doc_id, CAST(ord AS INT) AS ord, mark AS article_marker, {_no_headings('raw')} AS raw_text, chapter_detected, section_detected, CAST(start AS INT) AS start_pos, CAST(start + length(part) AS INT) AS end_pos FROM carried WHERE ord > 0)"
)


@query("article_split", on_laws("SELECT * FROM articles", _ARTICLES))
def article_split(spark, sf_dir):
    return structure.split_articles(laws(spark, sf_dir))


@query("article_offsets", on_laws("SELECT doc_id, count(*) AS n, min(start_pos) AS first, max(end_pos) AS last, CAST(sum(end_pos - start_pos) AS BIGINT) AS covered FROM articles GROUP BY doc_id", _ARTICLES))
def article_offsets(spark, sf_dir):
    rows = structure.split_articles(laws(spark, sf_dir)).groupBy("doc_id")
    return rows.agg(F.count("*").alias("n"), F.min("start_pos").alias("first"), F.max("end_pos").alias("last"), F.sum(F.col("end_pos") - F.col("start_pos")).alias("covered"))


@query("chapter_carry", on_laws("SELECT chapter_detected, section_detected, count(*) AS n FROM articles GROUP BY ALL", _ARTICLES))
def chapter_carry(spark, sf_dir):
    return structure.split_articles(laws(spark, sf_dir)).groupBy("chapter_detected", "section_detected").agg(F.count("*").alias("n"))


@query("strip_headings", on_laws(f"SELECT doc_id, {_no_headings('text')} AS body FROM laws"))
def strip_headings(spark, sf_dir):
    return laws(spark, sf_dir).select("doc_id", structure.strip_headings(F.col("text")).alias("body"))


def _key(x: str) -> str:
    return rf"regexp_replace({_strip(rf"regexp_replace(regexp_replace(lower(strip_accents({x})), '[-–:]+', ' ', 'g'), '[^a-z0-9{W[1:-1]}]', '', 'g')")}, '{W}+', '_', 'g')"


@query("chapter_key", on_laws(f"SELECT DISTINCT chapter_detected, {_key('chapter_detected')} AS chapter_key FROM articles WHERE chapter_detected IS NOT NULL", _ARTICLES))
def chapter_key(spark, sf_dir):
    rows = structure.split_articles(laws(spark, sf_dir)).select("chapter_detected").filter("chapter_detected is not null").distinct()
    return rows.withColumn("chapter_key", structure.chapter_key(F.col("chapter_detected")))


_FIRST = rf"(?i)a?rticle{W}+(?:premier|1er|1){W}*[.\-–:]"
_PREFIX = f"CASE WHEN regexp_matches(text, '{_FIRST}') THEN {_strip(f"string_split(regexp_replace(text, '{_FIRST}', chr(1)), chr(1))[1]")} ELSE {_strip('substr(text, 1, 2000)')} END"


@query("header_prefix", on_laws(f"SELECT doc_id, {_PREFIX} AS header FROM laws"))
def header_prefix(spark, sf_dir):
    return laws(spark, sf_dir).select("doc_id", structure.header_prefix(F.col("text")).alias("header"))


# Headers

_TYPES = " ".join(f"WHEN regexp_matches(h, '{p.replace('xa0', 'x{a0}')}') THEN '{t}'" for t, p in headers.LAW_TYPES)
_HEADERS = (
    f"pre AS (SELECT doc_id, {_PREFIX} AS h FROM laws), "
    rf"num AS (SELECT doc_id, h, nullif(regexp_replace(regexp_extract(h, '(?i)n°[\s\x{{a0}}]*(\p{{Nd}}{{2,4}}[-–]?\p{{Nd}}*)', 1), '\s*[-–]\s*', '-', 'g'), '') AS law_number, CASE {_TYPES} END AS law_type FROM pre), "
    r"head AS (SELECT doc_id, h AS preamble_text, law_number, law_type, CASE WHEN contains(law_number, '-') THEN CASE WHEN TRY_CAST(string_split(law_number, '-')[1] AS INT) > 30 THEN 1900 ELSE 2000 END + TRY_CAST(string_split(law_number, '-')[1] AS INT) "
    r"WHEN law_number IS NOT NULL THEN TRY_CAST(regexp_extract(h, '(\p{Nd}{4})', 1) AS INT) END AS year, 'tn-' || translate(lower(law_type), ' éèêàû', '-eeeau') || '-' || law_number AS parent_document_id FROM num)"
)


@query("header_regex", on_laws("SELECT * FROM head", _HEADERS))
def header_regex(spark, sf_dir):
    return headers.regex_headers(laws(spark, sf_dir))


@query("law_types", on_laws("SELECT law_type, year, count(*) AS n, min(parent_document_id) AS first_id FROM head GROUP BY ALL", _HEADERS))
def law_types(spark, sf_dir):
    return headers.regex_headers(laws(spark, sf_dir)).groupBy("law_type", "year").agg(F.count("*").alias("n"), F.min("parent_document_id").alias("first_id"))


_GIVEN = (
    "given AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'Ministère A, Ministère B ,,C' WHEN 1 THEN '' END AS institution, CASE WHEN doc_id % 4 = 1 THEN ['X', 'Y'] ELSE [] END AS institutions, "
    "CASE WHEN doc_id % 5 > 0 THEN 'Loi organique' END AS law_type, CASE WHEN doc_id % 7 > 0 THEN CAST(doc_id AS STRING) ELSE '' END AS law_number, '1966-04-30' AS publication_date, CASE WHEN doc_id % 2 = 0 THEN '' ELSE '1967-01-01' END AS effective_date FROM laws), "
    "lists AS (SELECT *, CASE WHEN len(institutions) > 0 THEN institutions ELSE coalesce(list_filter(list_transform(string_split(nullif(institution, ''), ','), lambda x: trim(x)), lambda x: x <> ''), []) END AS l FROM given)"
)


@query(
    "header_reply",
    on_laws(
        "SELECT doc_id, coalesce(nullif(institution, ''), CASE WHEN len(l) > 0 THEN array_to_string(l, ', ') END) AS institution, l[1] AS institution_primary, l[2] AS institution_secondary, nullif(law_number, '') AS law_number, "
        "coalesce(nullif(effective_date, ''), publication_date) AS effective_date, 'tn-' || 'loi-organique' || '-' || CASE WHEN law_type IS NOT NULL THEN nullif(law_number, '') END AS parent_document_id FROM lists",
        _GIVEN,
    ),
)
def header_reply(spark, sf_dir):
    given = laws(spark, sf_dir).selectExpr(
        "doc_id",
        "named_struct('institution', CASE doc_id % 3 WHEN 0 THEN 'Ministère A, Ministère B ,,C' WHEN 1 THEN '' END, 'institutions', CASE WHEN doc_id % 4 = 1 THEN array('X', 'Y') ELSE array() END, 'law_type', CASE WHEN doc_id % 5 > 0 THEN 'Loi organique' END, "
        "'law_number', CASE WHEN doc_id % 7 > 0 THEN CAST(doc_id AS STRING) ELSE '' END, 'year', 1966, 'title_french', '', 'title_arabic', '', 'publication_date', '1966-04-30', 'effective_date', CASE WHEN doc_id % 2 = 0 THEN '' ELSE '1967-01-01' END, "
        "'source_name', '', 'source_number', '', 'source_date', '') AS reply",
    )
    rows = given.select("doc_id", headers.reply_headers(F.col("reply")).alias("h"))
    return rows.select("doc_id", *[f"h.{c}" for c in ("institution", "institution_primary", "institution_secondary", "law_number", "effective_date", "parent_document_id")])


# Model replies


def _packed(parts: str, glue: str, long: str | None) -> str:
    """Greedy packing as a fold over structs (out, cur, more): the chunks so far, the open one, and of a part its own chunks if it is long."""
    closed = f"list_concat(s.out, CASE WHEN {_strip('s.cur')} <> '' THEN [{_strip('s.cur')}] ELSE CAST([] AS STRING[]) END)"
    over, is_long = f"length(s.cur) + length(x.cur) > {correction.MAX_CHUNK}", f"length(x.cur) > {correction.MAX_CHUNK}" if long else "FALSE"
    out = f"CASE WHEN NOT ({over}) THEN s.out WHEN {is_long} THEN list_concat({closed}, x.more) ELSE {closed} END"
    cur = f"CASE WHEN NOT ({over}) THEN CASE WHEN s.cur = '' THEN x.cur ELSE s.cur || {glue} || x.cur END WHEN {is_long} THEN CASE WHEN {_strip('s.cur')} <> '' THEN '' ELSE s.cur END ELSE x.cur END"
    none, empty = "CAST([] AS STRING[])", "{'out': CAST([] AS STRING[]), 'cur': '', 'more': CAST([] AS STRING[])}"
    start = f"list_transform({parts}, lambda p: {{'out': {none}, 'cur': p, 'more': {long or none}}})"
    fold = f"list_reduce({start}, lambda s, x: {{'out': {out}, 'cur': {cur}, 'more': {none}}}, {empty})"
    return f"list_transform([{fold}], lambda s: {closed})[1]"


_SENTENCES = rf"string_split(regexp_replace(p, '\.{W}+([A-ZÀ-Ý])', '.' || chr(1) || '\1', 'g'), chr(1))"
_LONG = f"CASE WHEN length(p) > {correction.MAX_CHUNK} THEN {_packed(_SENTENCES, "' '", None)} ELSE CAST([] AS STRING[]) END"
_PARAGRAPHS = rf"list_filter(list_transform(regexp_split_to_array(t, '\n{W}*\n'), lambda q: {_strip('q')}), lambda q: q <> '')"
_CHUNKS = (
    f"{_RULES}, sides AS (SELECT doc_id, 'french' AS lang, french_text AS t FROM cleaned UNION ALL SELECT doc_id, 'arabic', arabic_text FROM cleaned), "
    f"chunked AS (SELECT doc_id, lang, {_packed(_PARAGRAPHS, f'{N} || {N}', _LONG)} AS c FROM sides), "
    "chunks AS (SELECT doc_id, lang, CAST(generate_subscripts(c, 1) AS INT) AS chunk_no, unnest(c) AS original FROM chunked)"
)


@query("chunk_text", on_laws("SELECT * FROM chunks", _CHUNKS))
def chunk_text(spark, sf_dir):
    return correction.chunk_table(cleaning.rule_clean(laws(spark, sf_dir)))


_PAIRS = (
    "pairs AS (SELECT doc_id, ord, raw_text AS a, CASE ord % 6 WHEN 0 THEN raw_text WHEN 1 THEN raw_text || raw_text WHEN 2 THEN 'Article 2 ' || raw_text WHEN 3 THEN replace(raw_text, 'rticle 4', 'RTICLE 9') WHEN 4 THEN 'Voici ' || raw_text ELSE upper(raw_text) END AS b FROM articles), "
    f"bare AS (SELECT doc_id, ord, {_strip('a')} AS a, {_strip('b')} AS b FROM pairs)"
)
_MARKS = [rf"(?i)Article[\s\x{{a0}}]+\p{{Nd}}+", r"(?i)Article[\s\x{a0}]+premier", "(?i)CHAPITRE", "(?i)SECTION"]
_NUMBERS = rf"Article{W}+(\p{{Nd}}+)"
_SAID = " OR ".join(f"regexp_matches(b, '{p.replace('(?iu)', '(?i)').replace(chr(39), chr(39) * 2)}')" for p in correction.COMMENTS)
_VERDICT = (
    "CASE WHEN a = '' THEN 'ok' WHEN abs(length(a) - length(b)) / greatest(length(a), 1) > 0.5 THEN 'length' "
    + " ".join(f"WHEN {_count('a', m)} <> {_count('b', m)} THEN 'marker'" for m in _MARKS)
    + f" WHEN regexp_extract_all(a, '{_NUMBERS}', 1) <> regexp_extract_all(b, '{_NUMBERS}', 1) THEN 'numbers' WHEN {_SAID} THEN 'comment' ELSE 'ok' END"
)


@query("validate_correction", on_laws(f"SELECT doc_id, ord, {_VERDICT} AS verdict FROM bare", f"{_ARTICLES}, {_PAIRS}"))
def validate_correction(spark, sf_dir):
    changed = "CASE ord % 6 WHEN 0 THEN raw_text WHEN 1 THEN raw_text || raw_text WHEN 2 THEN 'Article 2 ' || raw_text WHEN 3 THEN replace(raw_text, 'rticle 4', 'RTICLE 9') WHEN 4 THEN 'Voici ' || raw_text ELSE upper(raw_text) END"
    rows = structure.split_articles(laws(spark, sf_dir)).select("doc_id", "ord", F.col("raw_text").alias("a"), F.expr(changed).alias("b"))
    rows = rows.withColumn("reason", correction.validate(F.col("a"), F.col("b")))
    reason = F.col("reason")
    kind = F.when(reason.isNull(), "ok").when(reason.startswith("Text length"), "length").when(reason.startswith("Legal marker"), "marker").when(reason.startswith("Article numbers"), "numbers").otherwise("comment")
    return rows.select("doc_id", "ord", kind.alias("verdict"))


def _words(x: str) -> str:
    return f"CASE WHEN {_strip(x)} = '' THEN [] ELSE list_distinct(regexp_split_to_array({_strip(x)}, '{W}+')) END"


_SWAPPED = "replace(text, 'th', 'ht')"


@query(
    "word_changes",
    on_laws(
        "SELECT laws.doc_id, CAST(coalesce(n, 0) AS INT) AS changed FROM laws LEFT JOIN (SELECT doc_id, count(*) AS n FROM ((FROM x EXCEPT FROM y) UNION ALL (FROM y EXCEPT FROM x)) GROUP BY doc_id) USING (doc_id)",
        f"x AS (SELECT DISTINCT doc_id, unnest({_words('lower(text)')}) AS w FROM laws), y AS (SELECT DISTINCT doc_id, unnest({_words(f'lower({_SWAPPED})')}) AS w FROM laws)",
    ),
)
def word_changes(spark, sf_dir):
    return laws(spark, sf_dir).select("doc_id", correction.word_changes(F.col("text"), F.expr(_SWAPPED)).alias("changed"))


@query("reply_unfence", on_laws(f"SELECT doc_id, {_strip('text')} AS reply, CAST(floor((length({_strip('text')}) + 16) / 4) AS INT) AS tokens FROM laws"))
def reply_unfence(spark, sf_dir):
    raw = F.concat(F.lit("```markdown\n"), T.strip(F.col("text")), F.lit("\n```\n\n"))
    return laws(spark, sf_dir).select("doc_id", correction.unfence(raw).alias("reply"), correction.reply_tokens(raw, F.lit(0)).alias("tokens"))


@query("json_reply", "SELECT doc_id, CASE doc_id % 5 WHEN 4 THEN NULL WHEN 3 THEN NULL ELSE CAST(doc_id AS STRING) END AS article_number, CASE WHEN doc_id % 5 IN (3, 4) THEN NULL ELSE CAST(doc_id % 3 AS BIGINT) END AS n FROM documents")
def json_reply(spark, sf_dir):
    raw = (
        "CASE doc_id % 5 WHEN 0 THEN concat('{\"article_number\": \"', doc_id, '\", \"n\": ', doc_id % 3, '}') WHEN 1 THEN concat('Voici {x} la réponse: {\"article_number\": \"', doc_id, '\", \"n\": ', doc_id % 3, ', } fin') "
        "WHEN 2 THEN concat('<think>{no}</think>{\\'article_number\\': \\'', doc_id, '\\', \\'n\\': ', doc_id % 3, '}') WHEN 3 THEN '[1, 2]' ELSE 'rien' END"
    )
    rows = _documents(spark, sf_dir).select("doc_id", R.parse_reply(F.expr(raw), "article_number string, n long").alias("r"))
    return rows.select("doc_id", "r.article_number", "r.n")


# Assembly

_NUMBER = rf"regexp_replace({_strip(rf"regexp_replace(article_marker, '(?i)\Aa?rticle|[.\-–:]\z', '', 'g')")}, '{W}+', ' ', 'g')"
_ROWS = (
    f"made AS (SELECT a.doc_id, a.ord, {_NUMBER} AS article_number, coalesce(TRY_CAST(regexp_extract({_NUMBER}, '\\A(\\p{{Nd}}+)', 1) AS INT), a.ord) AS article_order, raw_text AS content_french, "
    "CASE WHEN a.ord % 3 = 0 THEN 'فصل ' || CAST(a.ord AS STRING) ELSE '' END AS content_arabic, chapter_detected AS chapter, h.law_type, h.law_number, h.year, h.parent_document_id FROM articles a JOIN head h USING (doc_id)), "
    "named AS (SELECT *, coalesce(parent_document_id || '-', '') || 'art-' || coalesce(nullif(article_number, ''), CAST(article_order AS STRING)) AS article_id FROM made)"
)
_ALL = f"{_ARTICLES}, {_HEADERS}, {_ROWS}"


def _assembled(spark, sf_dir, *, failures: bool = False) -> DataFrame:
    table = laws(spark, sf_dir)
    number = F.regexp_replace(T.strip(F.regexp_replace("article_marker", r"(?iu)\Aa?rticle|[.\-–:]\z", "")), f"{T.WHITE}+", " ")
    rows = structure.split_articles(table)
    fields = [f.split(" ") for f in assembly.ARTICLE_REPLY.split(", ")]
    made = {"article_number": number, "content_french": F.col("raw_text"), "content_arabic": F.when(F.col("ord") % 3 == 0, F.concat(F.lit("فصل "), F.col("ord").cast("string"))).otherwise(""), "chapter": F.col("chapter_detected"), "keywords": F.array(F.lit("loi"), F.col("ord").cast("string"))}
    reply = F.struct(*[made.get(n, F.lit(None)).cast(k).alias(n) for n, k in fields])
    # With failures, every fourth article stands for a failed extraction, which leaves a gap that the links skip.
    replies = rows.select("doc_id", "ord", (F.when(F.col("ord") % 4 != 2, reply) if failures else reply).alias("reply"))
    given = headers.regex_headers(table)
    none = lambda c: F.lit(None).cast("string").alias(c)
    names = ("institution", "institution_primary", "institution_secondary", "title_french", "title_arabic", "publication_date", "source_name", "source_number", "source_date")
    given = given.select("doc_id", "law_type", "law_number", "year", "parent_document_id", F.lit("TUNISIA").alias("jurisdiction"), F.array().cast("array<string>").alias("institutions"), F.lit("1966-04-30").alias("effective_date"), *[none(c) for c in names])
    return assembly.assemble(given, replies)


@query("article_order", on_laws("SELECT doc_id, ord, article_number, article_order FROM named", _ALL))
def article_order(spark, sf_dir):
    return _assembled(spark, sf_dir).select("doc_id", "ord", "article_number", "article_order")


@query("article_links", on_laws("SELECT doc_id, ord, article_id, lag(article_id) OVER w AS preceding_article_id, lead(article_id) OVER w AS following_article_id FROM named WINDOW w AS (PARTITION BY doc_id ORDER BY ord)", _ALL))
def article_links(spark, sf_dir):
    return _assembled(spark, sf_dir).select("doc_id", "ord", "article_id", "preceding_article_id", "following_article_id")


@query("content_hash", on_laws("SELECT doc_id, ord, sha256(content_french || content_arabic) AS content_hash_sha256, concat_ws(' ', nullif(content_french, ''), nullif(content_arabic, '')) AS content_combined FROM named", _ALL))
def content_hash(spark, sf_dir):
    return _assembled(spark, sf_dir).select("doc_id", "ord", "content_hash_sha256", "content_combined")


@query("search_content", on_laws("SELECT doc_id, ord, concat_ws(', ', law_type || ' ' || law_number, 'loi', CAST(ord AS STRING), left(nullif(content_french, ''), 200), left(nullif(content_arabic, ''), 200)) AS search_content FROM named", _ALL))
def search_content(spark, sf_dir):
    return _assembled(spark, sf_dir).select("doc_id", "ord", "search_content")


#: The columns of the article table that the made replies leave at their defaults, by default.
_DEFAULTS = {
    "''": ("summary", "summary_french", "summary_arabic"), "[]": ("institutions", "legal_domains", "target_audience", "related_laws", "entity_names", "entity_types", "entity_ids", "relation_target_ids", "relation_types"),
    "FALSE": assembly.FLAGS, "'LOW'": ("business_impact", "ambiguity_level"), "1": ("graph_level", "version"), "'ACTIVE'": ("status",), "'TUNISIA'": ("jurisdiction",), "'1966-04-30T00:00:00Z'": ("effective_date",),
    "NULL": (*assembly.NULLABLE, "institution", "institution_primary", "institution_secondary", "title_french", "title_arabic", "publication_date", "repeal_date", "superseded_by_id", "supersedes_id", "next_check", "source_name", "source_number", "source_date", "source_url"),
}
_FIXED = ", ".join(f"{'CAST(NULL AS STRING)' if v == 'NULL' else 'CAST([] AS STRING[])' if v == '[]' else v} AS {c}" for v, names in _DEFAULTS.items() for c in names)


@query(
    "assemble",
    on_laws(
        f"SELECT doc_id, ord, article_id, law_type, law_number, year, parent_document_id, nullif(chapter, '') AS chapter, {_key('chapter')} AS chapter_normalized, nullif(article_number, '') AS article_number, article_order, content_french, content_arabic, "
        "concat_ws(' ', nullif(content_french, ''), nullif(content_arabic, '')) AS content_combined, sha256(content_french || content_arabic) AS content_hash_sha256, ['loi', CAST(ord AS STRING)] AS keywords, "
        "concat_ws(', ', law_type || ' ' || law_number, 'loi', CAST(ord AS STRING), left(nullif(content_french, ''), 200), left(nullif(content_arabic, ''), 200)) AS search_content, "
        f"lag(article_id) OVER w AS preceding_article_id, lead(article_id) OVER w AS following_article_id, {_FIXED} FROM named WINDOW w AS (PARTITION BY doc_id ORDER BY ord)",
        _ALL,
    ),
)
def assemble(spark, sf_dir):
    """All articles with all columns of the article table but last_checked, which is the time of the run."""
    return _assembled(spark, sf_dir).drop("last_checked")


@query(
    "parse_results",
    on_laws("SELECT a.doc_id, count(n.ord) AS total_articles, count(*) AS rough_chunks, count(*) + 1 AS llm_calls, count(*) - count(n.ord) AS failed, coalesce(string_agg(CASE WHEN n.ord IS NULL THEN 'Article ' || a.ord || ': extraction failed, skipped.' END, ' ' ORDER BY a.ord), '') AS warnings FROM articles a LEFT JOIN named n ON n.doc_id = a.doc_id AND n.ord = a.ord AND n.ord % 4 <> 2 GROUP BY a.doc_id", _ALL),
)
def parse_results(spark, sf_dir):
    rough = structure.split_articles(laws(spark, sf_dir))
    found = assembly.parse_results(_assembled(spark, sf_dir, failures=True), rough)
    return found.withColumn("warnings", F.array_join("warnings", " "))


@query("article_log", on_laws("SELECT doc_id, ord, article_id || ' [None] FR=' || CASE WHEN trim(content_french) <> '' THEN 'yes' ELSE 'no' END || ' AR=' || CASE WHEN trim(content_arabic) <> '' THEN 'yes' ELSE 'no' END || ' | ' AS line FROM named", _ALL))
def article_log(spark, sf_dir):
    return sinks.log_line(_assembled(spark, sf_dir))


_CELLS = {
    "law_type": "coalesce(law_type, 'Unknown')", "law_number": "coalesce(law_number, 'Unknown')", "year": "coalesce(CAST(year AS STRING), 'Unknown')",
    "chapter": "coalesce(chapter_detected, 'Non détecté')", "section": "coalesce(section_detected, 'Non détectée')", "article_text": "raw_text",
}
_PROMPT = "'" + re.sub(r"\{(\w+)\}", lambda m: f"' || {_CELLS[m[1]]} || '", models.ARTICLE.replace("'", "''")) + "'"


@query("article_prompts", on_laws(f"SELECT doc_id, ord, {_PROMPT} AS prompt FROM articles JOIN head USING (doc_id)", f"{_ARTICLES}, {_HEADERS}"))
def article_prompts(spark, sf_dir):
    table = laws(spark, sf_dir)
    return models.article_prompts(structure.split_articles(table), headers.regex_headers(table))


@query(
    "change_summary",
    on_laws(
        f"SELECT doc_id, 'Cleaning Summary:' || {N} || '  Characters: ' || format('{{:,}}', length(text)) || ' → ' || format('{{:,}}', length(cleaned_text)) || ' (' || format('{{:,}}', greatest(0, length(text) - length(cleaned_text))) || ' noise removed)' || {N} || "
        f"'  Lines removed: ' || noise_lines_removed || {N} || '  Words corrected by LLM: 0' || {N} || '  Chunks processed: 0 (0 needed LLM)' || {N} || '  Duration: 1.50s' AS summary FROM cleaned",
        _RULES,
    ),
)
def change_summary(spark, sf_dir):
    rows = cleaning.rule_clean(laws(spark, sf_dir))
    none = F.lit(0)
    return rows.select("doc_id", correction.change_summary(F.length("text"), F.length("cleaned_text"), F.col("noise_chars_removed"), F.col("noise_lines_removed"), none, none, none, F.lit(1.5)).alias("summary"))


@query(
    "article_report",
    on_laws(
        f"SELECT doc_id, ord, '── Article ' || coalesce(nullif(article_number, ''), 'None') || ' (order: ' || article_order || ') ──' || {N} || coalesce('Chapter: ' || chapter || {N}, '') || 'Summary: ...' || {N} || 'Keywords: loi, ' || ord || {N} || 'Impact: LOW' || {N} || "
        f"'Obligations: False | Penalties: False' || {N} || 'Prev: ' || coalesce(lag(article_id) OVER w, 'None') || {N} || 'Next: ' || coalesce(lead(article_id) OVER w, 'None') AS report FROM named WINDOW w AS (PARTITION BY doc_id ORDER BY ord)",
        _ALL,
    ),
)
def article_report(spark, sf_dir):
    return sinks.report(_assembled(spark, sf_dir))


_BOTH = f"wordlists AS (SELECT doc_id, {_words('text').replace('list_distinct', '')} AS x, {_words(_SWAPPED).replace('list_distinct', '')} AS y FROM laws), " "pairs AS (SELECT doc_id, list_filter(list_zip(x[:least(len(x), len(y))], y[:least(len(x), len(y))]), lambda p: p[1] <> p[2]) AS d FROM wordlists)"


@query("word_diff", on_laws("SELECT doc_id, array_to_string(list_transform(d[:5], lambda p: p[1] || ' → ' || p[2]), '; ') AS changes, CAST(greatest(len(d) - 5, 0) AS INT) AS remaining FROM pairs", _BOTH))
def word_diff(spark, sf_dir):
    found = laws(spark, sf_dir).select("doc_id", correction.word_diff(F.col("text"), F.expr(_SWAPPED)).alias("d"))
    shown = F.transform("d.changes", lambda p: F.concat(p["before"], F.lit(" → "), p["after"]))
    return found.select("doc_id", F.array_join(shown, "; ").alias("changes"), "d.remaining")


# Pages and formats: each text of the documents table is a page of the law that it belongs to

_CONFIDENCE = "CASE WHEN doc_id % 4 > 0 THEN CAST(doc_id % 100 AS DOUBLE) / 100 END AS confidence"
_PAGES = (
    f"raw AS (SELECT CAST(floor(doc_id / 10) AS BIGINT) AS id, CAST(doc_id % 10 + 1 AS INT) AS page_number, text, {_CONFIDENCE} FROM documents), "
    "more AS (SELECT id, page_number + place AS page_number, added AS text, CAST(NULL AS DOUBLE) AS confidence FROM raw, (VALUES (10, 'page 7 du scan'), (20, ' ')) v(place, added) WHERE id % 3 = 0), "
    f"pg AS (SELECT id, page_number, {_clean("coalesce(text, '')")} AS text, confidence FROM (FROM raw UNION ALL FROM more)), "
    f"agg AS (SELECT id AS doc_id, count(*) AS total_pages, count(*) FILTER (length({_strip('text')}) < 50) AS short_pages, round(avg(confidence), 9) AS avg_confidence, string_agg(text, {N} || {N} ORDER BY page_number) FILTER (NOT ({_blank('text')})) AS t FROM pg GROUP BY id)"
)


def _page_documents(spark, sf_dir) -> DataFrame:
    """Each text whole as a page. Every third law gets a short and a blank page per text besides, so that it counts as scanned."""
    rows = _documents(spark, sf_dir).selectExpr("CAST(floor(doc_id / 10) AS BIGINT) AS doc_id", "CAST(doc_id % 10 + 1 AS INT) AS page_number", "text", _CONFIDENCE)
    more = rows.filter("doc_id % 3 = 0").select("doc_id", "page_number", F.explode(F.array(F.struct(F.lit(10).alias("after"), F.lit("page 7 du scan").alias("text")), F.struct(F.lit(20).alias("after"), F.lit(" ").alias("text")))).alias("x"))
    more = more.selectExpr("doc_id", "page_number + x.after AS page_number", "x.text AS text", "CAST(NULL AS DOUBLE) AS confidence")
    return extraction.documents(extraction.page_table(rows.union(more)))


@query("page_concat", f"WITH {_PAGES} SELECT doc_id, {_clean("coalesce(t, '')")} AS full_text, total_pages FROM agg")
def page_concat(spark, sf_dir):
    return _page_documents(spark, sf_dir).select("doc_id", "full_text", "total_pages")


@query("scanned_docs", f"WITH {_PAGES} SELECT doc_id, short_pages, short_pages / total_pages > 0.5 AS is_scanned, {_has_french("coalesce(t, '')")} AS has_french_content FROM agg")
def scanned_docs(spark, sf_dir):
    return _page_documents(spark, sf_dir).select("doc_id", "short_pages", "is_scanned", "has_french_content")


@query("avg_confidence", f"WITH {_PAGES} SELECT doc_id, avg_confidence FROM agg")
def avg_confidence(spark, sf_dir):
    return _page_documents(spark, sf_dir).select("doc_id", F.round("avg_confidence", 9).alias("avg_confidence"))


@query("ocr_choice", f"WITH {_PAGES}, nat AS (SELECT doc_id, {_clean("coalesce(t, '')")} AS n, short_pages / total_pages > 0.5 AS sc FROM agg) SELECT doc_id, sc AND doc_id % 2 = 0 AS used_ocr, CASE WHEN sc AND doc_id % 2 = 0 THEN n || ' OCR' ELSE n END AS full_text FROM nat")
def ocr_choice(spark, sf_dir):
    native = _page_documents(spark, sf_dir)
    ocr = native.select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.concat("full_text", F.lit(" OCR"))).otherwise(F.lit("")).alias("full_text"), F.lit(0.9).alias("avg_confidence"))
    rows = extraction.choose_text(native, ocr)
    return rows.select("doc_id", (F.col("extraction_method") == "ocr").alias("used_ocr"), "full_text")


@query("ocr_confidence", "SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 0.0 ELSE round((doc_id % 97 + 1 + 88) / 2 / 100, 3) END AS confidence FROM documents")
def ocr_confidence(spark, sf_dir):
    confs = F.when(F.col("doc_id") % 5 == 0, F.array(F.lit("-1"), F.lit("0"), F.lit("x"))).otherwise(F.array(F.lit("-1"), (F.col("doc_id") % 97 + 1).cast("string"), F.lit("88"), F.lit("95.5"), F.lit("0")))
    return _documents(spark, sf_dir).select("doc_id", F.round(extraction.word_confidence(confs), 3).alias("confidence"))


@query("format_detect", "SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'pdf' WHEN 1 THEN 'docx' WHEN 2 THEN 'txt' WHEN 3 THEN 'unknown' WHEN 4 THEN 'docx' ELSE 'unknown' END AS format FROM documents")
def format_detect(spark, sf_dir):
    names = F.element_at(F.array(*[F.lit(x) for x in ("/a/b.PDF", "x.y/c.docx", "d.tar.text", "/e/.pdf", "f.Doc", "/g.txt/h")]), (F.col("doc_id") % 6 + 1).cast("int"))
    return _documents(spark, sf_dir).select("doc_id", extraction.file_format(names).alias("format"))


@query("preview", "SELECT doc_id, left(text, 1500) || CASE WHEN length(text) > 1500 THEN chr(10) || chr(10) || '... (' || format('{:,}', length(text) - 1500) || ' more characters)' ELSE '' END AS preview FROM documents")
def preview(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", sinks.preview(F.col("text")).alias("preview"))


@query("correction_layer")
def correction_layer(spark, sf_dir):
    cleaned = stored(cleaning.rule_clean(laws(spark, sf_dir)), "ruled")
    chunks = correction.chunk_table(cleaned)
    fixed = F.when(F.col("chunk_no") % 3 == 0, F.concat(F.lit("```\n"), F.regexp_replace("original", " mot", " mots"), F.lit("\n```"))).when(F.col("chunk_no") % 7 == 1, F.lit("Voici")).otherwise(F.col("original"))
    replies = stored(chunks.select("doc_id", "lang", "chunk_no", fixed.alias("raw_reply"), F.lit(0).alias("eval_count")), "replies")
    return correction.clean_with_replies(cleaned, replies).drop("timestamp")


@query("envelopes")
def envelopes(spark, sf_dir):
    pages = _page_documents(spark, sf_dir).select("doc_id", "full_text", "total_pages", "is_scanned")
    return sinks.envelope(2, pages, correction.clean_with_replies(cleaning.rule_clean(laws(spark, sf_dir)), None).drop("timestamp"))
