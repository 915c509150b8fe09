"""Prompts for a language model, and a pluggable client that answers them by partitions.

A client is a function (prompt, timeout in seconds) -> (reply, token count), or raises. No client is built in: replies are a
table, and a run without a client works on a stored one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from concurrent.futures import TimeoutError as Late

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from . import assembly, headers

Client = Callable[[str, float], tuple[str, int]]
CORRECTION = {
    "french": "Corrige les erreurs de numérisation du texte juridique suivant, sans rien ajouter, traduire ni résumer. Rends le texte corrigé seul.\n\n{chunk}",
    "arabic": "صحح أخطاء المسح الضوئي في النص القانوني التالي دون إضافة أو ترجمة أو تلخيص. أعد النص المصحح فقط.\n\n{chunk}",
}
HEADER = (
    "Voici le début d'un texte juridique. Rends un seul objet JSON, sans commentaire, qui commence par { et a les champs :\n"
    + ", ".join(f"{n} ({k})" for n, k in (f.split(" ") for f in headers.REPLY.split(", ")))
    + ".\nDates en AAAA-MM-JJ ; null pour ce que le texte ne dit pas ; toutes les institutions nommées dans institutions.\n\n{header_text}"
)
ARTICLE = (
    "Texte : {law_type} n° {law_number} ({year}). Chapitre : {chapter}. Section : {section}.\n"
    "Rends un seul objet JSON, sans commentaire, qui commence par { et a les champs :\n"
    + ", ".join(f"{n} ({k})" for n, k in (f.split(" ") for f in assembly.ARTICLE_REPLY.split(", ")))
    + ".\ncontent_french et content_arabic sont obligatoires : traduis le texte qui manque. business_impact et ambiguity_level : LOW, MEDIUM ou HIGH. null pour ce que l'article ne dit pas.\n\n{article_text}"
)


def _fill(template: str, **cells: Column) -> Column:
    out = F.lit(template)
    for name, cell in cells.items():  # the text comes last, so that braces in it are never filled
        out = F.replace(out, F.lit("{" + name + "}"), cell)
    return out


def correction_prompt(chunk: Column, lang: Column, templates: dict[str, str] = CORRECTION) -> Column:
    return F.when(lang == "arabic", _fill(templates["arabic"], chunk=chunk)).otherwise(_fill(templates["french"], chunk=chunk))


def article_prompts(articles: DataFrame, headers: DataFrame, template: str = ARTICLE) -> DataFrame:
    """doc_id, ord and prompt for each rough article; what isn't known is named so."""
    known = lambda c, other: F.coalesce(T.nonempty(F.col(c).cast("string")), F.lit(other))
    rows = articles.join(headers.select("doc_id", "law_type", "law_number", "year"), "doc_id", "left")
    prompt = _fill(
        template, law_type=known("law_type", "Unknown"), law_number=known("law_number", "Unknown"), year=known("year", "Unknown"),
        chapter=known("chapter_detected", "Non détecté"), section=known("section_detected", "Non détectée"), article_text=F.col("raw_text"),
    )
    return rows.select("doc_id", "ord", prompt.alias("prompt"))


def header_prompts(headers_: DataFrame, template: str = HEADER) -> DataFrame:
    """doc_id and prompt for each document, from its preamble_text."""
    return headers_.select("doc_id", _fill(template, header_text=F.coalesce("preamble_text", F.lit(""))).alias("prompt"))


def chunk_prompts(chunks: DataFrame, templates: dict[str, str] = CORRECTION) -> DataFrame:
    """doc_id, lang, chunk_no and prompt for each chunk of correction.chunk_table."""
    return chunks.select("doc_id", "lang", "chunk_no", correction_prompt(F.col("original"), F.col("lang"), templates).alias("prompt"))


def is_available(names: list[str], model: str) -> bool:
    """Whether a listed model's name contains the wanted one."""
    return any(model in n for n in names)


def answers(client: Client, model: str, listed: Callable[[], list[str]], timeout: float) -> bool:
    """Whether the model is listed, or else a trial call goes through. A list that can't be had counts as no model."""
    try:
        if not is_available(listed(), model):
            client("test", timeout)
        return True
    except Exception:  # noqa: BLE001  whatever keeps the client from answering
        return False


class _Line:
    """One thread that calls the client for a partition. A late call keeps its thread until the client gives up, which got
    the same timeout; the next call takes a new one."""

    def __init__(self, client: Client, timeout: float):
        self.client, self.timeout, self.pool = client, timeout, None

    def call(self, prompt: str) -> tuple[str, int]:
        self.pool = self.pool or ThreadPoolExecutor(1)
        try:
            return self.pool.submit(self.client, prompt, self.timeout).result(self.timeout)
        except Late:
            self.pool.shutdown(wait=False, cancel_futures=True)
            self.pool = None
            raise


def ask(prompts: DataFrame, client: Client, *, timeout: float = 180.0, attempts: int = 3) -> DataFrame:
    """prompts with raw_reply and eval_count. A late, failing or empty call is tried again, then gives null and 0."""
    names = [c for c in prompts.columns if c != "prompt"]
    schema = ", ".join(f"{c} {prompts.schema[c].dataType.simpleString()}" for c in names) + ", raw_reply string, eval_count int"

    def one(prompt: str, line: _Line) -> tuple[str | None, int]:
        for _ in range(attempts):
            try:
                reply, count = line.call(prompt)
                if reply and reply.strip():
                    return reply, int(count or 0)
            except Exception:  # noqa: BLE001  any failure of the client, lateness included, counts as no answer
                continue
        return None, 0

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        line = _Line(client, timeout)
        for batch in batches:
            found = [one(p, line) for p in batch["prompt"]]
            yield batch[names].assign(raw_reply=[r for r, _ in found], eval_count=pd.array([n for _, n in found], dtype="int32"))

    return prompts.mapInPandas(run, schema)
