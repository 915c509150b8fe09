"""Command line: python -m maktaba FILE... [--phase 1|2|3] [--ocr] [--no-llm] [--model NAME] [--timeout S] [--client MODULE:FUNCTION] [--replies DIR] [--output FILE.json|DIR] [--text-only | --articles-only]"""

from __future__ import annotations

import argparse
import importlib
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import assembly
from .plans.run import Model, Run, run
from .sources import sinks


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="maktaba", description="Legal documents to article tables.")
    p.add_argument("file", nargs="+")
    p.add_argument("--phase", type=int, choices=(1, 2, 3), default=3)
    p.add_argument("--ocr", action="store_true", help="read PDF files by OCR")
    p.add_argument("--no-llm", action="store_true", help="no corrections by a model")
    p.add_argument("--model", default="gemma3:4b", help="the model that the replies come from")
    p.add_argument("--replies", help="a folder with chunks, headers and articles tables of replies (Parquet)")
    p.add_argument("--timeout", type=int, default=180, help="seconds that a call of the model may take")
    p.add_argument("--client", help="module:function that answers prompts, (prompt, timeout) -> (reply, token count); its attribute listed, if any, names the models at hand")
    p.add_argument("--output", "-o", help="a .json file (for results of a few documents), else a folder for JSON lines")
    p.add_argument("--text-only", action="store_true")
    p.add_argument("--articles-only", action="store_true")
    o = p.parse_args(args)
    spark = SparkSession.builder.appName("maktaba").getOrCreate()
    replies = {}
    if o.replies:
        replies = {n: spark.read.parquet(f"{o.replies}/{n}.parquet") for n in ("chunks", "headers", "articles") if "://" in o.replies or os.path.exists(f"{o.replies}/{n}.parquet")}
    client = None
    if o.client:
        module, _, name = o.client.partition(":")
        client = getattr(importlib.import_module(module), name)
    began = time.perf_counter()
    try:
        found = run(spark, o.file, o.phase, force_ocr=o.ocr, replies=replies, model=Model(o.model, client, o.timeout, listed=getattr(client, "listed", None)), skip_llm=o.no_llm)
    except (FileNotFoundError, ValueError) as e:
        print(f"Error: {e}", file=sys.stderr)
        return 1
    as_file = bool(o.output) and o.output.endswith(".json")
    save = (lambda df: sinks.write_pretty(df, o.output)) if as_file else (lambda df: sinks.write_json(df, o.output))
    if o.phase == 3 and o.articles_only:
        table = found.articles if found.articles is not None else found.rough
        if o.output:
            save(table)
        else:
            print(sinks.write_pretty(table, None))
        return 0
    for row in _shown(found, o).toLocalIterator():
        print(row.text)
    if o.output:
        envelopes = sinks.envelope(o.phase, found.extraction, found.cleaning, None if found.headers is None else _parsing(found, o.model, time.perf_counter() - began))
        if as_file:
            sinks.write_texts(envelopes.select("envelope"), o.output)
        else:
            save(envelopes)
    return 0


def _shown(found: Run, o: argparse.Namespace) -> DataFrame:
    """The lines that a run prints, as column text: whole texts, previews, or after phase 3 a report of each article."""
    if o.phase == 3:
        if o.text_only or found.articles is None:
            return found.extraction.select(F.col("doc_id").alias("text")).limit(0) if o.text_only else found.rough.orderBy("doc_id", "ord").select(F.concat("doc_id", F.lit(" "), "ord", F.lit(" "), "article_marker").alias("text"))
        return sinks.report(found.articles).orderBy("doc_id", "ord").select(F.col("report").alias("text"))
    texts = found.extraction.select("doc_id", F.col("full_text").alias("text")) if found.cleaning is None else found.cleaning.select("doc_id", F.col("cleaned_text").alias("text"))
    return texts.select("text" if o.text_only else F.concat("doc_id", F.lit("\n"), sinks.preview(F.col("text"))).alias("text"))


def _parsing(found: Run, model: str, seconds: float) -> DataFrame:
    """The parsing part of the envelopes: header, articles, counts, model and warnings per document."""
    header = found.headers.select("doc_id", F.struct(*[c for c in found.headers.columns if c != "doc_id"]).alias("header"))
    out = header.withColumn("model_used", F.lit(model)).withColumn("parsing_duration_seconds", F.lit(round(seconds, 3)))
    if found.articles is not None:
        rows = found.articles.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("ord", F.struct(*assembly.ARTICLE_COLUMNS).alias("a")))).alias("articles"))
        out = out.join(rows.select("doc_id", F.transform("articles", lambda a: a["a"]).alias("articles")), "doc_id", "left").join(found.results, "doc_id", "left")
    return out


if __name__ == "__main__":
    sys.exit(main())
