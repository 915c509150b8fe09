"""Whole runs over files, prompts and model clients."""

import json
import time

from pyspark.sql import functions as F

from maktaba.__main__ import main
from maktaba.operators import models
from maktaba.plans.run import Model, run

LAW = "Loi n° 66-27 du 30 avril 1966\nCHAPITRE PREMIER - TITRE\nArticle premier.- Le mot ,juste.\n&@#\nArticle 2.- Fin du texte.\n"


def test_run(spark, tmp_path):
    path = tmp_path / "law.txt"
    path.write_text(LAW, encoding="utf-8")
    doc = f"file:{path}"
    articles = spark.createDataFrame([(doc, 1, '{"article_number": "premier", "content_french": "Le mot, juste."}'), (doc, 2, "rien")], "doc_id string, ord int, raw_reply string")
    found = run(spark, [str(path)], replies={"articles": articles})
    assert found.headers.first().parent_document_id == "tn-loi-66-27"
    assert [r.article_marker for r in found.rough.orderBy("ord").collect()] == ["Article premier.", "Article 2."]
    row = found.articles.collect()
    assert len(row) == 1 and row[0].article_id == "tn-loi-66-27-art-premier" and row[0].law_type == "Loi"
    given = spark.createDataFrame([(doc, 'x {"law_type": "Décret", "law_number": "1", "institution": "A, B",} y')], "doc_id string, raw_reply string")
    head = run(spark, [str(path)], replies={"headers": given}).headers.first()
    assert (head.parent_document_id, head.institution_secondary) == ("tn-decret-1", "B")


def test_command_line(spark, tmp_path, capsys):
    path, out = tmp_path / "law.txt", tmp_path / "out"
    path.write_text(LAW, encoding="utf-8")
    assert main([str(path), "--phase", "2", "--text-only", "--no-llm", "--output", str(out)]) == 0
    assert "Le mot, juste." in capsys.readouterr().out
    whole = json.loads(spark.read.json(str(out)).first().envelope)
    assert whole["phase"] == 2 and whole["cleaning"]["lines_removed"] == 1 and whole["cleaning"]["warnings"] == []
    assert main([str(tmp_path / "missing.txt")]) == 1 and "not found" in capsys.readouterr().err
    assert main([str(path), "--articles-only"]) == 0 and "Article 2." in capsys.readouterr().out
    file = tmp_path / "all.json"
    assert main([str(path), "--client", "tests.test_run:answer", "--timeout", "9", "-o", str(file)]) == 0
    assert "── Article 2 (order: 2) ──" in capsys.readouterr().out
    whole = json.loads(file.read_text(encoding="utf-8"))
    assert whole["phase"] == 3 and whole["parsing"]["total_articles"] == 2 and whole["parsing"]["model_used"] == "gemma3:4b" and whole["parsing"]["header"]["institution_primary"] == "A"
    assert whole["cleaning"]["llm_available"] and whole["parsing"]["articles"][1]["content_french"] == "Fin du texte."
    file = tmp_path / "articles.json"
    assert main([str(path), "--client", "tests.test_run:answer", "--articles-only", "-o", str(file)]) == 0
    assert [a["article_order"] for a in json.loads(file.read_text(encoding="utf-8"))] == [1, 2]


def answer(prompt, timeout):
    """A model client for the tests."""
    if "institutions" in prompt:
        return '{"law_type": "Loi", "law_number": "66-27", "institutions": ["A", "B"]}', 5
    if "content_french" in prompt:
        n = 1 if "Article premier" in prompt else 2
        return json.dumps({"article_number": "premier" if n == 1 else "2", "article_order": n, "content_french": "Le mot, juste." if n == 1 else "Fin du texte.", "summary_french": "s"}), 7
    return prompt.split("\n\n", 1)[1], 3


def test_model_and_documents_without_articles(spark, tmp_path):
    for name, text in (("law", LAW), ("none", "rien du tout")):
        (tmp_path / f"{name}.txt").write_text(text, encoding="utf-8")
    paths = [str(tmp_path / f"{n}.txt") for n in ("law", "none")]
    found = run(spark, paths, model=Model("m", answer))
    results = {r.doc_id.rsplit("/", 1)[1]: r for r in found.results.collect()}
    assert (results["law.txt"].total_articles, results["law.txt"].llm_calls, results["law.txt"].warnings) == (2, 3, [])
    assert (results["none.txt"].total_articles, results["none.txt"].llm_calls, results["none.txt"].warnings) == (0, 1, ["No articles found in document text."])
    plain = run(spark, paths[:1], 2).cleaning
    assert plain.columns == found.cleaning.columns and plain.first().warnings == ["Ollama not available. Skipping LLM correction."] and not plain.first().llm_available
    assert run(spark, paths[:1], 2, skip_llm=True).cleaning.first().warnings == []


def test_prompts_and_client(spark):
    rows = spark.createDataFrame([(1, 1, "texte {law_type} fin", None, None)], "doc_id long, ord int, raw_text string, chapter_detected string, section_detected string")
    head = spark.createDataFrame([(1, None, "12", 1966)], "doc_id long, law_type string, law_number string, year int")
    prompt = models.article_prompts(rows, head).first().prompt
    assert "Unknown n° 12 (1966)" in prompt and "Non détectée" in prompt and prompt.endswith("texte {law_type} fin")
    shown = spark.range(1).select(models.correction_prompt(F.lit("abc"), F.lit("french")).alias("p")).first().p
    assert shown.endswith("abc") and "Corrige" in shown

    def client(prompt, timeout):
        if prompt == "slow":
            time.sleep(1)
        if prompt == "bad":
            raise OSError
        return ("" if prompt == "empty" else prompt.upper()), 3

    asked = spark.createDataFrame([(i, p) for i, p in enumerate(["a", "slow", "bad", "empty"])], "id long, prompt string")
    found = {r.id: (r.raw_reply, r.eval_count) for r in models.ask(asked, client, timeout=0.2, attempts=2).collect()}
    assert found == {0: ("A", 3), 1: (None, 0), 2: (None, 0), 3: (None, 0)}
    assert models.is_available(["gemma3:4b-it"], "gemma3:4b") and not models.is_available([], "x")


def test_model_that_is_not_at_hand(spark, tmp_path):
    path = tmp_path / "law.txt"
    path.write_text(LAW, encoding="utf-8")
    asked = []

    def down(prompt, timeout):
        asked.append(prompt)
        raise ConnectionError

    def gone():
        raise ConnectionError

    for listed, tried in ((lambda: ["other"], ["test"]), (gone, [])):
        asked.clear()
        row = run(spark, [str(path)], 2, model=Model(client=down, listed=listed)).cleaning.first()
        assert not row.llm_available and row.warnings == ["Ollama not available. Skipping LLM correction."] and asked == tried
    assert Model(client=answer, listed=lambda: ["gemma3:4b-it"]).available and not Model().available
    loads = Model("later", client=lambda prompt, timeout: ("x", 1), listed=list)
    assert loads.available and loads.available


def test_chunk_size_and_length_change_of_a_model(spark, tmp_path):
    path = tmp_path / "law.txt"
    path.write_text("Premier alinéa du texte.\n\nSecond alinéa du texte.", encoding="utf-8")
    short = Model(client=lambda prompt, timeout: (prompt.split("\n\n", 1)[1][:-3], 1), max_chunk=30, max_length_change=0.1)
    row = run(spark, [str(path)], 2, model=short).cleaning.first()
    assert row.chunks_processed == 2 and row.chunks_corrected_by_llm == 0 and "Text length changed too much" in row.warnings[0]
    assert run(spark, [str(path)], 2, model=Model(client=short.client)).cleaning.first().chunks_corrected_by_llm == 1
