"""Golden rows, worked out by hand from the rules, and plain-Python models of the packing and splitting operators."""

import random
import re

import pytest
from pyspark.sql import functions as F

from maktaba.functions import replies
from maktaba.functions import text as T
from maktaba.operators import assembly, cleaning, correction, extraction, headers, structure


def value(spark, column, **cells):
    """The column over one row of string cells."""
    names = list(cells) or ["x"]
    row = spark.createDataFrame([tuple(cells.values()) or ("",)], ", ".join(f"{n} string" for n in names))
    return row.select(column.alias("v")).first().v


def on(spark, function, text):
    return value(spark, function(F.col("t")), t=text)


@pytest.mark.parametrize(
    ("text", "want"),
    [("“a” – b ‏", '"a" - b '), ("é ‘x’ — ﻿", "é 'x' - ")],
)
def test_characters(spark, text, want):
    assert on(spark, cleaning.normalize_characters, text) == want


def test_noise_lines(spark):
    kept, removed = cleaning.remove_noise_lines(F.col("t"))
    found = value(spark, F.struct(kept.alias("k"), removed.alias("r")), t="06\nLS\n&@#\nII\n12/03/1959\nArt\n \n. 12\n.,;\nab\x0bcd\n")
    assert (found.k, found.r) == ("12/03/1959\nArt\n\nab\ncd", 6)


@pytest.mark.parametrize(
    ("line", "want"),
    [
        ("prévus par la loi. 06", "prévus par la loi"), ("taux 12.5", "taux 12"), ("annexe B est", "annexe est"), ("x B C y", "x C y"), ("fin &@# ", "fin"), ("voir 5-2 116", "voir"), ("a A b", "a A b"),
    ],
)
def test_artifacts(spark, line, want):
    assert on(spark, cleaning.clean_artifacts, line) == want


@pytest.mark.parametrize(
    ("text", "french", "arabic"),
    [
        ("Latin seul", "Latin seul", ""), ("قانون", "", "قانون"), ("12 - 34", "12 - 34", ""), ("  ", "", ""), ("", "", ""),
        ("les dispositions de la présente loi sont applicables قا dans tous", "les dispositions de la présente loi sont applicables dans tous", ""), ("la loi قانون 14", "la loi 14", "قانون 14"),
    ],
)
def test_languages(spark, text, french, arabic):
    found = on(spark, cleaning.separate_languages, text)
    assert (found.fr, found.ar) == (french, arabic)


@pytest.mark.parametrize(("text", "want"), [("fin.\n- tiret", "fin.- tiret"), ("a\n. b", "a. b"), ('le 1" avril', "le 1er avril"), ("Art.Le mot ,x", "Art. Le mot, x"), ("été.à", "été. à")])
def test_punctuation(spark, text, want):
    assert on(spark, cleaning.fix_punctuation, text) == want


def test_spaces(spark):
    assert on(spark, cleaning.normalize_whitespace, " a\t b \n c\n\n\n\n\nd") == "a b\nc\n\n\nd"
    assert on(spark, T.clean_text, " a \n \n \n \n b c ") == "a\n\n\n\nb c"
    assert on(spark, T.clean_text, None) == ""


def test_rule_clean_of_nothing(spark):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "06")], "doc_id long, text string")
    found = cleaning.rule_clean(rows).collect()
    assert [(r.cleaned_text, r.noise_lines_removed, r.noise_chars_removed) for r in found] == [("", 0, 0), ("", 0, 0), ("", 1, 2)]
    assert cleaning.rule_clean(rows.limit(0)).count() == 0


def split(spark, text):
    return structure.split_articles(spark.createDataFrame([(1, text)], "doc_id long, text string")).orderBy("ord").collect()


def test_splitter(spark):
    rows = split(spark, "Préambule Article 2.- x l'article 5. particle 9- Article premier : fin")
    assert [r.article_marker for r in rows] == ["Article 2.", "article 5.", "article 9-", "Article premier :"]
    assert rows[0].start_pos == 10 and all(a.end_pos == b.start_pos for a, b in zip(rows, rows[1:]))
    assert split(spark, "ARTICLE 7 sans marque") == [] and split(spark, None) == []
    assert split(spark, "ARTICLE 14 bis- x")[0].article_marker == "ARTICLE 14 bis-"


def test_headings(spark):
    find = lambda t: on(spark, lambda c: structure.heading(c, structure.CHAPTER, "CHAPITRE"), t)
    assert find("CHAPITRE II DISPOSITIONS") is None and find("CHAPITRE DIX") is None
    assert find("CHAPITRE I -\nTITRE") == "CHAPITRE I - TITRE" and find("x\nChapitre PREMIER\ny") == "CHAPITRE PREMIER"
    rows = split(spark, "Article 1.- a\nCHAPITRE II - DEUX\nArticle 2.- b\nArticle 3.- c")
    assert [r.chapter_detected for r in rows] == ["CHAPITRE II - DEUX"] * 3 and rows[0].raw_text == "Article 1.- a"
    assert on(spark, structure.chapter_key, "CHAPITRE PREMIER - DISPOSITIONS GÉNÉRALES") == "chapitre_premier_dispositions_generales"


def test_headers(spark):
    assert value(spark, headers.parent_id(F.col("a"), F.col("b")), a="Décret-loi", b="66-27") == "tn-decret-loi-66-27"
    assert value(spark, headers.parent_id(F.col("a"), F.col("b")), a="", b="66-27") is None
    year = lambda n, strict=True: value(spark, headers.law_year(F.lit("du 5 mai 1999"), F.col("n"), strict=strict), n=n)
    assert [year("66-27"), year("14-5"), year("2017-51"), year("2017-51", False), year("123"), year(None)] == [1966, 2014, 3917, 2017, 1999, None]
    assert on(spark, headers.law_type, "un emploi") == "Loi" and on(spark, headers.law_type, "Décret loi") == "Décret-loi"
    assert on(spark, headers.law_number, "N° 66–27 du") == "66-27"
    assert on(spark, structure.header_prefix, "Loi\nARTICLE premier. x") == "Loi" and on(spark, structure.header_prefix, "y" * 3000) == "y" * 2000


def test_assembly(spark):
    order = lambda n: value(spark, assembly.article_order(F.col("n"), F.lit(7)), n=n)
    assert [order("premier"), order("14 bis"), order("1630-47"), order(None)] == [7, 14, 1630, 7]
    assert value(spark, assembly.iso_date(F.col("d")), d="1966-04-30") == "1966-04-30T00:00:00Z" and value(spark, assembly.iso_date(F.col("d")), d="1966-04-30T10") == "1966-04-30T10"
    rows = spark.createDataFrame([(1, 1, '{"article_number": "1", "keywords": null}'), (1, 2, "none"), (1, 3, '{"article_number": "3", "content_french": "x", "has_penalties": true}')], "doc_id long, ord int, raw string")
    replies_ = rows.select("doc_id", "ord", replies.parse_reply(F.col("raw"), assembly.ARTICLE_REPLY).alias("reply"))
    given = spark.createDataFrame([(1, "tn-loi-1")], "doc_id long, parent_document_id string")
    nothing = [c for c in ("jurisdiction", "institution", "institution_primary", "institution_secondary", "law_type", "law_number", "title_french", "title_arabic", "effective_date", "publication_date", "source_name", "source_number", "source_date")]
    given = given.select("*", *[F.lit(None).cast("string").alias(c) for c in nothing], F.array().cast("array<string>").alias("institutions"), F.lit(1966).alias("year"))
    found = assembly.assemble(given, replies_)
    assert found.columns[3:] == list(assembly.ARTICLE_COLUMNS) and len(assembly.ARTICLE_COLUMNS) == 61
    a, b = found.orderBy("ord").collect()
    assert (a.following_article_id, b.preceding_article_id, a.preceding_article_id) == ("tn-loi-1-art-3", "tn-loi-1-art-1", None)
    assert a.keywords == [] and a.content_french == "" and b.has_penalties and b.status == "ACTIVE"
    done = assembly.parse_results(found, rows.select("doc_id", "ord")).first()
    assert (done.total_articles, done.rough_chunks, done.llm_calls, done.failed, len(done.warnings)) == (2, 3, 4, 1, 1)


@pytest.mark.parametrize(
    ("reply", "want"),
    [
        ('{"a": 1}', '{"a": 1}'), ('x {"a": [1, 2,],} y', '{"a": [1, 2]}'), ("<t>{no}</t> {'a': 'b'}", '{"a": "b"}'), ("} {'a': 1}", None), ("[1]", None), ("nothing", None), (None, None), ('{"a": null}', '{"a": null}'),
    ],
)
def test_json_replies(reply, want):
    assert replies.find_object(reply) == want


def model_chunks(text, limit):
    """The packing of paragraphs and sentences, restated as plain loops."""

    def pack(parts, separator, whole=None):
        out, cur = [], ""
        for p in parts:
            if len(cur) + len(p) > limit:
                if cur.strip():
                    out.append(cur.strip())
                    cur = "" if whole else cur
                if whole and len(p) > limit:
                    out += whole(p)
                else:
                    cur = p
            else:
                cur = cur + separator + p if cur else p
        return out + ([cur.strip()] if cur.strip() else [])

    sentences = lambda p: pack(re.split(r"(?<=\.)\s+(?=[A-ZÀ-Ý])", p), " ")
    return pack([p.strip() for p in re.split(r"\n\s*\n", text) if p.strip()], "\n\n", sentences)


def test_chunks_against_model(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice(["abc. ", "Def", " ", "\n", "\n\n", "é. É", "x" * 9]) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    texts += ["a" * 500 + "\n\n" + "b" * 300 + "\n\nc", ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for limit in (20, 800):
        found = {r.i: r.c for r in rows.select("i", correction.split_chunks(F.col("t"), limit).alias("c")).collect()}
        assert [found[i] for i in range(len(texts))] == [model_chunks(t, limit) for t in texts]


def test_validator(spark):
    check = lambda a, b: value(spark, correction.validate(F.col("a"), F.col("b")), a=a, b=b)
    assert check("a" * 10, "b" * 15) is None and check("a" * 10, "b" * 16).startswith("Text length changed too much (10 → 16, 60%")
    assert "Legal marker count changed" in check("Article 2 dispose", "Art. 2 dispose ici") and check("", "anything") is None
    assert check("Article 2 dispose", "Article 3 dispose") == "Article numbers changed: ['2'] → ['3']"
    assert "commentary" in check("le texte de loi", "Voici le texte") and check("article 2 x", "ARTICLE 3 x") is None


def test_correction_layer(spark):
    cleaned = cleaning.rule_clean(spark.createDataFrame([(1, "Le mot ,juste.\n&@#"), (2, None)], "doc_id long, text string"))
    reply = spark.createDataFrame([(1, "french", 1, "```\nLe mot exact.\n```", 0)], "doc_id long, lang string, chunk_no int, raw_reply string, eval_count int")
    a, b = correction.clean_with_replies(cleaned, reply).orderBy("doc_id").collect()
    assert (a.cleaned_text, a.chunks_processed, a.chunks_corrected_by_llm, a.words_corrected, len(a.changes)) == ("Le mot exact.", 1, 1, 4, 2)
    assert (b.cleaned_text, b.chunks_processed, b.changes, b.warnings) == ("", 0, [], [])
    diff = value(spark, correction.word_diff(F.col("a"), F.col("b"), 1), a="x y z", b="x b c d")
    assert [tuple(c) for c in diff.changes] == [("y", "b")] and diff.remaining == 1


def test_extraction(spark):
    confs = lambda xs: spark.createDataFrame([(xs,)], "c array<string>").select(extraction.word_confidence(F.col("c")).alias("v")).first().v
    assert confs(["-1", "0", "96", "88", "95.5"]) == 0.92 and confs(["x"]) == 0.0 and confs([]) == 0.0
    long = "y" * 60
    pages = [(1, n, t, None) for n, t in enumerate(["a", "b", long, long], 1)] + [(2, n, t, 0.5) for n, t in enumerate(["a", "b", " ", long], 1)]
    one, two = extraction.documents(spark.createDataFrame(pages, "doc_id long, page_number int, text string, confidence double")).orderBy("doc_id").collect()
    assert (one.is_scanned, one.avg_confidence, one.total_pages) == (False, None, 4) and (two.is_scanned, two.avg_confidence) == (True, 0.5)
    assert two.full_text == f"a\n\nb\n\n{long}" and len(two.warnings) == 1
