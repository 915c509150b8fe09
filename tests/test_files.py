"""File sources, sinks and the stream of arriving files."""

import io
import json
import uuid
import zipfile

import pytest

from maktaba.operators import cleaning
from maktaba.sources import files, sinks
from maktaba.streaming import arrivals

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'


def docx(*parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {W}><w:body>{''.join(parts)}</w:body></w:document>")
    return out.getvalue()


def p(text, brk=False):
    return f'<w:p><w:r>{"<w:br w:type=\"page\"/>" if brk else ""}<w:t>{text}</w:t></w:r></w:p>'


def table(*rows):
    return "<w:tbl>" + "".join("<w:tr>" + "".join(f"<w:tc>{p(c)}</w:tc>" for c in r) + "</w:tr>" for r in rows) + "</w:tbl>"


def test_text_files(spark, tmp_path):
    french = "Article 2.- Des autorisations d'exercice de la médecine vétérinaire peuvent être accordées"
    arabic = "يضبط هذا القانون شروط ممارسة المهنة"
    (tmp_path / "f.txt").write_text(french, encoding="utf-8")
    (tmp_path / "a.TXT").write_text(arabic, encoding="utf-8")
    (tmp_path / "b.text").write_text(f"{french}\r\n{arabic}", encoding="utf-8")
    (tmp_path / "w.txt").write_bytes(arabic.encode("cp1256"))
    found = {r.file_name: r for r in files.extract(spark, [str(tmp_path / n) for n in ("f.txt", "a.TXT", "b.text", "w.txt")]).collect()}
    assert found["f.txt"].has_french_content and found["f.txt"].total_pages == 1 and "autorisations" in found["f.txt"].full_text and found["f.txt"].file_format == "txt"
    assert found["a.TXT"].has_arabic_content and found["a.TXT"].full_text == arabic
    assert found["b.text"].has_french_content and found["b.text"].has_arabic_content and found["b.text"].full_text == f"{french}\n{arabic}"
    assert found["w.txt"].full_text == arabic and found["w.txt"].warnings == ["File was not UTF-8. Decoded using: windows-1256"]


def test_bad_paths(spark, tmp_path):
    (tmp_path / "empty.txt").touch()
    with pytest.raises(ValueError, match="empty"):
        files.extract(spark, str(tmp_path / "empty.txt"))
    with pytest.raises(FileNotFoundError):
        files.extract(spark, "/nonexistent/file.txt")
    with pytest.raises(ValueError, match="Unsupported"):
        files.extract(spark, "document.xyz")


def test_word_files(spark, tmp_path):
    (tmp_path / "d.docx").write_bytes(docx(p("un"), p(" "), p("deux", True), p("", True), p("trois", True), table(("a", " ", "b"), ("", ""), ("c", "d"))))
    (tmp_path / "bad.docx").write_bytes(b"no zip")
    found = {r.file_name: r for r in files.extract(spark, [str(tmp_path / "d.docx"), str(tmp_path / "bad.docx")]).collect()}
    assert [(x.page_number, x.text) for x in found["d.docx"].pages] == [(1, "un"), (2, "deux"), (4, "trois\na | b\nc | d")]
    assert found["d.docx"].extraction_method == "docx_parse"
    assert found["bad.docx"].total_pages == 0 and found["bad.docx"].warnings == ["File is not a valid .docx package."]


def logged(folder, name, pages):
    """A reader that leaves a file in the folder for each call."""

    def read(content):
        (folder / f"{name}-{uuid.uuid4().hex}").touch()
        yield from pages(content)

    return read


def test_pdf_files_are_read_once(spark, tmp_path):
    (tmp_path / "scan.pdf").write_bytes(b"scan")
    (tmp_path / "text.pdf").write_bytes(b"text")
    calls = tmp_path / "calls"
    calls.mkdir()
    native = logged(calls, "native", lambda content: [(1, "x" if content == b"scan" else "mot " * 40, None), (2, "", None)])
    ocr = logged(calls, "ocr", lambda content: [(1, "lu par la machine", 0.9), (2, "suite", 0.8)])
    paths = [str(tmp_path / n) for n in ("scan.pdf", "text.pdf")]
    found = {r.file_name: r for r in files.extract(spark, paths, pdf_reader=native, ocr_reader=ocr).collect()}
    assert sorted(p.name.split("-")[0] for p in calls.iterdir()) == ["native", "native", "ocr"]
    assert (found["scan.pdf"].extraction_method, found["scan.pdf"].full_text, found["scan.pdf"].is_scanned) == ("ocr", "lu par la machine\n\nsuite", True)
    assert found["scan.pdf"].avg_confidence == pytest.approx(0.85)
    assert (found["text.pdf"].extraction_method, found["text.pdf"].is_scanned, found["text.pdf"].total_pages) == ("native_pdf", False, 2)
    forced = files.extract(spark, paths[1], force_ocr=True, ocr_reader=ocr).first()
    assert forced.extraction_method == "ocr" and forced.is_scanned


def test_pdf_faults(spark, tmp_path):
    for name in ("broken", "scan", "poor"):
        (tmp_path / f"{name}.pdf").write_bytes(name.encode())

    def native(content):
        if content == b"broken":
            yield 1, "gardé " * 20, None
            raise OSError("page 2")
        yield from [(1, "court", None)] if content == b"scan" else [(1, "a" * 30, None), (2, "b", None), (3, "c" * 60, None)][: 0 if content == b"poor" else 3]

    def ocr(content):
        raise RuntimeError("no engine")
        yield

    second = lambda content: [(1, "second lecteur", None)]
    paths = [str(tmp_path / f"{n}.pdf") for n in ("broken", "scan", "poor")]
    found = {r.file_name: r for r in files.extract(spark, paths, pdf_reader=native, second_reader=second, ocr_reader=ocr).collect()}
    assert found["broken.pdf"].total_pages == 1 and found["broken.pdf"].warnings == ["PDF extraction error: page 2"]
    scan = found["scan.pdf"]
    assert scan.full_text == "court" and scan.is_scanned and [w[:25] for w in scan.warnings] == ["Document appears to be sc", "OCR extraction error: no "]
    assert found["poor.pdf"].full_text == "second lecteur" and found["poor.pdf"].warnings == ["PyMuPDF extraction poor, falling back to pdfplumber."]
    missing = files.extract(spark, paths[1], pdf_reader=native).first()  # no OCR library here: the native text stands
    assert missing.extraction_method == "native_pdf" and len(missing.warnings) == 2 and missing.warnings[1].startswith("OCR")
    assert files.TesseractReader().languages == "fra+ara" and files.word_confidence([-1, "96", 50, "95.5", "x"]) == 0.73
    assert set(files.supported_formats()) == {"pdf", "docx", "txt"}


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "é", None)], "doc_id long, t string, n string")
    sinks.write_pretty(rows, str(tmp_path / "o.json"))
    assert json.loads((tmp_path / "o.json").read_text(encoding="utf-8"))[0]["t"] == "é"
    sinks.write_json(rows, str(tmp_path / "lines"))
    assert spark.read.json(str(tmp_path / "lines")).first().t == "é"
    with pytest.raises(ValueError, match="more than"):
        sinks.write_pretty(spark.range(5), None, limit=2)
    whole = json.loads(sinks.envelope(2, rows, rows).first().envelope)
    assert whole["phase"] == 2 and whole["cleaning"]["t"] == "é" and "parsing" not in whole


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("LS\nLe mot ,juste", encoding="utf-8")
    for name in ("b", None):
        arrivals.clean_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
        if name:
            (tmp_path / "in" / f"{name}.txt").write_text("Deux", encoding="utf-8")
    found = sorted(r.cleaned_text for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert found == ["Deux", "Le mot, juste"]
    assert cleaning.rule_clean(spark.read.parquet(str(tmp_path / "out")).select("text")).count() == 2


def test_readers_of_further_formats(spark, tmp_path):
    (tmp_path / "a.xyz").write_bytes(b"un|deux")
    (tmp_path / "b.txt").write_text("trois", encoding="utf-8")
    paths = [str(tmp_path / n) for n in ("a.xyz", "b.txt")]
    with pytest.raises(ValueError, match="Unsupported"):
        files.extract(spark, paths)

    def reader(content):
        for i, part in enumerate(content.decode().split("|"), 1):
            yield i, part, None
        raise OSError("cut off")

    rows = {r.file_name: r for r in files.extract(spark, paths, more={"xyz": reader}).collect()}
    assert rows["a.xyz"].extraction_method == "xyz_parse" and rows["a.xyz"].full_text == "un\n\ndeux" and rows["a.xyz"].total_pages == 2
    assert rows["a.xyz"].warnings == ["XYZ extraction error: cut off"] and rows["b.txt"].full_text == "trois"
