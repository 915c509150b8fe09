"""File sources: text, Word and page-wise PDF/OCR files as rows of binaryFile, read by partitions.

PDF text and OCR need a page reader, which is a function (bytes) -> pages (page number, text, confidence or None), best a
generator, so that pages before an error are kept. Readers of installed libraries are looked for where files are read, and
only when a file needs one; any other can be passed in. A PDF file is read natively once, and by OCR only if it looks scanned.
"""

from __future__ import annotations

import functools
import io
import os
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import extraction

Reader = Callable[[bytes], Iterable[tuple[int, str, float | None]]]
#: A row per page, and one without a page number per file, which carries its warnings.
PAGES = "path string, length long, format string, method string, scanned boolean, page_number int, text string, confidence double, warnings array<string>"
LANGUAGES, DPI = "fra+ara", 300
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def check_paths(paths: list[str], format_override: str | None = None, formats: dict[str, str] = extraction.FORMATS) -> None:
    """Local paths must be files that aren't empty, of a known format; other stores are left to Spark."""
    for path in paths:
        extension = os.path.splitext(path)[1].lower()
        if format_override is None and extension not in formats:
            raise ValueError(f"Unsupported file format: {path}. Supported: {list(formats)}")
        if "://" in path:
            continue
        if not os.path.exists(path):
            raise FileNotFoundError(f"File not found: {path}")
        if not os.path.isfile(path):
            raise ValueError(f"Not a file: {path}")
        if os.path.getsize(path) == 0:
            raise ValueError(f"File is empty: {path}")


def read_files(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """path, length and content of each file, and its format by extension."""
    paths = [paths] if isinstance(paths, str) else paths
    return spark.read.format("binaryFile").load(paths).select("path", "length", "content", extraction.file_format(F.col("path")).alias("format"))


def decode_text(content: Column) -> tuple[Column, Column]:
    """The text of bytes that are UTF-8, else windows-1256 (which any bytes are), with line ends as \\n; and the encoding."""
    text = content.cast("string")

    @F.pandas_udf("string")
    def arabic(values: pd.Series) -> pd.Series:
        return pd.Series([None if v is None else v.decode("cp1256") for v in values], dtype=object)

    valid = F.is_valid_utf8(text)
    # The Python decoder only sees bytes that aren't UTF-8.
    decoded = F.when(valid, text).otherwise(arabic(F.when(~valid, content)))
    return F.regexp_replace(decoded, r"\r\n?", "\n"), F.when(valid, F.lit("utf-8")).otherwise(F.lit("windows-1256"))


def text_pages(files: DataFrame) -> DataFrame:
    """PAGES of text files, without Python but for bytes that aren't UTF-8."""
    text, encoding = decode_text(F.col("content"))
    rows = files.select("path", "length", "format", text.alias("_t"), encoding.alias("_e"))
    said = F.when(F.col("_e") != "utf-8", F.array(F.concat(F.lit("File was not UTF-8. Decoded using: "), "_e"))).otherwise(F.array().cast("array<string>"))
    return rows.select("path", "length", "format", F.lit("plain_text").alias("method"), F.lit(False).alias("scanned"), F.lit(1).alias("page_number"), F.col("_t").alias("text"), F.lit(None).cast("double").alias("confidence"), said.alias("warnings"))


def _paragraph_text(node: ET.Element) -> str:
    out = []
    for x in node.iter():
        if x.tag == f"{_W}t":
            out.append(x.text or "")
        elif x.tag == f"{_W}tab":
            out.append("\t")
        elif x.tag in (f"{_W}br", f"{_W}cr") and x.get(f"{_W}type") in (None, "textWrapping"):
            out.append("\n")
    return "".join(out).strip()


def docx_sections(content: bytes) -> list[tuple[int, str]]:
    """Number and text of the sections that page breaks part; table texts go to the last one, blank sections are left out."""
    body = ET.parse(io.BytesIO(zipfile.ZipFile(io.BytesIO(content)).read("word/document.xml"))).getroot().find(f"{_W}body")
    sections: list[list[str]] = [[]]
    for p in body.findall(f"{_W}p"):
        if any(x.get(f"{_W}type") == "page" for r in p.findall(f"{_W}r") for x in r.iter(f"{_W}br")):
            sections.append([])
        if text := _paragraph_text(p):
            sections[-1].append(text)
    for table in body.findall(f"{_W}tbl"):
        rows = []
        for row in table.findall(f"{_W}tr"):
            cells = ["\n".join(_paragraph_text(p) for p in cell.findall(f"{_W}p")).strip() for cell in row.findall(f"{_W}tc")]
            if any(cells):
                rows.append(" | ".join(c for c in cells if c))
        if rows:
            sections[-1].append("\n".join(rows))
    return [(i, t) for i, s in enumerate(sections, 1) if (t := "\n".join(s)).strip()]


def _clean(text: str) -> str:
    """functions.text.clean_text for one text, to compare the lengths of two readings of a file."""
    text = re.sub(r"\n{4,}", "\n\n\n", re.sub(f"{T.WHITE_BUT_FEED}+", " ", text or ""))
    return "\n".join(line.strip() for line in text.splitlines()).strip()


class _Reading:
    """What one reader finds in one file; an error ends the reading and keeps the pages before it."""

    def __init__(self, reader: Reader, content: bytes, error: str):
        self.pages: list[tuple] = []
        self.warnings: list[str] = list(getattr(reader, "warnings", lambda: [])())
        try:
            for number, text, confidence in reader(content):
                self.pages.append((number, text, confidence))
        except Exception as e:  # noqa: BLE001  one bad file must not end the job
            self.warnings.append(f"{error}: {e}")

    def lengths(self) -> list[int]:
        return [len(_clean(t)) for _, t, _ in self.pages]

    def chars(self) -> int:
        return len(_clean("\n\n".join(t for t in (_clean(t) for _, t, _ in self.pages) if t)))


def read_docx(content: bytes) -> tuple[str, bool, list[tuple], list[str]]:
    try:
        return "docx_parse", False, [(n, t, None) for n, t in docx_sections(content)], []
    except zipfile.BadZipFile:
        return "docx_parse", False, [], ["File is not a valid .docx package."]
    except Exception as e:  # noqa: BLE001
        return "docx_parse", False, [], [f"Error opening DOCX: {e}"]


def read_pdf(content: bytes, native: Reader | None, second: Reader | None, ocr: Callable[[], Reader], *, force_ocr: bool = False) -> tuple[str, bool, list[tuple], list[str]]:
    """Method, whether it looks scanned, pages and warnings of a PDF file.

    A native reading of which most pages have few characters looks scanned; then OCR reads the file as well, and the
    strictly longer text wins. A native reading that is poor otherwise gives way to that of the second reader.
    """
    if force_ocr:
        found = _Reading(ocr(), content, "OCR extraction error")
        return "ocr", True, found.pages, found.warnings
    found = _Reading(native, content, "PDF extraction error")
    lengths, said = found.lengths(), found.warnings
    short = sum(n < extraction.SHORT_PAGE for n in lengths)
    scanned = bool(lengths) and short / len(lengths) > 0.5
    if scanned:
        said.append(extraction.SCANNED.format(short=short, pages=len(lengths)))
        try:
            seen = _Reading(ocr(), content, "OCR extraction error")
            if seen.chars() > found.chars():
                return "ocr", True, seen.pages, seen.warnings
            said += [w for w in seen.warnings if w.startswith("OCR extraction error")]
        except Exception as e:  # noqa: BLE001  the native reading stands
            said.append(f"OCR fallback failed: {e}")
    elif sum(lengths) < extraction.SHORT_PAGE and second is not None:
        said.append("PyMuPDF extraction poor, falling back to pdfplumber.")
        found = _Reading(second, content, "pdfplumber extraction error")
        said += found.warnings
    return "native_pdf", scanned, found.pages, said


def read_other(content: bytes, kind: str, reader: Reader) -> tuple[str, bool, list[tuple], list[str]]:
    """A file of a format that a caller's reader knows."""
    found = _Reading(reader, content, f"{kind.upper()} extraction error")
    return f"{kind}_parse", False, found.pages, found.warnings


def _rows(files: DataFrame, read: Callable[[bytes], tuple[str, bool, list[tuple], list[str]]]) -> DataFrame:
    """PAGES of files: each is read once, whatever the number of results that are made of it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, length, kind, content in zip(batch["path"], batch["length"], batch["format"], batch["content"]):
                method, scanned, pages, said = read(bytes(content))
                rows = [(path, length, kind, method, scanned, n, t, c, []) for n, t, c in pages] + [(path, length, kind, method, scanned, None, None, None, said)]
                names = ["path", "length", "format", "method", "scanned", "page_number", "text", "confidence", "warnings"]
                yield pd.DataFrame(rows, columns=names).astype({"page_number": "Int32", "confidence": "float64"})

    return files.select("path", "length", "format", "content").mapInPandas(run, PAGES)


def native_pdf_readers() -> list[Reader]:
    """Page readers of the installed PDF libraries, the quicker one first."""
    found: list[Reader] = []
    try:
        import fitz

        found.append(lambda content: ((i, p.get_text("text"), None) for i, p in enumerate(fitz.open(stream=content, filetype="pdf"), 1)))
    except ImportError:
        pass
    try:
        import pdfplumber

        found.append(lambda content: ((i, p.extract_text() or "", None) for i, p in enumerate(pdfplumber.open(io.BytesIO(content)).pages, 1)))
    except ImportError:
        pass
    return found


class TesseractReader:
    """Pages by OCR: each page as an image of `dpi` dots an inch, with the mean confidence of its words.

    The libraries are imported when the first file is read; without them that reading fails with an ImportError.
    """

    def __init__(self, languages: str = LANGUAGES, dpi: int = DPI):
        self.languages, self.dpi = languages, dpi

    def warnings(self) -> list[str]:
        """What the installation lacks."""
        try:
            import pytesseract

            have = pytesseract.get_languages()
        except Exception as e:  # noqa: BLE001
            return [f"Tesseract not found or not configured: {e}. Install with: sudo apt install tesseract-ocr"]
        return [f"Tesseract language '{x}' not installed. Install with: sudo apt install tesseract-ocr-{x}" for x in self.languages.split("+") if x not in have]

    def __call__(self, content: bytes) -> Iterator[tuple[int, str, float | None]]:
        import fitz
        import pytesseract
        from PIL import Image

        for i, page in enumerate(fitz.open(stream=content, filetype="pdf"), 1):
            shot = page.get_pixmap(matrix=fitz.Matrix(self.dpi / 72, self.dpi / 72))
            image = Image.frombytes("RGB", (shot.width, shot.height), shot.samples)
            words = pytesseract.image_to_data(image, lang=self.languages, output_type=pytesseract.Output.DICT)
            yield i, pytesseract.image_to_string(image, lang=self.languages), word_confidence(words.get("conf", []))


def word_confidence(values: list) -> float:
    """extraction.word_confidence for the words of one page."""
    whole = [int(v) for v in map(str, values) if re.fullmatch(r"-*\d+", v) and v.count("-") < 2 and int(v) > 0]
    return round(sum(whole) / len(whole) / 100, 3) if whole else 0.0


def supported_formats(format_: str | None = None) -> dict[str, tuple[str, ...]]:
    """The methods by which files of each format are read."""
    methods = {"pdf": ("native_pdf", "ocr"), "docx": ("docx_parse",), "txt": ("plain_text",)}
    return methods if format_ is None else {format_: methods[format_]}


def extract(
    spark: SparkSession, paths: list[str] | str, *, force_ocr: bool = False, format_override: str | None = None, pdf_reader: Reader | None = None, second_reader: Reader | None = None,
    ocr_reader: Reader | None = None, languages: str = LANGUAGES, dpi: int = DPI, more: dict[str, Reader] | None = None,
) -> DataFrame:
    """One row per file: path, name, format, size, method, pages, full text, confidence, flags and warnings.

    One pass over the files and one exchange by path. The OCR reader is only built where a file needs it. `more` has page
    readers of further formats by name, each of which is its extension too; a reader of a known format replaces that one.
    """
    paths, more = [paths] if isinstance(paths, str) else paths, more or {}
    formats = extraction.FORMATS | {f".{kind}": kind for kind in more}
    check_paths(paths, format_override, formats)
    by_kind: dict[str, list[str]] = {}
    for path in paths:
        by_kind.setdefault(format_override or formats[os.path.splitext(path)[1].lower()], []).append(path)

    def pdf(content: bytes) -> tuple[str, bool, list[tuple], list[str]]:
        installed = [] if pdf_reader is not None else native_pdf_readers()
        native = pdf_reader or (installed or [None])[0]
        if native is None and not force_ocr:
            raise ImportError("PDF files need a page reader: install a PDF library or pass pdf_reader")
        return read_pdf(content, native, second_reader or (installed[1] if len(installed) > 1 else None), lambda: ocr_reader or TesseractReader(languages, dpi), force_ocr=force_ocr)

    readers = {"txt": text_pages, "docx": lambda files: _rows(files, read_docx), "pdf": lambda files: _rows(files, pdf)}
    readers |= {kind: functools.partial(_rows, read=functools.partial(read_other, kind=kind, reader=reader)) for kind, reader in more.items()}
    if "pdf" in by_kind and "pdf" not in more and not force_ocr and pdf_reader is None and not native_pdf_readers():
        raise ImportError("PDF files need a page reader: install a PDF library or pass pdf_reader")
    pages = None
    for kind, names in by_kind.items():
        if kind not in readers:
            raise ValueError(f"No reader for format: {kind}")
        found = readers[kind](read_files(spark, names).withColumn("format", F.lit(kind)))
        pages = found if pages is None else pages.unionByName(found)
    flagged = extraction.page_table(pages.withColumnRenamed("path", "doc_id"))
    page = F.struct("page_number", "text", "confidence", "has_arabic", "has_french")
    more = {
        "pages": F.sort_array(F.collect_list(F.when(F.col("page_number").isNotNull(), page))), "said": F.flatten(F.collect_list("warnings")),
        "method": F.max("method"), "scanned": F.max("scanned"), "size": F.max("length"), "kind": F.max("format"),
    }
    docs = extraction.documents(flagged, more)
    return docs.select(
        F.col("doc_id").alias("file_path"), F.regexp_extract("doc_id", r"([^/]+)\z", 1).alias("file_name"), F.col("kind").alias("file_format"), F.col("size").alias("file_size_bytes"),
        F.col("method").alias("extraction_method"), "total_pages", "pages", "full_text", "avg_confidence", F.col("scanned").alias("is_scanned"), "has_arabic_content", "has_french_content", F.col("said").alias("warnings"),
    )
