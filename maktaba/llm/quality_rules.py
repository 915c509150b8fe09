"""Quality rules: fixed base rules, then gradient-boosted trees over document statistics.

The trees are learnt from labelled rows, flattened into numpy node arrays and broadcast; some features may only lower the
score (MONOTONE). Learning takes at most `sample` labelled rows, those with the least hash of their id; all counts, the
base rules and the scores cover whole texts of all rows.

Cases: a null or empty text has no words and fails the base rules; words are split at ASCII white space only; repeated
rows get equal verdicts; rows with a null id or label don't teach; without labels of both kinds the trees are empty, and
the base rules decide alone; an empty table gives an empty result; other columns are not read, and `keep` passes them on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import gbt

WINDOW = 5
SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\x0b\x0c\r"
#: Feature -> -1 if more of it may only lower the score, 0 if free.
MONOTONE = {
    "log_words": 0, "mean_word": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": -1,
    "digit_share": 0, "bang_share": -1, "distinct_share": 0, "stop_share": 0, "line_words": 0, "top_word_share": -1,
    "pipe_line_share": -1, "upper_line_share": -1, "other_share": 0,
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_CLASS = np.zeros((256, 6))
_CLASS[list(WHITE), 0] = 1
_CLASS[list(SYMBOLS), 1] = 1
_CLASS[65:91, 2] = 1
_CLASS[48:58, 3] = 1
_CLASS[128:192, 4] = 1  # bytes after the first of a character
_CLASS[33, 5] = 1


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """How many words lie in a window of that many words which the text holds twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    code, kinds = ids[:n].copy(), len(seen)
    for k in range(1, window):  # exact: the codes are ranked anew before they could overflow
        if kinds * len(seen) >= 1 << 62:
            code = np.unique(code, return_inverse=True)[1]
            kinds = int(code.max()) + 1
        code = code * len(seen) + ids[k : k + n]
        kinds *= len(seen)
    order = np.argsort(code, kind="stable")
    same = code[order][1:] == code[order][:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    step = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    step[at] += 1
    np.subtract.at(step, at + window, 1)
    return int((step.cumsum() > 0).sum())


def statistics(text: str | None) -> tuple[tuple[int, ...], list[float]]:
    """The counts of COUNTS, and the features of MONOTONE."""
    data = (text or "").encode("utf-8", "replace")
    words = data.split()
    white, symbols, upper, digits, later, bangs = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _CLASS if data else [0.0] * 6
    chars = len(data) - later
    lines = [(x, w) for x in data.split(b"\n") if (w := x.split())]
    distinct_lines = len({x for x, _ in lines})
    n, kinds = len(words), {}
    for w in words:
        kinds[w] = kinds.get(w, 0) + 1
    repeat = repeated_words(words)
    counts = (n, int(chars - white), int(symbols), len(lines) - distinct_lines, repeat)
    word_chars, n1 = max(1.0, float(chars - white)), max(1, n)
    top = max(kinds.values(), default=0)
    short = sum(c for w, c in kinds.items() if len(w) <= 3)
    ranked = sum(sorted(kinds.values(), reverse=True)[:5])
    loud = sum(len(w) for x, w in lines if x.isupper())
    piped = sum(len(w) for x, w in lines if x.count(b"|") >= 2)
    other = sum(1 for w in kinds if not w.strip(b".,").isalpha() and w[0] < 128)
    return counts, [
        float(np.log1p(n)), word_chars / n1, symbols / word_chars, counts[3] / max(1, len(lines)), repeat / n1, upper / word_chars,
        digits / word_chars, bangs / word_chars, len(kinds) / n1, short / n1, n / max(1, len(lines)), top / n1,
        piped / n1, loud / n1, other / max(1, len(kinds)),
    ]


def text_features(text: Column) -> Column:
    """The features of MONOTONE, as an array."""

    @F.pandas_udf("array<double>")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([statistics(t)[1] for t in texts], dtype=object)

    return features(F.coalesce(text, F.lit("")))


def learn(docs: DataFrame, labels: DataFrame, *, target: str = "quality", id_column: str = "doc_id", text_column: str = "text", sample: int = 12_000) -> gbt.Trees:
    """Trees for the label, from at most `sample` labelled rows: those whose id has the least hash."""
    known = labels.select(F.col(id_column).alias("_id"), F.col(target).cast("int").alias("_y")).dropna()
    known = known.groupBy("_id").agg(F.max("_y").alias("_y")).orderBy(F.xxhash64("_id"), "_id").limit(sample)
    rows = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")).join(F.broadcast(known), "_id")
    rows = rows.select("_id", "_y", text_features(F.col("_text")).alias("features")).toPandas()
    rows = rows.assign(_key=rows["features"].map(tuple)).sort_values(["_id", "_key"], kind="stable")
    x = np.array(rows["features"].tolist(), dtype=np.float64).reshape(-1, len(MONOTONE))
    return gbt.fit(x, rows["_y"].to_numpy(np.float64), np.array(list(MONOTONE.values())))


def verdict(text: Column, trees: gbt.Trees, *, threshold: float = 0.5) -> Column:
    """A struct of COUNTS, base_failed, score and kept."""

    @F.pandas_udf(", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, score double, kept boolean")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [statistics(t) for t in texts]
            out = pd.DataFrame([c for c, _ in found], columns=list(COUNTS)).astype("int64")
            out["base_failed"] = (out["n_words"] < 10) | (100 * out["n_repeat_words"] > 20 * out["n_words"])
            out["score"] = trees.score(np.array([f for _, f in found]).reshape(-1, len(MONOTONE)))
            out["kept"] = ~out["base_failed"] & ((out["score"] >= threshold) | (len(trees.value) == 0))
            yield out

    return judge(F.coalesce(text, F.lit("")))


def judge(docs: DataFrame, trees: gbt.Trees, *, id_column: str = "doc_id", text_column: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per document: its id, the counts, base_failed, kept and score."""
    found = docs.select(F.col(id_column), verdict(F.col(text_column), trees, threshold=threshold).alias("_v"))
    return found.select(id_column, *[f"_v.{c}" for c in COUNTS], "_v.base_failed", "_v.kept", "_v.score")


def keep(docs: DataFrame, trees: gbt.Trees, *, text_column: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of docs that pass, all columns unchanged."""
    columns = [F.col(f"_d.{c}") for c in docs.columns]
    found = docs.select(F.struct(*docs.columns).alias("_d"), verdict(F.col(text_column), trees, threshold=threshold).alias("_v"))
    return found.filter("_v.kept").select(*columns)
