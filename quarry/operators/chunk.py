"""Chunks of documents: paragraphs packed up to a size, long ones cut at sentences, with some overlap."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ids
from ..functions.text import lines_normal, strip

SENTENCE_END = "。！？；!?;"
_AFTER_END = re.compile(f"(?<=[{SENTENCE_END}])")


def _units(paragraph: str, limit: int) -> Iterator[str]:
    """Runs of whole sentences within the limit; a sentence beyond it is cut."""
    if len(paragraph) <= limit:
        yield paragraph
        return
    run = ""
    for sentence in filter(None, map(str.strip, _AFTER_END.split(paragraph))):
        if run and len(run) + len(sentence) > limit:
            yield run
            run = ""
        if len(sentence) <= limit:
            run += sentence
        else:
            yield from (sentence[at : at + limit].strip() for at in range(0, len(sentence), limit))
    if run:
        yield run


def split_text(text: str, limit: int, overlap: int) -> list[str]:
    """Chunks of a text in normal form. Each but the first begins with the end of the one before, where that leaves room."""
    if len(text) <= limit:
        return [text] if text else []
    chunks, held = [], ""
    for paragraph in filter(None, map(str.strip, text.split("\n\n"))):
        for unit in _units(paragraph, limit):
            if held and len(held) + 2 + len(unit) > limit:
                chunks.append(held)
                tail = held[-overlap:].strip() if overlap else ""
                held = tail if tail and len(tail) + 2 + len(unit) <= limit else ""
            held = f"{held}\n\n{unit}" if held else unit
    return [*chunks, held] if held else chunks


def chunk_documents(df: DataFrame, id_col: str, text_col: str, title_col: str | None = None, limit: int = 1000, overlap: int = 200) -> DataFrame:
    """chunk_id, doc_id, chunk_no, chunk_count, title, content. Rows with a blank id are left out, empty texts have no chunks."""

    @F.pandas_udf("array<string>")
    def split(s: pd.Series) -> pd.Series:
        return s.map(lambda t: split_text(t or "", limit, overlap))

    own = F.trim(F.col(id_col).cast("string"))
    title = F.coalesce(F.nullif(F.trim(F.col(title_col)), F.lit("")), own) if title_col else own
    rows = df.select(own.alias("doc_id"), title.alias("__title"), split(lines_normal(text_col)).alias("__chunks")).where("doc_id <> ''")
    each = rows.select("doc_id", "__title", F.size("__chunks").alias("chunk_count"), F.posexplode("__chunks").alias("__pos", "content")).withColumn("chunk_no", F.col("__pos") + 1)
    name = F.concat("__title", F.format_string("（第%d/%d段）", "chunk_no", "chunk_count"))
    return each.select(ids.ordinal_id("doc_id", "chunk:", F.col("chunk_no"), 4).alias("chunk_id"), "doc_id", "chunk_no", "chunk_count", name.alias("title"), "content")


def sentences(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, n, sentence: cut behind sentence ends with a mark that stands in no text."""
    marked = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), f"([{SENTENCE_END}])", "$1\x01")
    parts = F.filter(F.transform(F.split(marked, "\x01"), strip), lambda x: x != "")
    return df.select(id_col, F.posexplode(parts).alias("n", "sentence"))
