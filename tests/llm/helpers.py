"""Plain, slow versions of what the operators compute, and small tables with every odd case."""

from __future__ import annotations

import re
import zlib

import duckdb

ODD = [
    (1, "One two three. One two three.\nOne two three.", "en"),
    (2, None, "de"),
    (3, "", None),
    (4, " \t\n ", "en"),
    (5, "Zoë naïve ÉTÉ — 日本語 x\x00y a b", "fr"),
    (6, "word " * 5000, "en"),
    (7, "One two three. One two three.\nOne two three.", "en"),
    (7, "One two three. One two three.\nOne two three.", "en"),
    (None, "a text without an id", "en"),
    (9, "x" * 20000, "en"),
    (10, "<|startoftext|> <|ENDOFTEXT|> it's 42 don't", "en"),
]
#: Columns that clash with those the operators make.
EXTRA = "doc_id long, text string, lang string, score double, fp long, kept boolean, length long, digest string, item_id long, chunk long, id long"


def odd_docs(spark):
    return spark.createDataFrame([(i, t, x, 0.5, 1, True, 3, "d", 4, 5, 6) for i, t, x in ODD], EXTRA)


def no_docs(spark):
    return spark.createDataFrame([], EXTRA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def fold(doc_id, n):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % n


def rows_of(path):
    return duckdb.sql(f"SELECT doc_id, text FROM '{path}/documents.parquet' ORDER BY doc_id").fetchall()
