"""Small inputs and plain-Python rules that the operators are held against."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

from pyspark.sql import SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rid string, kind string, __doc string"
SPACE = " \t\n\x0b\x0c\r"


def docs(spark: SparkSession, texts: dict | list, parts: int = 3):
    """A documents table with extra columns whose names the operators use inside."""
    rows = list(texts.items()) if isinstance(texts, dict) else list(texts)
    return spark.createDataFrame([(i, t, None, "s", len(t or ""), "x", "y", "z") for i, t in rows], SCHEMA).repartition(parts)


def edge_rows() -> list[tuple]:
    long = " ".join(f"w{i % 700}é" for i in range(30_000))
    line = "this line is in very many documents"
    return [(1, None), (2, ""), (3, "   "), (4, long), (5, long), (5, long), (6, f"a\n{line}\nb\n{line}"), (7, line), (8, line.upper() + "  "),
            (9, f"\t{line}"), (10, "x" * 5000), (11, "日本語のテキスト 中文字"), (12, "a\x00b\r\nc\x85d e　f"), (13, "<|endoftext|> <s> ▁▁ it's"),
            (14, f"{line}\n" * 50), (None, f"null id\n{line}"), (15, "😀 " * 30), (16, " lead  and  trail ")]


def drop_lines(rows, min_chars=20, min_docs=3):
    def key(x):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(SPACE))

    holders = defaultdict(set)
    for i, t in rows:
        if i is not None:
            for x in (t or "").split("\n"):
                if len(key(x)) >= min_chars:
                    holders[key(x)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(key(x)) < min_chars or len(holders[key(x)]) < min_docs or max(holders[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def held_out(doc_id, n, at):
    return (0 if doc_id is None else zlib.crc32(str(doc_id).encode())) % n == at
