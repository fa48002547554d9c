"""Order-dependent splits of one text.

Cutting long texts and packing paragraphs are column expressions: a regular expression whose greedy
window ends where a piece may end, and a fold over the pieces. Halving and Markdown are small helpers run
in Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from .ids import col
from .text import strip

#: The type of a list without texts.
_TEXTS = "array<string>"


def cut_long(x, most: int = 1000) -> Column:
    """Pieces of at most ``most`` characters, trimmed: each ends at the window's last line end, else its last blank (neither in its first third), else at the window's end. A short text stays as it is; null has none."""
    some = f".{{{most // 3},{most - 1}}}"
    window = rf"(?sU)(.{{1,{most}}}+\z|{some}(?=\n)|{some}(?= )|.{{{most}}})\s*"
    pieces = F.transform(F.regexp_extract_all(col(x), F.lit(window), F.lit(1)), strip)
    own = F.when(F.char_length(col(x)) <= most, F.array(col(x))).otherwise(F.filter(pieces, lambda p: p != ""))
    return F.coalesce(own, F.array().cast(_TEXTS))


def pack_paragraphs(x, most: int = 1000) -> Column:
    """Paragraphs joined by blank lines into texts of at most ``most`` characters, joiners counted; long ones are cut first."""
    paragraphs = F.filter(F.transform(F.split(col(x), "\n\n"), strip), lambda p: p != "")
    pieces = F.flatten(F.transform(paragraphs, lambda p: cut_long(p, most)))

    def add(out: Column, piece: Column) -> Column:
        last = F.try_element_at(out, F.lit(-1))
        joined = F.concat(last, F.lit("\n\n"), piece)
        return F.when(F.char_length(joined) <= most, F.concat(F.slice(out, F.lit(1), F.size(out) - 1), F.array(joined))).otherwise(F.concat(out, F.array(piece)))

    return F.coalesce(F.aggregate(pieces, F.array().cast(_TEXTS), add), F.array().cast(_TEXTS))


def halves(text: str) -> list[str]:
    """Two trimmed parts, cut at the blank line nearest to the middle, else at the nearest line end, else in the middle; of two equally near the first."""
    text = text.strip()
    middle = len(text) // 2
    ways = ([m.end() for m in re.finditer(joint, text)] for joint in ("\n\n", "\n"))
    at = min(next((ends for ends in ways if ends), [middle]), key=lambda end: abs(end - middle))
    return [text[:at].strip(), text[at:].strip()]


# ---- Markdown -------------------------------------------------------------------------------------

# The forms of headings, of the line under a title, and of the rule in a table.
ATX, BOLD, UNDER = re.compile(r"(#{1,6})\s+(.+)"), re.compile(r"\*\*(.*\S.*)\*\*"), re.compile(r"=+|-+")
RULE = re.compile(r"\|+\s*[-:]+(?:\s*\|\s*[-:]+)*\s*\|*")


def _kinds(lines: list[str]) -> list[tuple[str, int, str]]:
    """(kind, level, text) of each line: heading, row, or prose (also blank). The line under a title is no line of its own."""
    bare = [line.strip() for line in lines]
    marks = [b[0] if UNDER.fullmatch(b) else "" for b in bare[1:]] + [""]
    out: list[tuple[str, int, str]] = []
    taken = False
    for line, text, mark in zip(lines, bare, marks):
        if taken:
            taken = False
            continue
        row = text.startswith("|") or ("|" in text and bool(RULE.fullmatch(f"|{text}|")))
        if row and out and out[-1][0] == "row":
            out.append(("row", 0, line))
        elif m := ATX.fullmatch(line):
            out.append(("heading", len(m[1]), m[2].strip()))
        elif taken := bool(mark and text and not text.startswith("|")):
            out.append(("heading", "=-".index(mark) + 1, text))
        elif m := BOLD.fullmatch(text):
            out.append(("heading", 2, m[1].strip()))
        else:
            out.append(("row", 0, line) if row else ("prose", 0, line.rstrip()))
    return out


def markdown_blocks(text: str) -> list[dict]:
    """Headings with the path that leads to them, tables, and paragraphs.

    A paragraph goes over one blank line and ends at two, at a heading and at a table row. Rows are a
    table if there are two or more and one is a rule or all begin with a bar; else paragraphs.
    """
    blocks: list[dict] = []
    path: dict[int, str] = {}
    for kind, run in groupby(_kinds(text.splitlines()), key=lambda x: x[0]):
        own = list(run)
        texts = [x[2] for x in own]
        if kind == "row":
            bare = [t.strip() for t in texts]
            table = len(bare) > 1 and (any(map(RULE.fullmatch, bare)) or all(t.startswith("|") for t in bare))
            found = [("table", None, "\n".join(texts))] if table else [("paragraph", None, t) for t in bare]
        elif kind == "prose":
            found = [("paragraph", None, t.strip()) for t in re.split("\n{3,}", "\n".join(texts)) if t.strip()]
        else:
            found = own
        for name, level, body in found:
            if level:
                path = {n: t for n, t in path.items() if n < level} | {level: body}
            blocks.append({"type": name, "level": level, "text": body, "heading_path": list(path.values())})
    return blocks


#: Block extractors by name. A new one is a function from a text to block dicts.
EXTRACTORS: dict[str, Callable[[str], list[dict]]] = {"markdown": markdown_blocks}


def register_extractor(name: str, extract: Callable[[str], list[dict]]) -> None:
    EXTRACTORS[name] = extract


def extractor(name: str) -> Callable[[str], list[dict]]:
    if name not in EXTRACTORS:
        raise KeyError(f"no blocks extractor {name!r}; known: {', '.join(sorted(EXTRACTORS))}")
    return EXTRACTORS[name]


# ---- as columns -------------------------------------------------------------------------------------

BLOCKS = T.ArrayType(
    T.StructType([T.StructField("type", T.StringType()), T.StructField("level", T.IntegerType()), T.StructField("text", T.StringType()), T.StructField("heading_path", T.ArrayType(T.StringType()))])
)


def _over(fn: Callable[[str], list], kind: T.DataType) -> Callable[[Column], Column]:
    @F.pandas_udf(kind)
    def run(x: pd.Series) -> pd.Series:
        return x.map(lambda t: fn(t or ""))

    return run


def halves_column(x) -> Column:
    return _over(halves, T.ArrayType(T.StringType()))(col(x))


def blocks_column(x, name: str = "markdown") -> Column:
    return _over(extractor(name), BLOCKS)(col(x))
