"""Where model calls plug in: embedder, graph extractor, page synthesizer. Each has a deterministic offline default."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions import ids, text as X
from ..functions.splitting import halves

Embedder = Callable[[list[str]], np.ndarray]
Extractor = Callable[[str], dict]
Synthesizer = Callable[[dict], dict]
SMALLEST, BATCH = 400, 8


def hashing_embedder(dim: int = 64) -> Embedder:
    """Signed hashed word counts, at length one; an empty text is the zero vector."""

    def embed(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim))
        for k, t in enumerate(texts):
            for w in re.findall(r"\w+", t.lower()):
                h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
                out[k, h % dim] += 1 if h >> 63 else -1
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(norm > 0, norm, 1)

    return embed


def embed_texts(df: DataFrame, id_col: str, text_col: str, embedder: Embedder, dim: int = 64, batch: int = BATCH) -> DataFrame:
    """``id_col, embedding array<float>``: the embedder is called with ``batch`` texts at a time; count and dimension of what it returns are checked."""
    source = df.select(id_col, text_col)
    kind = dict(source.dtypes)[id_col]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            vectors = []
            for k in range(0, len(pdf), batch):
                part = [t or "" for t in pdf[text_col].iloc[k : k + batch]]
                got = np.asarray(embedder(part))
                if got.shape != (len(part), dim):
                    raise ValueError(f"embedder returned {got.shape} for {len(part)} texts of dimension {dim}")
                vectors.extend(got.astype(np.float32).tolist())
            yield pd.DataFrame({id_col: pdf[id_col].to_numpy(), "embedding": vectors})

    return source.mapInPandas(run, f"{id_col} {kind}, embedding array<float>")


class TooLong(ValueError):
    """An extractor raises this when a text is too much for it."""


def wikilink_extractor(text: str) -> dict:
    """Entities from links in double brackets; no edges."""
    names = list(dict.fromkeys(n.strip() for n in re.findall(r"\[\[([^\]]+)\]\]", text)))
    return {"entities": [{"id": f"entity:{n}", "name": n, "description": ""} for n in names if n], "edges": []}


def _extract(text: str, extract: Extractor) -> list[dict]:
    try:
        return [extract(text)]
    except TooLong:
        if len(text) <= SMALLEST:
            return []
        return [r for half in halves(text) if half for r in _extract(half, extract)]


def extract_graph(prompts: DataFrame, id_col: str, text_col: str, extract: Extractor = wikilink_extractor) -> tuple[DataFrame, DataFrame]:
    """Entity and edge records of prompts, numbered by part and place; a text that is too long is halved until it is not, texts of up to 400 characters are given up."""
    source = prompts.select(id_col, text_col)
    kind = dict(source.dtypes)[id_col]
    fields = "kind string, part int, pos int, id string, name string, type string, source string, target string, confidence double, description string"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for key, t in zip(pdf[id_col], pdf[text_col]):
                for part, g in enumerate(_extract(t or "", extract)):
                    rows += [(key, "entity", part, k, e.get("id"), e.get("name"), None, None, None, None, e.get("description")) for k, e in enumerate(g.get("entities") or [])]
                    rows += [(key, "edge", part, k, None, None, e.get("type"), e.get("source"), e.get("target"), e.get("confidence"), e.get("description")) for k, e in enumerate(g.get("edges") or [])]
            yield pd.DataFrame(rows, columns=["key", *[f.split()[0] for f in fields.split(", ")]])

    found = source.mapInPandas(run, f"key {kind}, {fields}").withColumnRenamed("key", id_col)
    return found.filter("kind = 'entity'").select(id_col, "part", "pos", "id", "name", "description"), found.filter("kind = 'edge'").select(id_col, "part", "pos", "type", "source", "target", "confidence", "description")


def stub_pages(contexts: DataFrame, project_slug=None) -> DataFrame:
    """``community_id, title, body_text``: the page of a community from the first ten names of its context."""
    names = F.array_join(F.slice(F.transform("entities", lambda e: e["name"]), 1, 10), ", ")
    title = F.concat(F.lit("Community L"), F.col("level").cast("string"), F.lit(" ("), F.lit("default") if project_slug is None else project_slug, F.lit(")"))
    return contexts.select("community_id", "level", title.alias("title"), F.concat(F.lit("# Community Report\n\nEntities: "), F.coalesce(names, F.lit("")), F.lit("\n")).alias("body_text"))


def synthesize_pages(contexts: DataFrame, synthesize: Synthesizer) -> DataFrame:
    """``community_id, level, title, body_text``: pages that ``synthesize`` makes of contexts (``community_id, level, entities``), a context at a time; sections of the page that have no text are left out."""
    source = contexts.select("community_id", "level", "entities")
    ids_, level = (source.schema[c].dataType.simpleString() for c in ("community_id", "level"))
    sections = ["key_entities", "notable_relationships", "open_questions"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for who, at, entities in zip(pdf["community_id"], pdf["level"], pdf["entities"]):
                page = synthesize({"community_id": who, "level": at, "entities": [dict(e) for e in entities] if entities is not None else []})
                rows.append((who, at, page.get("title"), page.get("executive_summary"), *(list(page.get(s) or []) for s in sections)))
            yield pd.DataFrame(rows, columns=["community_id", "level", "title", "executive_summary", *sections])

    made = source.mapInPandas(run, f"community_id {ids_}, level {level}, title string, executive_summary string, " + ", ".join(f"{s} array<string>" for s in sections))
    page = F.struct("title", "executive_summary", *sections)
    return made.select("community_id", "level", F.coalesce(X.filled(X.strip("title")), F.lit("Community Report")).alias("title"), X.page_markdown(page).alias("body_text"))


def index_pages(pages: DataFrame, namespace=None) -> DataFrame:
    """Pages with their path and the text that is indexed of them."""
    path = X.page_path("level", "title", "community_id")
    return pages.select("community_id", "title", "body_text", path.alias("slug"), F.concat(F.lit("/wiki/"), path, F.lit(".md")).alias("vfs_path"), F.substring(X.search_text("title", "body_text"), 1, 8000).alias("search_text"), F.octet_length("body_text").alias("size"))

