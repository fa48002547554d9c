"""Text expressions: trimming, slugs, truncation, cleaning, paths."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from .ids import col, text_hash


def strip(x) -> Column:
    """Without Unicode white space at either end."""
    return F.regexp_replace(col(x), r"(?U)^\s+|\s+$", "")


def rstrip(x) -> Column:
    return F.regexp_replace(col(x), r"(?U)\s+$", "")


def blank(x) -> Column:
    return F.coalesce(strip(x), F.lit("")) == ""


def filled(x) -> Column:
    """The value, or null if it has no characters."""
    return F.when(F.length(col(x)) > 0, col(x))


def slug(x) -> Column:
    """Lower case; runs of other characters than a-z, 0-9, ``_`` and ``-`` become ``_``; none at the ends. Null where nothing is left."""
    return filled(F.regexp_replace(F.regexp_replace(F.lower(col(x)), "[^a-z0-9_-]+", "_"), "^_+|_+$", ""))


def slug_of_name(x) -> Column:
    """A slug, or ``p_`` and eight digits of the name's hash where no Latin letter or digit is left."""
    name = strip(x)
    return F.coalesce(slug(name), F.concat(F.lit("p_"), F.substring(text_hash(name), 1, 8)))


def namespace_of(tenant, project, prefix: str = "kb") -> Column:
    return F.concat_ws("_", F.lit(prefix), slug(tenant), slug(project))


def path_segment(x, most: int = 60) -> Column:
    """A title as one path segment of at most ``most`` characters; ``community`` where nothing is left."""
    s = F.regexp_replace(F.regexp_replace(strip(x), r"[/\\]+", "-"), r"(?U)\s+", "-")
    s = F.regexp_replace(s, "^-+|-+$", "")
    s = F.when(F.char_length(s) > most, F.regexp_replace(F.substring(s, 1, most), "-+$", "")).otherwise(s)
    return F.coalesce(filled(s), F.lit("community"))


def page_path(level, title, community) -> Column:
    return F.concat(F.lit("L"), col(level).cast("string"), F.lit("/"), path_segment(title), F.lit("-"), F.substring(F.translate(col(community), "-", ""), 1, 8))


def mount_path(name, project_slug) -> Column:
    """``/wiki/<name>/`` with slashes as ``-`` and white space collapsed; the slug where there is no name."""
    segment = strip(F.regexp_replace(F.translate(strip(name), "/\\", "--"), r"(?U)\s+", " "))
    return F.concat(F.lit("/wiki/"), F.coalesce(filled(segment), slug(project_slug)), F.lit("/"))


def knowledge_binding(tenant, project_id, project_slug, project_name) -> Column:
    """Where a project's knowledge is: index namespace and filter, graph space, page mount."""
    space = namespace_of(tenant, project_slug)
    return F.struct(
        col(tenant).alias("tenant"), col(project_id).alias("project_id"), slug(project_slug).alias("project_slug"),
        F.struct(space.alias("index_namespace"), F.struct(col(project_id).alias("project_id")).alias("filter")).alias("rag"),
        F.struct(space.alias("space")).alias("graph"), F.struct(mount_path(project_name, project_slug).alias("vfs_mount")).alias("wiki"),
    )


def clean_path(x) -> Column:
    """One leading slash, single slashes, none at the end; the root is ``/``."""
    p = F.regexp_replace(F.concat(F.lit("/"), strip(x)), "/+", "/")
    return F.coalesce(filled(F.regexp_replace(p, "/$", "")), F.lit("/"))


def parent_path(x) -> Column:
    return F.when(col(x) == "/", F.lit(None).cast("string")).otherwise(F.coalesce(filled(F.regexp_replace(col(x), "/[^/]*$", "")), F.lit("/")))


def last_segment(x) -> Column:
    return F.substring_index(col(x), "/", -1)


def url_filename(url) -> Column:
    """Last path segment before ``?``; ``index.html`` for none, ``download.bin`` where only a query is left."""
    last = F.coalesce(filled(last_segment(F.regexp_replace(col(url), "/+$", ""))), F.lit("index.html"))
    return F.coalesce(filled(F.substring_index(last, "?", 1)), F.lit("download.bin"))


def uri_filename(uri) -> Column:
    return last_segment(F.regexp_replace(F.substring_index(col(uri), "://", -1), "^/+", ""))


def suffix(name) -> Column:
    """Lower-case extension with its dot, empty for none; a leading dot is no extension."""
    return F.lower(F.regexp_extract(last_segment(name), r"(?s)[^.].*?(\.[^.]+)$", 1))


def extensions(x) -> Column:
    """``"pdf, .MD"`` as the sorted set ``[".md", ".pdf"]``."""
    parts = F.filter(F.transform(F.split(col(x), ","), lambda p: F.lower(F.trim(p))), lambda p: p != "")
    return F.sort_array(F.array_distinct(F.transform(parts, lambda p: F.when(p.startswith("."), p).otherwise(F.concat(F.lit("."), p)))))


def truncated(x, most: int) -> Column:
    """Trimmed text of at most ``most`` characters, with an ellipsis where it was cut."""
    t = F.coalesce(strip(x), F.lit(""))
    return F.when(F.char_length(t) <= most, t).otherwise(F.concat(rstrip(F.substring(t, 1, max(most - 1, 0))), F.lit("…")))


def snippet(x, most: int = 400) -> Column:
    return truncated(F.translate(F.coalesce(strip(x), F.lit("")), "\n", " "), most)


def search_text(title, body) -> Column:
    """What is indexed of a page or entity: title and body, each trimmed, blank ones left out."""
    return F.concat_ws("\n", filled(strip(title)), filled(strip(body)))


@F.pandas_udf(T.StringType())
def nfc(x: pd.Series) -> pd.Series:
    """Unicode normal form C, for which Spark has no function."""
    return x.str.normalize("NFC")


#: Characters that form C leaves as they are, whatever stands beside them: none combines, and none is second in a composition.
_SETTLED = r"\x00-\u02ff\u0400-\u0482\u048a-\u052f\u2010-\u2027\u2030-\u205e\u3000-\u3029\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fff\uac00-\ud7a3\uff00-\uffef"


def in_form_c(x) -> Column:
    """The text in form C. Only texts with a character that could need it go to Python; for the others a null does."""
    s = col(x)
    # The cheaper tests first: most texts are ASCII or Latin.
    may = (F.octet_length(s) > F.char_length(s)) & s.rlike(r"[^\x00-\u02ff]") & s.rlike(f"[^{_SETTLED}]")
    return F.coalesce(nfc(F.when(may, s)), s)


# What cleaning looks for.
_CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
_COMMAND = r"\\[a-zA-Z]+\{([^}]*)\}"
_HANGUL = r"([\uac00-\ud7a3])\n([\uac00-\ud7a3])"
_MIDWORD = r"(?U)(?<=[^\n\s])\n(?=[^\n\s])"


def _cleaned(x, normalise: bool) -> Column:
    s = F.coalesce(col(x), F.lit(""))
    s = in_form_c(s) if normalise else s
    s = F.regexp_replace(F.regexp_replace(s, _CONTROL, " "), _COMMAND, "$1")
    return F.regexp_replace(s, _HANGUL, "$1$2")


def clean_chunk(x, normalise: bool = True) -> Column:
    """Chunk text for a prompt. ``normalise=False`` stays inside the JVM where the text is known to be in form C."""
    return strip(F.regexp_replace(F.regexp_replace(_cleaned(x, normalise), _MIDWORD, ""), "[ \t]+", " "))


def clean_field(x, normalise: bool = True) -> Column:
    """A field of an extracted record: also without the tail of a cut-off JSON text, white space collapsed."""
    s = F.regexp_replace(F.regexp_replace(_cleaned(x, normalise), _MIDWORD, " "), r"(?U)[.\d]*\}\],?\s*['\"]?\s*$", "")
    return strip(F.regexp_replace(s, r"(?U)\s+", " "))


def json_payload(x) -> Column:
    """The innermost object of up to four ``{"output": ...}`` envelopes (an output may be a JSON text), taken from a fence if there is one."""
    fenced = F.regexp_extract(col(x), r"(?is)```(?:json)?\s*(.*?)```", 1)
    s = F.coalesce(filled(fenced), col(x))
    for _ in range(4):
        inner = F.get_json_object(s, "$.output")
        s = F.coalesce(F.when(inner.startswith("{"), inner), s)
    return s


def page_markdown(page) -> Column:
    """Markdown of a page struct: title, then the sections that have text, in a fixed order."""

    def bullets(heading: str, items: Column) -> Column:
        kept = F.filter(F.transform(F.coalesce(items, F.array().cast("array<string>")), strip), lambda i: i != "")
        return F.when(F.size(kept) > 0, F.concat(F.lit(f"## {heading}\n"), F.array_join(F.transform(kept, lambda i: F.concat(F.lit("- "), i)), "\n")))

    p = col(page)
    title = F.concat(F.lit("# "), strip(F.coalesce(filled(p["title"]), F.lit("Community Report"))))
    summary = filled(strip(p["executive_summary"]))
    parts = F.array(
        title,
        F.when(summary.isNotNull(), F.concat(F.lit("## Executive Summary\n"), summary)),
        bullets("Key Entities", p["key_entities"]),
        bullets("Notable Relationships", p["notable_relationships"]),
        bullets("Open Questions", p["open_questions"]),
    )
    return strip(F.array_join(F.filter(parts, lambda s: s.isNotNull()), "\n\n"))


#: Words of a query that ask for an overview.
GLOBAL_HINTS = ("전체", "주요", "패턴", "비교", "요약", "overview", "summary", "themes", "overall")


def search_mode(query, requested) -> Column:
    """Mode of a query: the requested one unless ``auto``; else by its form."""
    q = strip(query)
    tokens = F.filter(F.split(q, r"(?U)\s+"), lambda t: t != "")
    hint = F.lit(False)
    for h in GLOBAL_HINTS:
        hint = hint | F.lower(q).contains(h)
    named = q.rlike(r"[^\x00-\x7f]") | F.exists(tokens, lambda t: t.rlike(r"^\p{Lu}"))
    return (
        F.when(col(requested) != "auto", col(requested))
        .when(q.rlike(r"\[\[[^\]]+\]\]"), "local")
        .when(hint, "global")
        .when((F.size(tokens) <= 4) & F.exists(tokens, lambda t: F.char_length(t) >= 2) & named, "local")
        .when(F.size(tokens) >= 8, "drift")
        .otherwise("basic")
    )
