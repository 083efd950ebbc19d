"""Text helpers as Column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import as_col


def slugify(c: Column | str, alphanum_replace: str = "", space_replace: str = "_", lower: bool = True) -> Column:
    """Replace everything but letters, digits and blanks, then the blanks, then lower-case. Letters of any script count."""
    kept = F.regexp_replace(as_col(c), r"(?U)[^\p{Alnum} ]", alphanum_replace)
    joined = F.replace(kept, F.lit(" "), F.lit(space_replace))
    return F.lower(joined) if lower else joined


def first_contained(c: Column | str, texts: Sequence[str]) -> Column:
    """The first of ``texts``, in the order given, that occurs in the value; NULL if none does."""
    c = as_col(c)
    hits = [F.when(F.contains(c, F.lit(t)), F.lit(t)) for t in texts]
    return F.coalesce(*hits) if len(hits) > 1 else hits[0]


def url_basename(c: Column | str, prefix: str = "data/") -> Column:
    """``prefix`` plus the last path segment; empty text when there is none."""
    c = as_col(c)
    segment = F.regexp_extract(c, r"/([^/]+)$", 1)
    return F.when(segment != "", F.concat(F.lit(prefix), segment)).when(segment == "", F.lit(""))


_VALUE = r"""(?:"[^"]*"|'[^']*'|[^\s"'>]+)"""


def _up_to(element: str, attribute: str) -> str:
    """An element's start tag up to the value of its first such attribute: other attributes are passed over whole."""
    return rf"""(?is)<{element}(?=[\s/])(?:[\s/]*(?!{attribute}[\s=])[^\s=>"'/]+(?:\s*=\s*{_VALUE})?)*+[\s/]*{attribute}\s*=\s*({_VALUE})"""


_HREF = _up_to("a", "href")
#: Character references in attribute values, the ampersand last.
_REFERENCES = (("&quot;", '"'), ("&#34;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&#38;", "&"), ("&amp;", "&"))


def hrefs(c: Column | str, container: str | None = None) -> Column:
    """All ``href`` targets of the anchors in an HTML text, in order, however they are quoted or spaced, references decoded.

    ``container`` is a regular expression with one group; only the text it captures is searched.
    """
    c = as_col(c)
    if container is not None:
        c = F.regexp_extract(c, container, 1)

    return F.transform(F.regexp_extract_all(c, F.lit(_HREF), F.lit(1)), _attribute_value)


def _attribute_value(raw: Column) -> Column:
    """An attribute's text as written, without its quotes, references decoded, trimmed."""
    quoted = raw.startswith('"') | raw.startswith("'")
    out = F.when(quoted, F.substring(raw, F.lit(2), F.length(raw) - 2)).otherwise(raw)
    for reference, text in _REFERENCES:
        out = F.replace(out, F.lit(reference), F.lit(text))
    return F.btrim(out, F.lit(" \t\n\r\x0c"))


def inner_html(c: Column | str, element: str, attribute: str | None = None, value: str | None = None) -> Column:
    """What stands inside the named elements of an HTML text, elements of the same name nested in them included.

    Without ``attribute`` every element of that name counts; with it those whose first such attribute is ``value`` (for
    ``class``: has it among its names). Several elements are joined by a line break; one inside another is given once. Names are
    compared without regard to case, values with it. Comments, scripts and styles are left out. An element that never
    ends runs to the end of the text, an end tag without start is passed over, and no such element gives the empty text.
    Every page is one row; its work grows with its length and the square of the number of its tags of that name.
    """
    if not re.fullmatch(r"[A-Za-z][A-Za-z0-9-]*", element) or attribute is not None and not re.fullmatch(r"[A-Za-z][A-Za-z0-9_-]*", attribute):
        raise ValueError(f"not a name of an element or attribute: {element}, {attribute}")
    shown = F.regexp_replace(as_col(c), r"(?is)<!--.*?(?:-->|\z)|<(script|style)(?=[\s/>]).*?(?:</\1\s*>|\z)", "")
    # Every piece but the first begins with a start or end tag of the element.
    pieces = F.split(shown, rf"(?i)(?=</?{element}[\s/>])")
    start, end = rf"(?is)^<{element}[\s/>]", rf"(?is)^</{element}[\s/>]"

    def wanted(piece: Column) -> Column:
        if attribute is None:
            return F.rlike(piece, F.lit(start))
        found = F.nullif(F.regexp_extract(piece, "^" + _up_to(element, attribute), 1), F.lit(""))
        found = _attribute_value(found)
        fits = F.array_contains(F.split(found, r"[ \t\n\r\x0c]+"), value) if attribute.lower() == "class" else found == F.lit(value)
        return F.coalesce(fits, F.lit(False))

    def fold(state: Column, piece: Column) -> Column:
        step = F.when(F.rlike(piece, F.lit(start)), 1).when(F.rlike(piece, F.lit(end)), -1).otherwise(0)
        depth = F.when(state["depth"] > 0, state["depth"] + step).otherwise(F.when(wanted(piece), 1).otherwise(0))
        # 0: outside; 1: the element's own start tag, of which what follows it counts; 2: inside.
        mark = F.when(depth == 0, 0).when(state["depth"] == 0, 1).otherwise(2)
        return F.struct(depth.alias("depth"), F.array_append(state["marks"], mark).alias("marks"))

    first = F.struct(F.lit(0).alias("depth"), F.lit([]).cast("array<int>").alias("marks"))
    tag = rf"""(?is)^<{element}(?:[^>"']|"[^"]*"|'[^']*')*+>"""

    def kept(parts: Column) -> Column:
        marks = F.aggregate(parts, first, fold)["marks"]
        texts = F.zip_with(parts, marks, lambda p, m: F.when(m == 2, p).when(m == 1, F.concat(F.lit("\n"), F.regexp_replace(p, tag, ""))).otherwise(""))
        return F.btrim(F.array_join(texts, ""), F.lit("\n"))

    return F.transform(F.array(pieces), kept)[0]  # binds the pieces, so that the text is split once
