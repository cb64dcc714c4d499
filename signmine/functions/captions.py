"""Caption predicates, hits and highlighting, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from signmine.functions import arrays

# The whole words that speak of visible text.
VISIBLE_TEXT_WORDS = ("text", "word", "words", "reads", "says", "displays", "written", "titled", "labeled", "labelled", "spelling", "inscription", "inscribed", "engraved")

#: A word character as Python's re has it for str: letters, numbers of any kind, and the underscore.
_W = r"[\p{L}\p{N}_]"
_BEFORE, _AFTER = rf"(?<!{_W})", rf"(?!{_W})"
WORD_RE = rf"(?iu){_BEFORE}(?:{'|'.join(VISIBLE_TEXT_WORDS)}){_AFTER}"
#: Between double quotes of either form, or between single quotes that have no word character outside; on one line, not empty.
QUOTED_RE = "[\"“][^\"“”\\n]+[\"”]" + f"|{_BEFORE}['‘][^'‘’\\n]+['’]{_AFTER}"

# HTML's escapes of markup characters; & is replaced first.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;"))


def speaks_of_text(caption: Column) -> Column:
    """Whether a caption names visible text or quotes something. Null and empty captions: false."""
    return F.coalesce(caption.rlike(WORD_RE) | caption.rlike(QUOTED_RE), F.lit(False))


def spans(text: Column, pattern: str, kind: str) -> Column:
    """All hits of a pattern in text, as an array of structs (start, end, kind): code points, end exclusive."""
    return F.transform(arrays.spans(text, pattern), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def quoted_spans(text: Column) -> Column:
    return spans(text, QUOTED_RE, "q")


def word_spans(text: Column) -> Column:
    return spans(text, WORD_RE, "v")


def without_overlaps(found: Column) -> Column:
    """Spans in order of (start, end, kind) without those that begin before the end of the last one kept."""

    def step(last: Column, s: Column) -> tuple[Column, Column]:
        stays = s["start"] >= last
        return F.when(stays, s["end"]).otherwise(last), F.when(stays, s)

    kept = arrays.scan(F.array_sort(found), F.lit(0), step, "struct<start:int,end:int,kind:string>")
    return F.filter(kept, lambda s: s.isNotNull())


def escape_html(text: Column) -> Column:
    for plain, escaped in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def highlight(text: Column) -> Column:
    """text escaped for HTML, with hits in <span class="hl-q"> (quoted) or <span class="hl-v"> (words of visible text). Null: empty."""
    text = F.coalesce(text, F.lit(""))

    def step(at: Column, s: Column) -> tuple[Column, Column]:
        gap = F.substring(text, at + 1, s["start"] - at)
        body = F.substring(text, s["start"] + 1, s["end"] - s["start"])
        return s["end"], F.concat(escape_html(gap), F.lit('<span class="hl-'), s["kind"], F.lit('">'), escape_html(body), F.lit("</span>"))

    def shown(whole: Column) -> Column:
        last = F.coalesce(F.try_element_at(whole, F.lit(-1))["end"], F.lit(0))
        return F.concat(F.array_join(arrays.scan(whole, F.lit(0), step, "string"), ""), escape_html(F.substring(text, last + 1, F.length(text))))

    return arrays.bound(without_overlaps(F.concat(quoted_spans(text), word_spans(text))), shown)
