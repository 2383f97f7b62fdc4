"""String column functions: strip, split, compose, prompt, rank parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.isspace() accepts, which str.strip()
# and str.split() use.  Written as one regex class usable by Java and RE2.
WS_CLASS = (
    r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)

# Prompt markers and special token text of the model family.
QUERY_PROMPT = "<unused0>"
DOC_PROMPT = "<unused1>"
EOS_TEXT = "<eos>"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(col) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.regexp_replace(_c(col), f"^{WS_CLASS}+|{WS_CLASS}+$", "")


# The non-ASCII and control whitespace of str.isspace() that Java's
# plain \s does not cover; mapped to a space before an ASCII split.
RARE_WS = ("\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
           "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def split_words(col) -> Column:
    r"""Python ``str.split()``: whitespace runs as separators, no empty words.

    Same result as splitting on ``WS_CLASS``, but the rare whitespace is first
    mapped to a space by ``translate`` so the split runs on the cheap ASCII
    ``\s`` class.
    """
    t = F.translate(_c(col), RARE_WS, " " * len(RARE_WS))
    return F.array_remove(F.split(t, r"\s+"), "")


def compose_document(title, snippet) -> Column:
    """``title\\nsnippet``, else snippet, else title, else null ('' counts as missing)."""
    t = F.nullif(_c(title), F.lit(""))
    s = F.nullif(_c(snippet), F.lit(""))
    return F.nullif(F.concat_ws("\n", t, s), F.lit(""))


def is_truthy(col) -> Column:
    """Python truthiness of a string: not null and not empty (null-rejecting)."""
    return _c(col).isNotNull() & (_c(col) != "")


def rank_or_default(col, default: int = 1) -> Column:
    """``int(rank)`` with a default for missing or unparsable values.

    Digit strings and floats are truncated toward zero like ``int()``; null or
    text that is not a number gives ``default``.
    """
    d = _c(col).cast("string").try_cast("double")
    return F.coalesce(F.when(F.abs(d) < 2.0e9, d.cast("int")), F.lit(default))


def rank_weight(rank) -> Column:
    """``1/log2(1+rank)``; rank null or <= 0 counts as 1."""
    r = F.coalesce(_c(rank).cast("int"), F.lit(1))
    r = F.when(r <= 0, F.lit(1)).otherwise(r)
    return F.lit(1.0) / F.log2(F.lit(1.0) + r.cast("double"))


def prompt(text, role, layout: str = "prefix") -> Column:
    """Role prompt around a text.

    layout='prefix': ``<unused0>{t}<eos>`` (query) / ``<unused1>{t}<eos>`` (document)
    layout='suffix': ``{t}<unused0><eos>`` / ``{t}<unused1><eos>``
    A role outside {query, document} gets the bare text (no prompt, no eos).
    """
    t, r = _c(text), _c(role)
    marker = F.when(r == "query", F.lit(QUERY_PROMPT)).when(r == "document", F.lit(DOC_PROMPT))
    if layout == "prefix":
        framed = F.concat(marker, t, F.lit(EOS_TEXT))
    elif layout == "suffix":
        framed = F.concat(t, marker, F.lit(EOS_TEXT))
    else:
        raise ValueError(f"unknown prompt layout: {layout}")
    return F.when(marker.isNull(), t).otherwise(framed)


def decode_lenient(col) -> Column:
    """UTF-8 bytes to text, dropping malformed sequences (``errors='ignore'``)."""
    return F.replace(F.make_valid_utf8(_c(col).cast("string")), F.lit("�"), F.lit(""))
