"""String columns: words, truncation, masking, HTML, redaction, sentence splitting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ASCII white space only: ``\s`` means different sets of characters in different engines.
SPACE = "[ \\t\\n\\r]+"
EDGE_SPACE = "^[ \\t\\n\\r]+|[ \\t\\n\\r]+$"


def words(text: Column) -> Column:
    """The white-space separated words of a text."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words; 0 for NULL. The unit that reports call a token."""
    return F.coalesce(F.size(words(text)), F.lit(0)).cast("bigint")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, EDGE_SPACE, "")


def truncate(text: Column, limit: int) -> Column:
    """The first ``limit`` characters and ``...`` when the text is longer."""
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))).otherwise(text)


def preview(text: Column, limit: int = 100) -> Column:
    """The first ``limit`` characters, ``...`` always appended."""
    return F.concat(F.substring(text, 1, limit), F.lit("..."))


def mask(value: Column) -> Column:
    """Keep four characters at both ends; values of at most eight characters are hidden whole."""
    size = F.length(value)
    hidden = F.concat(
        F.substring(value, 1, 4), F.repeat(F.lit("*"), size - 8), F.right(value, F.lit(4))
    )
    return F.when(size <= 8, F.repeat(F.lit("*"), size)).otherwise(hidden)


def sentences(text: Column) -> Column:
    """Sentences, split after ``.``, ``?`` or ``!`` and white space; empty parts dropped."""
    parts = F.split(F.regexp_replace(text, "([.?!])[ \\t\\n\\r]+", "$1\u0001"), "\u0001")
    return F.filter(F.transform(parts, strip), lambda s: s != "")


# The entities decoded, in the order they are applied (``&amp;`` has to come last).
HTML_ENTITIES = [
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&amp;", "&"),
]


def _decode_entities(text: Column) -> Column:
    for entity, char in HTML_ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def html_title(html: Column) -> Column:
    raw = F.regexp_extract(html, "(?is)<title[^>]*>(.*?)</title>", 1)
    return strip(F.regexp_replace(_decode_entities(raw), SPACE, " "))


def html_text(html: Column) -> Column:
    """Visible text: head blocks, scripts, styles, comments and tags removed, entities decoded."""
    bare = F.regexp_replace(html, "(?is)<script.*?</script>|<style.*?</style>|<title.*?</title>", " ")
    bare = F.regexp_replace(bare, "(?s)<!--.*?-->", " ")
    bare = F.regexp_replace(bare, "<[^>]*>", " ")
    return strip(F.regexp_replace(_decode_entities(bare), SPACE, " "))


# Entity classes that a regular expression can recognise, in the order applied.
REDACTION_PATTERNS = {
    "EMAIL": "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}",
    "URL": "https?://[^ \\t\\n\\r<>\"]+",
    "IP": "\\b[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3}\\b",
    "SSN": "\\b[0-9]{3}-[0-9]{2}-[0-9]{4}\\b",
    "PHONE": "\\+?[0-9]{1,3}[ -]\\(?[0-9]{3}\\)?[ -][0-9]{3}[ -][0-9]{4}",
}


def redact(text: Column, kinds: list[str] | None = None, keep_type: bool = True) -> Column:
    """Replace recognised entities by ``<TYPE>``, or by ``***`` when the type is not kept."""
    for kind in kinds or list(REDACTION_PATTERNS):
        text = F.regexp_replace(text, REDACTION_PATTERNS[kind], f"<{kind}>" if keep_type else "***")
    return text
