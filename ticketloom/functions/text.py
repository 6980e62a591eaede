"""Text expressions on columns; all run inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticketloom import constants as K

# Whitespace as Unicode text defines it, written out because Java's \s covers ASCII only.
SPACE = r"\s\x1c-\x1f\x0b\x85\p{Z}"
# A run of whitespace other than one plain blank, so that ordinary text needs no replacement.
WHITESPACE = rf"(?: (?=[{SPACE}])|[{SPACE}&&[^ ]])[{SPACE}]*"
# (?d): only a newline ends the reach of ".".
EDGES = rf"^[{SPACE}]+|[{SPACE}]+$"
TAG = r"(?d)<.*?>"
PHONE = r"\p{Nd}{3}-\p{Nd}{3}-\p{Nd}{4}"
TOKEN = r"[\p{L}\p{N}_]{2,}"


def strip(c: Column) -> Column:
    """``c`` without white space at its ends, by the Unicode rule."""
    return F.regexp_replace(c, EDGES, "")


def clean_text(c: Column) -> Column:
    """Plain text: tags dropped, whitespace collapsed and trimmed, phone numbers masked; NULL gives ''."""
    present = F.coalesce(c, F.lit(""))
    untagged = F.when(F.contains(present, F.lit("<")), F.regexp_replace(present, TAG, "")).otherwise(present)
    collapsed = F.trim(F.regexp_replace(untagged, WHITESPACE, " "))
    masked = F.regexp_replace(collapsed, PHONE, K.PHONE_MASK)
    # texts without a dash skip the search
    return F.when(F.contains(collapsed, F.lit("-")), masked).otherwise(collapsed)


def text_length(c: Column) -> Column:
    """Number of code points."""
    return F.length(c)


def response_ratio(answer_length: Column, body_length: Column) -> Column:
    return answer_length.cast("double") / (body_length + F.lit(1)).cast("double")


def left_n(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def ellipsize(c: Column, n: int) -> Column:
    """First ``n`` characters followed by dots, or the text itself if it is not longer."""
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def default_if(c: Column, value) -> Column:
    return F.coalesce(c, F.lit(value))


def combine_text(subject: Column, body: Column) -> Column:
    """Subject, one blank, body; the blank stays when either side is missing."""
    return F.concat(default_if(subject, ""), F.lit(" "), default_if(body, ""))


def text_hash(c: Column) -> Column:
    return F.sha2(c, 256)


def lower(c: Column) -> Column:
    return F.lower(c)


def upper(c: Column) -> Column:
    return F.upper(c)


def sanitize_id(c: Column) -> Column:
    """Everything but letters, digits, '_' and '-' becomes '_'."""
    return F.regexp_replace(c, r"[^\p{L}\p{N}_-]", "_")


def normalize_newlines(c: Column) -> Column:
    """Paragraphs as ``<p>`` and single newlines as ``<br>``; empty input is returned unchanged."""
    squeezed = F.regexp_replace(c, r"\n{3,}", "\n\n")
    stripped = F.transform(F.split(squeezed, "\n\n"), strip)
    kept = F.filter(stripped, lambda p: p != "")
    html = F.transform(
        kept, lambda p: F.concat(F.lit("<p>"), F.replace(p, F.lit("\n"), F.lit("<br>")), F.lit("</p>"))
    )
    return F.when(c == "", c).otherwise(F.array_join(html, ""))


def _contains_any(c: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(w)) for w in words])


def intent_of(c: Column) -> Column:
    """gratitude, success, positive or (short) confirmation; NULL when the text needs a prediction."""
    t = strip(F.lower(c))
    found = {name: _contains_any(t, words) for name, words in K.INTENT_WORDS.items()}
    found["confirmation"] &= F.length(t) < K.CONFIRMATION_MAX_CHARS
    expr = None
    for name, test in found.items():
        expr = F.when(test, name) if expr is None else expr.when(test, name)
    return expr


def lang_guard(c: Column) -> Column:
    """'unknown' for texts too short to tell; NULL where the detector decides."""
    trimmed = strip(F.coalesce(c, F.lit("")))
    return F.when(F.length(trimmed) < K.MIN_DETECTABLE_CHARS, F.lit("unknown"))


def valid_query(c: Column) -> Column:
    """The trimmed text if it is 1..5000 characters and not blank, else NULL."""
    trimmed = strip(c)
    ok = F.length(c).between(1, K.MAX_QUERY_CHARS) & (F.length(trimmed) > 0)
    return F.when(ok, trimmed)


def tokens(c: Column) -> Column:
    """Lower-case words of two or more letters, digits or underscores."""
    return F.regexp_extract_all(F.lower(c), F.lit(f"({TOKEN})"), 1)


def to_json_metadata(refined_queue: Column, urgency_level: Column, language: Column) -> Column:
    return F.to_json(
        F.struct(
            refined_queue.alias("refined_queue"),
            urgency_level.alias("urgency_level"),
            default_if(language, "en").alias("language"),
        )
    )


def json_get(c: Column, key: str) -> Column:
    return F.get_json_object(c, f"$.{key}")


def ts_format(c: Column, fmt: str = K.SNAPSHOT_FORMAT) -> Column:
    return F.date_format(c, fmt)


def ts_parse(c: Column, fmt: str = K.SNAPSHOT_FORMAT) -> Column:
    """NULL where the text does not follow the format."""
    return F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz")


def ts_iso(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def round_pct(part: Column, total: Column) -> Column:
    """Percentage to one decimal."""
    return F.round(part.cast("double") * 100.0 / total.cast("double"), 1)
