"""Keyword flags and the rules that turn them into classes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticketloom import constants as K


def word_pattern(words: list[str]) -> str:
    """Whole-word pattern for folded text; a word ends where no letter, digit or '_' follows."""
    edge = r"[^\p{L}\p{N}_]"
    return rf"(?:^|{edge})(?:{'|'.join(words)})(?:{edge}|$)"


def folded(c: Column) -> Column:
    """Lower case, with the letters that case-insensitive matching treats as s or i."""
    return F.lower(F.translate(c, "ſıİ", "sii"))


def keyword_flags(c: Column, keywords: dict[str, list[str]] = K.KEYWORDS) -> list[Column]:
    """One 0/1 column ``has_<topic>`` per topic; NULL text gives 0.

    A plain substring search, much cheaper than the pattern, comes first and rules out most texts.
    """
    t = folded(c)

    def flag(words: list[str]) -> Column:
        somewhere = reduce(lambda a, b: a | b, [F.contains(t, F.lit(w)) for w in words])
        return F.coalesce(somewhere & F.rlike(t, F.lit(word_pattern(words))), F.lit(False)).cast("int")

    return [flag(words).alias(f"has_{topic}") for topic, words in keywords.items()]


def substring_flags(c: Column, fragments: dict[str, list[str]] = K.SUBSTRINGS) -> list[Column]:
    """The looser production flags: a fragment anywhere counts."""
    return [
        F.coalesce(reduce(lambda a, b: a | b, [c.ilike(f"%{w}%") for w in words]), F.lit(False))
        .cast("int")
        .alias(f"has_{topic}")
        for topic, words in fragments.items()
    ]


def map_urgency(priority: Column) -> Column:
    """Three levels; anything unknown, NULL included, is low."""
    return (
        F.when(priority.isin("critical", "high"), "high")
        .when(priority == "medium", "medium")
        .otherwise("low")
    )


def refine_queue(queue: Column, merge_printer: bool = True) -> Column:
    """Class of a ticket from its flags and queue; the order of the branches is the rule."""
    flag = {name: F.col(f"has_{name}") == 1 for name in K.KEYWORDS}
    return (
        F.when(flag["security"], K.SECURITY_QUEUE)
        .when(flag["printer"], K.HARDWARE_QUEUE if merge_printer else K.PRINTER_QUEUE)
        .when(flag["hardware"], K.HARDWARE_QUEUE)
        .when(flag["network"], K.NETWORK_QUEUE)
        .when(flag["software"] | (queue == K.PRODUCT_SUPPORT), K.SOFTWARE_QUEUE)
        .when(queue == K.OUTAGES_AND_MAINTENANCE, K.OUTAGE_QUEUE)
        .otherwise(K.GENERAL_QUEUE)
    )


def serving_features(c: Column, keywords: dict[str, list[str]] = K.KEYWORDS) -> Column:
    """The eight numbers used when a request is scored.

    Lengths are estimates here (answer = 0.8 of the text, ratio 0.8), unlike in training.
    """
    length = F.length(c).cast("double")
    return F.array(length, length * 0.8, F.lit(0.8), *[f.cast("double") for f in keyword_flags(c, keywords)])


def cast_types(df, types: dict[str, str]):
    """Cast columns by name; text that does not parse becomes NULL."""
    return df.select(*[df[c].try_cast(types[c]).alias(c) if c in types else df[c] for c in df.columns])
