"""Text and timestamp expressions. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from replyloom.functions.dialect import BLANKS, WORD_END, WORD_START, unicode_regex

# The shapes of handles, links, signatures and dates in the message data.
NUMERIC_HANDLE = r"@\d+\b"
LINK = r"https?://\S+|t\.co/\S+"
MENTION_OR_LINK = r"(@[A-Za-z0-9_]+|https?://\S+|t\.co/\S+)"
MENTION_LINK_OR_TOKEN = r"(@[A-Za-z0-9_]+|https?://\S+|t\.co/\S+|\[URL\])"
AGENT_SIGNATURE = r"\s*[\^/][A-Za-z]{1,3}\s*$"
SIGNATURE_CARET = r"\^[A-Z]{1,3}\b"
SIGNATURE_SLASH = r"/[A-Z]{1,3}\b"
MENTION_NAME = r"@([A-Za-z0-9_]+)"
CREATED_AT = r"^(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun) [A-Z][a-z]{2} [0-9]{1,2} [0-9]{2}:[0-9]{2}:[0-9]{2} \+0000 [0-9]{4}$"
MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"


def strip(text: Column) -> Column:
    """Remove Unicode white space at both ends."""
    return F.btrim(text, F.lit(BLANKS))


def collapse_spaces(text: Column) -> Column:
    """One blank per run of white space, none at the ends."""
    return F.trim(F.regexp_replace(text, unicode_regex(r"\s+"), " "))


def mask_handles(text: Column) -> Column:
    """``@115854`` becomes ``@user``."""
    return F.regexp_replace(text, unicode_regex(NUMERIC_HANDLE), "@user")


def mask_links(text: Column) -> Column:
    """Replace every link by ``[URL]``; null becomes an empty text."""
    return F.regexp_replace(_or_empty(text), unicode_regex(LINK, ignore_case=True), "[URL]")


def normalize_question(text: Column) -> Column:
    """Conservative customer-side normalisation; null becomes an empty text."""
    return mask_handles(collapse_spaces(_or_empty(text)))


def normalize_reply(text: Column) -> Column:
    """As the customer side, then drop an agent signature at the very end.

    The signature shape also eats a real ending such as ``and/or``.
    """
    return strip(F.regexp_replace(normalize_question(text), unicode_regex(AGENT_SIGNATURE), ""))


def substantive(text: Column) -> Column:
    """What is left of a message without mentions and links."""
    return strip(F.regexp_replace(_or_empty(text), unicode_regex(MENTION_OR_LINK), ""))


def modelling_text(text: Column) -> Column:
    """Lower case, mentions and links blanked, white space collapsed."""
    lowered = F.lower(_or_empty(text))
    return collapse_spaces(F.regexp_replace(lowered, unicode_regex(MENTION_LINK_OR_TOKEN), " "))


def ascii_words(text: Column, stop_words: Iterable[str] = ()) -> Column:
    """Whole words of three or more letters a-z, stop words dropped."""
    found = F.regexp_extract_all(F.lower(_or_empty(text)), F.lit(f"{WORD_START}[a-z]{{3,}}+{WORD_END}"), 0)
    return drop_words(found, stop_words)


def model_words(text: Column, stop_words: Iterable[str] = ()) -> Column:
    """Word runs of two or more characters, lower case, stop words dropped."""
    found = F.regexp_extract_all(F.lower(_or_empty(text)), F.lit(unicode_regex(r"\w{2,}")), 0)
    return drop_words(found, stop_words)


def drop_words(words: Column, stop_words: Iterable[str]) -> Column:
    stops = sorted(set(stop_words))
    return F.filter(words, lambda w: ~w.isin(stops)) if stops else words


def ngrams(words: Column, n: int) -> Column:
    """Blank-joined runs of ``n`` neighbouring words.

    ``words`` should be a column reference: it is read once per run length.
    """
    runs = words
    for last in range(2, n + 1):
        count = F.greatest(F.size(words) - (last - 1), F.lit(0))
        runs = F.zip_with(
            F.slice(runs, 1, count), F.slice(words, last, count), lambda head, tail: F.concat(head, F.lit(" "), tail)
        )
    return runs


def child_ids(id_list: Column) -> Column:
    """``"119249, 119251,x"`` to ``[119249, 119251]``; null to an empty array."""
    parts = F.transform(F.split(_or_empty(id_list), ","), strip)
    numeric = F.filter(parts, lambda p: p.rlike("^[0-9]+$"))
    return F.filter(F.transform(numeric, lambda p: p.try_cast("bigint")), lambda i: i.isNotNull())


def parse_created_at(text: Column) -> Column:
    """``Tue Oct 31 22:10:47 +0000 2017`` to a zone-free UTC timestamp, null when malformed."""
    part = F.split(text, " ")
    clock = F.split(part[3], ":")
    month_at = F.instr(F.lit(MONTHS), part[1])
    month = F.when(month_at % 3 == 1, ((month_at + 2) / 3).cast("int"))
    moment = F.try_make_timestamp_ntz(
        part[5].try_cast("int"),
        month,
        part[2].try_cast("int"),
        clock[0].try_cast("int"),
        clock[1].try_cast("int"),
        clock[2].try_cast("decimal(8,6)"),
    )
    return F.when(text.rlike(CREATED_AT), moment)


def seconds_between(later: Column, earlier: Column) -> Column:
    """Whole seconds between zone-free timestamps, null when either side is null."""
    return (later - earlier).cast("interval second").cast("bigint")


def micros_since_epoch(at: Column) -> Column:
    """A zone-free timestamp as a number that keeps its order."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = (at.cast("timestamp_ntz") - epoch).cast("interval second").cast("decimal(24,6)")
    return (seconds * 1_000_000).cast("bigint")


def is_ascii(text: Column) -> Column:
    return text.rlike(r"\A[\x00-\x7F]*\z")


def _or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))
