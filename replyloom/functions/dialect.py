"""Regular expressions with Unicode character classes.

Java's ``\\w \\d \\s \\b`` follow ASCII or change between JDK releases. Support text is full of
emoji, NBSP and accents, so patterns are written with the usual shorthands and expanded here into
explicit Unicode classes that mean the same on every JDK.
"""

from __future__ import annotations

WORD = r"\p{L}\p{N}_"
DIGIT = r"\p{Nd}"
# The White_Space property is one test per character; the four separators are white space in Python as well.
SPACE = r"\x1c-\x1f\p{IsWhite_Space}"
BLANKS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
BOUNDARY = f"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"
WORD_START = f"(?<![{WORD}])"
WORD_END = f"(?![{WORD}])"

_OUTSIDE = {
    "b": BOUNDARY,
    "w": f"[{WORD}]",
    "d": DIGIT,
    "s": f"[{SPACE}]",
    "S": f"[^{SPACE}]",
}
_INSIDE = {"w": WORD, "d": DIGIT, "s": SPACE}


def unicode_regex(pattern: str, ignore_case: bool = False) -> str:
    """Expand the shorthand classes of ``pattern`` for Spark's regex functions.

    A ``\\b`` at the very beginning must be followed by word characters only; it is tried at every
    position of a text, so it becomes the cheaper test that no word character comes before.
    """
    out: list[str] = []
    if pattern.startswith(r"\b"):
        out.append(WORD_START)
        pattern = pattern[2:]
    in_class = False
    chars = iter(pattern)
    for ch in chars:
        if ch == "\\":
            escaped = next(chars)
            table = _INSIDE if in_class else _OUTSIDE
            out.append(table.get(escaped, "\\" + escaped))
            continue
        if ch == "[" and not in_class:
            in_class = True
        elif ch == "]" and in_class:
            in_class = False
        out.append(ch)
    return ("(?iu)" if ignore_case else "") + "".join(out)
