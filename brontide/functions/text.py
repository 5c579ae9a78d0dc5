"""Text of logs: lines, fingerprints, level and error classification."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Fixed values ------------------------------------------------------------------------------
# Line terminators: all those of Python's str.splitlines.
LINE_TERMINATOR = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"
# Whitespace stripped from messages: all characters of Python's str.strip.
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
              "           "
              "    　")
# Levels in the order in which they are looked for.
LEVELS = ("ERROR", "WARN", "INFO", "DEBUG")
# Tokens that mark an error.
ERROR_TOKENS = (
    "ERROR", "EXCEPTION", "TRACEBACK", "FAILED", "FAILURE", "OUTOFMEMORY", "OUT OF MEMORY",
    "EXECUTORLOSTFAILURE", "PERMISSION DENIED", "TIMEOUT", "PY4JJAVAERROR", "ANALYSIS_EXCEPTION",
)
ERROR_HINT = "possible_error_chunk"
# -------------------------------------------------------------------------------------------

# A token that contains another token can never decide the outcome.
_DECISIVE_TOKENS = [t for t in ERROR_TOKENS if not any(o != t and o in t for o in ERROR_TOKENS)]


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)


def split_at_terminators(text: Column) -> Column:
    """Array of the pieces between line terminators.

    Nearly all texts hold no terminator but the line feed; the cheap test for the others lets
    those be split at a plain character, which is much faster than at a pattern.
    """
    others = text.rlike("[\x0b-\r\x1c-\x1e]")
    for wide in ("\x85", "\u2028", "\u2029"):
        others = others | text.contains(wide)
    return F.when(others, F.split(text, LINE_TERMINATOR)).otherwise(F.split(text, "\n"))


def lines(text: Column) -> Column:
    """Array of the lines of a text; a final terminator adds no line, '' has no lines."""
    def without_final_empty(parts: Column) -> Column:
        return (F.when(F.get(parts, F.size(parts) - 1) == "",
                       F.slice(parts, F.lit(1), F.size(parts) - 1))
                 .otherwise(parts))

    # The one-element array binds the parts to a name, so that the text is split only once.
    return F.get(F.transform(F.array(split_at_terminators(text)), without_final_empty), F.lit(0))


def line_count(text: Column) -> Column:
    return F.size(lines(text))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def has_text(text: Column) -> Column:
    """Whether ``strip`` leaves anything; looks no further than the first such character."""
    return text.rlike(f"[^{WHITESPACE}]")


def pick_content(raw_text: Column, raw_content: Column) -> Column:
    return F.coalesce(raw_text, raw_content, F.lit(""))


def guess_level(message: Column) -> Column:
    """First level whose name occurs in the message in any case, else NULL."""
    upper = F.upper(message)
    return F.coalesce(*[F.when(upper.contains(level), F.lit(level)) for level in LEVELS])


def is_error(message: Column) -> Column:
    """Whether any error token occurs in the message in any case; false for NULL."""
    upper = F.upper(message)
    found = reduce(Column.__or__, [upper.contains(t) for t in _DECISIVE_TOKENS])
    return F.coalesce(found, F.lit(False))


def error_hint(error: Column) -> Column:
    return F.when(error, F.lit(ERROR_HINT))
