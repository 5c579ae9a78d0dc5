"""JSON of any depth, with repeated keys and numbers of any length, and its canonical text.

The reading is that of Python's ``json``: the last of repeated keys wins. Where its recursion ends, a
loop with a stack of its own goes on. A number is its exact decimal value, however it was written. A surrogate
without its other half is no character and becomes a question mark, as in every encoding to UTF-8.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from json.decoder import scanstring

# Zeros that a plain number may begin or end with; beyond, it is written with an exponent.
_MOST_ZEROS = 400
_WHITE = re.compile(r"[ \t\n\r]*")
_NUMBER = re.compile(r"-?(?:0|[1-9]\d*)(\.\d+)?([eE][-+]?\d+)?")
_WORDS = {"true": True, "false": False, "null": None}
_HALF = re.compile(r"\\u[dD][89a-fA-F]")
# A pair of halves, a lone half, any other escape.
_ESCAPES = re.compile(r"(\\u[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2})|\\u[dD][89a-fA-F][0-9a-fA-F]{2}|(\\.)", re.S)
_SPECIAL = re.compile(r'["\\\x00-\x1f]')
_NAMED = {'"': '\\"', "\\": "\\\\", "\b": "\\b", "\t": "\\t", "\n": "\\n", "\f": "\\f", "\r": "\\r"}


@dataclass(frozen=True)
class Number:
    """A number in its canonical form."""

    text: str


def number(text: str) -> Number:
    """Equal values have equal forms: no sign of a zero, no zeros that do not count, no exponent unless the zeros get too many."""
    mantissa, _, exponent = text.lower().partition("e")
    whole, _, fraction = mantissa.removeprefix("-").partition(".")
    digits = (whole + fraction).lstrip("0")
    significant = digits.rstrip("0")
    if not significant:
        return Number("0")
    # The value is the significant digits times ten to the power of ``shift``.
    sign = "-" if mantissa.startswith("-") else ""
    try:
        shift = int(exponent or 0) - len(fraction) + len(digits) - len(significant)
    except ValueError:  # an exponent of thousands of digits
        return Number(f"{sign}{mantissa.removeprefix('-')}E{exponent}")
    if 0 <= shift <= _MOST_ZEROS:
        plain = significant + "0" * shift
    elif shift < 0 and -shift < len(significant):
        plain = f"{significant[:shift]}.{significant[shift:]}"
    elif shift < 0 and -shift - len(significant) <= _MOST_ZEROS:
        plain = f"0.{'0' * (-shift - len(significant))}{significant}"
    else:
        rest = f".{significant[1:]}" if len(significant) > 1 else ""
        plain = f"{significant[0]}{rest}E{len(significant) - 1 + shift}"
    return Number(sign + plain)


def _refuse(word: str):
    raise ValueError(f"not JSON: {word}")


def loads(text: str):
    """The value; ``ValueError`` where the text is not JSON."""
    if _HALF.search(text):
        text = _ESCAPES.sub(lambda m: m[0] if m[1] or m[2] else "?", text)
    try:
        return json.loads(text, parse_int=number, parse_float=number, parse_constant=_refuse)
    except RecursionError:
        return _loads_flat(text)


def _loads_flat(text: str):
    """The same without recursion. The stack holds open lists and objects, and an object's open key."""
    def white(at: int) -> int:
        return _WHITE.match(text, at).end()

    def key(at: int) -> tuple[str, int]:
        if text[at:at + 1] != '"':
            raise ValueError(f"no key at {at}")
        name, at = scanstring(text, at + 1, True)
        at = white(at)
        if text[at:at + 1] != ":":
            raise ValueError(f"no colon at {at}")
        return name, white(at + 1)

    stack: list[list] = []
    at = white(0)
    while True:
        sign = text[at:at + 1]
        if sign in ("[", "{"):
            own, at = ([] if sign == "[" else {}), white(at + 1)
            if text[at:at + 1] == ("]" if sign == "[" else "}"):
                value, at = own, at + 1
            else:
                name = None
                if sign == "{":
                    name, at = key(at)
                stack.append([own, name])
                continue
        elif sign == '"':
            value, at = scanstring(text, at + 1, True)
        else:
            word = next((w for w in _WORDS if text.startswith(w, at)), None)
            digits = None if word else _NUMBER.match(text, at)
            if word:
                value, at = _WORDS[word], at + len(word)
            elif digits:
                value, at = number(digits[0]), digits.end()
            else:
                raise ValueError(f"no value at {at}")
        # The value is complete: put it in its place, and close what ends with it.
        while True:
            at = white(at)
            if not stack:
                if at < len(text):
                    raise ValueError(f"more at {at}")
                return value
            own, name = stack[-1]
            if name is None:
                own.append(value)
            else:
                own[name] = value
            end, sign = ("]" if name is None else "}"), text[at:at + 1]
            if sign == ",":
                at = white(at + 1)
                if name is not None:
                    stack[-1][1], at = key(at)
                break
            if sign != end:
                raise ValueError(f"neither comma nor {end} at {at}")
            value, at = stack.pop()[0], at + 1


def _string(text: str) -> str:
    return '"' + _SPECIAL.sub(lambda m: _NAMED.get(m[0]) or f"\\u{ord(m[0]):04X}", text) + '"'


def dumps(value) -> str:
    """Canonical text: keys in the order of their UTF-16 units, no blanks, characters as they are."""
    out: list[str] = []
    todo: list = [value]
    while todo:
        item = todo.pop()
        if isinstance(item, (_Raw, Number)):
            out.append(item.text)
        elif isinstance(item, str):
            out.append(_string(item))
        elif isinstance(item, dict):
            parts: list = [_Raw("{")]
            for i, name in enumerate(sorted(item, key=lambda name: name.encode("utf-16-be", "surrogatepass"))):
                parts += [_Raw(("," if i else "") + _string(name) + ":"), item[name]]
            todo += reversed([*parts, _Raw("}")])
        elif isinstance(item, list):
            parts = [_Raw("[")]
            for i, child in enumerate(item):
                parts += [_Raw(","), child] if i else [child]
            todo += reversed([*parts, _Raw("]")])
        else:
            out.append(json.dumps(item))
    return "".join(out)


@dataclass(frozen=True)
class _Raw:
    text: str
