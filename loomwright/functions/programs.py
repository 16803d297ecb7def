"""Programs by their shape: the text with every plain numeral taken out.

Texts of one shape parse alike, so a shape is parsed once.  Numerals are whole or
decimal numbers of few digits that touch no letter, digit or point; texts with a
backslash, a carriage return, a null character or many characters are parsed by
themselves.
"""

from __future__ import annotations

import ast
import re
from functools import lru_cache

NUMERAL = re.compile(r"((?<![\w.])(?<![eE][-+])(?:0|[1-9][0-9]{0,14})(?:\.[0-9]{1,14})?(?![\w.]))")
#: A line that is a comment and has nothing by which a string could end or a field begin.
COMMENT = re.compile(r"""^([ \t]*#)[^\n\r\f\0"'\\{}]+$""", re.MULTILINE)
#: In a shape, the place of a numeral; and the longest text that is kept.
MARK, LONGEST = "\0", 4000


def shape_of(code: str) -> tuple[str, list[str]] | None:
    """The shape of a text and its numerals; None if it must be parsed by itself."""
    if len(code) > LONGEST or any(x in code for x in ("\\", "\r", MARK)):
        return None
    parts = NUMERAL.split(code)
    return MARK.join(parts[::2]), parts[1::2]


def _parses(text: str | None) -> bool:
    try:
        ast.parse(text)
        return True
    except (SyntaxError, ValueError, TypeError, RecursionError, MemoryError):
        return False


@lru_cache(maxsize=2048)
def _shape_parses(shape: str) -> bool:
    return _parses(shape.replace(MARK, "1"))


def is_program(text: str | None) -> bool:
    """Whether a text is a program by its syntax; it is only parsed, never run."""
    found = shape_of(COMMENT.sub(r"\1", text) if "#" in text else text) if text and "\\" not in text else None
    return _parses(text) if found is None else _shape_parses(found[0])
