"""The line functions of ``text`` in plain Python, for what runs over every line.

Higher-order functions of Catalyst are interpreted, about 10 microseconds a token; a worker
that splits a line once takes a few tenths of one.  Columns that are not read pass through
as Arrow, without becoming objects.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from linemend.constants import LETTERS, MARKS, MIN_TOKEN_LEN, STRIP_CHARS, TAIL_CHARS

_WIDE = "\x85\xa0  -     　"
_UNICODE_TOKENS = re.compile(f"[^\t-\r {_WIDE}]+")
_ASCII_TOKENS = re.compile("[^\t-\r ]+")
#: Where ``str.split`` parts from white space as patterns know it.
_OTHER_SPLIT = re.compile(f"[\x1c-\x1f{_WIDE}]")
_EQUALS = re.compile(f"(?<=[{LETTERS}])=(?=[{LETTERS}])")
is_word = re.compile(f"[{LETTERS}]+").fullmatch
compound = re.compile(f"([{LETTERS}]+)[-=]([{LETTERS}]+)").fullmatch


def tokens(line: str) -> list[str]:
    """White-space tokens (Unicode white space)."""
    return line.split() if line.isprintable() else _UNICODE_TOKENS.findall(line)


def ascii_tokens(line: str, plain: bool) -> list[str]:
    """Tokens between ASCII white space; ``plain``: the line holds no other (see ``is_plain``)."""
    return line.split() if plain else _ASCII_TOKENS.findall(line)


def is_plain(text: str) -> bool:
    return _OTHER_SPLIT.search(text) is None


def strip_token(raw: str) -> str:
    bare = raw.strip(STRIP_CHARS)
    return _EQUALS.sub("-", bare) if "=" in bare else bare


def separator(raw: str) -> int:
    """0, 1 or 2: plain, period or comma."""
    tail = raw.rstrip(TAIL_CHARS)[-1:]
    return 1 if tail == "." else 2 if tail == "," else 0


def break_words(line: str, following: str | None) -> tuple | None:
    """(left, right, raw_left, raw_right, hyphenated, h, t) of the break between two lines,
    h and t the words beside the pair; null where it has no usable pair."""
    if following is None:
        return None
    marked = line.endswith(MARKS)
    head, tail = tokens(line[:-1] if marked else line), tokens(following)
    if not head or not tail:
        return None
    raw_left, raw_right = head[-1], tail[0]
    if len(tail) == 1 and raw_right.endswith(MARKS):
        raw_right = raw_right[:-1]
    left, right = strip_token(raw_left), strip_token(raw_right)
    if len(left) < MIN_TOKEN_LEN or len(right) < MIN_TOKEN_LEN:
        return None
    return left, right, raw_left, raw_right, marked, (strip_token(head[-2]) or None) if len(head) > 1 else None, (strip_token(tail[1]) or None) if len(tail) > 1 else None


def final_words(line: str, following: str | None) -> tuple | None:
    """(raw, w, prev_w, next_w) of a line end; null where it has a mark or no token."""
    if line.endswith(MARKS):
        return None
    toks = tokens(line)
    if not toks:
        return None
    ahead = None if following is None else tokens(following)
    return toks[-1], strip_token(toks[-1]), strip_token(toks[-2]) if len(toks) > 1 else None, strip_token(ahead[0]) if ahead else None


def with_words(rows: DataFrame, of: Callable[[str, str | None], tuple | None], fields: list[StructField], whole: bool = False) -> DataFrame:
    """Rows of (line, next_line, ...) with what ``of`` makes of the two lines beside them;
    rows of which it makes nothing go, or with ``whole`` stay, with nulls."""
    nothing = (None,) * len(fields)
    schema = StructType([*rows.schema.fields, *fields])
    kinds = [pa.string() if isinstance(f.dataType, StringType) else pa.bool_() for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # nothing here holds itself
        for b in batches:
            made = [of(x, y) or (nothing if whole else None) for x, y in zip(b.column("line").to_pylist(), b.column("next_line").to_pylist(), strict=True)]
            kept = b.filter(pa.array([x is not None for x in made], pa.bool_()))
            columns = zip(*[x for x in made if x is not None], strict=True) if kept.num_rows else [[]] * len(fields)
            yield pa.RecordBatch.from_arrays([*kept.columns, *[pa.array(x, k) for x, k in zip(columns, kinds, strict=True)]], [*b.schema.names, *[f.name for f in fields]])

    return rows.mapInArrow(run, schema)
