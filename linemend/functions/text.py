"""Column functions over line text: everything stays inside Catalyst."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from linemend.constants import LETTERS, MARKS, MIN_TOKEN_LEN, NEXT_WORD, SPACE_WORDS, STREET_WORDS, STRIP_CHARS, TAIL_CHARS


def tokens(line: Column) -> Column:
    """White-space tokens of a line (Unicode white space, as str.split)."""
    return F.array_remove(F.split(line, r"(?U)\s+"), "")


def strip_token(raw: Column) -> Column:
    """Lookup key of a token: outer punctuation off, ``=`` between letters as ``-``."""
    return F.regexp_replace(F.btrim(raw, F.lit(STRIP_CHARS)), f"(?<=[{LETTERS}])=(?=[{LETTERS}])", "-")


def is_word(token: Column) -> Column:
    return token.rlike(f"^[{LETTERS}]+$")


def ends_with_mark(line: Column) -> Column:
    return F.right(line, F.lit(1)).isin(*MARKS)


def last(arr: Column) -> Column:
    return F.try_element_at(arr, F.lit(-1))


def first(arr: Column) -> Column:
    return F.try_element_at(arr, F.lit(1))


def without_last(text: Column) -> Column:
    return F.substring(text, F.lit(1), F.greatest(F.char_length(text) - 1, F.lit(0)))


def interior(toks: Column) -> Column:
    """Tokens that are neither first nor last on their line."""
    return F.when(F.size(toks) > 2, F.slice(toks, F.lit(2), F.size(toks) - 2)).otherwise(F.slice(toks, 1, 0))


def separator(raw: Column) -> Column:
    """What stands between a token and the next: plain, period or comma."""
    tail = F.right(F.rtrim(raw, F.lit(TAIL_CHARS)), F.lit(1))
    return F.when(tail == ".", "period").when(tail == ",", "comma").otherwise("plain")


def break_pair(line: Column, following: Column) -> Column:
    """Struct (left, right, raw_left, raw_right, hyphenated) of the break between
    two lines; null where it has no usable pair."""
    marked = ends_with_mark(line)
    body = F.when(marked, without_last(line)).otherwise(line)
    head, tail = tokens(body), tokens(following)
    raw_left, raw_first = last(head), first(tail)
    raw_right = F.when((F.size(tail) == 1) & ends_with_mark(raw_first), without_last(raw_first)).otherwise(raw_first)
    left, right = strip_token(raw_left), strip_token(raw_right)
    usable = (F.char_length(left) >= MIN_TOKEN_LEN) & (F.char_length(right) >= MIN_TOKEN_LEN)
    return F.when(usable, F.struct(left.alias("left"), right.alias("right"), raw_left.alias("raw_left"), raw_right.alias("raw_right"), marked.alias("hyphenated")))


def next_word(line: Column) -> Column:
    return F.regexp_extract(F.coalesce(line, F.lit("")), NEXT_WORD, 1)


def mark_action(word: Column) -> Column:
    """What the rule does with a line-end mark before the next word."""
    return (
        F.when(word == "", "remove").when(word.isin(*SPACE_WORDS), "space").when(word.rlike(r"^\p{Lu}"), "hyphen")
        .when(word == "und", "hyphen").when(word.isin(*STREET_WORDS), "hyphen").otherwise("remove")
    )


def joined_by_rule(lines: Column) -> Column:
    """A paragraph's lines as one text by the mark rule: row-local, no shuffle."""

    def piece(line: Column, i: Column) -> Column:
        more = i < F.size(lines) - 1
        action = mark_action(next_word(F.try_element_at(lines, (i + 2).cast("int"))))
        suffix = F.when(action == "space", " ").when(action == "hyphen", "-").otherwise("")
        return F.when(more & ends_with_mark(line), F.concat(without_last(line), suffix)).when(more, F.concat(line, F.lit(" "))).otherwise(line)

    return F.array_join(F.transform(lines, piece), "")


def joined_by_marks(lines: Column, marks: Column) -> Column:
    """Joined text driven by break marks: ``word`` joins, ``compound`` keeps ``-``,
    anything else is a space (after dropping the mark)."""

    def piece(line: Column, i: Column) -> Column:
        mark = F.try_element_at(marks, (i + 1).cast("int"))
        body = F.when(ends_with_mark(line), without_last(line)).otherwise(line)
        suffix = F.when(mark == "word", "").when(mark == "compound", "-").otherwise(" ")
        return F.when(i < F.size(lines) - 1, F.concat(body, suffix)).otherwise(line)

    return F.array_join(F.transform(lines, piece), "")


def is_initial(word: Column) -> Column:
    return (F.char_length(word) == 1) & word.rlike(r"^\p{Lu}")


def apply_rules(text: Column, rules: list[tuple[str, str]]) -> Column:
    """Ordered replacements, each over the result of the last: one expression, a
    fold over a literal array (the rule list is small and read by the driver)."""
    if not rules:
        return text
    table = F.array(*[F.struct(F.lit(a).alias("old"), F.lit(b).alias("new")) for a, b in rules])
    return F.aggregate(table, text, lambda acc, r: F.replace(acc, r["old"], r["new"]))


def times_before(text: Column) -> Column:
    """``730 Uhr`` as ``7.30 Uhr``."""
    return F.regexp_replace(text, r"(?<!\d)(1[0-2]|[1-9])([0-5]\d)(?= Uhr)", "$1.$2")


def without_breaks(text: Column, mark: str) -> Column:
    """Joined text whose breaks still show as ``mark`` (``"¬ "``): each goes, or becomes a
    space or a dash by what follows; ``-XXX`` stands for a dash before ``und``."""
    one = re.escape(mark)
    follow = lambda words: f"{one}(?=(?:{'|'.join(map(re.escape, words))}))"
    out = F.regexp_replace(text, follow(SPACE_WORDS), " ")
    out = F.regexp_replace(out, f"{one}(?=\\p{{Lu}})", "-")
    out = F.regexp_replace(out, f"{one}(?=und)", "-XXX")
    return F.regexp_replace(F.regexp_replace(out, follow(STREET_WORDS), "-"), one, "")
