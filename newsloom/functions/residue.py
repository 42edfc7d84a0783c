"""HTML to plain text without page residue at its head and tail.

Tags, white space and notes go by built-in functions. Entities (all names of HTML) and the
residue, whose rounds depend on what the round before left, take one Arrow function, which
gets only the texts that may hold either. All scans are linear in a text's length.
"""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import INLINE_NOTES, strip_inline_ui, text_or_empty, without_tags

# What stands at the head or tail of scraped pages.
CSS = re.compile(r"^[\s:;,.\[\]\w-]{0,60}(?:last-child|first-child|mb-\d|mt-\d|px-\d|py-\d|flex|grid|text-)[\s\S]{0,50}?\">\s*")
LOADING = re.compile(r"^(?:Loading…?|Loading\.\.\.|加载中…?)\s*")
MENU = re.compile(r"^(?:Share|Contents|Table of contents|On this page)\b")
SHARE = re.compile(r"^Share\s+(?=[A-Z一-鿿])")
BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
EDGE_HEAD, EDGE_TAIL = BLANKS + "|·—–>", BLANKS + "|·—–"
TAIL, TAIL_MOST, TAIL_LONGEST = re.compile(r"(?:Share|Related|Read more|Explore more|Next article)\b"), 200, 14
SENTENCE = re.compile(r"[.。!！?？]")
GRAMS, HEAD_WORDS, ROUNDS, LEAST_KEPT = (3, 4, 5), 80, 4, 0.7


def repeat_ends(words: list[str]) -> list[int]:
    """Where repeated word runs end."""
    ends = []
    for n in GRAMS:
        first: dict[tuple, int] = {}
        ends += [i + n for i in range(len(words) - n + 1) if first.setdefault(tuple(words[i : i + n]), i) < i]
    return ends


def without_menu(text: str) -> str:
    """Text after a menu, told by its looping headings; unchanged where that is in doubt."""
    words = text.split()
    end = max(repeat_ends(words[:HEAD_WORDS]), default=0)
    head = " ".join(words[:end])
    if len(words) < 20 or not 8 <= end < len(words) - 8 or SENTENCE.search(head) or len(head) > 12 * end:
        return text
    return " ".join(words[end:])


def tail_start(text: str) -> int:
    """Where a tail begins: the first line end of the white space before a tail word near the end; -1 if there is none."""
    for m in TAIL.finditer(text, max(0, len(text) - TAIL_MOST - TAIL_LONGEST)):
        if len(text) - m.end() <= TAIL_MOST:
            begin = m.start()
            while begin and text[begin - 1].isspace():
                begin -= 1
            if (at := text.find("\n", begin, m.start())) >= 0:
                return at
    return -1


def without_residue(text: str) -> str:
    """Texts that would lose over three tenths stay as they are."""
    now, before = text, None
    for _ in range(ROUNDS):
        if now == before:
            break
        before = now
        now = LOADING.sub("", CSS.sub("", now))
        now = without_menu(now) if MENU.match(now) else now
        now = SHARE.sub("", now).lstrip(EDGE_HEAD).rstrip(EDGE_TAIL)
    at = tail_start(now)
    if 0 <= at and len(now) - at <= 600 and len(words := now[at:].split()) >= 12 and repeat_ends(words):
        now = now[:at].rstrip()
    return (text if len(now) < LEAST_KEPT * len(text) else now).strip()


def _mapped(f, c: Column) -> Column:
    """An Arrow function of a text column; rows that are null cost next to nothing."""

    def run(s: pd.Series) -> pd.Series:
        return s.map(f, na_action="ignore")

    run.__annotations__ = {"s": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "string")(c)


def cut_nav_head(c: Column) -> Column:
    """Text after a looping menu of headings. Null: empty."""
    return _mapped(without_menu, text_or_empty(c))


# What a text has to hold at its head, its tail or anywhere for a rule of without_residue to change more than its edges' white space.
_HEAD, _LATER = r"^(?:Loading|加载中|Share|Contents|Table of contents|On this page|[|·—–>])", r'[|·—–]$|\s(?:Share|Related|Read more|Explore more|Next article)\b'


def _may_hold_residue(c: Column) -> Column:
    return c.rlike(_HEAD) | F.contains(F.left(c, F.lit(140)), F.lit('">')) | F.right(c, F.lit(240)).rlike(_LATER)


def clean_web_junk(c: Column) -> Column:
    """Inline notes go first, by built-in functions; then the residue, where there may be any. Null: empty."""
    bare = F.btrim(strip_inline_ui(text_or_empty(c)), F.lit(BLANKS))
    return F.coalesce(_mapped(without_residue, F.when(_may_hold_residue(bare), strip_inline_ui(text_or_empty(c)))), bare)


_NOTES = [re.compile(note) for note in INLINE_NOTES]


def plain(text: str) -> str:
    """Text without tags to clean text: entities, white space, inline notes, residue."""
    text = re.sub("[ \t\u00a0]+", " ", html.unescape(text))
    text = re.sub("\n{3,}", "\n\n", text).strip()
    for note in _NOTES:
        text = note.sub("", text)
    return without_residue(text)


def strip_tags(c: Column) -> Column:
    """Clean plain text of a piece of HTML. Null: empty. Only texts with an entity or a mark of residue leave the JVM."""
    bare = without_tags(c)
    tight = F.regexp_replace(F.regexp_replace(bare, "[ \\t\u00a0]++", " "), "\n{3,}+", "\n\n")
    tight = F.btrim(strip_inline_ui(F.btrim(tight, F.lit(BLANKS))), F.lit(BLANKS))
    odd = F.contains(bare, F.lit("&")) | _may_hold_residue(tight)
    return F.coalesce(_mapped(plain, F.when(odd, bare)), tight)


def body_header_strip(c: Column, most: int = 1500) -> Column:
    """Body of a reader service without its header lines, as plain text of `most` characters at most."""
    # fixed value: names of the header lines
    c = F.regexp_replace(text_or_empty(c), r"(?m)^(Title|URL Source|Markdown Content):.*$", "")
    return F.substring(strip_tags(c), 1, most)
