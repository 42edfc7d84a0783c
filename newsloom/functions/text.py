"""Text functions on columns. All built in: they stay inside code generation."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C

CJK = "[\\u4e00-\\u9fff]"


def _any(words: list[str]) -> str:
    return "|".join(re.sub(r"([^\w\s])", r"\\\1", w) for w in words)


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


# Letters whose upper case is several letters, and those of them that also have a single one.
_LONG = "".join(x for x in map(chr, range(0x80, 0x10000)) if len(x.upper()) > 1)
_SINGLE = {"ß": "ẞ", **{x: x.title() for x in _LONG if len(x.title()) == 1}}


def upper_by_letter(c: Column) -> Column:
    """Upper case letter by letter, as SQL engines have it: no letter becomes several (ß: ẞ)."""
    letters = F.transform(F.split(c, ""), lambda x: F.when(x.rlike(f"[{_LONG}]"), F.translate(x, "".join(_SINGLE), "".join(_SINGLE.values()))).otherwise(F.upper(x)))
    return F.when(c.rlike(f"[{_LONG}]"), F.array_join(letters, "")).otherwise(F.upper(c))


def norm_title(c: Column) -> Column:
    """Letters, digits and _ of a title, lower case."""
    return F.lower(F.regexp_replace(text_or_empty(c), r"[^\p{L}\p{N}_]+", ""))


def item_id(c: Column) -> Column:
    return F.substring(F.md5(norm_title(c).cast("binary")), 1, 10)


def has_cjk(c: Column) -> Column:
    return text_or_empty(c).rlike(CJK)


def token_set(c: Column) -> Column:
    """Words; a word of CJK characters alone gives its 2-grams."""
    words = F.filter(F.split(F.regexp_replace(F.lower(text_or_empty(c)), r"[^\p{L}\p{N}_]+", " "), " "), lambda w: w != "")
    grams = F.transform(
        words,
        lambda w: F.when(
            w.rlike(f"^{CJK}+$") & (F.char_length(w) > 2),
            F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(w) - 1, F.lit(1))), lambda i: F.substr(w, i, F.lit(2))),
        ).otherwise(F.array(w)),
    )
    return F.array_distinct(F.flatten(grams))


def cjk_tokens(c: Column) -> Column:
    return F.when(has_cjk(c), token_set(c)).otherwise(F.array().cast("array<string>"))


def latin_tokens(c: Column) -> Column:
    return F.when(has_cjk(c), F.array().cast("array<string>")).otherwise(token_set(c))


def similar(a: Column, b: Column, percent: int) -> Column:
    """Whether the Jaccard similarity of two sets is `percent` hundredths at least, in whole numbers; never if one is empty."""
    return (F.size(a) > 0) & (F.size(b) > 0) & (100 * F.size(F.array_intersect(a, b)) >= percent * F.size(F.array_union(a, b)))


def host_of(c: Column) -> Column:
    """Lower-cased authority without a leading www."""
    return F.regexp_replace(F.lower(F.regexp_extract(text_or_empty(c), r"^[^:]+://([^/?#]*)", 1)), r"^www\.", "")


def canonical_url(c: Column) -> Column:
    """Cut at the first ?, no slashes at the end; the fragment stays."""
    return F.regexp_replace(F.split(text_or_empty(c), r"\?").getItem(0), "/+$", "")


def source_label(c: Column) -> Column:
    # fixed value: marks of a feed's kind behind its name
    s = F.regexp_replace(text_or_empty(c), "(?i)（(?:RSS|网页|Atom|feed)[^）]*）", "")
    return F.substring(F.trim(F.regexp_replace(s, r"\s+", " ")), 1, 34)


#: White space of all scripts, as a class that Java's and Python's patterns read alike.
WHITE = r"[\s\x1c-\x1f\x85\xa0  -     　]"
# Accessibility notes and invisible characters, in the order they are removed. Each match begins
# at the first of its blanks and gives none of them back, so long runs of white space are read twice at most.
INLINE_NOTES = ["[\\u2060\\ufeff\\u200b]"] + [
    note.replace("_", WHITE)
    for note in (
        r"(?i)(?<!_)(?:_*+(?:\(_*+)?opens?_++in_++(?:a_++)?new_++(?:window|tab)_*+\)?)++",
        r"(?<!_)_*+[（(]_*+在新窗口(?:中)?打开_*+[）)]",
        r"(?<!_)_*+[（(]_*+在新标签页?中?打开_*+[）)]",
    )
]


# What a text has to hold for any note to match.
_MAY_HOLD_NOTES = "[\\u2060\\ufeff\\u200b]|[oO][pP][eE][nN]|在新"


def strip_inline_ui(c: Column) -> Column:
    """Text without accessibility notes. One quick search spares most texts the patterns."""
    bare = c
    for note in INLINE_NOTES:
        bare = F.regexp_replace(bare, note, "")
    return F.when(c.rlike(_MAY_HOLD_NOTES), bare).otherwise(c)


def without_tags(c: Column) -> Column:
    """HTML without its tags; blocks of script and style go, line ends stay. Entities are left."""
    c = F.regexp_replace(text_or_empty(c), r"(?is)<script.*?</script>|<style.*?</style>", " ")
    c = F.regexp_replace(c, r"(?i)<br\s*+/?>|</p>", "\n")
    tail = F.substring_index(c, ">", -1)  # no tag ends there: a search would run to the end from each <
    return F.concat(F.regexp_replace(F.left(c, F.char_length(c) - F.char_length(tail)), "<[^>]+>", " "), tail)


def is_nonwork(c: Column) -> Column:
    t = text_or_empty(c)
    return t.rlike(C.NONWORK_COLUMN) & t.rlike("[：:]") & ~t.rlike(C.NONWORK_MADE)


def keyword_hit(*titles: Column) -> Column:
    return F.lower(F.concat_ws(" ", *titles)).rlike(_any(C.TOP_KEYWORDS))


def guess_type(title: Column, title_cn: Column, *rest: Column) -> Column:
    """Form of an application by keyword in the titles and the rest (summary, text, block, url); digests first."""
    hay = F.lower(F.concat_ws(" ", title, title_cn, *rest))
    out = F.when(is_nonwork(title) | is_nonwork(title_cn), C.NONWORK_LABEL)
    for label, words in C.TYPE_RULES.items():
        out = out.when(hay.rlike(_any(words)), label)
    return out.otherwise(C.DEFAULT_TYPE)


def is_quota_error(c: Column) -> Column:
    return F.lower(text_or_empty(c)).rlike(_any(C.QUOTA_HINTS))


def ngram_repeat(words: Column, n: int) -> Column:
    """Whether a run of n words occurs twice in an array."""
    grams = F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.array_join(F.slice(words, i, F.lit(n)), " "))
    return F.when(F.size(words) >= n, F.size(grams) > F.size(F.array_distinct(grams))).otherwise(F.lit(False))


def is_nav_fragment(c: Column) -> Column:
    words = F.filter(F.split(text_or_empty(c), r"\s+"), lambda w: w != "")
    repeats = ngram_repeat(words, 3) | ngram_repeat(words, 4) | ngram_repeat(words, 5)
    return (F.char_length(text_or_empty(c)) <= 600) & (F.size(words) >= 12) & repeats
