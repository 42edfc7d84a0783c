"""Cleaning of page residue: against a plain version of its rules, and in linear time."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from newsloom.functions import residue as R
from newsloom.functions import text as X

PIECES = [
    "\n", " ", "\t", " ", "  \n ", "Loading…", "Loading... ", "Share ", "Share The end. ", "Contents ", "On this page ", "| ", "—", "· ", ">", "word ", "Long ", "a. ", ':last-child]:mb-0"> ', 'flex x"> ', "\nRelated ", "\n \nRead more ",
    "Related", "one two three four five ", "one two three four five one two three four five six seven ", " (opens in a new window)", "opens in new tab ) ", "( ( opens  in\na new tab", "（在新窗口打开）", "( 在新标签页打开 ) ", "⁠", "text " * 40,
]


def looping(words):
    return [i + n for n in (3, 4, 5) for i in range(len(words) - n + 1) if any(words[j : j + n] == words[i : i + n] for j in range(i))]


def plainly(text):
    """The rules one by one, with no eye on time."""
    text = re.sub("[⁠﻿​]", "", text)
    text = re.sub(r"(?i)\s*\(?\s*opens?\s+in\s+(?:a\s+)?new\s+(?:window|tab)\s*\)?", "", text)
    for middle in ("窗口(?:中)?", "标签页?中?"):
        text = re.sub(rf"\s*[（(]\s*在新{middle}打开\s*[）)]", "", text)
    now = text
    for _ in range(4):
        before = now
        now = re.sub(r"^[\s:;,.\[\]\w-]{0,60}(?:last-child|first-child|mb-\d|mt-\d|px-\d|py-\d|flex|grid|text-)[\s\S]{0,50}?\">\s*", "", now)
        now = re.sub(r"^(?:Loading…?|Loading\.\.\.|加载中…?)\s*", "", now)
        if re.match(r"(?:Share|Contents|Table of contents|On this page)\b", now):
            words = now.split()
            end = max(looping(words[:80]), default=0)
            head = " ".join(words[:end])
            if len(words) >= 20 and 8 <= end < len(words) - 8 and not re.search("[.。!！?？]", head) and len(head) / end <= 12:
                now = " ".join(words[end:])
        now = re.sub(r"^Share\s+(?=[A-Z一-鿿])", "", now)
        now = re.sub(r"[\s|·—–]+$", "", re.sub(r"^[\s|·—–>]+", "", now))
        if now == before:
            break
    tail = re.search(r"\n\s*(?:Share|Related|Read more|Explore more|Next article)\b[\s\S]{0,200}$", now)
    if tail and len(tail.group()) <= 600 and len(tail.group().split()) >= 12 and looping(tail.group().split()):
        now = now[: tail.start()].rstrip()
    return (text if len(now) < 0.7 * len(text) else now).strip()


def test_residue_against_the_plain_rules(spark):
    rnd = random.Random(6)
    texts = ["".join(rnd.choices(PIECES, k=rnd.randint(1, 9))) for _ in range(3000)]
    texts += [t + "text " * 60 + "".join(rnd.choices(PIECES, k=4)) for t in texts[:1500]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: (r.a, r.b) for r in df.select("i", R.clean_web_junk(F.col("t")).alias("a"), R.strip_tags(F.col("t")).alias("b")).collect()}
    changed = 0
    for i, t in enumerate(texts):
        assert got[i][0] == plainly(t), repr(t)
        tight = re.sub("\n{3,}", "\n\n", re.sub("[ \t ]+", " ", re.sub("<[^>]+>", " ", t))).strip()
        assert got[i][1] == plainly(tight), repr(t)
        changed += plainly(t) != t.strip()
    assert changed > 1000


MIXES = ["\n", " ", "\t", "\n ", " \n\t", "  ", "　", "( ", "(", "opens ", "\nShare ", "| ", "<", "&", "\n|"]


@pytest.mark.parametrize("clean", [R.plain, R.without_residue])
@pytest.mark.parametrize("mix", MIXES)
def test_a_megabyte_of_a_mix_takes_no_time(clean, mix):
    began = time.process_time()
    clean("a" + mix * (1_000_000 // len(mix)) + "b")
    assert time.process_time() - began < 3


def test_columns_are_linear_too(spark):
    """Ten times the text takes no hundred times as long (the rules took 22 s for 2 KB once)."""
    texts = ["a" + mix * (300_000 // len(mix)) + "b" for mix in MIXES]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(8).cache()
    df.count()
    began = time.time()
    df.select(F.max(F.char_length(R.strip_tags(F.col("t")))), F.max(F.char_length(R.clean_web_junk(F.col("t")))), F.max(F.char_length(X.strip_inline_ui(F.col("t"))))).collect()
    assert time.time() - began < 60


def test_texts_without_notes_are_spared_the_patterns(spark):
    """The patterns alone took several times as long."""
    df = spark.createDataFrame([("plain words of no note " * 8000,)] * 16, "t string").repartition(8).cache()
    df.count()
    patterns = F.col("t")
    for note in X.INLINE_NOTES:
        patterns = F.regexp_replace(patterns, note, "")

    def seconds(c):
        best = 99
        for _ in range(3):
            began = time.time()
            df.select(F.sum(F.crc32(c.cast("binary")))).collect()
            best = min(best, time.time() - began)
        return best

    assert seconds(X.strip_inline_ui(F.col("t"))) < 0.7 * seconds(patterns)
    for text, want in (("a o\u200bpens in new tab b", "ab"), ("a OPEN in a new window b", "ab"), ("a （在新窗口打开） b", "a b")):
        assert spark.createDataFrame([(text,)], "t string").select(X.strip_inline_ui(F.col("t")).alias("t")).first().t == want
