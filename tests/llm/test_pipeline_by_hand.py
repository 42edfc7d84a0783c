"""The whole pipeline against its rules done by hand, one document after the other."""

import re
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def calm(spark, docs, labels):
    """Documents whose score, each alone, is below a half."""
    from newsloom.llm import op1_toxicity as m

    model = m.train(docs, labels)
    features = m.Features(model.cost, model.weights)
    return [(d, t) for d, t in ((r.doc_id, r.text) for r in docs.collect()) if model.score(features, t or "") < 0.5]


def distinct(docs):
    kept = {}
    for d, t in sorted(docs, key=lambda x: x[0]):
        kept[(t or "").translate(LOW)] = (d, t)
    return list(kept.values())


def apart(docs):
    sets = {}
    for d, t in docs:
        words = re.findall("[^ \t\n\x0b\x0c\r]+", (t or "").translate(LOW))
        sets[d] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return [(d, t) for d, t in docs if find(d) == d]


def clean(docs, items):
    windows = set()
    for t in items:
        words = WORD.findall((t or "").translate(LOW))
        windows |= {tuple(words[i : i + 10]) for i in range(max(1, len(words) - 9))} if words else set()
    sizes = {len(w) for w in windows}
    for d, t in docs:
        found = list(WORD.finditer((t or "").translate(LOW)))
        words, hit = [m.group() for m in found], set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) in windows:
                    hit.update(range(i, i + n))
        if len(hit) > 0.5 * len(words):
            continue
        runs = []
        for i in sorted(hit):
            if runs and runs[-1][1] == i:
                runs[-1][1] = i + 1
            else:
                runs.append([i, i + 1])
        for a, b in reversed(runs):
            t = t[: found[a].start()] + t[found[b - 1].end() :]
        yield d, t


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_pipeline_by_hand(spark, sf):
    from tokenizers import Tokenizer

    import corpus_pipeline as cp
    from newsloom.llm.tokens import vocabulary_path

    at = f"/root/testdata/{sf}"
    read = lambda t: spark.read.parquet(f"{at}/{t}.parquet")
    ids = [r.doc_id for r in read("documents").select("doc_id").collect()]
    assert len(ids) == len(set(ids))  # so that rows can be named by their id here
    left = calm(spark, read("documents"), read("labels"))
    assert 0 < len(left) < len(ids)
    for stage in (distinct, apart, lambda x: list(clean(x, [r.text for r in read("benchmark").collect()]))):
        before, left = left, stage(left)
        assert left != before and len(left) <= len(before)  # each stage drops some, or cuts their texts
    enc = Tokenizer.from_file(vocabulary_path())
    want = {d: [*enc.encode(t or "", add_special_tokens=False).ids, 2] for d, t in left}

    pieces, room = defaultdict(list), defaultdict(list)
    for r in cp.run(spark, at).collect():
        pieces[r.doc_id].append(r)
        room[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(want)
    for d, whole in want.items():
        end = 0
        for r in sorted(pieces[d], key=lambda r: r.start):
            assert r.start == end and r.doc_tokens == len(whole)
            end += r.length
            assert r.ids_crc32 == zlib.crc32(np.array(whole[r.start : end], "<u4").tobytes())
        assert end == len(whole)
    for parts in room.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 4096
    total = sum(map(len, want.values()))
    assert len(room) <= -(-total // 4096) + 1  # next to no padding
