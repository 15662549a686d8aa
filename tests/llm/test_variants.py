"""Spelling variants against all pairs of words."""

import collections
import random
import re
import time
import zlib

import numpy as np
import pytest
from edge_cases import EDGES, SCHEMA, rows
from hypothesis import given, settings, strategies as st

from docindex.llm import variants


def near(a, b):
    """One code point inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def by_force(docs):
    count = collections.Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 7 and c >= 2}
    around = {w: [v for v in n if near(v, w)] for w in n}
    form = {}
    for w, others in around.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(around[w]), n.get(form[w])))
    return sorted(out, key=repr)


def mutated(rng, word):
    k = rng.randrange(len(word) + 1)
    return rng.choice([word[:k] + rng.choice("abÿ") + word[k:], word[:k] + word[k + 1 :], word[:k] + rng.choice("abÿ") + word[k + 1 :]])


def dense(seed):
    """Few letters, many neighbours, chains of forms and runs of one letter."""
    rng = random.Random(seed)
    words = ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "abababab", "babababa", "Wörtchenß"]
    for _ in range(60):
        words.append(mutated(rng, rng.choice(words)))
    docs = [(k, " ".join(rng.choice(words) + "." * rng.randrange(2) for _ in range(rng.randrange(60)))) for k in range(60)]
    chain = "Abcdefgh abcdefgx abcdefyx abcdexyx".split()
    return docs + [(100 + k, f"{word} " * times) for k, (word, times) in enumerate(zip(chain, (4000, 300, 25, 2)))] + [(None, "aaaaaaa×÷ aaaaaaa"), (None, None)]


@pytest.mark.parametrize("grams,limit", [(20_000, 8), (20_000, 0), (0, 8), (6, 1)])
def test_variants(spark, monkeypatch, grams, limit):
    """With any dictionary, from none to all grams."""
    monkeypatch.setattr(variants, "LIMIT", limit)
    docs = dense(grams + limit)
    df = spark.createDataFrame(rows(docs), SCHEMA).repartition(3)
    assert sorted(map(tuple, variants.variants(df, grams).collect()), key=repr) == by_force(docs)


def test_odd_and_no_documents(spark, edges, nothing):
    got = sorted(map(tuple, variants.variants(edges).collect()), key=repr)
    assert got == by_force(EDGES) and any(r[0] == "a" * 3000 for r in by_force(EDGES + [(90, "a" * 3000)]))
    assert variants.variants(nothing).count() == 0


WORD = st.text("ab", min_size=7, max_size=13)


@settings(max_examples=200, deadline=None)
@given(WORD, st.integers(0, 13), st.sampled_from("abc"), st.sampled_from(["put", "cut", "set"]), st.sets(st.text("abc\x02\x03", min_size=2, max_size=3)))
def test_an_edit_leaves_a_key(word, k, c, kind, grams):
    """Whatever the dictionary, a word and its edit meet at the edit's place, and no more grams than the bound are lost."""
    k = min(k, len(word) - 1)
    other = {"put": word[:k] + c + word[k:], "cut": word[:k] + word[k + 1 :], "set": word[:k] + c + word[k + 1 :]}[kind]
    if other == word or not near(word, other):
        return
    closed = set(grams) | {g[:2] for g in grams}
    dictionary = variants.Dictionary(sorted(closed))
    texts = [variants.FRONT + w + variants.BACK for w in (word, other)]
    points = np.array([ord(x) for t in texts for x in t])
    owner, place, own, keys, bound = variants.merged_keys(points, np.array([len(t) for t in texts]), dictionary)
    of = [{(int(key), bool(o)) for w, o, key in zip(owner, own, keys) if w == which} for which in (0, 1)]
    shared = [(a, b) for key, a in of[0] for other_key, b in of[1] if key == other_key]
    if len(word) == len(other):
        assert (True, True) in shared
    else:
        longer = len(other) > len(word)
        assert ((False, True) if longer else (True, False)) in shared
    assert bound.max() <= variants.LONGEST


def test_long_words_in_time():
    text = variants.FRONT + "ab" * 500_000 + variants.BACK
    started = time.monotonic()
    variants.merged_keys(np.array([ord(c) for c in text]), np.array([len(text)]), variants.Dictionary(["ab", "aba"]))
    assert time.monotonic() - started < 20
