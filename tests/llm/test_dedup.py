"""Suffix-array dedup, exact dedup, near dedup: against brute force."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from edge_cases import EDGES, digest
from docindex.llm import exact_dedup, induced, near_dedup, suffix_dedup


def repeated_by_force(pairs):
    texts = [(i, (t or "").encode()) for i, t in pairs]
    n = suffix_dedup.LENGTH
    times = Counter(b[k : k + n] for _, b in texts for k in range(len(b) - n + 1))
    out = []
    for i, b in texts:
        hit = np.zeros(len(b) + 2, int)
        for k in range(len(b) - n + 1):
            if times[b[k : k + n]] > 1:
                hit[k + 1] += 1
                hit[k + n + 1] -= 1
        cover = np.cumsum(hit)[1 : len(b) + 1] > 0
        spans = int((np.diff(cover.astype(int), prepend=0) == 1).sum())
        rest = bytes(np.frombuffer(b, np.uint8)[~cover])
        out.append((i, len(b), int(cover.sum()), spans, digest(rest), rest.decode(errors="ignore")))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [3000, 1])
def test_suffix_dedup(spark, edges, nothing, documents, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    got = sorted((tuple(r) for r in suffix_dedup.cleaned(edges).collect()), key=repr)
    assert got == repeated_by_force(EDGES)
    pairs = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in suffix_dedup.cleaned(documents).collect()), key=repr) == repeated_by_force(pairs)
    assert suffix_dedup.cleaned(nothing).count() == 0


def test_hot_hashes_by_number_and_by_bytes(spark):
    sizes = [(1, 200, suffix_dedup.PASSAGE), (2, 200, 1), (3, suffix_dedup.HOT + 1, 1)]
    rows = [(key, (k, 0, 0, strings)) for key, n, strings in sizes for k in range(n)]
    distinct = spark.createDataFrame(rows, "key long, of struct<doc_id: long, text_print: long, start: int, strings: int>")
    assert {r.key: r.hot for r in suffix_dedup._hot(distinct).collect()} == {1: True, 2: False, 3: True}


def test_suffix_dedup_of_long_passages_with_one_hash(spark, monkeypatch):
    """Runs of one letter in many lengths have one hash; counted string by string they give the same."""
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 5_000)
    pairs = [(k, "z" * (500 + 37 * k) + f" end {k}") for k in range(20)]
    got = sorted((tuple(r) for r in suffix_dedup.cleaned(spark.createDataFrame(pairs, "doc_id long, text string")).collect()), key=repr)
    assert got == repeated_by_force(pairs)


@pytest.mark.parametrize("period", [352, 353, 354])
def test_suffix_dedup_of_one_period(spark, period):
    """A block that is repeated back to back in one document only."""
    block = "".join(map(chr, np.random.default_rng(period).integers(97, 123, period)))
    pairs = [(1, block * 3), (2, block[:200] + "x" + block[200:])]
    got = suffix_dedup.cleaned(spark.createDataFrame(pairs, "doc_id long, text string")).collect()
    assert sorted((tuple(r) for r in got), key=repr) == repeated_by_force(pairs)
    assert got[0].n_removed + got[1].n_removed == 3 * period


@settings(max_examples=60, deadline=None)
@given(st.text("ab", max_size=40), st.integers(1, 4))
def test_suffix_array(text, times):
    data = text.encode() * times
    array = induced.suffix_array(np.frombuffer(data, np.uint8), len(data) + 1).tolist()
    assert array == sorted(range(len(data)), key=lambda i: data[i:])


def test_passages_cover_every_string_once():
    data = np.random.default_rng(1).integers(97, 99, 3000).astype(np.uint8)
    borders = np.array([0, 399, 800, 800, 3000])
    row, start, strings, *_ = suffix_dedup.passages(data, borders)
    got = sorted((r, s + k) for r, s, n in zip(row.tolist(), start.tolist(), strings.tolist()) for k in range(n))
    assert got == [(r, k) for r in range(4) for k in range(borders[r + 1] - borders[r] - 399)]


def exact_by_force(pairs):
    groups = defaultdict(list)
    for i, t in pairs:
        body = (t or "").encode().translate(None, exact_dedup.BLANK)
        groups[body].append((-len(t or ""), i is None, i or 0))
    out = []
    for body, members in groups.items():
        best = min(members)
        stays = None if best[1] else best[2]
        out += [(None if n else i, stays, len(members), digest(body)) for _, n, i in members]
    return sorted(out, key=repr)


def test_exact_groups(edges, nothing):
    rows = exact_dedup.exact_groups(edges).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=repr) == exact_by_force(EDGES)
    # Exactly one row of each group stays, the one that is named.
    kept = [r for r in rows if r.kept]
    assert len(kept) == len({r.text_sha256 for r in rows})
    assert all(r.doc_id == r.keep_id for r in kept)
    assert exact_dedup.exact_groups(nothing).count() == 0


def test_without_copies(edges, nothing):
    stay = exact_dedup.without_copies(edges)
    assert stay.columns == edges.columns
    bodies = [(t or "").encode().translate(None, exact_dedup.BLANK) for t in [r.text for r in stay.collect()]]
    assert len(bodies) == len(set(bodies)) == len({(t or "").encode().translate(None, exact_dedup.BLANK) for _, t in EDGES})
    assert exact_dedup.without_copies(nothing).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=50))
def test_rice_codes(values):
    values = np.unique(np.array(values, np.uint64))
    shift, code = exact_dedup.rice_encode(values)
    assert exact_dedup.rice_decode(shift, code, len(values)).tolist() == values.tolist()


def near_by_force(pairs):
    hasher = near_dedup.Hasher()
    words, counts = hasher.words([t or "" for _, t in pairs])
    shingles, numbers = near_dedup.labelled(words, counts)
    parts = np.split(shingles, np.cumsum(numbers)[:-1])
    group = list(range(len(pairs)))

    def head(k):
        while group[k] != k:
            k = group[k]
        return k

    for a in range(len(pairs)):
        for b in range(a):
            same = len(parts[a]) == len(parts[b]) == 0 or len(parts[a]) and len(parts[b]) and near_dedup.similar(parts[a], parts[b])
            if same:
                group[head(a)] = head(b)
    members = defaultdict(list)
    for k, (i, _) in enumerate(pairs):
        members[head(k)].append(i)
    return sorted((sorted(m, key=lambda i: (i is None, i or 0)) for m in members.values() if len(m) > 1), key=repr)


def classes(rows):
    members = defaultdict(list)
    for r in rows:
        members[r.class_id, r.class_size].append(r.doc_id)
    assert all(len(m) == size for (_, size), m in members.items() if members)
    return sorted((sorted(m, key=lambda i: (i is None, i or 0)) for m in members.values() if len(m) > 1), key=repr)


def test_near_classes(spark, edges, nothing, documents):
    pairs = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert classes(near_dedup.near_classes(documents).collect()) == near_by_force(pairs)
    rows = near_dedup.near_groups(edges).collect()
    want = near_by_force(EDGES)
    got = defaultdict(list)
    for r in rows:
        got[r.class_id, r.class_size, r.doc_id is None and r.text_print].append(r.doc_id)
    assert [11, 12, 13] in want and sorted(got[11, 3, False]) == [11, 12, 13]
    assert sorted(got[6, 2, False]) == [6, 7] and sorted(got[1, 3, False]) == [1, 2, 3]
    assert near_dedup.near_classes(nothing).count() == 0


def test_one_of_each(edges, nothing):
    stay = near_dedup.one_of_each(edges)
    assert stay.columns == edges.columns
    ids = sorted((r.doc_id for r in stay.collect()), key=repr)
    assert ids.count(5) <= 1 and ids.count(None) == 1 and 12 not in ids and 11 in ids and ids.count(15) == 2
    assert near_dedup.one_of_each(nothing).count() == 0


def test_hot_group_of_near_copies(spark):
    """A large group costs comparisons in proportion to its size, and is found whole."""
    base = EDGES[16][1].split()
    texts = [(k, " ".join(base[:k % 290] + [f"edit{k}"] + base[k % 290 + 1 :])) for k in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = near_dedup.near_classes(docs).collect()
    assert {(r.class_id, r.class_size) for r in rows} == {(0, 400)}


def test_near_copies_with_few_equal_sketches(spark):
    """Similar pairs that have only two sketches in common."""
    texts = []
    for mark, at in (("s39k47w", 22), ("s16k203w", 22)):
        words = [f"{mark}{j}" for j in range(60)]
        texts += [" ".join(words), " ".join(words[:at] + ["edit"] + words[at + 1 :])]
    assert len(near_by_force(list(enumerate(texts)))) == 2
    shingles, numbers = near_dedup.labelled(*near_dedup.Hasher().words(texts))
    found = [set(x) for x in near_dedup.sketches(shingles, numbers).tolist()]
    assert [len(found[k] & found[k + 1]) for k in (0, 2)] == [2, 2]
    docs = spark.createDataFrame(enumerate(texts), "doc_id long, text string")
    assert classes(near_dedup.near_classes(docs).collect()) == [[0, 1], [2, 3]]


@pytest.mark.parametrize("share", [1.0, 0.0])
def test_near_copies_hidden_in_a_crowd(spark, monkeypatch, share):
    """Texts of one template, nearly all pairs just below the threshold: those above it are all found."""
    monkeypatch.setattr(near_dedup, "JOINS", share)
    chance = np.random.default_rng(7)
    texts = []
    for k in range(240):
        words = [f"w{j}" for j in range(300)]
        for j in chance.choice(300, int(chance.integers(5, 7)), replace=False):
            words[j] = f"own{k}x{j}"
        texts.append((k, " ".join(words)))
    want = near_by_force(texts)
    assert len(want) > 1 and max(map(len, want)) < 120
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    assert classes(near_dedup.near_classes(docs).collect()) == want


def test_components(spark):
    links = spark.createDataFrame([(bytes([a]), bytes([a + 1])) for a in range(40) if a != 20], "a binary, b binary")
    got = {r.node[0]: r.group[0] for r in near_dedup.components(links).collect()}
    assert got == {k: 0 if k <= 20 else 21 for k in range(41)}
