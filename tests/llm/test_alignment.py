"""Alignment of two tokenizers against a walk over both token lists of one document at a time."""

import collections
import hashlib

import pyarrow as pa
import pytest
import public_tokenizers
from edge_cases import EDGES, SCHEMA, rows

from docindex.llm import alignment


def spans(ids, values):
    out, at = [], 0
    for i, v in zip(ids, values):
        out.append((i, at, at + len(v)))
        at += len(v)
    return out


def by_force(docs):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_side.encode_special_tokens = True
    b_side = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = alignment.byte_letters()
    each, counts = [], collections.Counter()
    for doc_id, text in docs:
        each.append((doc_id, None))
        if not text:
            continue
        a = a_side.encode(" " + text, add_special_tokens=False)
        b = b_side.encode(text)
        names = [b_side.id_to_piece(i) for i in b]
        a_bytes = [bytes(letters[c] for c in t) for t in a.tokens]
        b_bytes = [bytes([int(s[3:5], 16)]) if b_side.is_byte(i) else s.replace("▁", " ").encode() for i, s in zip(b, names)]
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            continue
        x, y = spans(a.ids, a_bytes), spans(b, b_bytes)
        links, low = [], 0
        for i, start, stop in x:
            while y[low][2] <= start:
                low += 1
            k = low
            while k < len(y) and y[k][1] < stop:
                links.append((i, y[k][0]))
                k += 1
        groups = []
        for end in sorted({e for *_, e in x} & {e for *_, e in y}):
            start = groups[-1][0] if groups else 0
            sides = [",".join(str(i) for i, s, e in z if start <= s and e <= end) for z in (x, y)]
            groups.append((end, "|".join(sides)))
        text = ";".join(g for _, g in groups)
        each[-1] = (doc_id, (len(x), len(y), len(groups), links, hashlib.sha256(text.encode()).hexdigest()))
        counts.update(set(links))
    best = collections.defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    out = []
    for doc_id, r in each:
        if r is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, n_groups, links, digest = r
            out.append((doc_id, n_a, n_b, n_groups, len(links), sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links), digest))
    return sorted(out, key=repr)


SHORT = [(i, t) for i, t in EDGES if t is None or len(t) < 5000] + [
    (30, "<|endoftext|> in a text"), (31, "<s> </s> <unk> <0x0A>"), (32, " "), (33, "two  spaces, and\ttabs\n"), (34, "naïve café — “quotes” 中文 🙂🙂"), (35, "ﬁ ½ é"),
]


@pytest.mark.parametrize("frequent", [1 << 18, 40, 0])
def test_alignment(spark, frequent):
    """Counts through the broadcast alone, through both ways, and through the join alone."""
    docs = spark.createDataFrame(rows(SHORT), SCHEMA).repartition(3)
    assert sorted(map(tuple, alignment.alignment(docs, frequent=frequent).collect()), key=repr) == by_force(SHORT)


def test_given_documents(spark, documents):
    some = documents.where("length(text) < 6000")
    got = sorted(map(tuple, alignment.alignment(some, frequent=1000).collect()), key=repr)
    assert got == by_force([(r.doc_id, r.text) for r in some.collect()])


def test_nothing(spark, nothing):
    assert alignment.alignment(nothing).count() == 0


def test_batches_of_any_size_count_alike(spark, monkeypatch):
    docs = spark.createDataFrame(rows(SHORT), SCHEMA).repartition(2).cache()
    want = sorted(map(tuple, alignment.alignment(docs).collect()), key=repr)
    for size in (1, 300):
        monkeypatch.setattr(alignment, "BATCH_TEXT", size)
        assert sorted(map(tuple, alignment.alignment(docs).collect()), key=repr) == want


def test_least_count_of_frequent_pairs(spark):
    counts = [1] * 50 + [2] * 20 + [300] * 7 + [70_000] * 3 + [70_001]
    df = spark.createDataFrame([(k, n) for k, n in enumerate(counts)], "pair long, n long")
    for most in (0, 1, 3, 4, 5, 11, 12, 30, 31, 32, 80, 81, 1000):
        least = alignment.frequent_from(df, most)
        kept = sum(n >= least for n in counts)
        assert kept <= most
        lower = [n for n in counts if n < least]
        assert not lower or sum(n >= max(lower) for n in counts) > most


def test_a_long_text_without_spaces():
    a, b = alignment.default_tokenizers()
    out = alignment.align(pa.array(["ab" * 200_000, "", "x"]), a, b)
    assert out["n_a"].to_pylist()[1:] == [0, 1] and out["n_a"][0].as_py() + out["n_b"][0].as_py() - out["n_groups"][0].as_py() == out["n_links"][0].as_py()
