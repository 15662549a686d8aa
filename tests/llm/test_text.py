"""Pieces, token files, languages, quality, decontamination, chats, pages."""

import random
import time
import zlib

import numpy as np
import oracle
import pyarrow as pa
import pytest
from edge_cases import EDGES, digest, prose
from hypothesis import given, settings, strategies as st

from docindex.llm import chat, common, decontaminate, language, pages, pieces, quality, queries, token_files
from docindex.workspace import work_dir

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=pieces.default_model())


def test_pieces_are_the_librarys(spark, edges, nothing, documents, library):
    for docs in (edges, documents):
        texts = {(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()}
        want = sorted(((i, library.encode(t)) for i, t in texts), key=repr)
        got = {(r.doc_id, tuple(r.ids)) for r in pieces.encode(docs).collect()}
        assert sorted(((i, list(x)) for i, x in got), key=repr) == want
    back = pieces.decode(pieces.encode(edges)).collect()
    assert {(r.doc_id, r.text) for r in back} == {(i, (t or "").replace(pieces.SPACE, " ")) for i, t in EDGES}
    assert pieces.round_trip(nothing).count() == 0


def test_round_trip(edges):
    rows = pieces.round_trip(edges).collect()
    assert len(rows) == len(EDGES) and all(r.exact for r in rows)
    lengths = sorted(len((t or "").replace(pieces.SPACE, " ").encode()) for _, t in EDGES)
    assert sorted(r.n_bytes for r in rows) == lengths


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("aeinorst hT.,\n▁é日\x00"), max_size=40))
def test_any_text_encodes_as_the_library_does(library, text):
    coder = pieces.coder(pieces.default_model())
    ids, counts = coder.encode(pa.array([text]))
    assert ids.tolist() == library.encode(text)
    assert coder.decode(ids, counts) == [text.replace(pieces.SPACE, " ").encode()]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("aeinorst hT.,\n▁é日"), max_size=30), max_size=6))
def test_long_units_are_relaxed_alike(library, texts):
    """Units above the length that is relaxed character by character, in stretches shorter than a piece."""
    coder = pieces.coder(pieces.default_model())
    coder.memory.forget()
    kept = pieces.LONG, pieces.MATCHED
    pieces.LONG, pieces.MATCHED = 4, 7
    try:
        ids, counts = coder.encode(pa.array(texts, pa.string()))
    finally:
        pieces.LONG, pieces.MATCHED = kept
    want = [library.encode(t) for t in texts]
    assert ids.tolist() == [i for w in want for i in w] and counts.tolist() == [len(w) for w in want]


@pytest.mark.parametrize("unit", ["thequickbrownfox", "a", "日本é"])
def test_units_of_a_million_characters(library, unit):
    import resource
    import time

    text = (unit * 1_000_000)[:1_000_000]
    coder = pieces.coder(pieces.default_model())
    before, started = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.monotonic()
    ids, _ = coder.encode(pa.array([text]))
    assert time.monotonic() - started < 40
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 400_000
    assert ids.tolist() == library.encode(text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*"aei  or\n\nst's\t.,12é\x00\x01\x0b\x1f\x85\u00a0\u2003\u3000", "<|endoftext|>", "<|", "ing the"]), max_size=30).map("".join), max_size=4))
def test_tokens_are_the_librarys(texts):
    encoder = token_files.encoder(token_files.default_vocabulary())
    ids, counts = encoder.encode(pa.array(texts, pa.string()))
    want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_token_files(spark, edges, nothing):
    folder = work_dir(spark, "test-tokens")
    token_files.write_tokens(edges, folder)
    tokenizer = token_files.encoder(token_files.default_vocabulary()).tokenizer
    ordered = sorted((i is not None, i or 0, (t or "").encode()) for i, t in EDGES)
    want = [(known, i, tokenizer.encode(t.decode(), add_special_tokens=False).ids + [0]) for known, i, t in ordered]
    rows = sorted(token_files.read_index(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [i if known else None for known, i, _ in want]
    assert [r.start for r in rows] == np.cumsum([0] + [len(x) for *_, x in want])[:-1].tolist()
    sums = sorted(((i if known else None, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for known, i, x in want), key=repr)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows), key=repr) == sums
    some = token_files.read_documents(spark, folder, [4, 9]).collect()
    assert {(r.doc_id, tuple(r.ids)) for r in some} == {(i, tuple(x)) for known, i, x in want if known and i in (4, 9)}
    assert token_files.token_index(nothing).count() == 0


def test_files_are_ordered_by_their_numbers(spark):
    names = [f"file:/f/part-{task:05d}-8c1-c{n:03d}.txt" for task in (0, 7, 99999, 100000) for n in (0, 999, 1000)]
    df = spark.createDataFrame([(n,) for n in reversed(names)], "path string")
    assert [r.path for r in df.orderBy(*token_files.file_order("path")).collect()] == names


def test_a_memory_is_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(common, "MEMORY_BYTES", 20_000)
    lengths = lambda keys: (np.array([len(k) for k in keys]), np.ones(len(keys), int))
    known = common.Known(np.int64, lengths)
    for k in range(200):
        values, counts = known.take(pa.array([f"word {k * j}" for j in range(10)] + ["x"]).dictionary_encode())
        assert values.tolist() == [len(f"word {k * j}") for j in range(10)] + [1] and set(counts.tolist()) == {1}
        assert known.size() < 40_000


def test_damaged_frames_are_seen():
    import struct

    frame, tokens, crc = next(token_files.frames(np.array([5, 6]), np.array([2])))
    good = token_files.sealed([frame], [(7, False, tokens, len(frame), crc)]) + token_files.ENDING.encode()
    assert [(i, x.tolist()) for _, i, x, _ in token_files.documents_of(good)] == [(7, [5, 6, 0])]
    wrong = token_files.sealed([frame], [(7, False, tokens, len(frame), crc ^ 1)]) + token_files.ENDING.encode()
    with pytest.raises(ValueError):
        list(token_files.documents_of(wrong))
    # Any reader of the format skips the table and sees the ids.
    import zstandard

    with zstandard.ZstdDecompressor().stream_reader(good, read_across_frames=True) as reader:
        assert struct.unpack("<3I", reader.read()) == (5, 6, 0)


def phrases_by_force(text: bytes, sample: bytes) -> int:
    count, at = 0, 0
    while at < len(text):
        n = 1
        while at + n < len(text) and text[at : at + n + 1] in sample and text[at : at + n] in sample:
            n += 1
        at, count = at + n, count + 1
    return count


@settings(max_examples=100, deadline=None)
@given(st.text("abc", min_size=1, max_size=30), st.text("abcd", min_size=1, max_size=40))
def test_phrases_are_longest_matches(sample, text):
    parser = language.Parser((("x", sample.encode()),))
    grid = parser.short[language.classes(np.frombuffer(text.encode(), np.uint8))][:, None]
    assert parser.phrases(grid)[0, 0] == phrases_by_force(text.encode(), sample.encode())


def test_languages(spark, edges, nothing):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = language.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 200 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)
    odd = [(r.doc_id, r.lang_pred) for r in language.languages(edges).collect()]
    assert len(odd) == len(EDGES)
    assert {i for i, name in odd if name == "und"} == {1, 2, 3, 18}
    assert {r.lang_pred for r in language.predict(edges, ()).collect()} == {"und"}
    assert language.languages(nothing).count() == 0


def test_quality(spark, edges, nothing):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = quality.quality(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    model = quality.fit(docs, labels)
    odd = quality.score(edges, model).collect()
    assert len(odd) == len(EDGES)
    stay = quality.without_rejected(edges, labels)
    assert stay.columns == edges.columns
    assert sorted(map(repr, (r.doc_id for r in stay.collect()))) == sorted(repr(r.doc_id) for r in odd if r.predicted)
    none = labels.where("false")
    assert {r.score for r in quality.quality(edges, none).collect()} == {0.5}
    assert quality.quality(nothing, labels).count() == 0


def windows_by_force(docs, items):
    def words(text):
        import re

        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)

    cut = [(i, [tuple(w[k : k + min(13, len(w))]) for k in range(max(1, len(w) - 12))]) for i, t in items if (w := words(t))]
    out = []
    for doc_id, text in docs:
        w = words(text)
        hit, listed = set(), set()
        for item, windows in cut:
            for window in windows:
                n = len(window)
                for k in range(len(w) - n + 1):
                    if tuple(w[k : k + n]) == window:
                        hit.update(range(k, k + n))
                        listed.add(str(item))
        names = ",".join(sorted(listed))
        out.append((doc_id, len(w), len(hit), len(listed), digest(names.encode()), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


ITEMS = [
    (1, prose(2, 40)), (2, prose(4, 30)), (3, "A b"), (4, "no ID, here!"), (5, None), (6, "..."), (7, prose(2, 13)), (8, prose(99, 50)), (7, prose(2, 13)),
    (10, "Σας ΑΣ"), (11, " ".join(["x"] * 20)),
]
MORE = [(30, "Σας, ΑΣ!"), (31, "y " + "x " * 30), (32, prose(2, 60)[:200].upper()), (33, prose(50, 300) + prose(2, 13))]


@pytest.mark.parametrize("few", [1_000_000, -1])
def test_contamination(spark, edges, nothing, monkeypatch, few):
    monkeypatch.setattr(decontaminate, "BROADCAST_PRINTS", few)
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", few)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = edges.select("doc_id", "text").unionByName(spark.createDataFrame(MORE, "doc_id long, text string"))
    got = sorted((tuple(r) for r in decontaminate.contamination(docs, items).collect()), key=repr)
    assert got == windows_by_force(EDGES + MORE, ITEMS)
    assert decontaminate.contamination(nothing, items).count() == 0
    none = decontaminate.contamination(edges, items.where("false")).collect()
    assert len(none) == len(EDGES) and not any(r.contaminated or r.n_hit for r in none)


def test_without_contaminated(spark, edges, nothing):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    stay = decontaminate.without_contaminated(edges, items)
    assert stay.columns == edges.columns
    bad = {(r[0], r[1]) for r in windows_by_force(EDGES, ITEMS) if r[5]}
    assert stay.count() == sum((i, n) not in bad for i, n, *_ in windows_by_force(EDGES, ITEMS))
    assert decontaminate.without_contaminated(nothing, items).count() == 0


@pytest.mark.parametrize("name", sorted(queries.REGISTRY.sql))
def test_sql(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    assert oracle.compare(spark, oracle.connect(sf_dir), queries.REGISTRY.queries[name], queries.REGISTRY.sql[name], sf_dir) is None


def test_chats(spark):
    talk = [("user", "hi"), ("assistant", "<|im_end|> yes"), ("user", "more"), ("assistant", "ok")]
    logged = [(c, k, *talk[k]) for c, n in ((1, 2), (2, 4), (3, 4), (4, 1), (None, 4)) for k in range(n)]
    logged += [(5, 0, "user", "hi"), (5, 1, "assistant", "no"), (5, 1, "assistant", "no"), (6, None, None, None), (7, 0, "userh", "i")]
    frame = spark.createDataFrame([(*r, "x", 1) for r in logged], "conv_id long, turn long, role string, text string, end string, n_turns int")
    rows = {r.conv_id: (r.n_turns, r.text) for r in chat.chats(frame).collect()}
    assert set(rows) == {2, 5, 6, 7}
    assert rows[2][0] == 4 and rows[2][1].startswith("<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\n< |im_end|> yes<|im_end|>\n")
    assert rows[5][0] == 2 and rows[6] == (1, "<|im_start|>unknown\n<|im_end|>\n")
    assert chat.chats(frame.where("false")).count() == 0


BODY = "".join(f"<p>{prose(k, 40)}, {prose(k + 50, 20)}.</p>" for k in range(4))
TEXT = "\n".join(f"{prose(k, 40)}, {prose(k + 50, 20)}." for k in range(4))


@pytest.mark.parametrize("source, text", [
    (None, ""), ("", ""), ("<p></p><br>", ""), ("plain  text &lt;here", "plain text <here"),
    (f"<nav><ul><li><a href=/a>Menu one, two, three</a></ul></nav><article><h1>Title</h1>{BODY}</article><footer>&copy; x</footer>", "Title\n" + TEXT),
    (f"<div class='post-content'>{BODY}</div><div class='sidebar'><p>{prose(9, 80)}</p></div><div id=comments><p>{prose(8, 90)}, so</p></div>", TEXT),
    (f"<div>{BODY}<form><p>{prose(7, 50)}</p></form><ul><li><a href=x>{prose(6, 9)}</a><li><a href=y>more</a></ul></div>", f"{TEXT}\n{prose(6, 9)}\nmore"),
    (f"<body>{BODY}<ul><li><a href=x>{prose(6, 9)}</a><li><a href=y>more</a></ul>", TEXT),
    (f"<article>{BODY}<noscript><p>no script</p></noscript><div class=related-work><p>Related</p></div><p class='search-results'>Found</p>"
     "<table><tr><td><a href=x>linked</a></table></article>", TEXT + "\nno script\nRelated\nFound\nlinked"),
    (f"<main><article>{BODY}<div class='comment-list'><p>So, so, so</p></div><ol class=comments><li>x</ol><article class=comment><p>Well</p></article>"
     f"<div class='ad-slot'>Buy</div><div class='cookie-notice wide'>Eat</div><section class='section-header'>Part</section></article></main>", TEXT + "\nPart"),
    (f"<noscript>Enable it, {prose(4, 60)}</noscript><div class='search-box'><p>{prose(3, 60)}</p></div><article>{BODY}</article>", TEXT),
    (f"<body class='with-sidebar'><div class='cookie-notice'>We, use, cookies, {prose(3, 40)}</div><main>{BODY}<!-- {prose(2, 9)} --></main>", TEXT),
    (f"<article>{BODY}<script>if (a < b) document.write('<p>x</p>')</script><style>p{{}}</style><p>cut &am", TEXT + "\ncut &am"),
    (f"<article>{BODY}<p><b>bold<br>line<p>next <a title='a > b' href=z>li nk</a> &#233;&nbsp;!</article>", TEXT + "\nbold line\nnext li nk é !"),
    ("<div>" * 3000 + f"<p>{prose(1, 60)}</p>", prose(1, 60)),
])
def test_main_text(source, text):
    assert pages.main_text(source) == text


class Walked(pages.Page):
    """The tree by walks over all open elements."""

    def _close_implied(self, tag):
        ends = pages.CLOSES.get(tag, ())
        for place in range(len(self._open) - 1, 0, -1):
            name = self.tags[self._open[place]]
            if name == "p" or name in ends:
                self._cut(place)
                if name in ends and tag != "tr":
                    return
            elif name not in pages.INLINE:
                return

    def _end(self, tag):
        if tag not in pages.INLINE:
            self._flush()
        for place in range(len(self._open) - 1, 0, -1):
            name = self.tags[self._open[place]]
            if name == tag:
                return self._cut(place)
            if tag in pages.INLINE and name not in pages.INLINE:
                return None


def test_trees_equal_walked_ones():
    rng = random.Random(5)
    names = "p b a li ul td tr table div article section nav dt dd".split()
    for _ in range(300):
        parts = [rng.choice(["<{}>", "</{}>", "<{} class=x>", "<{}/>", "{}, words", " "]).format(rng.choice(names)) for _ in range(rng.randrange(80))]
        source = "".join(parts)
        page, walked = pages.Page(source), Walked(source)
        assert (page.tags, page.parents, page.blocks, page.points) == (walked.tags, walked.parents, walked.blocks, walked.points)
        assert page.main_text() == walked.main_text()


@pytest.mark.parametrize("source", [
    "<div>" * 100_000 + "</x>" * 100_000, "<b>" * 100_000 + "<p>x" * 150_000, "<b>" * 100_000 + "<div>" + "</b>" * 100_000 + "x",
    "<script " * 125_000, "<a href='" * 110_000 + '"', "<ul><li>" * 120_000, "<!-- " * 200_000, "&amp" * 250_000, "<td><table>" * 90_000,
])
def test_pages_of_a_megabyte(source):
    started = time.monotonic()
    pages.main_text(source)
    assert time.monotonic() - started < 20


def test_captions_stay():
    figure = f"<figure><img src=a><figcaption>{prose(5, 12)}</figcaption></figure>"
    assert pages.main_text(f"<article>{BODY}{figure}{BODY}</article>") == f"{TEXT}\n{prose(5, 12)}\n{TEXT}"


def test_extract(spark):
    rows = [(1, "u", None, "x"), (None, None, "<p>a  b</p>", "y"), (1, "u", None, "x"), (2, "v", f"<article>{BODY * 300}</article>", "z")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((tuple(r) for r in pages.extract(frame).collect()), key=repr)
    long = "\n".join([TEXT] * 300)
    assert got == sorted([(1, "u", "", 0), (1, "u", "", 0), (None, None, "a b", 3), (2, "v", long, len(long))], key=repr)
    assert pages.extract(frame.where("false")).count() == 0


