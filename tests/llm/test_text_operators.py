"""SentencePiece coding, token files, language identification and HTML text."""

from __future__ import annotations

import itertools
import zlib
from html.parser import HTMLParser

import numpy as np
import pytest
from helpers import documents, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlens.llm import html_text, language_id, memo, pieces, simple8b, token_files
from ledgerlens.llm.queries import vocabulary_path

MODEL = vocabulary_path("piece_bpe_32k.model")
TEXTS = [None, "", " ", "a", "naïve café\n\nzwei  Worte", "日本語 🎉\x00", "▁mark ▁▁", "x" * 3_000, " ".join(prose(1, 20_000))]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcdeinorst  \n\t.,éß日🎉▁<>/[]0123456789", max_size=60))
def test_encoding_and_decoding_equal_the_library(library, text):
    model = pieces.load_model(MODEL)
    ids = [i for chunk in model.chunks(text) for i in model.encode_chunk(chunk)]
    assert ids == library.encode(text)
    assert model.decode(ids) == library.decode(ids)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31_999)), max_size=20))
def test_any_ids_decode_like_the_library(library, ids):
    assert pieces.load_model(MODEL).decode(ids) == library.decode(ids)


def test_pieces_of_a_table(spark, library):
    docs = documents(spark, enumerate(TEXTS), ids="clash", decoded="clash")
    rows = pieces.decode_pieces(pieces.encode_pieces(docs, MODEL), MODEL).collect()
    assert len(rows) == len(TEXTS)
    for row in rows:
        want = library.encode(TEXTS[row.doc_id] or "") + [2]
        assert row.ids == want and row.decoded == library.decode(want)
    assert pieces.encode_pieces(docs.limit(0), MODEL).count() == 0
    twice = pieces.encode_pieces(docs.union(docs), MODEL)
    assert twice.count() == 2 * len(TEXTS)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=80), max_size=6))
def test_simple8b_round_trip(streams):
    values = np.array([v for s in streams for v in s], dtype=np.uint64)
    sizes = simple8b.block_sizes(np.array([len(s) for s in streams], dtype=np.int64))
    words, counts = simple8b.encode(values, sizes)
    assert simple8b.decode(words, counts, sizes).tolist() == values.tolist()


def test_token_files_read_back(spark):
    from tokenizers import Tokenizer

    path = vocabulary_path("byte_bpe_50k.json")
    texts = [*TEXTS, "it's  <|endoftext|> \t tab", "line\nline two.", "a \n b\n"]
    ids = [7, 3, 12, 40, 1, 9, 30, 2, 100, 41, 42, 43]
    docs = documents(spark, [*zip(ids, texts, strict=True), (3, "again"), (None, "nameless")], start=1, n_tokens=2)
    read = token_files.read_tokens(spark, token_files.token_store(docs, path)).orderBy("start").collect()
    tokenizer = Tokenizer.from_file(path)
    want = sorted((i, tokenizer.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in zip(ids, texts, strict=True))
    assert [r.doc_id for r in read] == [None, 1, 2, 3, 3, *sorted(i for i in ids if i > 3)]
    assert [r.start for r in read] == [0, *itertools.accumulate(len(r.ids) for r in read)][:-1]
    once = {r.doc_id: r.ids for r in read if r.doc_id not in (None, 3)}
    assert once == {i: v for i, v in want if i != 3}
    assert zlib.crc32(np.array(read[0].ids, "<u4").tobytes())
    empty = token_files.read_tokens(spark, token_files.token_store(docs.limit(0), path))
    assert empty.count() == 0


def test_encoder_equals_the_library(spark):
    from tokenizers import Tokenizer

    path = vocabulary_path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").toPandas().text.tolist()
    odd = ["", "a", "\n", " ", "a\nb", "a\n b", "a \nb", "x\ty", "\tx", "a  b", "don't\n'tis 42nd\n-x", "é\u00a0b", "<|endoftext|> a", "a<|endoftext|>", "ab " * 3_000 + "c\nd"]
    texts = [t or "" for t in odd + rows + odd]
    for encoder in (token_files.Encoder(path), token_files.Encoder(path)):
        for part in (texts[:7], texts, texts[5:30], []):
            ids, sizes = encoder.encode(part, 2)
            got = [p.tolist() for p in np.split(ids, np.cumsum(sizes)[:-1])] if part else []
            assert got == [tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in part]
        encoder.by_units = False


def test_words_that_stay_are_looked_up_once():
    class Counted(memo.WordMemo):
        looked = 0

        def get(self, word):
            self.looked += 1
            return super().get(word)

        def __contains__(self, word):
            self.looked += 1
            return super().__contains__(word)

        def __getitem__(self, word):
            self.looked += 1
            return super().__getitem__(word)

    known = Counted(lambda words: [w.encode() for w in words], keep=3, recent=1, longest=3)
    assert known.values_of(["a", "b", "long word"]) == [b"a", b"b", b"long word"]
    known.looked = 0
    assert known.values_of(["b", "a"]) == [b"b", b"a"] and known.looked == 2
    words = [f"w{i}" for i in range(9)]
    for _ in range(3):
        assert known.values_of(words) == [w.encode() for w in words] and known.values_of([]) == []


def test_workers_hold_one_operators_memory():
    memo.held("one", "a", lambda: 1)
    assert memo.held("one", "a", lambda: 2) == 1
    assert memo.held("two", "a", lambda: 3) == 3
    assert memo.held("one", "a", lambda: 4) == 4 and list(memo._held) == ["a"]
    memo.enter("one")
    assert list(memo._held) == ["a"]
    memo.enter("two")
    assert not memo._held


def summed(word, table):
    """Log of the probability of a word per language, summed over all its segmentations one position at a time."""
    finder, count = language_id.vocabulary(MODEL)
    number = {}
    for end, value in finder.iter(word):
        number[end + 1 - value % (1 << language_id.LENGTH), end + 1] = value >> language_id.LENGTH
    for i in range(len(word)):
        number.setdefault((i, i + 1), count)
    starts = {}
    for s, e in number:
        starts.setdefault(e, []).append(s)
    ways = [np.zeros(table.shape[1])]
    with np.errstate(divide="ignore"):
        for end in range(1, len(word) + 1):
            ways.append(np.logaddexp.reduce([ways[s] + np.log(table[number[s, end]]) for s in starts[end]]))
    return ways[-1]


def random_table(langs):
    count = language_id.vocabulary(MODEL)[1]
    table = np.random.default_rng(3).random((count + 1, langs)) / count
    table[-1] = language_id.UNSEEN
    return table


def test_forward_sums_all_segmentations():
    table = random_table(2)
    words = ["the", "a", "straße", "日本x", "international", "x" * 41, "その日は" * 700, "w" * 39, "", "ab" * 20, "straße" * 90]
    got = language_id.log_probabilities(words, table, MODEL)
    assert np.allclose(got, [summed("▁" + w, table) for w in words], rtol=1e-9)
    counts = language_id.expected_counts(words, np.ones(len(words)), np.zeros(len(words), dtype=int), table, MODEL)
    assert counts[:, 0].sum() > 5 and counts[:, 1].sum() == 0


def test_expected_counts_of_long_and_short_words_agree(monkeypatch):
    table = random_table(2)
    words = ["a" * 20 + "b" * 20, "日本" * 20, "the", "international"]
    amounts, langs = np.array([2.0, 3.0, 1.0, 5.0]), np.array([0, 1, 0, 1])
    want = language_id.expected_counts(words, amounts, langs, table, MODEL)
    monkeypatch.setattr(language_id, "WORD", 2)  # all words by logarithms
    assert np.allclose(language_id.expected_counts(words, amounts, langs, table, MODEL), want)


def test_predictions_equal_sums_by_hand(spark):
    table = random_table(3)
    model = language_id.LanguageModel(["de", "en", "fr"], table, MODEL)
    texts = ["The cat sat", "straße " * 9, "日本" * 60 + " x", "½ ²", "Ⅷ ①", "12 _ 3", "", None, "½ a"]
    told = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(documents(spark, list(enumerate(texts))), model).collect()}
    for i, text in enumerate(texts):
        if i in (3, 4, 5, 6, 7):
            assert told[i] == ("und", 0.0)
            continue
        total = sum(summed("▁" + w, table) for w in text.lower().split())
        assert told[i][0] == model.langs[int(total.argmax())]
        assert np.isclose(told[i][1], np.exp(total.max() - np.logaddexp.reduce(total)))


def test_languages_told_by_the_end_of_long_words(spark):
    # Without spaces; the first 40 characters are the same in both languages.
    texts = [("x" * 40 + (end * 30), lang) for end, lang in (("その日は", "ja"), ("这是我们", "zh"))]
    docs = documents(spark, [(i, t) for i, (t, _) in enumerate(texts)])
    docs = docs.withColumn("lang", F.element_at(F.array(*[F.lit(lang) for _, lang in texts]), (F.col("doc_id") + 1).cast("int")))
    model = language_id.train(docs, MODEL)
    told = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(docs, model).collect()}
    assert [told[i][0] for i in (0, 1)] == ["ja", "zh"] and min(told[i][1] for i in (0, 1)) > 0.99


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("held_out", language_id.held_out())
    model = language_id.train(docs.where("not held_out"), MODEL, rounds=2)
    told = language_id.identify(docs, model, keep=["lang", "held_out"]).where("held_out").toPandas()
    assert len(told) > 100 and (told.lang == told.lang_pred).mean() > 0.98
    assert told.score.between(0, 1).all()
    odd = documents(spark, enumerate([None, "", "123 %%", "x" * 5_000, "der die das und nicht"]), score=1.0, lang_pred="clash")
    rows = {r.doc_id: r for r in language_id.identify(odd, model).collect()}
    assert [rows[i].lang_pred for i in (0, 1, 2)] == ["und"] * 3 and rows[4].lang_pred == "de"
    assert rows[0].score == 0.0
    untaught = language_id.train(docs.limit(0), MODEL)
    assert {r.lang_pred for r in language_id.identify(odd, untaught).collect()} == {"und"}


PAGE = """<!DOCTYPE html><html><head><title>A &amp; B</title><style>p{}</style><script>x="</p>"</script></head><body>
<nav><ul><li><a href=x>One</a><li>Two<ul><li>Deep</ul></ul></nav><div>Ad<p>Para one<br>line two<p hidden>no<p style="display: none">no</p>
<ol start=3><li>a<li>b</ol><table><caption>Cap</caption><tr><th>Name<th>Qty<tr><td>Apples<td>3<tr><td>Plums and more</td><td>12</td></table>
<pre>  x = 1
    y
</pre><blockquote>quote <b>bold</b>text</blockquote>a &lt; b<!-- no --> end</div></span></body></html>"""

LAID_OUT = """- One
- Two
  - Deep

Ad

Para one
line two

3. a
4. b

Cap
Name            Qty
Apples          3
Plums and more  12

  x = 1
    y

  quote boldtext

a < b end"""


def test_layout():
    assert html_text.page_text(PAGE) == ("A & B", LAID_OUT)


class _Words(HTMLParser):
    """Words outside the head, scripts and styles, by another parser."""

    def __init__(self):
        super().__init__()
        self.words, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("head", "script", "style")

    def handle_endtag(self, tag):
        self.skip -= tag in ("head", "script", "style")

    def handle_data(self, data):
        if not self.skip:
            self.words.append(data)


def test_all_visible_words_of_real_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html", F.lit(1).alias("text"))
    texts = {r.page_id: r.text for r in html_text.extract_text(pages).collect()}
    for row in pages.collect():
        parser = _Words()
        parser.feed(row.html)
        assert "".join(texts[row.page_id].replace("- ", "").split()) == "".join("".join(parser.words).replace("- ", "").split())


def test_odd_pages(spark):
    odd = [None, "", "plain", "<", "<p", "a < b", "<div>" * 5_000 + "deep", "<p>" * 5_000, "<table><tr><td>" * 300 + "in", "&nbsp;&amp;&bogus;"]
    rows = spark.createDataFrame(list(enumerate(odd)), "page_id long, html string").withColumn("url", F.lit("u"))
    texts = {r.page_id: r.text for r in html_text.extract_text(rows).collect()}
    assert texts[0] is None and texts[1] == "" and texts[2] == "plain" and texts[5] == "a < b"
    assert texts[6] == "deep" and texts[8] == "in" and texts[9] == "\xa0&&bogus;"
    assert html_text.extract_text(rows.limit(0)).count() == 0


def test_quotes_elsewhere_in_a_tag_are_characters():
    assert html_text.page_text("<a title=don't>Hello</a> <p>more</p>")[1] == "Hello\n\nmore"
    assert html_text.page_text("<a title=don't>Hello</a> <p title=it's>more</p>")[1] == "Hello\n\nmore"
    assert html_text.page_text("<a 'b\" =c d=e\"f>Hello</a\"> more")[1] == "Hello more"
    assert html_text.page_text("<a x='1>2'y = \"3>'4\" z=>Hello")[1] == "Hello"
    assert html_text.page_text("<p x='1'hidden>no</p><p title=a'b hidden>no</p>yes")[1] == "yes"


TABLES = {
    "<table><tbody><form><tr><td>x1<td>x2</form></table>x3": "x1  x2\n\nx3",
    "<table><tr><form><td>x1</td></form></table>": "x1",
    "<table><tr><a href=u><td>x1</a></table>": "x1",
    "<table><tr><div>x1</div><td>x2</table>": "x1\n\nx2",
    "<table><tbody><div>x1</div><tr><td>x2</table>": "x1\n\nx2",
    "<table><tr><td>x1</td>x2<b>x3</b><td>x4</table>x5": "x2x3\n\nx1  x4\n\nx5",
    "<table><tbody><caption>x1</caption><tr><td>x2</table>": "x1\nx2",
    "<table><tr><td>x1<tr><table><tr><td>x2</table>x3": "x1\n\nx2\n\nx3",
    "<table><tr><td><table><tbody><span>x1</span><tr><td>x2</table></table>": "x1\nx2",
    "<table><colgroup><i>x1</i><tr><td>x2</table>": "x1\n\nx2",
}


@pytest.mark.parametrize("page", TABLES)
def test_content_of_a_table_outside_its_cells(page):
    assert html_text.page_text(page)[1] == TABLES[page]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("table tbody tr td th caption colgroup form a div p span ul li select b /table /tr /td /form /div /p x x x".split()), max_size=25))
def test_no_text_in_and_around_tables_is_lost(names):
    words = [f"x{k}." for k, name in enumerate(names) if name == "x"]
    page = "<table>" + "".join(f"x{k}." if name == "x" else f"<{name}>" for k, name in enumerate(names))
    shown = "".join(html_text.page_text(page)[1].split())
    assert all(shown.count(word) == 1 for word in words)


def test_formulas_maps_and_drawings():
    page = "a <math><mi>b</mi><annotation>no</annotation></math> <map><a href=u>c</a></map>"
    page += "<svg><style/><title>no</title><defs><text>no</text></defs><defs/><text>d</text><text>e</text></svg>"
    assert html_text.page_text(page)[1] == "a b c\nd\ne"


SPANS = {
    "<table><tr><td rowspan=2>A<td>b1<tr><td>b2</table>": "A  b1\n   b2",
    "<table><tr><td>x<td rowspan=0>tall<td>z<tr><td>1<td>3<tr><td>4<td>5</table>": "x  tall  z\n1        3\n4        5",
    # A span ends with its group of rows, and a wide cell ends where a tall one stands.
    "<table><tbody><tr><td rowspan=9>A<td>b<tbody><tr><td>c<td>d</table>": "A  b\nc  d",
    "<table><tr><td>a<td rowspan=2>b<td>c<tr><td colspan=3>wide cell<td>d</table>": "a          b  c\nwide cell     d",
    "<table><tr><td colspan=2>head<td>z<tr><td>1<td>2<td>3</table>": "head  z\n1  2  3",
    "<table><tr><td colspan=1000>a<td>b<tr><td>long<td>c</table>": "a        b\nlong  c",
    "<table><tr><td rowspan=x>a<td rowspan=-3>b<tr><td>c<td>d</table>": "a  b\nc  d",
    "<table><tr><td rowspan=2 colspan=2>A<td>b<tr><td>c<tr><td>1<td>2<td>3</table>": "A     b\n      c\n1  2  3",
}


@pytest.mark.parametrize("page", SPANS)
def test_cells_that_span_rows_and_columns(page):
    assert html_text.page_text(page)[1] == SPANS[page]


SHOWN = {
    "<div style='visibility:hidden'>a<b style='visibility: visible'>b</b>c</div>d": "b\nd",
    "<div style='visibility:hidden'>a<div style='display:none'><b style='visibility:visible'>b</b></div></div>d": "d",
    "<p style='visibility:hidden;visibility:visible'>a</p>": "a",
    "<div style='content-visibility:hidden'>a<b style='visibility:visible'>b</b></div>c": "c",
    "<ol><li style='visibility:hidden'>a<li>b</ol>": "2. b",
    "<table><tr style='visibility:collapse'><td>a<td style='visibility:visible'>b<tr><td>c<td>d</table>": "   b\nc  d",
    "<input value=one> <input type=password value=two> <input type=email value=three> <input type=checkbox value=4> <input placeholder=5>": "one three",
    "<input type=image alt=go value=no> <input type=submit value=send>": "go send",
    "a<br>b<br><br>c<br> <br><br>d": "a\nb\n\nc\n\nd",
    "<div>a</div><div><br></div><div>b</div>": "a\n\nb",
    "<br><br>a<br>": "a",
    "<ruby>x<rp>(</rp><rt>y</rt><rp>)</rp></ruby>": "xy",
}


@pytest.mark.parametrize("page", SHOWN)
def test_what_is_shown(page):
    assert html_text.page_text(page)[1] == SHOWN[page]


def test_wide_and_long_tables_stay_small():
    import time

    began = time.process_time()
    wide = "<table><tr>" + "<td colspan=1000>x" * 4_000 + "</table>"
    assert html_text.page_text(wide)[1].split() == ["x"] * 4_000
    tall = "<table><tr>" + "<td rowspan=9999>y" * 2_000 + "<tr><td>z" * 2_000 + "</table>"
    text = html_text.page_text(tall)[1]
    assert text.split() == ["y"] * 2_000 + ["z"] * 2_000 and len(text) < 100_000
    long = "<table><tr><td>" + "w" * 50_000 + "<td>v" + "<tr><td>a<td>b" * 5_000 + "</table>"
    text = html_text.page_text(long)[1]
    assert len(text) < 200_000 and text.endswith("a  b\na  b")
    assert time.process_time() - began < 20


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(-1, 4), st.integers(-1, 4)), max_size=5), max_size=6))
def test_spans_equal_a_grid(shape):
    rows = [[f"<td rowspan={down} colspan={over}>{r}.{c}" for c, (down, over) in enumerate(row)] for r, row in enumerate(shape)]
    page = "<table>" + "".join("<tr>" + "".join(row) for row in rows) + "</table>"
    found, ends = html_text._table_rows(html_text.parse(page).children[0]) if shape else ([], [])
    taken = set()
    for r, (row, places) in enumerate(zip(shape, html_text._columns(found, ends), strict=True)):
        column = 0
        for (down, over), (first, end) in zip(row, places, strict=True):
            while (r, column) in taken:
                column += 1
            wide = 1
            while wide < max(1, over) and (r, column + wide) not in taken:
                wide += 1
            assert (first, end) == (column, column + wide)
            tall = len(shape) - r if down == 0 else min(max(1, down), len(shape) - r)
            taken |= {(r + i, column + k) for i in range(tall) for k in range(wide)}


class Hashed(str):
    """A word that counts how often a map looks it up."""

    times = 0

    def __hash__(self):
        Hashed.times += 1
        return super().__hash__()


def test_new_words_are_looked_up_and_kept_once():
    calls = []
    words_seen = memo.WordMemo(lambda words: calls.append(words) or [w.encode() for w in words], keep=30, recent=50)
    for start in (0, 10, 200):
        words = [Hashed(f"w{start + i}") for i in range(40)] + [Hashed("x" * 60)]
        Hashed.times = 0
        assert words_seen.values_of(words) == [w.encode() for w in words]
        assert Hashed.times <= 3 * len(words)
    assert [len(c) for c in calls] == [41, 10, 40] and len(words_seen) == 30 and "x" * 60 not in words_seen


def test_words_start_where_the_last_one_ended():
    rng = np.random.default_rng(5)
    values = rng.integers(0, 2 ** rng.integers(1, 62, 30_000), dtype=np.int64).astype(np.uint64)
    sizes = np.array([4096, 1, 0, 4096, 59, 4096, 3, 4096, 4096, 4096, 5361])
    words, counts = simple8b.encode(values, sizes)
    assert np.array_equal(simple8b.decode(words, counts, sizes), values) and counts[2] == 0
    one_by_one = [simple8b.encode(part, np.array([len(part)]))[0] for part in np.split(values, np.cumsum(sizes)[:-1])]
    assert np.array_equal(np.concatenate(one_by_one), words)
