"""SentencePiece, token counts, HTML text, personal data: against brute force
and the public libraries, and on nulls, empty and long texts, repeats, empty
tables and columns with clashing names."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickflow.llm import html_text, personal_data, pieces, token_counts

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = "doc_id long, text string, score double, n_tokens long, ids string, kept string"
ODD = ["", " ", "  two  spaces ", "\n\nlines\n", "a\tb\rc\x0bd\x0ce", "x☃𐍈y é́", "日本語テスト",
       "▁sign ▁", "\x00\x1c\x85\xa0z", "İstanbul ΣΑΣ", "it's 12,345.67 <|endoftext|> we'll",
       "word " * 30_000, "x" * 20_000]


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS)


# ------------------------------------------------------------ SentencePiece

@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(pieces.model_file())


def best_path(model, text):
    score = {model.pieces[i]: (model.scores[i], i) for i in model.normal}
    longest = max(map(len, score))
    best, back = [0.0] + [float("-inf")] * len(text), [None] * (len(text) + 1)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - longest), end):
            piece = text[start:end]
            if piece in score and best[start] + score[piece][0] > best[end]:
                best[end] = best[start] + score[piece][0]
                back[end] = (start, [score[piece][1]])
        if text[end - 1] not in score and best[end - 1] + model.unknown_score > best[end]:
            best[end] = best[end - 1] + model.unknown_score
            back[end] = (end - 1, [model.bytes[b] for b in text[end - 1].encode()])
    ids, end = [], len(text)
    while end:
        end, got = back[end]
        ids = got + ids
    return ids


def test_encoding_is_the_best_path(model):
    rng = random.Random(1)
    texts = ["".join(rng.choice("the ni\n,é☃▁") for _ in range(40)) for _ in range(150)]
    for t in [*texts, *(x for x in ODD if len(x) < 100), "of.\nThe end\n\nThe"]:
        want = best_path(model, "▁" + t.replace(" ", "▁")) if t else []
        assert model.encode(t).tolist() == want, t
        assert model.encode(t).tolist() == want, t       # now from the cache


def test_encoding_matches_the_library_in_unigram_mode(model):
    import sentencepiece
    with open(pieces.model_file(), "rb") as f:        # field 2.3, model_type: UNIGRAM
        unigram = sentencepiece.SentencePieceProcessor(model_proto=f.read() + b"\x12\x02\x18\x01")
    for w in "the token stationed hested lereoi theaeati osgara Straße".split():
        assert model.encode(w).tolist() == unigram.nbest_encode(w, nbest_size=2)[0]


def test_decoding_restores_texts_and_agrees_with_the_library(model):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.model_file())
    for t in ODD:
        assert model.decode(model.encode(t)) == t.replace("▁", " ")
        if "\x00" not in t and t.strip():
            assert sp.decode(model.encode(t).tolist()) == t.replace("▁", " ")


def test_round_trip_frame(spark):
    df = spark.createDataFrame([(1, "a b", 1.0, 5, "x", "k"), (1, "a b", 1.0, 5, "x", "k"),
                                (None, None, None, None, None, None), (2, "", 0.0, 0, "", "")],
                               CLASH)
    rows = pieces.round_trip(df).collect()
    assert len(rows) == 4 and all(r["round_trip"] for r in rows)
    assert sorted(r["n_tokens"] for r in rows)[:2] == [0, 0]
    assert pieces.round_trip(df.limit(0)).count() == 0
    coded = pieces.encode(docs(spark, ODD))
    back = pieces.decode(coded, carry=("doc_id", "text")).collect()
    assert all(r["decoded"] == r["text"].replace("▁", " ") for r in back)


# ------------------------------------------------------------ token counts

def test_whole_token_shortcut_is_proven_and_counts_match_the_library():
    from tokenizers import Tokenizer
    path = token_counts.tokenizer_file()
    counter, library = token_counts.BpeCounter(path), Tokenizer.from_file(path)
    rng = random.Random(2)
    for w in rng.sample(sorted(counter.counts), 300):
        assert counter.counts[w] == 1 == counter.merged(w)
    letters = "aeiotns'sT 1٣é\ńİß–.,<|endoftext|>"
    texts = ["".join(rng.choice(letters) for _ in range(60)) for _ in range(400)]
    for t in [*texts, *ODD]:
        assert counter.count(t) == len(library.encode(t, add_special_tokens=False).ids), t


def test_count_cache_stays_bounded(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE_WORDS", 3)
    counter = token_counts.BpeCounter(token_counts.tokenizer_file())
    for i in range(40):
        assert counter.count(f"qzx{'j' * i}") >= 1
    assert len(counter.counts) <= counter.proven + 8


def test_token_counts_frame(spark):
    df = spark.createDataFrame([(1, "Hello world", 1.0, 5, "x", "k"), (None, None, None, None, None,
                                                                       None), (1, "", 0.0, 0, "", "")],
                               CLASH)
    rows = {(r["doc_id"], r["n_bytes"]): r for r in token_counts.token_counts(df, limit=1).collect()}
    assert rows[1, 11]["n_tokens"] == 2 and rows[1, 11]["over_limit"]
    assert rows[None, 0]["n_tokens"] == 0 == rows[1, 0]["n_tokens"]
    assert token_counts.token_counts(df.limit(0)).count() == 0


# ------------------------------------------------------------ HTML

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script>
</head><body><header><h1>Site</h1></header><nav><ul><li><a href="/a">Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies and much more text than needed here.</div>
<!-- ad --><div class="ad">Buy now</div>
<article><h1>Head &amp; line</h1><p>First <b>par</b>agraph.<br><p>Second
   one.</p><ul><li>item</li></ul></article><aside>More</aside>
<form><label>Mail</label></form><div id="comments"><p>Nice post!</p></div><footer>&copy; x"""


def test_article_without_its_surroundings():
    assert html_text.main_text(PAGE) == "Head & line First paragraph. Second one. item"


def test_text_between_surge_and_dive_without_an_article_mark():
    links = "".join(f'<li><a href="/{i}">Section number {i}</a></li>' for i in range(12))
    body = "".join(f"<p>Sentence {i} of the text goes on for a good while, as texts do.</p>"
                   for i in range(6))
    page = f"<body><ul>{links}</ul><div>{body}</div><ul>{links}</ul><p>x</p></body>"
    want = " ".join(f"Sentence {i} of the text goes on for a good while, as texts do."
                    for i in range(6))
    assert html_text.main_text(page) == want


MENU = "<ul>" + "<li><a href='/x'>Section</a></li>" * 5 + "</ul>"


def paragraphs(*sizes):
    texts = [f"{i} " + "w" * (n - 2) for i, n in enumerate(sizes)]
    return "".join(f"<p>{t}</p>" for t in texts), " ".join(texts)


def test_text_outside_a_marked_part_is_kept_where_it_surges():
    body, text = paragraphs(*[70] * 8)
    for name in ("article", "main"):
        page = f"<body><{name}><p>Teaser.</p></{name}>{MENU}<div>{body}</div>{MENU}<p>x</p></body>"
        assert html_text.main_text(page) == "Teaser. " + text
    page = f"<body>{MENU}<p>x</p>{MENU}<article>{body}</article>{MENU}<p>y</p></body>"
    assert html_text.main_text(page) == text


def test_uneven_paragraphs_and_short_sections_are_kept():
    for sizes in ((50, 100, 100, 100, 5000), (5000, 100, 100, 50), (40, 9000, 30, 60), (30, 7000)):
        body, text = paragraphs(*sizes)
        assert html_text.main_text(f"<body>{MENU}<div>{body}</div>{MENU}</body>") == text
        assert html_text.main_text(f"<body>{body}</body>") == text
    lead, body, end = paragraphs(120), paragraphs(*[900] * 6), paragraphs(90)
    page = f"<body>{lead[0]}{MENU}{body[0]}{MENU}{end[0]}{MENU}<p>x</p></body>"
    assert html_text.main_text(page) == " ".join((lead[1], body[1], end[1]))


STORY = "<article><h1>Head</h1><p>First paragraph.</p></article>"


@pytest.mark.parametrize("around", [
    "<form>", "<form class='search'>", "<div class='layout has-sidebar'>", "<div id='no-sidebar'>",
    "<section class='widget-area main'>", "<div class='page header-fixed'>", "<div class='search'>"])
def test_noise_around_an_article_does_not_hide_it(around):
    assert html_text.main_text(f"<body>{around}{STORY}") == "Head First paragraph."
    body, text = paragraphs(*[70] * 6)
    assert html_text.main_text(f"<body>{around}<div>{body}</div><nav>Menu</nav>") == text


@pytest.mark.parametrize("attrs", ["class='comments-open'", "data-comment-count='3'",
                                   "id='commentary-7'", "class=post data-id='comment'"])
def test_articles_that_only_mention_comments_are_kept(attrs):
    page = STORY.replace("<article", f"<article {attrs}")
    assert html_text.main_text(f"<body>{page}") == "Head First paragraph."
    assert html_text.main_text(f"<body><main>{page}</main>") == "Head First paragraph."


def test_paragraphs_of_an_article_keep_soft_roles_and_lose_whole_noise():
    for word in "notice reply search related share social social-history search-results".split():
        page = f"<article><p>One.</p><p class='{word}'>A real one.</p></article>"
        assert html_text.main_text(page) == "One. A real one.", word
    for noise in ("<article class='comment-body'><p>Nice!</p></article>",
                  "<article id='comment-9'><p>Nice!</p></article>",
                  "<div class='share-buttons'><a href='/x'>Post this</a></div>",
                  "<div class='site-newsletter'>Mail us</div>", "<form>Mail</form>",
                  "<div class='ad-slot-3'>Buy</div>", "<aside><article>More</article></aside>"):
        page = STORY.replace("</article>", noise + "</article>")
        assert html_text.main_text(f"<body>{page}") == "Head First paragraph.", noise
        assert html_text.main_text(f"<body>{STORY}{noise}") == "Head First paragraph.", noise
    page = f"<body><div class='ad'>{'Buy now. ' * 20}</div>{STORY}"
    assert html_text.main_text(page) == "Head First paragraph."
    page = f"<body>{STORY}<div class='related'><article><p>Teaser.</p></article></div>"
    assert html_text.main_text(page) == "Head First paragraph."
    assert html_text.main_text(f"<body><form>{page}</form>") == "Head First paragraph."


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<!--", "<a href='x", "<script>x", "</p>" * 50,
                                  "<div class='a\"b'>" * 200, "<" * 5000, "&amp" * 100])
def test_broken_markup_gives_a_defined_text(page):
    assert isinstance(html_text.main_text(page), str)


def test_html_frame(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "x"), (1, "u", PAGE, "y"), (None, None, None, None),
                                (2, "v", "", "")], "page_id long, url string, html string, text string")
    rows = html_text.extract_text(df).collect()
    assert len(rows) == 4
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    assert html_text.extract_text(df.limit(0)).count() == 0


# ------------------------------------------------------------ personal data

PATTERNS = {0: r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            1: r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", 2: r"[0-9]([\x20-]?[0-9])+",
            3: r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            if (kind == 0 or kind == 1 and all(int(p) <= 255 for p in m[0].split("."))
                    or kind == 2 and 16 <= len(digits) <= 19 and personal_data.luhn(digits)
                    or kind == 3 and 8 <= len(digits) <= 15):
                out.append((kind, *m.span()))
    return out


def test_base_spans_are_the_patterns_matches():
    rng = random.Random(3)
    for _ in range(5000):
        t = "".join(rng.choice("a.@-+ 1( )29.@") for _ in range(30))
        assert personal_data.base_spans(t) == plain_base(t)


def test_field_splits_neighbours_that_the_patterns_drop():
    t = "call +1 (269) 555-3296 4524132264652876 and 10.0.0.1 or joe [at] mail [dot] com"
    base, spans = personal_data.find_spans(t, personal_data.prior())
    assert [t[a:b] for _, a, b in base] == ["10.0.0.1"]
    assert [(personal_data.KINDS[k], t[a:b]) for k, a, b in spans] == [
        ("email", "joe [at] mail [dot] com"), ("ip", "10.0.0.1"),
        ("card", "4524132264652876"), ("phone", "+1 (269) 555-3296")]
    clean = "In 2024-01-02 at 12:30, version 1.2.3 sold 1234 of 123456789012 for 3.50"
    assert personal_data.find_spans(clean, personal_data.prior()) == ([], [])


def test_decoding_is_the_best_segmentation():
    w = personal_data.prior()
    t = "+1 269 555 3296 4524132264652876 10.1.2.3 77"
    atoms = next(personal_data.zones(t))
    segs = personal_data.segments(t, atoms)

    def every(at):
        if at == len(atoms):
            yield 0.0, ()
        for i, j, k, x in segs:
            if i == at:
                for s, rest in every(j + 1):
                    yield s + float(w[k] @ x), ((k, i, j), *rest)
    best = max(every(0))[1]
    want = [(k, atoms[i][0], atoms[j][1]) for k, i, j in best if k < 4]
    assert personal_data.decode(t, atoms, w) == want


def test_fit_raises_the_likelihood_of_the_base_labels(spark):
    texts = [f"see +1 ({200 + i}) 555-{1000 + i} and a{i}@b.com or 10.0.{i}.7 of {i}" for i in range(40)]
    sample = personal_data.sample_zones(docs(spark, texts), limit=50)
    assert len(sample) == 50
    w = personal_data.fit(sample)
    assert (w != personal_data.prior()).any()
    for t in texts:
        base, spans = personal_data.find_spans(t, w)
        assert base == spans


def test_personal_data_frame_and_redaction(spark):
    rows = [(1, "mail a@b.com", 1.0, 5, "x", "k"), (1, "mail a@b.com", 1.0, 5, "x", "k"),
            (None, None, None, None, None, None), (2, "", 0.0, 0, "", "")]
    df = spark.createDataFrame(rows, CLASH)
    got = personal_data.personal_data(df).orderBy("n_email").collect()
    assert [r["n_email"] for r in got] == [0, 0, 1, 1]
    assert got[3]["spans"] == "email:5:12" and got[0]["spans"] == ""
    assert personal_data.personal_data(df.limit(0)).count() == 0
    red = personal_data.redact(df)
    assert red.columns == df.columns
    assert {r["text"] for r in red.collect()} == {"mail [EMAIL]", None, ""}
    long = docs(spark, ["1" * 50_000, "1.1." * 20_000, "a" * 50_000 + "@", "+1" * 20_000])
    assert personal_data.personal_data(long.filter(F.lit(True))).count() == 4


def test_fit_learns_from_the_stated_number_of_zones(spark):
    rows = [(i, f"mail a{i}@b.org or call +1 (212) 555-01{i:02d} at 10.0.0.{i}") for i in range(30)]
    sample = personal_data.sample_zones(spark.createDataFrame(rows, "doc_id long, text string"))
    assert len(sample) > 40
    assert np.array_equal(personal_data.fit(sample, limit=0), personal_data.prior())
    few = personal_data.fit(sample, per_shape=1)
    assert not np.array_equal(few, personal_data.fit(sample, per_shape=30))
    shapes = {}
    for z in sample:
        text, _, marks = z.rpartition("|")
        shapes.setdefault((re.sub("[a-z]+", "a", re.sub("[0-9]", "9", text)), marks), z)
    assert np.array_equal(few, personal_data.fit(list(shapes.values())))
