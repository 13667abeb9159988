"""Operators that add columns to each row: token counts, pieces, quality, language, main text."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from opsloom.llm import catalog, html, language, pieces, quality, token_counts
from tests_llm_helpers import documents, nothing  # noqa: F401


def test_token_counts_equal_the_library(documents, nothing):
    from tokenizers import Tokenizer

    definition = catalog.tokenizer_file("byte_bpe_50k.json").decode()
    library = Tokenizer.from_str(definition)
    rows = token_counts.count_tokens(documents, definition, limit=50).collect()
    assert len(rows) == documents.count()
    for row in rows:
        assert row.score == "kept"
        assert row.n_bytes == len((row.text or "").encode())
        assert row.n_tokens == len(library.encode(row.text or "", add_special_tokens=False).ids)
        assert row.over_limit == (row.n_tokens > 50)
    assert token_counts.count_tokens(nothing, definition).count() == 0


@pytest.mark.parametrize("text", ["a<|endoftext|> b", "a   b", "x\x1c \x1cy", "!\n\n  z", "it's  9² 'll", "　 中"])
def test_fragments_add_up(text):
    from tokenizers import Tokenizer

    definition = catalog.tokenizer_file("byte_bpe_50k.json").decode()
    known: dict[str, int] = {}
    parts = token_counts._SAFE.split(text)
    token_counts._learn(definition, parts, known)
    assert sum(known[p] for p in parts) == len(Tokenizer.from_str(definition).encode(text, add_special_tokens=False).ids)


def _best(vocabulary, text):
    best = [0.0] + [float(pieces.NEVER)] * len(text)
    for end in range(1, len(text) + 1):
        for size in range(1, min(end, vocabulary.longest) + 1):
            i = vocabulary.ids.get(text[end - size : end])
            score = vocabulary.scores[i] if i is not None else vocabulary.unknown_score if size == 1 else None
            if score is not None:
                best[end] = max(best[end], best[end - size] + score)
    return best[-1]


def test_pieces_round_trip_and_chunks_agree(documents, nothing):
    model = catalog.tokenizer_file("piece_bpe_32k.model")
    whole = pieces.decode_pieces(pieces.encode_texts(documents, model), model).collect()
    assert len(whole) == documents.count()
    assert all(r.decoded == (r.text or "") and r.n_pieces == len(r.pieces) // 4 for r in whole)
    chunked = pieces.encode_texts(documents, model, chunk=64).select("text", "pieces").distinct().collect()
    assert {(r.text, bytes(r.pieces)) for r in chunked} == {(r.text, bytes(r.pieces)) for r in whole}
    assert pieces.encode_texts(nothing, model).count() == 0


def test_matrices_of_chunks_combine_to_the_best_score():
    vocabulary = pieces.Vocabulary(catalog.tokenizer_file("piece_bpe_32k.model"))
    text = vocabulary.normalized("representationrepresentative responsibility  中x\nthe" * 3)
    for size in (5, 16, 33):
        parts = [(text[b : b + size + vocabulary.longest - 1], min(size, len(text) - b)) for b in range(0, len(text), size)]
        matrices = [vocabulary.transfer(part, end) for part, end in parts]
        product = matrices[0]
        for matrix in matrices[1:]:
            product = pieces.combine(product, matrix)
        assert product[0, 0] == pytest.approx(_best(vocabulary, text))
        left = pieces.combine(pieces.combine(matrices[0], matrices[1]), matrices[2])
        assert (left == pieces.combine(matrices[0], pieces.combine(matrices[1], matrices[2]))).all()


def test_pieces_equal_the_library_read_as_unigram():
    sentencepiece = pytest.importorskip("sentencepiece")
    model = catalog.tokenizer_file("piece_bpe_32k.model")
    at = model.index(b"\x18\x02\x20\x80\xfa\x01")  # the kind of model, before the vocabulary size
    library = sentencepiece.SentencePieceProcessor(model_proto=model[: at + 1] + b"\x01" + model[at + 2 :])
    vocabulary = pieces.Vocabulary(model)
    words = ["implementation", "strength", "weather", "understanding", "naïve", "x", "größer"]
    for word, ids in zip(words, vocabulary.encode(words), strict=True):
        own = [vocabulary.pieces[i] for i in memoryview(ids).cast("i")]
        score = sum(vocabulary.scores[vocabulary.ids[p]] for p in own)
        assert score == sum(vocabulary.scores[i] for i in library.encode(word))


def test_pieces_equal_the_library_by_its_merges(spark, documents):
    sentencepiece = pytest.importorskip("sentencepiece")
    model = catalog.tokenizer_file("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    words = [" implementation", "x" * 700, "ab" * 400, " " * 99 + "a", "a   b  ", "naïve größer 中文 😀", "pneumonoultramicroscopic" * 9]
    frame = documents.select("text").union(spark.createDataFrame([(w,) for w in words], "text string"))
    for chunk in (1 << 15, 64):
        for row in pieces.encode_texts(frame, model, chunk=chunk).collect():
            assert list(memoryview(row.pieces).cast("i")) == library.encode(row.text or ""), row.text[:50]
    merging = pieces.vocabulary(model)
    for word in ("representationrepresentative", "▁▁▁▁▁xxxxxxxxxxx", "ab" * 40):
        assert merging._listed(word) == merging._heaped(word)
    # A file marked as a unigram model takes the matrices, whole and in chunks.
    at = model.index(b"\x18\x02\x20\x80\xfa\x01")
    unigram = model[: at + 1] + b"\x01" + model[at + 2 :]
    assert pieces.model_kind(unigram) == pieces.UNIGRAM and pieces.model_kind(model) == pieces.BPE
    found = [{(r.text, bytes(r.pieces)) for r in pieces.encode_texts(documents, unigram, chunk=c).collect()} for c in (1 << 15, 64)]
    assert found[0] == found[1]


def test_quality_learns_and_scores_every_row(spark, documents, nothing):
    good = [(i, " ".join(f"word{j * i % 97} the of" for j in range(40)) + ".", 1) for i in range(60)]
    bad = [(100 + i, " ".join(f"WORD{j * i % 97}!!" for j in range(40)), 0) for i in range(60)]
    rows = spark.createDataFrame(good + bad, "doc_id long, text string, quality int")
    labels = rows.select("doc_id", "quality").union(spark.sql("select 9999L, 1")).union(spark.sql("select 3L, cast(null as int)"))
    model = quality.fit_quality(rows.select("doc_id", "text"), labels)
    assert quality.score_quality(rows, model).where("predicted <> quality").count() == 0
    scored = quality.score_quality(documents, model).collect()
    assert len(scored) == documents.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in scored)
    assert quality.score_quality(nothing, model).count() == 0
    empty = quality.fit_quality(rows.select("doc_id", "text"), labels.limit(0))
    assert {r.score for r in quality.score_quality(rows, empty).collect()} == {0.5}


def test_language(spark, documents, nothing):
    words = {"aa": ["hello", "there", "world"], "bb": ["bonjour", "monde", "ça"], "cc": ["привет", "мир", "это"]}
    rows = [(i, " ".join(words[k][(i + j) % 3] for j in range(12)), k) for i in range(20) for k in words]
    frame = spark.createDataFrame([*rows, (1, "hello", None), (2, None, "aa")], "doc_id long, text string, lang string")
    model = language.fit_languages(frame)
    assert model.languages == ("aa", "bb", "cc")
    known = language.predict_language(frame.where("lang is not null and text is not null"), model)
    assert known.where("lang_pred <> lang or score < 0.5").count() == 0
    found = {r.doc_id: r for r in language.predict_language(documents, model).collect()}
    assert {found[i].lang_pred for i in (6, 7, 8)} == {"und"} and found[6].score == 0
    assert found[14].lang_pred in model.languages
    assert language.predict_language(nothing, model).count() == 0
    none = language.fit_languages(nothing.withColumn("lang", F.lit("aa")))
    assert {r.lang_pred for r in language.predict_language(documents, none).collect()} == {"und"}


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="no-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/a">A</a></li></ul></nav><div class="cookie-notice">We use cookies.</div>
<div class="wrap has-sidebar"><article><header><h1>Head &amp; more</h1><p>by x</p></header><p>One<br>two&nbsp;<b>thr</b>ee
 four</p><div class="ad">buy</div><aside>side</aside><ul><li>i1<li>i2</ul><form>f</form><p>&lt;tag&gt; &#233;</p>tail
<section id="comments"><article class="comment">bad</article></section></article></div><footer>foot</footer></body></html>"""


def test_main_text(spark):
    assert html.main_text(PAGE) == "Head & more\n\nOne two three four\n\ni1\n\ni2\n\n<tag> é\n\ntail"
    long = "The cat is on the mat and it was there for the dog. " * 6
    plain = f"<div><a href=1>Home</a> <a href=2>About us</a></div><h2>Title</h2><p>{long}</p><p>Short.</p><p>{long}</p><p>&copy; x</p>"
    assert html.main_text(plain) == "\n\n".join(["Title", long.strip(), "Short.", long.strip()])
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "x"), (3, "u", "", "x"), (4, "u", "<p>a < b", "x")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = html.extract_main_text(frame).collect()
    assert len(found) == 5 and all(r.n_chars == len(r.text) for r in found)
    assert {r.page_id: r.text for r in found}[2] == "" and {r.page_id: r.text for r in found}[4] == "a < b"
    assert html.extract_main_text(frame.limit(0)).count() == 0
    very_long = "<article><p>" + "w " * 200_000 + "</p></article>"
    assert len(html.main_text(very_long)) == 399_999


def test_main_text_judges_every_block():
    long = "The cat is on the mat and it was there for the dog. " * 6
    good = long.strip()
    teaser = "<article><h3><a href=1>Some other page</a></h3><p>A few words of it.</p></article>"
    bare = "<article><h3>Some other page</h3><p>A few words of it.</p></article>"
    for beside in (teaser, teaser * 4, bare, bare * 3):
        assert html.main_text(f"<div><h1>Title</h1><p>{long}</p><p>{long}</p></div>{beside}") == f"Title\n\n{good}\n\n{good}"
        assert html.main_text(f"<main><h1>Title</h1><p>{long}</p>{beside}</main><footer>f</footer>") == f"Title\n\n{good}"
    links = "".join(f"<li><a href={i}>Another page of the site {i}</a></li>" for i in range(5))
    inside = f"<h1>Title</h1><p>{long}</p><p>Short.</p><p>{long}</p>"
    wanted = f"Title\n\n{good}\n\nShort.\n\n{good}"
    # A list of links without a telling class goes, in an article as anywhere; the heading of it too.
    for page in (f"<article>{inside}<h2>More</h2><ul>{links}</ul></article>", f"<div>{inside}<h2>More</h2><ul>{links}</ul></div>"):
        assert html.main_text(page) == wanted
    # Regions are evidence: doubtful text stays in them, titles and by-lines do not lose it.
    assert html.main_text(f"<article><h1>Title</h1><p><a href=1>An Author</a></p><p>{long}</p></article>") == f"Title\n\n{good}"
    assert html.main_text(f"<article><h1><a href=1>Title</a></h1><p>{long}</p></article>") == f"Title\n\n{good}"
    assert html.main_text(f"<main><h1>Title</h1><article><p>{long}</p></article></main>") == f"Title\n\n{good}"
    foreign = "это текст на другом языке " * 12
    assert html.main_text(f"<nav>x</nav><article><h1>Имя</h1><p>{foreign}</p></article>") == f"Имя\n\n{foreign.strip()}"
    assert html.main_text("<nav>x</nav><article><p>Only this.</p></article>") == "Only this."


def test_tokenizer_path_is_a_parameter():
    assert catalog.tokenizer_file("piece_bpe_32k.model") == open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()
