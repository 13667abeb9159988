"""Main text on wrapped pages and unknown languages, and blocks against another reader of HTML."""

from html.parser import HTMLParser

import pytest
from conftest import SF

from opsloom.llm import html

ENGLISH = "This is the body of the page, and it has been written so that there are enough of the words which the rules know in it. " * 3
RUSSIAN = "Сегодня утром в городе прошёл сильный дождь, и жители долго ждали автобус. Потом выглянуло солнце. Дети пошли гулять в парк. " * 3
GREEK = "Το πρωί έβρεχε πολύ στην πόλη και οι κάτοικοι περίμεναν το λεωφορείο. Μετά βγήκε ο ήλιος. Τα παιδιά πήγαν στο πάρκο. " * 3
BODIES = {"english": ENGLISH.strip(), "russian": RUSSIAN.strip(), "greek": GREEK.strip()}
WRAPS = {
    "has-sidebar": ('<div class="content has-sidebar">', "</div>"),
    "comments-open": ('<div class="post comments-open">', "</div>"),
    "login-page": ('<div id="login-page-wrap" class="nav-fixed">', "</div>"),
    "form": ('<form method="post" action="./">', "</form>"),
    "form with main": ('<form method="post"><main><article>', "</article></main></form>"),
    "nested": ('<form id="aspnetForm"><div class="page-with-sidebar"><div class="modal-open">', "</div></div></form>"),
    "plain": ("<div>", "</div>"),
}


@pytest.mark.parametrize("wrap", WRAPS)
@pytest.mark.parametrize("body", BODIES)
def test_wrapped_bodies_stay(wrap, body):
    before, after = WRAPS[wrap]
    text = BODIES[body]
    beside = '<div class="sidebar"><p>Latest posts of the week and more of them</p></div>'
    page = f"<html><body><nav><a href=1>Home</a></nav>{before}<p>{text}</p><p>{text}</p>{beside}{after}<footer>foot</footer></body></html>"
    assert html.main_text(page) == f"{text}\n\n{text}"


@pytest.mark.parametrize("body", ["russian", "greek"])
def test_known_and_unknown_languages_beside_each_other(body):
    page = f"<body><div><p>{BODIES['english']}</p><p>{BODIES[body]}</p></div></body>"
    assert html.main_text(page) == f"{BODIES['english']}\n\n{BODIES[body]}"


def test_boxes_go_and_links_go():
    boxes = "".join(
        f"<div {a}><p>{ENGLISH[:150]}</p></div>"
        for a in ('class="sidebar"', 'class="site-sidebar"', 'id="cookie-notice"', 'class="ad"', 'class="comment-list"', "role=search", 'class="newsletter"')
    )
    form = f"<form><p>{ENGLISH[:150]}</p><input></form>"
    comments = f'<section id="comments" class="comments-area"><p>{ENGLISH * 9}</p></section>'
    body = "".join(f"<p>{ENGLISH}</p>" for _ in range(8))
    assert html.main_text(f"<body>{boxes}<div>{body}</div>{form}{comments}</body>") == "\n\n".join([ENGLISH.strip()] * 8)
    tags = " ".join(f"слово{i}" for i in range(60))
    links = f"<p><a href=1>{RUSSIAN}</a></p>"
    assert html.main_text(f"<body><div><p>{ENGLISH}</p><p>{tags}</p>{links}</div></body>") == ENGLISH.strip()


class _Reader(HTMLParser):
    """Blocks as the texts between tags that are not inline, read by the standard library's parser."""

    SKIP = frozenset("script style title textarea noscript iframe template svg math object select xmp".split())

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.texts, self.parts, self.skipped = [], [], 0

    def end_block(self):
        text = " ".join("".join(self.parts).split())
        if text:
            self.texts.append(text)
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag in self.SKIP:
            self.skipped += 1
        elif tag == "br":
            self.parts.append(" ")
        elif tag not in html._INLINE:
            self.end_block()

    def handle_endtag(self, tag):
        if tag in self.SKIP:
            self.skipped -= 1
        elif tag not in html._INLINE and tag != "br":
            self.end_block()

    def handle_data(self, data):
        if not self.skipped:
            self.parts.append(data)


def test_blocks_of_all_pages_equal_another_reader(spark):
    pages = [r.html for r in spark.read.parquet(f"{SF.replace('sf0.001', 'sf0.01')}/pages.parquet").select("html").collect()]
    assert len(pages) > 100
    for page in pages:
        reader = _Reader()
        reader.feed(page or "")
        reader.close()
        reader.end_block()
        assert [b.text for b in html.blocks(page or "")] == reader.texts
