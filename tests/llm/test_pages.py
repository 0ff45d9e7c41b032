import gzip
import hashlib
import random

import pytest

from tallyrill.llm import html_text, warc
from tallyrill.llm.store import FileStore

LONG = "This paragraph of the article is long enough to be taken for running text by anyone who reads it. "


def page(body, head="<title>T</title><style>p{}</style><script>var t='<p>no</p>';</script>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


CASES = [
    (None, ""), ("", ""), ("plain text", "plain text"), ("<", "<"), ("<p", ""), ("<!-- open", ""), ("a < b", "a < b"),
    (page("<nav><a href=x>Menu</a></nav><article><h1>Head &amp; more</h1><p>One\n two<br>three <b>bold</b><p>Next&nbsp;one &#233;&lt;"
          "</article><footer>foot</footer>"), "Head & more\nOne two three bold\nNext one é<"),
    (page(f"<header>Site name and slogan</header><div id=menu><a>One</a> <a>Two</a></div><div><h1>Title</h1><p>{LONG}</p><p>Short.</p>"
          f"<p>{LONG}</p></div><aside>{LONG}</aside><div class='comments'><p>{LONG}</p></div><div class=cookie-notice>{LONG}</div>"
          f"<form>{LONG}</form><footer>{LONG}</footer>"), f"Title\n{LONG.strip()}\nShort.\n{LONG.strip()}"),
    (page(f"<article><header><h1>Head</h1></header><p>{LONG}</p><div class=ad><p>Buy</p></div><p>End.</p>"
          f"<section class=comments><p>{LONG}</p></section></article>"), f"Head\n{LONG.strip()}\nEnd."),
    (page("<main><p>Few words</p></main><div>" + LONG + "</div>"), "Few words"),
    (page(f"<div><a href=1>{LONG}</a></div><p>{LONG}"), LONG.strip()),
    ("<article><p>never closed <b>bold <i>both", "never closed bold both"),
    ("<article><p title='a > b'>kept</p><p hidden>gone</p><p style='display: none'>gone</p><div role=navigation>gone</div></article>", "kept"),
    ("<article>a<script>if (1 < 2) { x('</p>') }</script>b<!-- <p>c --> <textarea><p>d</textarea></article>", "ab"),
    ("<article><table><tr><td>a<td>b</table><ul><li>c<li>d</ul></article>", "a\nb\nc\nd"),
    ("<article></p></div>x</b></article></article>", "x"),
    (page(f"<h1>Title</h1><div class=ad>Buy</div><p>{LONG}</p><p>{LONG}</p>"), f"Title\n{LONG.strip()}\n{LONG.strip()}"),
    (page(f"<article><h1>Head</h1><p>{LONG}</p><div class=ad>Buy</div><aside>More</aside><div class=ad>Buy</div><p>End.</p></article>"),
     f"Head\n{LONG.strip()}\nEnd."),
    (page(f"<article>Teaser</article><div><p>{LONG}</p><p>{LONG}</p></div>"), f"Teaser\n{LONG.strip()}\n{LONG.strip()}"),
    (page(f"<div class='content with-sidebar'><h1>Title</h1><p>{LONG}</p><div class=sidebar>{LONG[:40]}</div></div>"), f"Title\n{LONG.strip()}"),
    (page(f"<div class=no-social><div class='post no-comments'><p>{LONG}</p></div></div>"), LONG.strip()),
    (page(f"<p>{LONG}</p><div class=comments><p>{LONG}</p><p>{LONG}</p></div>"), LONG.strip()),
    (page(f"<article>Few</article><div class=ad>{LONG[:60]}</div>"), "Few"),
]


@pytest.mark.parametrize("markup, text", CASES)
def test_main_text(markup, text):
    assert html_text.main_text(markup) == text


SOME = "word " * 20 + "end."
LINKED = "<ul><li><a>One</a><li><a>Two</a><li><a>Three</a></ul>"


@pytest.mark.parametrize("markup, text", [
    ("<p>Press <button>OK</button> to go on</p>", "Press to go on"),
    ("<article><p>a <svg><text>x</text></svg> b <span class=ad>Buy</span>c<select><option>d</select></article>", "a b c"),
    ("<article><p>Euler: <math><mi>e</mi><mo>=</mo><mn>1</mn></math> holds.</article>", "Euler: e=1 holds."),
    ("<article><h2 id=social>Social life</h2><p>Few</p><section id=login><p>Log in here</p></section></article>", "Social life\nFew\nLog in here"),
    (f"<article><p>{SOME}</article><div>one</div><div>two</div><div>three</div><article><p>Short two</article>", f"{SOME}\nShort two"),
    (f"<h1>Title</h1>{LINKED}<p>{SOME}</p>{LINKED}<p>End here", f"Title\n{SOME}\nEnd here"),
    (f"<p>{SOME}</p><h2>References</h2><ul><li><a>An Author: a long title of a paper to be read</a><li><a>Another one: some other title of a paper</a></ul>",
     f"{SOME}\nReferences\nAn Author: a long title of a paper to be read\nAnother one: some other title of a paper"),
    (f"<p>{SOME}</p><div>Copyright 2020 A. Contact us.</div><div>Weather today</div>", SOME),
    (f"<div>Home of the paper</div><p>{SOME}</p><h3>More</h3>", SOME),
    (f"<p>{SOME}</p><div class=userComments><p>{SOME}</div><div class=cookieBar>{SOME}</div><ol class=commentlist><li>{SOME}</ol><div class=discussion>{SOME}</div>", SOME),
])
def test_what_names_and_lengths_choose(markup, text):
    assert html_text.main_text(markup) == text


def test_lines_of_made_up_pages_without_an_article_element():
    """Precision and recall by line, over pages that no rule was written for."""
    r = random.Random(17)

    def words(n):
        return " ".join("".join(r.choices("abcdefghijklmnoprstuvw", k=r.randint(2, 9))) for _ in range(n)).capitalize()

    right = kept = wanted = 0
    for _ in range(300):
        text, html = [], []
        around = [f"<div class={c}>{words(r.randint(1, 30))}</div>" for c in ("topbar", "siteNav", "promo", "sidebar-left", "cookie-bar")]
        around += [f"<ul>{''.join(f'<li><a href=#>{words(2)}</a>' for _ in range(r.randint(2, 9)))}</ul>", f"<div>{words(2)}</div>",
                   f"<footer>{words(40)}</footer>", f"<div><span>{words(1)}</span> <a>{words(2)}</a></div>", f"<div>\u00a9 2021 {words(3)}. All rights reserved.</div>"]
        for i in range(r.randint(2, 9)):
            if i == 0 or r.random() < 0.3:
                text.append(words(r.randint(2, 8)))
                html.append(f"<h{r.randint(1, 3)} id={r.choice(['ad', 'share', 'a1'])}>{text[-1]}</h1>")
            text.append(words(r.randint(4, 90)) + ".")
            html.append(f"<p>{text[-1]}</p>" if r.random() < 0.8 else f"<div>{text[-1]}</div>")
            if r.random() < 0.3:
                html.append(r.choice(around[:6]))
        page_ = "".join(r.sample(around, 4)) + "<div class=content>" + "".join(html) + "</div>" + "".join(r.sample(around, 4))
        got = html_text.main_text(page_).split("\n")
        right += len(set(got) & set(text))
        kept, wanted = kept + len(got), wanted + len(text)
    assert right / kept > 0.97 and right / wanted > 0.99


def test_long_and_deep_pages_are_read_whole():
    assert html_text.main_text("<article>" + "<div>" * 20_000 + "deep") == "deep"
    assert html_text.main_text("<article>" + "</x>" * 20_000 + "<b>" * 20_000 + "x") == "x"
    assert len(html_text.main_text("<article><p>" + "word " * 100_000).split()) == 100_000
    assert html_text.main_text("<p>" + "'\"<" * 20_000).count("<") == 20_000


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], "page_id long, url string, html string, text string, n_chars int")


def test_every_page_gives_a_row(spark):
    rows = [(i, f"u{i}", markup) for i, (markup, _) in enumerate(CASES)] + [(None, None, "<p>a"), (1, "u1", ""), (1, "u1", "")]
    got = html_text.extract(pages_of(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["n_chars"] == len(r["text"])
        if r["page_id"] is not None:
            assert r["text"] == CASES[r["page_id"]][1]
    assert html_text.extract(pages_of(spark, [])).count() == 0


PAGES = [
    (5, "http://a", "x" * 150), (3, "http://b\r\nWARC-Type: fake", "x" * 150), (9, None, "x" * 150), (4, "é", "y" * 99), (2, "d", "y" * 99),
    (7, "e", None), (8, "f", ""), (1, "g", "é" * 50), (0, "h", "é" * 50), (None, "i", "x" * 150), (None, None, "z" * 200), (6, "j", "a\r\n\r\nb" * 40),
    (11, "k", "q" * 100), (11, "k", "q" * 100),
]


@pytest.mark.parametrize("gap, size", [(0, 1), (64 << 10, 64 << 20)])
def test_archives_give_back_pages(spark, tmp_path, monkeypatch, gap, size):
    monkeypatch.setattr(warc, "GAP", gap)
    monkeypatch.setattr(warc, "FILE_BYTES", size)
    store = FileStore(f"file://{tmp_path}/w")
    index = warc.write_archives(pages_of(spark, PAGES), store)
    got = warc.read_records(index, store, with_payload=True).collect()
    assert len(got) == len(PAGES)
    first = {}
    for i, _, h in PAGES:
        raw = (h or "").encode()
        if len(raw) >= warc.LEAST_BYTES and i is not None:
            first[raw] = min(i, first.get(raw, i))
    payloads = {r["page_id"]: r["payload"] for r in got if r["record_type"] == "response"}
    for i, u, h in PAGES:
        raw = (h or "").encode()
        same = [r for r in got if r["page_id"] == i and r["payload_digest"] == hashlib.sha256(raw).hexdigest()]
        assert same
        for r in same:
            target = first.get(raw)
            revisit = target is not None and target != i
            assert (r["record_type"], r["refers_to"]) == (("revisit", target) if revisit else ("response", None))
            assert r["payload_bytes"] == len(raw)
            assert payloads[target] == raw if revisit else r["payload"] == raw


def test_archives_are_plain_warc_and_the_index_selects(spark, tmp_path):
    store = FileStore(str(tmp_path / "w"))
    index = warc.write_archives(pages_of(spark, PAGES), store)
    some = index.where("page_id in (3, 5)")
    assert {(r["page_id"], r["refers_to"]) for r in warc.read_records(some, store).collect()} == {(3, None), (5, 3)}
    for f in (tmp_path / "w").iterdir():
        raw = gzip.decompress(f.read_bytes())
        assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n") and b"\r\nWARC-Type: fake" not in raw


def test_no_pages(spark, tmp_path):
    store = FileStore(str(tmp_path / "w"))
    index = warc.write_archives(pages_of(spark, []), store)
    assert index.count() == 0 and warc.read_records(index, store).count() == 0


def test_damaged_records_are_refused():
    raw = warc.record(1, "u", b"payload", hashlib.sha256(b"other").hexdigest(), None)
    with pytest.raises(ValueError):
        warc._records([raw], True)
    with pytest.raises(ValueError):
        warc.parse(b"HTTP/1.1 200\r\n\r\n")


def test_ranges_join_what_lies_close():
    records = [{"offset": o, "length": 10} for o in (0, 10, 100_000, 100_010, 9_000_000)]
    assert [len(r) for r in warc._ranges(records)] == [2, 2, 1]
