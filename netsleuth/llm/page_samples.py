"""The small labelled table of text blocks: pages in many layouts whose article is marked.

In a page ``{n}`` stands for n words, and a block that belongs to the article begins
with the word of ``MARK``, which is part of its text. Every page is read with its words
as they are, twice, four times and half as many, so that no split hangs on one length.
"""

from __future__ import annotations

import re

from netsleuth.llm.html_blocks import features, text_blocks

MARK = "§"
_FILL = re.compile(r"\{(\d+)\}")
SCALES = (0.5, 1, 2, 4)

_MENU = "<nav><ul><li><a href=#>{1}</a><li><a href=#>{2}</a><li><a href=#>{1}</a></ul></nav>"
_TOP = "<header><a href=#>{2}</a><p>{6}</p></header>"
_FOOT = "<footer><p>{8} <a href=#>{2}</a></p><p>{14}</p></footer>"
_COOKIE = '<div class="cookie-consent"><p>{22}</p><button>{1}</button></div>'
_AD = '<div class="ad">{7}</div>'
_COMMENTS = ('<section id="comments"><h2>{2}</h2><article class="comment"><p>{3}</p><p>{30}</p></article>'
             '<article class="comment"><p>{12}</p></article></section>')
_TEXT = "<p>§ {45}</p><p>§ {80} <a href=#>{3}</a> {20}</p><p>§ {1}</p><p>§ {30}</p>"
_PLAIN_LIST = "<ul><li>§ {5}</li><li>§ {3}</li><li>§ {12}</li></ul>"

PAGES = [
    f"{_MENU}{_AD}<article><h1>§ {{7}}</h1>{_TEXT}</article>{_FOOT}",
    f"{_MENU}{_AD}<article><h1>§ {{3}}</h1><p>§ {{2}}</p></article>{_FOOT}",
    f"<article><h1>§ {{5}}</h1><p>§ {{1}}</p><p>§ {{90}}</p><p>§ {{1}}</p></article>",
    f"{_TOP}{_MENU}<main><h1>§ {{6}}</h1>{_TEXT}{_PLAIN_LIST}</main>{_FOOT}",
    f"{_TOP}{_MENU}<main><p>§ {{60}}</p><aside><h3>{{3}}</h3><p>{{25}}</p></aside><p>§ {{2}}</p></main>{_FOOT}",
    f"{_COOKIE}{_TOP}{_MENU}<article><header><h1>§ {{8}}</h1><p>{{4}}</p></header>{_TEXT}<footer>{{6}}</footer></article>{_COMMENTS}{_FOOT}",
    f"{_TOP}<main><article><h2>§ {{5}}</h2>{_TEXT}<blockquote>§ {{25}}</blockquote>{_AD}<h3>§ {{2}}</h3><p>§ {{6}}</p></article>"
    f"<p>{{5}}</p><ul><li><a href=#>{{6}}</a><li><a href=#>{{7}}</a></ul></main>{_FOOT}",
    f'{_MENU}<div id="content"><h1>§ {{4}}</h1>{_TEXT}<div class="share"><a href=#>{{1}}</a> <a href=#>{{1}}</a></div></div>'
    f'<div class="sidebar"><h3>{{2}}</h3><p>{{40}}</p></div>{_FOOT}',
    f'<div class="menu"><a href=#>{{2}}</a> <a href=#>{{2}}</a></div><div class="post-content"><p>§ {{3}}</p>{_TEXT}</div>'
    f'<ol class="commentlist"><li><p>{{20}}</p><li><p>{{9}}</p></ol><div id="footer">{{10}}</div>',
    f"<table><tr><td><a href=#>{{1}}</a><br><a href=#>{{2}}</a></td><td><p>§ {{70}}</p><p>§ {{55}}</p><p>§ {{25}}</p></td></tr></table>"
    f"<p><a href=#>{{2}}</a> <a href=#>{{1}}</a></p>",
    f"<div><a href=#>{{1}}</a></div><div><a href=#>{{3}}</a></div><h1>§ {{6}}</h1>{_TEXT}<div><a href=#>{{2}}</a> <a href=#>{{1}}</a></div>",
    f"<p>§ {{50}}</p><p>§ {{35}}</p><p>§ {{70}}</p>",
    f"<h1>§ {{4}}</h1><p>§ {{40}}</p><h2>§ {{3}}</h2><p>§ {{60}}</p>{_PLAIN_LIST}<p>§ {{30}}</p>",
    f'<article><h1>§ {{5}}</h1><p>§ {{40}}</p><div class="newsletter"><p>{{15}}</p><form><label>{{2}}</label></form></div>'
    f'<p>§ {{35}}</p><figure><figcaption>§ {{9}}</figcaption></figure><div class="related"><h3>{{2}}</h3>'
    f"<ul><li><a href=#>{{8}}</a><li><a href=#>{{6}}</a></ul></div></article>{_FOOT}",
    f"<main><h1>§ {{3}}</h1><form><p>{{6}}</p><label>{{2}}</label><button>{{1}}</button></form>{_TEXT}</main><aside><p>{{60}}</p></aside>",
    f"{_TOP}{_MENU}<form><p>{{10}}</p></form>{_FOOT}",
    f"{_TOP}{_MENU}<ul><li><a href=#>{{6}}</a><li><a href=#>{{9}}</a><li><a href=#>{{5}}</a></ul>{_FOOT}",
    f'<article><h1>§ {{6}}</h1><p><a href=#>§ {{3}}</a> {{9}}</p><p>§ {{4}}</p><dl><dt>§ {{2}}</dt><dd>§ {{11}}</dd></dl>'
    f"<table><tr><th>§ {{1}}</th><td>§ {{2}}</td></tr></table></article>{_COMMENTS}",
    f"<article><p>§ {{30}}</p><p>§ {{10}} <a href=#>{{9}}</a></p><ul><li>§ {{4}} <a href=#>{{4}}</a></li><li>§ {{1}}</li></ul></article>",
    f"<div>{{7}}</div>{_MENU}<div>{{4}}</div><article><h1>§ {{5}}</h1>{_TEXT}</article><div>{{12}}</div>",
    f"<p>{{30}}</p><p>{{9}}</p><main><p>§ {{20}}</p>{_TEXT}<p>§ {{5}}</p></main><p>{{20}}</p><div>{{60}}</div>",
    f"<h2>{{4}}</h2><p>{{14}}</p><article><h1>§ {{5}}</h1><p>§ {{300}}</p><p>§ {{1}}</p></article><h3>{{3}}</h3><p>{{25}}</p>",
    f'<div>{{6}}</div><div class="entry"><p>§ {{33}}</p><p>§ {{5}}</p><p>§ {{48}}</p></div><div>{{16}}</div>',
    f"<article><h1>§ {{6}}</h1><p><a href=#>§ {{6}}</a></p><p>§ {{40}}</p><p><a href=#>§ {{2}}</a></p><p>§ {{25}}</p></article>{_FOOT}",
    f"<article><p>§ {{40}}</p><p><a href=#>§ {{9}}</a></p><p>§ {{25}}</p><ul><li><a href=#>{{2}}</a><li><a href=#>{{3}}</a></ul></article>{_FOOT}",
    f"<main><p>§ {{20}}</p><p><a href=#>§ {{4}}</a></p><p>§ {{65}}</p></main><div><a href=#>{{2}}</a> <a href=#>{{2}}</a></div>",
    f"<div><a href=#>{{1}}</a> <a href=#>{{2}}</a></div><div>{{3}} <a href=#>{{2}}</a></div><p>§ {{42}}</p><p>§ {{11}}</p><p>§ {{52}}</p>"
    f"<div>{{2}} <a href=#>{{1}}</a></div><div><a href=#>{{1}}</a></div>",
    f"<h1>§ {{4}}</h1><p>§ {{3}}</p>",
    f"<p>§ {{8}}</p>",
]


def labelled_blocks() -> tuple[list[tuple[float, ...]], list[int]]:
    """(features, 1 for a block of the article) of all blocks of all samples."""
    rows, kept = [], []
    for page in PAGES:
        for scale in SCALES:
            blocks = text_blocks(_FILL.sub(lambda m: " ".join(["w"] * max(1, round(int(m.group(1)) * scale))), page))
            rows += features(blocks)
            kept += [int(b.text.startswith(MARK)) for b in blocks]
    return rows, kept
