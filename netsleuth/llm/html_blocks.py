"""A web page as flat text blocks in page order, each with what surrounds it.

Tags are read once from left to right, as leniently as browsers do: unclosed, stray and
wrongly nested tags, attributes without quotes, comments, scripts without an end. Only
block elements are tracked; inline ones leave the text together, and a line break is
white space. The work is in proportion to the page.
"""

from __future__ import annotations

import html
import re

_REST = r'(?:[^>=]+|=\s*(?:"[^"]*"|\'[^\']*\')|=)*+>'
_TAG = re.compile(rf"<(/?)([a-zA-Z][^\s/>]*)({_REST})")
_ATTRIBUTE = re.compile(r'([a-zA-Z-]+)\s*=\s*("[^"]*"|\'[^\']*\'|[^\s>]*)|(\bhidden\b)')
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

#: Elements whose content is no markup.
RAW = {"script", "style", "title", "textarea", "iframe", "noembed", "noframes", "xmp"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Elements that end the block before them.
BLOCKS = HEADINGS | set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form header hgroup html legend li main menu nav noscript ol optgroup option p pre search section "
    "select summary svg table tbody td template tfoot th thead tr ul".split())
#: Breaks without content of their own.
BREAKS = {"hr", "br", "img", "input", "link", "meta", "source", "wbr", "embed", "col", "area", "base", "track", "param"}
#: What an opening tag closes, up to the element that holds such items.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"}), "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
          "thead": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot"}, {"table"})}

#: Elements and roles that are not the text of an article, whatever they hold.
ASIDE = {"nav", "footer", "aside", "form", "dialog", "menu", "noscript", "template", "svg", "button", "select", "search"}
ASIDE_ROLES = {"navigation", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "form"}

#: Words in class and id that name such parts, those of reader comments, and those of the text itself.
PART_WORDS = set(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead topbar footer sidebar aside ad ads advert adverts "
    "advertisement adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notification alert "
    "popup modal overlay newsletter subscribe subscription signup login search share sharing social related recommended "
    "recommendations teaser toolbar pagination pager widget copyright legal skip byline form".split())
COMMENT_WORDS = set("comment comments commentlist disqus reply replies respond responses discussion".split())
TEXT_WORDS = set("content article post entry story articlebody maincontent text".split())

#: How surely an element is the article: its own tag, the main part, or a name.
ARTICLE, MAIN, NAMED = 3, 2, 1


class Block:
    """White space is single spaces; ``part`` is the innermost element named as something else than the article."""

    __slots__ = ("text", "words", "link_words", "aside", "header", "level", "heading", "part")

    def __init__(self, text, words, link_words, aside, header, level, heading, part):
        self.text, self.words, self.link_words, self.aside = text, words, link_words, aside
        self.header, self.level, self.heading, self.part = header, level, heading, part


class Part:
    """An element whose class or id says that it is not the article, and the words it holds."""

    __slots__ = ("parent", "comments", "words", "counts")

    def __init__(self, parent, comments):
        self.parent, self.comments, self.words, self.counts = parent, comments, 0, True


class _Open:
    __slots__ = ("tag", "aside", "header", "level", "part")

    def __init__(self, tag, aside, header, level, part):
        self.tag, self.aside, self.header, self.level, self.part = tag, aside, header, level, part


def _names(value: str) -> set[str]:
    return set(_WORD.findall(_CAMEL.sub(" ", value).lower()))


def _opened(tag: str, attributes: str, above: _Open, parts: list[Part]) -> _Open:
    """The element's context from that of the element around it."""
    aside, header, level, part = above.aside or tag in ASIDE, above.header, above.level, above.part
    names, role = set(), ""
    if len(attributes) > 1:
        for name, value, alone in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name in ("class", "id"):
                names |= _names(value)
            elif name == "role":
                role = value.strip().lower()
            elif name == "itemprop" and value.lower() == "articlebody":
                role = "article"
            elif alone or name == "style" and "display:none" in value.replace(" ", "").lower():
                aside = True
    aside = aside or role in ASIDE_ROLES
    comments = bool(names & COMMENT_WORDS)
    if (tag == "article" or role == "article") and not comments:
        level, part, header = ARTICLE, None, False
    elif (tag == "main" or role == "main") and not comments:
        # the main part never lies inside one of these: they were left open
        level, part, header, aside = max(level, MAIN), None, False, False
    elif tag not in ("body", "html"):
        if tag == "header" or role == "banner" or level and "header" in names:
            header = True
        if comments or names & (PART_WORDS - {"header"} if level else PART_WORDS) and not names & TEXT_WORDS:
            part = Part(part, comments)
            parts.append(part)
        elif names & TEXT_WORDS:
            level = max(level, NAMED)
    return _Open(tag, aside, header, level, part)


def text_blocks(page: str | None) -> list[Block]:
    """The blocks of a page; none for a null or empty page."""
    if not page:
        return []
    out: list[Block] = []
    parts: list[Part] = []
    stack = [_Open("", False, False, 0, None)]
    open_tags: dict[str, int] = {}
    pieces: list[str] = []
    link_words, link_depth = 0, 0

    def flush():
        nonlocal link_words
        if pieces:
            words = "".join(pieces).split()
            if words:
                top = stack[-1]
                out.append(Block(" ".join(words), len(words), min(link_words, len(words)), top.aside, top.header, top.level,
                                 top.tag in HEADINGS, top.part))
                if top.part is not None:
                    top.part.words += len(words)
            pieces.clear()
        link_words = 0

    def pop():
        nonlocal link_depth
        open_tags[stack.pop().tag] -= 1
        if len(stack) < link_depth:
            link_depth = 0

    def say(segment):
        nonlocal link_words
        if "&" in segment:
            segment = html.unescape(segment)
        pieces.append(segment)
        if link_depth:
            link_words += len(segment.split())

    at, size, lower = 0, len(page), None
    while at < size:
        mark = page.find("<", at)
        if mark < 0:
            say(page[at:])
            break
        if mark > at:
            say(page[at:mark])
        follow = page[mark + 1:mark + 2]
        if page.startswith("<!--", mark):
            # "<!-->" and "<!--->" are whole comments
            if page.startswith(("<!-->", "<!--->"), mark):
                at = page.index(">", mark) + 1
                continue
            end = page.find("-->", mark + 4)
            other = page.find("--!>", mark + 4, end if end >= 0 else size)
            at = other + 4 if other >= 0 else end + 3 if end >= 0 else size
            continue
        if follow in ("!", "?") or follow == "/" and not page[mark + 2:mark + 3].isalpha():
            end = page.find(">", mark + 2)
            at = end + 1 if end >= 0 else size
            continue
        tag = _TAG.match(page, mark) if follow == "/" or follow.isascii() and follow.isalpha() else None
        if tag is None:
            if follow == "/" or follow.isascii() and follow.isalpha():
                break  # a tag without an end
            say("<")
            at = mark + 1
            continue
        at = tag.end()
        name = tag.group(2).lower()
        if tag.group(1):
            if name in BLOCKS:
                flush()
                if open_tags.get(name):
                    while stack[-1].tag != name:
                        pop()
                    pop()
            elif name == "a":
                link_depth = 0
            elif name == "br":
                pieces.append(" ")
            continue
        if name in RAW:
            lower = page.lower() if lower is None else lower
            if len(lower) != size:  # lower case of some letters is longer
                lower = page.translate(_ASCII_LOWER)
            end = lower.find(f"</{name}", at)
            if name == "textarea" or name == "iframe":
                flush()
            at = size if end < 0 else end
            continue
        if name in BLOCKS:
            flush()
            if stack[-1].tag == "p" or stack[-1].tag in HEADINGS and name in HEADINGS:
                pop()
            if name in CLOSES:
                items, holders = CLOSES[name]
                if any(open_tags.get(item) for item in items):
                    for depth in range(len(stack) - 1, 0, -1):
                        if stack[depth].tag in items:
                            while len(stack) > depth:
                                pop()
                            break
                        if stack[depth].tag in holders:
                            break
            stack.append(_opened(name, tag.group(3), stack[-1], parts))
            open_tags[name] = open_tags.get(name, 0) + 1
        elif name == "a":
            link_depth = len(stack)
        elif name == "br":
            pieces.append(" ")
        elif name == "hr":
            flush()
    flush()
    _settle(out, parts)
    return out


_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def _settle(blocks: list[Block], parts: list[Part]) -> None:
    """A name on an element that holds most of the page says nothing about its text, unless it is that of comments."""
    total = sum(b.words for b in blocks)
    for part in reversed(parts):
        if part.parent is not None:
            part.parent.words += part.words
    for part in parts:
        above = part.parent is not None and part.parent.counts
        part.counts = above or part.comments or 2 * part.words <= total
    for block in blocks:
        if block.part is not None and block.part.counts:
            block.aside = True


FEATURES = ("aside", "header", "heading", "levels_below", "page_level", "link_density", "link_density_before",
            "link_density_after", "words", "words_before", "words_after")


def features(blocks: list[Block]) -> list[tuple[float, ...]]:
    """One row of ``FEATURES`` for each block; a neighbour that is not there has no words.

    ``page_level`` is the highest level that holds a quarter of the words outside asides,
    ``levels_below`` how far a block is from it.
    """
    held = [0, 0, 0, 0]
    for b in blocks:
        if not b.aside:
            held[b.level] += b.words
    total = sum(held)
    page = max((k for k in (1, 2, 3) if total and 4 * sum(held[k:]) >= total), default=0)
    words = [0, *(b.words for b in blocks), 0]
    links = [0.0, *(b.link_words / b.words for b in blocks), 0.0]
    return [(b.aside, b.header, b.heading, max(page - b.level, 0), page, links[i], links[i - 1], links[i + 1],
             words[i], words[i - 1], words[i + 1]) for i, b in enumerate(blocks, 1)]
