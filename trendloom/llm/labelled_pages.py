"""Labelled pages to train the page model on: random layouts whose nodes are marked as article or not.

The pages are generated. Their names come from the lists below and, so that names that no list holds say nothing, from random letters.
"""

from __future__ import annotations

import numpy as np

#: Elements and names that pages use for the article and for everything else.
ARTICLE = ["article", "main", "div.content", "div.post", "div.entry", "div.story", "div#main", "section.article", "div.article-body", "div.text"]
EDGES = ["nav", "nav.menu", "header", "header.site-header", "footer", "footer.site-footer", "aside", "div.sidebar", "div.menu", "div#navigation",
         "div.footer", "div.header", "div.breadcrumb", "ul.pagination", "div.cookie-notice", "div.notice", "div.consent", "div.banner", "div.ad",
         "div.ads", "div.advert", "div.sponsor", "div.promo", "div.popup", "div.newsletter", "form", "form.search", "div.login", "section.comments",
         "div#comments", "div.comment", "ol.commentlist", "div.replies", "div.related", "div.share", "div.social", "div.widget", "div.copyright",
         "section.related", "div.alert", "div.tags", "noscript", "div.toolbar"]
INSIDE = ["aside", "div.ad", "div.advert", "div.share", "div.related", "div.comments", "section.comments", "form", "div.newsletter", "div.notice", "nav", "div.promo"]
LETTERS = np.array(list("aeiounrstlmdcpghbfvy"))


def _words(rng: np.random.Generator, n: int) -> str:
    words = ["".join(rng.choice(LETTERS, rng.integers(1, 10))) for _ in range(n)]
    for i in range(0, n, max(2, int(rng.integers(4, 16)))):
        words[i] = words[i].capitalize()
        if i:
            words[i - 1] += "."
    return " ".join(words)


def _open(rng: np.random.Generator, name: str, label: int) -> tuple[str, str]:
    """Start and end tag for ``tag.class`` or ``tag#id``; the label stands in a ``data-y`` attribute."""
    tag, mark, value = name.partition("." if "." in name else "#")
    if rng.random() < 0.3:
        mark, value = mark or ".", f"{value} {_name(rng)}".strip()
    given = f' {"class" if mark == "." else "id"}="{value}"' if mark else ""
    return f'<{tag}{given} data-y="{label}">', f"</{tag}>"


def _name(rng: np.random.Generator) -> str:
    return "".join(rng.choice(LETTERS, rng.integers(3, 8)))


def _boxes(rng: np.random.Generator, inner: str, label: int, outer: int, most: int = 3) -> str:
    """Up to ``most`` boxes of names that mean nothing round a part of a page; the innermost has ``label``, the others ``outer``."""
    for i in range(rng.integers(0, most + 1)):
        tag = str(rng.choice(["div", "div", "div", "section", f"x-{_name(rng)}"]))
        mark = outer if i else label
        inner = f'<{tag} class="{_name(rng)} {_name(rng)}" data-y="{mark}">{inner}</{tag}>'
    return inner


def _code(rng: np.random.Generator) -> str:
    """Lines of code: short words without sentences."""
    return "\n".join(" " * int(rng.integers(0, 8)) + "".join(rng.choice(list("abcxyz =()[]{};_0123"), rng.integers(2, 40))) for _ in range(rng.integers(1, 12)))


def _links(rng: np.random.Generator) -> str:
    items = [f'<li data-y="0"><a href="/x" data-y="0">{_words(rng, int(rng.integers(1, 4)))}</a></li>' for _ in range(rng.integers(2, 8))]
    return '<ul data-y="0">' + "".join(items) + "</ul>"


def _edge(rng: np.random.Generator, names: list[str]) -> str:
    start, end = _open(rng, str(rng.choice(names)), 0)
    kind = rng.integers(0, 5)
    if kind == 0:
        body = _links(rng)
    elif kind == 1:
        body = _words(rng, int(rng.integers(2, 30)))
    elif kind == 2:
        body = "".join(f'<p data-y="0">{_words(rng, int(rng.integers(3, 40)))}</p>' for _ in range(rng.integers(1, 4)))
    elif kind == 3:
        body = f'<h3 data-y="0">{_words(rng, 2)}</h3><div data-y="0"><b data-y="0">{_words(rng, 2)}</b> {_words(rng, int(rng.integers(2, 30)))}</div>'
    else:
        body = f'<label data-y="0">{_words(rng, 1)}</label><input data-y="0"><button data-y="0">{_words(rng, 1)}</button>'
    return start + (_boxes(rng, body, 0, 0) if rng.random() < 0.3 else body) + end


def _block(rng: np.random.Generator) -> str:
    kind, text = rng.integers(0, 14), _words(rng, int(rng.integers(1, 70)))
    inner = f'{text} <{(t := rng.choice(["b", "a", "em", "i", "strong", "span"]))} data-y="1">{_words(rng, 2)}</{t}> {_words(rng, 3)}'
    if kind < 7:
        return f'<p data-y="1">{text if rng.random() < 0.6 else inner}</p>'
    if kind == 7:
        return f'<p data-y="1"><b data-y="1">{text}<br data-y="1">'
    if kind == 8:
        return f'<h{(h := rng.integers(2, 5))} data-y="1">{_words(rng, 4)}</h{h}>'
    if kind == 9:
        return '<ul data-y="1">' + "".join(f'<li data-y="1">{_words(rng, int(rng.integers(1, 20)))}</li>' for _ in range(rng.integers(1, 5))) + "</ul>"
    if kind == 10:
        return f'<blockquote data-y="1"><p data-y="1">{text}</p></blockquote>'
    if kind == 11:
        return f'<table data-y="1"><tr data-y="1"><td data-y="1">{_words(rng, 3)}</td><td data-y="1">{_words(rng, 3)}</td></tr></table>'
    if kind == 12:
        if rng.random() < 0.6:
            return f'<pre data-y="1">{text if rng.random() < 0.2 else _code(rng)}</pre>' if rng.random() < 0.5 else f'<pre data-y="1"><code data-y="1">{_code(rng)}</code></pre>'
        return f'<figure data-y="1"><figcaption data-y="1">{_words(rng, 6)}</figcaption></figure>'
    return f'<div data-y="1">{text if rng.random() < 0.5 else f"""<p data-y="1">{text}</p>"""}</div>'


def page(rng: np.random.Generator) -> str:
    start, end = _open(rng, str(rng.choice(ARTICLE)), 1) if rng.random() < 0.85 else ("", "")
    blocks = [f'<h1 data-y="1">{_words(rng, 5)}</h1>'] * int(rng.random() < 0.8) + [_block(rng) for _ in range(rng.integers(1, 12))]
    if rng.random() < 0.5:
        blocks.insert(int(rng.integers(1, len(blocks) + 1)), _edge(rng, INSIDE))
    if rng.random() < 0.3:
        cut = int(rng.integers(0, len(blocks)))
        blocks[cut:] = [_boxes(rng, "".join(blocks[cut:]), 1, 1)]
    body = start + "".join(blocks) + end
    if rng.random() < 0.4:
        body = _boxes(rng, body, 0 if start else 1, 0)
    if rng.random() < 0.3:
        wrap = _open(rng, str(rng.choice(["div.wrapper", "div#page", "div.container", "main", "div"])), 0)
        body = wrap[0] + "".join(_edge(rng, EDGES) for _ in range(rng.integers(0, 2))) + body + "".join(_edge(rng, EDGES) for _ in range(rng.integers(0, 3))) + wrap[1]
    before = "".join(_edge(rng, EDGES) for _ in range(rng.integers(0, 4)))
    after = "".join(_edge(rng, EDGES) for _ in range(rng.integers(0, 4)))
    return f'<html data-y="0"><head data-y="0"><title data-y="0">{_words(rng, 4)}</title></head><body data-y="0">{before}{body}{after}</body></html>'


def pages(count: int, seed: int) -> list[str]:
    rng = np.random.default_rng(seed)
    return [page(rng) for _ in range(count)]
