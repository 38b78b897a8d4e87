"""Labelled pages from which the extraction model is trained.

Each is a page skeleton in which ``y="1"`` marks an element of the main text and ``y="0"`` one that is not part of it;
the mark holds for all that is inside up to the next mark. Slots are filled with sentences (s), paragraphs (p), a few
words (w) and lists of links (links) of made-up words, several times each, some with their class names taken away, so
that the model also learns from lengths, links and punctuation.
"""

from __future__ import annotations

import random
import re

# The labelled skeletons.
SKELETONS = (
    '<html><head><title>{s}</title><style>x</style></head><body y="0"><nav><ul>{links}</ul></nav><div class="ad">{s}</div>'
    '<article y="1"><h1>{s}</h1><p>{p}</p><p>{p}</p><p>{s}</p></article><footer>&copy; {w} {s}</footer></body></html>',
    '<html><head><title>{w}</title></head><body y="0"><header><a href="/">{w}</a><p>{s}</p></header><main y="1"><h1>{w}</h1><p>{p}</p>'
    '<h2>{w}</h2><p>{p}</p><ul><li>{s}</li><li>{s}</li><li>{w}</li></ul><p>{s}</p></main><aside><h3>{w}</h3><ul>{links}</ul></aside>'
    "<footer><p>{s}</p></footer></body></html>",
    '<body y="0"><div id="header"><h1>{w}</h1><ul class="menu">{links}</ul></div><div id="content" y="1"><h2>{s}</h2><p>{p}</p><p>{p}</p>'
    '<blockquote><p>{s}</p></blockquote><p>{p}</p></div><div id="sidebar" y="0"><h3>{w}</h3><p>{s}</p><ul>{links}</ul></div>'
    '<div id="footer">{s} <a href="/">{w}</a></div></body>',
    '<body y="0"><div class="cookie-notice"><p>{s} {s}</p><button>{w}</button></div><div class="page"><div class="post" y="1">'
    '<h1>{w}</h1><div class="entry"><p>{p}</p><div class="ad" y="0">{s}</div><p>{p}</p><p>{p}</p></div></div>'
    '<section class="comments"><h3>{w}</h3><div class="comment"><p>{p}</p></div><div class="comment"><p>{s}</p></div>'
    "<form><label>{w}</label><textarea>{w}</textarea><input><button>{w}</button></form></section></div></body>",
    '<body y="0"><table><tr><td><ul>{links}</ul></td><td y="1"><h1>{s}</h1><p>{p}</p><p>{s}</p><table><tr><th>{w}</th><th>{w}</th></tr>'
    "<tr><td>{w}</td><td>{w}</td></tr></table><p>{p}</p></td></tr></table><p>{w} {w}</p></body>",
    '<body y="0"><div class="navbar"><a href="#">{w}</a> <a href="#">{w}</a></div><div class="banner">{s}</div><section class="article" y="1">'
    "<h1>{s}</h1><p>{s}</p><p>{p}</p><pre>{s}</pre><ol><li>{s}</li><li>{p}</li></ol><figure><img><figcaption>{s}</figcaption></figure>"
    '<p>{p}</p></section><div class="related"><h4>{w}</h4><ul>{links}</ul></div><div class="newsletter"><p>{s}</p><form><input>'
    "<button>{w}</button></form></div><footer><nav>{links}</nav><p>&copy; {w}</p></footer></body>",
    '<body y="0"><div role="navigation"><ul>{links}</ul></div><div role="main" y="1"><p>{p}</p><p>{s}</p><p>{p}</p></div>'
    '<div role="complementary"><p>{s}</p><p>{s}</p></div><div role="contentinfo"><p>{s}</p></div></body>',
    '<body y="0"><div class="wrapper"><div class="top"><a href="/">{w}</a></div><div class="story" y="1"><h1>{w}</h1><p>{p}</p>'
    '<aside class="pullquote" y="0"><p>{s}</p></aside><p>{p}</p><p>{s}</p></div><div class="share"><a href="#">{w}</a><a href="#">{w}</a></div>'
    '<div id="comments"><ul><li><p>{p}</p></li><li><p>{s}</p></li></ul></div></div></body>',
    '<body y="0"><div><ul>{links}</ul></div><div y="1"><h1>{s}</h1><p>{p}</p><p>{p}</p></div><div><p>{w}</p><p>{w}</p></div></body>',
    '<body y="0"><form class="search"><input><button>{w}</button></form><div class="breadcrumb"><a href="/">{w}</a> / <a href="/">{w}</a></div>'
    '<article y="1"><header><h1>{s}</h1></header><p>{s}</p><p>{s}</p><div class="advert" y="0"><p>{s}</p></div><h2>{w}</h2><p>{p}</p></article>'
    '<div class="pagination"><a href="#">{w}</a><a href="#">{w}</a></div><div class="alert notice"><p>{s}</p></div></body>',
    '<body y="0"><nav>{links}</nav><article y="1"><h1>{w}</h1><p><b>{s}<br><p>{s}</p><p>{w}</p></article><footer>&copy; {w}. {s}</footer></body>',
    '<body y="0"><article y="1"><p>{w}</p></article><aside><p>{p}</p></aside><footer>{p}</footer></body>',
    '<body y="0"><div class="promo sponsored"><p>{p}</p></div><div class="main-content" y="1"><h1>{w}</h1><div class="text"><p>{p}</p>'
    '<p>{s} <a href="#">{w}</a> {s}</p><dl><dt>{w}</dt><dd>{s}</dd></dl></div></div><div class="author-bio"><p>{s}</p></div>'
    '<div class="subscribe popup"><p>{s}</p></div><div class="copyright">{s}</div></body>',
    '<body y="1"><h1>{w}</h1><p>{p}</p><p>{p}</p><p>{s}</p></body>',
    '<body y="1"><p>{p}</p><p>{p}</p><p>{s}</p><div class="footer" y="0"><p>{w}</p></div></body>',
    '<body y="0"><header><nav><a href="/">{w}</a><a href="/">{w}</a></nav></header><div class="cookie"><p>{s} {s}</p><button>{w}</button></div>'
    '<main y="1"><p>{p}</p><div class="ad" y="0">{s}</div><p>{w}.</p><p>{p}</p><form action="/s" y="0"><input><label>{w}</label>'
    '<button>{w}</button></form></main><section class="comments"><p>{p}</p><p>{s}</p></section><footer>{s} {s}</footer></body>',
    '<body y="0"><header><a href="/">{w}</a></header><main y="1"><h1>{s}</h1><p>{s}</p><section><h2>{w}</h2><p>{p}</p></section>'
    '<nav y="0"><a href="#">{w}</a><a href="#">{w}</a></nav><section><h2>{w}</h2><p>{p}</p><p>{w}</p></section>'
    '<aside y="0"><p>{p}</p></aside></main><footer><p>{s}</p><p>{s}</p></footer></body>',
    '<body y="0"><nav><a href="/">{w}</a></nav><article y="1"><header><h1>{w}</h1><p>{w}</p></header><p>{p}</p><p>{p}</p><footer y="0">{w}: {w}, {w}'
    '</footer></article><div class="notice"><p>{s}</p></div><section id="comments"><h2>{w}</h2><article class="comment"><p>{p}</p></article>'
    '<article class="comment"><p>{s}</p></article></section></body>',
    '<body y="0"><div class="header"><h1>{w}</h1><p>{s}</p></div><div class="main"><div class="article" y="1"><h2>{s}</h2><p>{s}</p><p>{s}</p>'
    '<p>{p}</p><div class="share" y="0"><a href="#">{w}</a></div><p>{s}</p></div><div class="sidebar"><p>{p}</p><form><p>{s}</p><input></form>'
    '</div></div><div class="popup modal"><p>{s}</p><p>{s}</p></div></body>',
    '<body y="0"><article y="1"><h1>{w}</h1><div><p>{p}</p></div><div><p>{p}</p><p>{w}</p></div><aside y="0"><h3>{w}</h3><p>{p}</p></aside>'
    '<form y="0"><p>{s}</p><select><option>{w}</option><option>{w}</option></select></form><div><p>{s}</p></div></article>'
    '<footer><p>{p}</p></footer></body>',
    '<body y="0"><div class="alert"><p>{p}</p></div><div class="banner ad"><p>{p}</p></div><article y="1"><p>{s}</p><p>{w}</p></article>'
    '<div class="consent notice">{s}</div><footer>{w}</footer></body>',
    '<html><body y="1"><p>{p}</p><p>{p}</p></body></html>',
    '<html><body y="1"><h1>{s}</h1><p>{p}</p><ul><li>{s}</li><li>{w}</li></ul><p>{p}</p><table><tr><td>{w}</td><td>{w}</td></tr></table></body></html>',
    '<html><body y="0"><div id="page"><div id="masthead"><h1>{w}</h1><p>{w}</p></div><div class="entry-content" y="1"><h2>{w}</h2><p>{p}</p>'
    '<table><tr><th>{w}</th></tr><tr><td>{w}</td></tr></table><p>{s}</p></div><div class="widget"><h3>{w}</h3><p>{s}</p></div></div></body></html>',
    '<html><body y="0"><div class="masthead"><h1>{w}</h1><p>{s}</p></div><article y="1"><section><h2>{w}</h2><p>{p}</p><table><tr><td>{w}</td>'
    '<td>{w}</td></tr></table><pre>{s}</pre></section></article><div class="footer"><p>{s}</p></div></body></html>',
)
CLASSES = re.compile(r' (?:class|id|role)="[^"]*"')


def labelled_pages(copies: int = 12, seed: int = 11) -> list[str]:
    """Filled skeletons, the same on each call."""
    pick = random.Random(seed)

    def word() -> str:
        return "".join(pick.choice("aeinorstlduhcm") for _ in range(pick.randint(1, 9)))

    def words(low: int, high: int) -> str:
        return " ".join(word() for _ in range(pick.randint(low, high)))

    def sentence() -> str:
        return words(3, 22).capitalize() + pick.choice(".....!?") if pick.random() < 0.9 else words(3, 12)

    def fill(match: re.Match) -> str:
        slot = match.group(1)
        if slot == "s":
            return sentence()
        if slot == "p":
            return " ".join(sentence() for _ in range(pick.randint(2, 7)))
        if slot == "w":
            return words(1, 3).title()
        return "".join(f'<li><a href="/{word()}">{words(1, 2)}</a></li>' for _ in range(pick.randint(3, 8)))

    pages = []
    for n in range(copies):
        for skeleton in SKELETONS:
            page = re.sub(r"\{(\w+)\}", fill, skeleton)
            pages.append(CLASSES.sub("", page) if n % 8 == 7 else page)
    return pages
