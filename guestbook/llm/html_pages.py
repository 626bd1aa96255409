"""Labelled pages to train the extractor: layouts with their main text marked, filled with made-up sentences.

``main="1"`` marks main text and ``main="0"`` what isn't, inside it or beside it; unmarked is not main text. The marks are
labels only: the features don't see them. ``{p}`` stands for a paragraph, ``{s}`` for a short sentence, ``{w}`` for a word or two.
"""

from __future__ import annotations

import numpy as np

_LINKS = "<ul>" + '<li><a href="#">{w}</a></li>' * 6 + "</ul>"
_NAV = f"<nav>{_LINKS}</nav>"
_MENU = f'<div class="menu" id="topnav">{_LINKS}</div>'
_ADS = '<div class="ad">{s}</div>'
_FOOT = '<footer>&copy; {w} <a href="#">{w}</a> {s}</footer>'
_COMMENTS = (
    '<div class="comments" main="0"><h3>{w}</h3><div class="comment"><p>{p}</p><a href="#">{w}</a></div>'
    '<div class="comment"><p>{s}</p></div></div>'
)
_SIDE = f'<aside class="sidebar"><h4>{{w}}</h4>{_LINKS}<p>{{s}}</p></aside>'
_COOKIE = '<div class="cookie-notice" role="alert"><p>{s} {s}</p><button>{w}</button></div>'
_FORM = '<form action="#"><label>{w}</label><input name="q"><p>{s}</p><button>{w}</button></form>'
_SHARE = '<div class="share" main="0"><a href="#">{w}</a> <a href="#">{w}</a></div>'
_RELATED = f'<section class="related" main="0"><h2>{{w}}</h2>{_LINKS}</section>'
_TABLE = "<table><tr><th>{w}</th><th>{w}</th></tr><tr><td>{s}</td><td>{w}</td></tr></table>"

LAYOUTS = [
    f'{_NAV}{_ADS}<article main="1"><h1>{{s}}</h1><p>{{p}}</p><p>{{w}}</p><p>{{p}}</p><p>{{s}}</p></article>{_FOOT}',
    f'{_NAV}{_ADS}<article main="1"><h1>{{w}}</h1><p>{{w}}</p><p>{{s}}</p><p>{{w}}</p></article>{_FOOT}',
    f'<header><h2>{{w}}</h2>{_NAV}</header><main main="1"><h1>{{s}}</h1><p>{{p}}</p><h2>{{w}}</h2><p>{{p}}</p>'
    f"<ul><li>{{s}}</li><li>{{s}}</li></ul></main>{_SIDE}{_FOOT}",
    f'{_MENU}<div id="wrapper"><div class="content" main="1"><h1>{{s}}</h1><p>{{p}}</p><p>{{w}}</p><p>{{s}}</p><p>{{p}}</p></div>{_SIDE}</div>'
    f'{_COMMENTS}<div class="footer">{{s}}</div>',
    f'{_COOKIE}{_MENU}<div class="post" main="1"><h2>{{s}}</h2><div class="entry"><p>{{p}}</p><blockquote>{{p}}</blockquote>'
    f"<p>{{p}}</p></div>{_SHARE}</div>{_COMMENTS}{_FORM}{_FOOT}",
    f"<table><tr><td>{_LINKS}</td><td main=\"1\"><h1>{{s}}</h1><p>{{p}}</p><p>{{p}}</p>{_TABLE}</td></tr></table>{_FOOT}",
    f'<div id="header"><a href="#">{{w}}</a></div><div main="1"><p>{{p}}</p><p>{{p}}</p><p>{{w}}</p><p>{{p}}</p></div><div id="footer">{{s}}</div>',
    f'{_NAV}<section main="1"><h1>{{s}}</h1>{{p}}<br>{{p}}<p>{{p}}</p><pre>{{s}}</pre>{_RELATED}</section>{_FORM}{_FOOT}',
    f'<header>{{w}} {_FORM}</header><article main="1"><header main="0"><p>{{w}}</p></header><h1>{{s}}</h1><p>{{p}}</p>'
    f'<aside class="promo" main="0"><p>{{s}}</p></aside><p>{{p}} <a href="#">{{w}}</a> {{s}}</p>'
    f'<footer main="0">{{s}}</footer></article>{_COMMENTS}{_FOOT}',
    f'<div class="banner">{{s}}</div><div class="main"><div class="story-body" main="1"><p>{{p}}</p><div class="advert" main="0">{{s}}</div>'
    f'<p>{{p}}</p><p>{{s}}</p></div><div class="widget">{_LINKS}</div></div><div class="copyright">{{s}}</div>',
    f"{_NAV}{_FORM}{_FOOT}",
    f'{_MENU}<article main="1"><h1>{{s}}</h1><div><div><p>{{p}}</p></div><div><p>{{s}}</p><p>{{p}}</p></div></div></article>'
    f'<div class="newsletter"><p>{{s}}</p>{_FORM}</div>{_SIDE}{_FOOT}',
    f'{_NAV}<article main="1"><h1>{{s}}</h1><dl><dt>{{w}}</dt><dd>{{s}}</dd></dl><p>{{p}}</p></article>'
    f'<section class="comments" id="disqus"><article class="comment"><p>{{p}}</p></article><p>{{p}}</p></section>{_FOOT}',
]

_SYLLABLES = "an be co de er fi go ha in ka lo mu no or pa re si ta un ve".split()


def filled(layout: str, random: np.random.Generator) -> str:
    def words(low: int, high: int) -> str:
        n = int(random.integers(low, high + 1))
        return " ".join("".join(random.choice(_SYLLABLES, random.integers(1, 4))) for _ in range(n))

    def sentences(count: int, low: int, high: int) -> str:
        return " ".join(words(low, high).capitalize() + "." for _ in range(count))

    parts = layout.replace("{p}", "\0p").replace("{s}", "\0s").replace("{w}", "\0w").split("\0")
    out = [parts[0]]
    for part in parts[1:]:
        if part[0] == "p":
            text = sentences(int(random.integers(2, 7)), 4, 18)
        else:
            text = sentences(1, 3, 14) if part[0] == "s" else words(1, 2)
        out.append(text + part[1:])
    return "<html><head><title>t</title></head><body>" + "".join(out) + "</body></html>"


def labelled_pages(copies: int = 16, seed: int = 5) -> list[str]:
    random = np.random.default_rng(seed)
    return [filled(layout, random) for layout in LAYOUTS for _ in range(copies)]
