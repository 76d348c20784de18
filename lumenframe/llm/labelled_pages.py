"""Labelled pages from which the block labeller learns.

A page is put together by rule from parts that sites commonly have, each in several spellings; the
blocks of its article carry a mark.  Words are random letters, so nothing is learned about a language.
"""

from __future__ import annotations

import random

#: Stands at the head of every block of the article; taken out before a block is measured.
MARK = "\ue000"
_LETTERS = ("abcdefghiklmnoprstuvw", "aeioulnrstéèçâ", "абвгдежзиклмнопрст", "äöüßeinrstadhulg")


class _Maker:
    def __init__(self, rng: random.Random) -> None:
        self.rng = rng
        self.letters = rng.choice(_LETTERS)

    def word(self) -> str:
        return "".join(self.rng.choices(self.letters, k=self.rng.randrange(1, 10)))

    def words(self, a: int, b: int) -> str:
        return " ".join(self.word() for _ in range(self.rng.randrange(a, b)))

    def sentences(self, a: int, b: int) -> str:
        junk = self.rng.choice(["", "", "", "%%%", "!!", " |"])
        out = []
        for _ in range(self.rng.randrange(a, b)):
            s = self.words(1, 18)
            out.append((s.upper() if junk == "!!" else s.capitalize()).replace(" ", junk + " ") + self.rng.choice(".....?!"))
        return " ".join(out)

    def wrap(self, spellings: str, inner: str) -> str:
        tag, _, attribute = self.rng.choice(spellings.split("; ")).partition(" ")
        return f"<{tag}{' ' + attribute if attribute else ''}>{inner}</{tag}>"

    def links(self, a: int, b: int) -> str:
        return "".join(f'<li><a href="/x">{self.words(1, 4)}</a></li>' for _ in range(self.rng.randrange(a, b)))

    def menu(self) -> str:
        return self.wrap('nav; div class="menu"; div id="nav"; div class="navbar main-menu"; nav role="navigation"; div class="breadcrumbs"; div class="pagination"', f"<ul>{self.links(3, 9)}</ul>")

    def header(self) -> str:
        inner = self.rng.choice([f"<a href='/'>{self.words(1, 4)}</a>", f"<h1>{self.words(1, 4)}</h1>", f"<p>{self.sentences(1, 2)}</p>", f"<div>{self.words(2, 6)}</div>"])
        return self.wrap('header; div class="header"; div id="masthead"; div class="site-header banner"; header class="top"', inner + (self.menu() if self.rng.random() < 0.4 else ""))

    def footer(self) -> str:
        inner = self.rng.choice([f"&copy; {self.word()}.example.com &middot; {self.sentences(1, 3)}", f"<p>&copy; {self.words(2, 5)}</p><p>{self.sentences(1, 3)}</p>", f"<ul>{self.links(3, 7)}</ul>{self.words(3, 9)}"])
        return self.wrap('footer; div class="footer"; div id="footer"; div class="site-footer legal"; div class="copyright"; div id="bottom"', inner)

    def advert(self) -> str:
        inner = self.rng.choice([self.sentences(1, 4), f"<p>{self.sentences(1, 4)}</p>", f"<a href='/ad'>{self.words(3, 9)}</a>", f"<p>{self.sentences(1, 2)}</p><p><a href='/b'>{self.words(1, 3)}</a></p>"])
        return self.wrap('div class="ad"; div class="ads"; div class="advert"; div class="advertisement"; aside class="ad-banner"; ins class="adsbygoogle"; div class="sponsored promo"; div id="ad-slot-3"; div class="banner"', inner)

    def notice(self) -> str:
        inner = self.rng.choice([self.sentences(1, 4), f"<p>{self.sentences(1, 4)}</p><button>{self.word()}</button>"])
        return self.wrap('div class="notice"; div class="cookie-banner"; div id="cookie-consent"; div class="alert warning"; div class="gdpr"; div role="alert"; div class="popup modal"; aside class="notice"; p class="notice"; div class="disclaimer"; div class="paywall message"', inner)

    def form(self) -> str:
        inner = f"<label>{self.words(1, 3)}</label><input name=a><select><option>{self.word()}</option><option>{self.word()}</option></select><p>{self.sentences(1, 3)}</p><button>{self.word()}</button>"
        return self.rng.choice(["<form action='/s'>{}</form>", "<div class='login'><form>{}</form></div>", "<form class='newsletter subscribe'>{}</form>", "<form role='search'>{}</form>", "<div class='signup form'>{}</div>"]).format(inner)

    def sidebar(self) -> str:
        inner = self.rng.choice([f"<h3>{self.words(1, 4)}</h3><ul>{self.links(3, 8)}</ul>", f"<p>{self.sentences(1, 4)}</p>", f"<h2>{self.words(1, 3)}</h2><p>{self.sentences(2, 5)}</p><p>{self.sentences(1, 3)}</p>"])
        return self.wrap('aside; div class="sidebar"; div id="sidebar"; div class="widget"; aside class="related"; div class="right-rail related-posts"; section class="recommended"; div class="share social"; aside role="complementary"', inner)

    def comments(self) -> str:
        one = lambda: self.rng.choice(["<li class='comment'><b>{}</b><p>{}</p></li>", "<div class='comment'><p>{1}</p></div>", "<div class='reply'><span>{}</span><div>{}</div></div>", "<article class='comment'><p>{1}</p></article>", "<li><cite>{}</cite><p>{}</p></li>"]).format(self.words(1, 3), self.sentences(1, 5))
        head = self.rng.choice(["", f"<h3>{self.words(1, 4)}</h3>", f"<h2>{self.words(1, 3)}</h2>"])
        return self.wrap('section class="comments"; div id="comments"; ol class="commentlist"; div class="comment-thread"; div class="user-comments discussion"; div id="disqus_thread"; section id="responses"; div class="reviews"; ul class="comments-list"', head + "".join(one() for _ in range(self.rng.randrange(1, 6))))

    def article(self) -> str:
        rng, out = self.rng, []
        title = self.words(1, 11)
        if rng.random() < 0.9:
            out.append(f"<h1>{MARK}{title}</h1>" if rng.random() < 0.8 else f"<h2 class='title'>{MARK}{title}</h2>")
            if rng.random() < 0.3:
                out = [f"<header>{out[0]}</header>"] if rng.random() < 0.5 else out
        for _ in range(rng.choice([1, 1, 2, 3, 6, 12, 30])):
            kind = rng.random()
            if kind < 0.72:
                out.append(f"<p>{MARK}{self.sentences(1, 8)}</p>")
            elif kind < 0.8:
                out.append(f"<p><b>{MARK}{self.sentences(1, 4)}<br>")
            elif kind < 0.85:
                out.append(f"<h2>{MARK}{self.words(1, 7)}</h2>")
            elif kind < 0.89:
                out.append("<ul>" + "".join(f"<li>{MARK}{self.words(1, 12)}</li>" for _ in range(rng.randrange(1, 5))) + "</ul>")
            elif kind < 0.92:
                out.append(f"<blockquote>{MARK}{self.sentences(1, 4)}</blockquote>")
            elif kind < 0.94:
                out.append(f"<figure><img src=x><figcaption>{MARK}{self.words(2, 9)}</figcaption></figure>")
            elif kind < 0.96:
                out.append(f"<p>{MARK}<a href='/y'>{self.words(1, 6)}</a> {self.words(0, 6)}</p>")
            elif kind < 0.97:
                out.append("<table><tr>" + "".join(f"<td>{MARK}{self.words(1, 4)}</td>" for _ in range(3)) + "</tr></table>")
            elif kind < 0.98:
                out.append(self.advert())
            elif kind < 0.99:
                out.append(self.rng.choice([self.form, self.notice, self.sidebar])())
            else:
                out.append(f"<div>{MARK}{self.sentences(1, 5)}</div>")
        if rng.random() < 0.1:
            out.append(self.comments())
        return self.wrap('article; article; article; article class="post"; main; div class="content"; div id="content"; div class="article-body"; div class="entry-content"; div class="story text"; section class="post-body"; main role="main"; div id="main"', "".join(out))

    def page(self) -> str:
        rng = self.rng
        some = lambda make, p: make() if rng.random() < p else ""
        top = [some(self.header, 0.5), some(self.menu, 0.6), some(self.advert, 0.4), some(self.notice, 0.35), some(self.form, 0.2)]
        if rng.random() < 0.3:
            rng.shuffle(top)
        end = [some(self.comments, 0.45), some(self.sidebar, 0.4), some(self.form, 0.25), some(self.advert, 0.25), some(self.notice, 0.15)]
        rng.shuffle(end)
        body = "".join(top) + some(self.sidebar, 0.2) + self.article() + "".join(end) + some(self.footer, 0.75)
        if rng.random() < 0.3:
            body = f'<div class="{rng.choice(["page", "wrapper", "container", "layout row"])}">{body}</div>'
        if rng.random() < 0.15:
            return self.article() if rng.random() < 0.5 else body
        return f"<!DOCTYPE html><html><head><meta charset=utf-8><title>{self.words(1, 9)}</title><style>p{{}}</style></head><body>{body}</body></html>"


def labelled_pages(n: int = 300, seed: int = 1) -> list[str]:
    return [_Maker(random.Random(f"{seed}-{k}")).page() for k in range(n)]
