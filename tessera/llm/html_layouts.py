"""Seeded generator of web pages with known main text (training input of the block labeller)."""

from __future__ import annotations

import html
from collections.abc import Iterator
from random import Random

#: Usual class and id words of page parts, and usual short texts in them.
CLASSES = {
    "main": "content main post entry article story body text single page-content post-content article-body "
            "entry-content main-content blog-post hentry td-post-content prose".split(),
    "neutral": "wrap row col container inner box section layout grid block cell group col-md-8 flex panel area "
               "module region".split(),
    "nav": "nav menu navbar navigation topnav breadcrumb breadcrumbs main-menu toc tabs pagination pager links "
           "site-nav".split(),
    "header": "header masthead banner site-header top topbar branding logo page-header hero".split(),
    "footer": "footer site-footer bottom copyright colophon legal foot credits".split(),
    "side": "sidebar widget related aside side rail right-column recommended popular trending tags-cloud "
            "more-stories secondary".split(),
    "notice": "notice cookie cookies alert consent newsletter subscribe paywall popup modal gdpr message "
              "cookie-banner signup".split(),
    "advert": "ad ads advert advertisement sponsor sponsored promo banner-ad adsbox promoted google-ad ad-slot "
              "ad-container".split(),
    "comment": "comment comments discussion disqus replies comment-list reviews respond feedback commentlist "
               "user-comments".split(),
    "share": "share social meta byline tags sharing post-meta toolbar follow actions".split(),
}
PHRASES = {
    "nav": "Home|About|Contact|News|Blog|Start|Accueil|Inicio|Next|Previous|Products|Services|Kontakt|Archive|"
           "Über uns|À propos|Sport|Login|FAQ|Shop|Help|Menu|Categories",
    "header": "Welcome|Search|Sign in|The Daily|My Site|Register|Willkommen|Bienvenue|Bienvenidos",
    "footer": "© 2021|© All rights reserved|Privacy Policy|Terms of use|Impressum|Datenschutz|Copyright 2019|"
              "Mentions légales|Aviso legal|Powered by|Sitemap|Contact us|Todos los derechos reservados",
    "side": "Related articles|Most read|Popular posts|Recent comments|Read more|Tags|Recommended|Archives|"
            "Mehr zum Thema|À lire aussi|Lo más leído|Trending now",
    "notice": "We use cookies.|Accept all cookies|This site uses cookies to improve your experience.|"
              "Subscribe to our newsletter|Sign up now|Wir verwenden Cookies.|Nous utilisons des cookies.|"
              "Usamos cookies.|You have read your last free article.|Accept|Please enable JavaScript.",
    "advert": "Advertisement|Sponsored|Buy now!|Anzeige|Publicité|Publicidad|50% off|Click here|Promoted|"
              "Limited offer!|Order today|Ad",
    "comment": "Reply|Comments (3)|Leave a comment|Great post!|I agree.|Posted by|says:|Thanks for sharing.|"
               "Antworten|Répondre|Responder|2 comments|Log in to comment|Report",
    "share": "Share|Tweet|Facebook|Like|By|Posted on|5 min read|Print|Email|Teilen|Partager|Compartir|Updated",
    "form": "Name|Email|Password|Submit|Search|Send|Your message|Abschicken|Envoyer|Enviar|Log in|Remember me",
}
SYLLABLES = ("th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve ch sch ung "
             "lich keit ei au ü ö ä ß qu é è ê ç ment tion eau oi eux re le la os ción ado ente ñ ó í á ra ll mi "
             "ka zo bu pe lu ng").split()


class Maker:
    def __init__(self, rng: Random):
        self.r = rng
        self.parts: list[str] = []
        self.main: list[str] = []
        self.shout = rng.random() < 0.08
        self.junk = rng.choice(["", "", "", "", "%%%", "###", " |"])

    def word(self) -> str:
        return "".join(self.r.choice(SYLLABLES) for _ in range(self.r.choice((1, 1, 2, 2, 2, 3, 4))))

    def number(self) -> str:
        return self.r.choice((str(self.r.randrange(1_900, 2_030)), str(self.r.randrange(1_000)),
                              f"{self.r.randrange(100)}.{self.r.randrange(10)}", f"{self.r.randrange(101)} %"))

    def prose(self, least: int, most: int) -> str:
        n = self.r.randint(least, most)
        words = []
        start = True
        for i in range(n):
            w = self.number() if self.r.random() < 0.02 else self.word()
            w = w.capitalize() if start else w
            start = False
            w += self.junk
            if i == n - 1 or self.r.random() < 0.1:
                w += self.r.choice(".....?!")
                start = True
            elif self.r.random() < 0.08:
                w += ","
            words.append(w)
        text = " ".join(words)
        return text.upper() if self.shout else text

    def phrase(self, kind: str) -> str:
        """Boilerplate text: a usual phrase, made-up words, or both."""
        known = self.r.choice(PHRASES[kind].split("|"))
        pick = self.r.random()
        if pick < 0.45:
            return known
        if pick < 0.85:
            return self.prose(1, 14)
        return f"{known} {self.prose(1, 12)}"

    def attributes(self, kind: str, chance: float = 0.8) -> str:
        out = ""
        if self.r.random() < chance:
            names = [self.r.choice(CLASSES[kind])]
            if self.r.random() < 0.3:
                names.append(self.r.choice(CLASSES["neutral"]))
            if self.r.random() < 0.15:
                names.append(f"css-{self.r.randrange(16 ** 5):x}")
            self.r.shuffle(names)
            out = f' {self.r.choice(("class", "class", "class", "id"))}="{" ".join(names)}"'
        return out

    def emit(self, text: str) -> None:
        self.parts.append(text)

    def text(self, text: str, main: bool = False, inline: bool = True) -> str:
        """Escaped text; main text is remembered as a reader would see it."""
        if main:
            self.main.append(" ".join(text.split()))
        words = html.escape(text, quote=False).split(" ")
        if inline and len(words) > 4 and self.r.random() < 0.25:
            i = self.r.randrange(len(words) - 2)
            tag = self.r.choice(("b", "i", "em", "strong", "a", "span", "code"))
            words[i] = f"<{tag}{' href=/x' if tag == 'a' else ''}>{words[i]}"
            words[i + 1] += f"</{tag}>"
        return self.r.choice((" ", " ", "\n")).join(words) if self.r.random() < 0.1 else " ".join(words)

    def links(self, kind: str) -> None:
        n = self.r.randint(2, 8)
        style = self.r.random()
        items = [f'<a href="/{i}">{self.text(self.phrase(kind), inline=False)}</a>' for i in range(n)]
        if style < 0.6:
            self.emit("<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>")
        elif style < 0.8:
            self.emit(" | ".join(items))
        else:
            self.emit("".join(f"<div>{x}</div>" for x in items))

    def boiler(self, kind: str, tag: str = "div", chance: float = 0.85) -> None:
        named = 0.75 if kind == "comment" else 1.0
        attributes = self.attributes(kind, named if tag in ("div", "section", "p", "span") else chance - 0.45)
        self.emit(f"<{tag}{attributes}>")
        if kind in ("nav",):
            self.links("nav")
        elif kind == "form":
            self.form()
        elif kind in ("side", "footer", "header"):
            if tag == "header" and self.r.random() < 0.5:  # the name of the site
                self.emit(f"<h1>{self.text(self.prose(1, 3), inline=False)}</h1>")
            elif self.r.random() < 0.4:
                h = self.r.choice(("h1", "h2", "h3", "h4", "p")) if kind != "footer" else "p"
                self.emit(f"<{h}>{self.text(self.phrase(kind))}</{h}>")
            pick = self.r.random()
            if pick < 0.35:
                self.links("nav" if kind == "header" else kind)
            elif pick < 0.7:
                for _ in range(self.r.randint(1, 3)):
                    self.emit(f"<p>{self.text(self.phrase(kind))}</p>")
            else:
                self.emit(self.text(self.phrase(kind)))
        elif kind == "comment":
            if not attributes or self.r.random() < 0.6:  # something names the comments
                h = self.r.choice(("h2", "h3", "h3", "h4", "p"))
                self.emit(f"<{h}>{self.text(self.r.choice(PHRASES[kind].split('|')) if not attributes else self.phrase(kind))}</{h}>")
            for _ in range(self.r.randint(1, 4)):
                if self.r.random() < 0.2:
                    self.emit(f"<p>{self.text(self.prose(3, 30))}</p>")
                    continue
                inner = self.r.choice(('<div class="comment">', "<li>", "<div>", "<article>", '<div class="reply">'))
                end = inner[1:].split()[0].rstrip(">")
                name = f"<b>{self.word().title()}</b> " if self.r.random() < 0.5 else ""
                body = self.text(self.prose(3, 30) if self.r.random() < 0.7 else self.phrase(kind))
                body = f"<p>{body}</p>" if self.r.random() < 0.6 else body
                self.emit(f"{inner}{name}{body}</{end}>")
        else:
            body = self.text(self.phrase(kind) if self.r.random() < 0.6 else self.prose(3, 25))
            self.emit(f"<p>{body}</p>" if self.r.random() < 0.4 else body)
        self.emit(f"</{tag}>")

    def form(self) -> None:
        fields = "".join(
            self.r.choice((f"<label>{html.escape(self.phrase('form'))}</label><input name=x>",
                           f"<p>{html.escape(self.phrase('form'))} <input></p>", "<textarea>x</textarea>",
                           f"<select><option>{self.word()}<option>{self.word()}</select>"))
            for _ in range(self.r.randint(1, 3)))
        self.emit(f"<form{self.attributes('notice', 0.2)}>{fields}<button>{html.escape(self.phrase('form'))}</button></form>")

    def paragraph(self) -> None:
        pick = self.r.random()
        least, most = self.r.choice(((1, 6), (4, 30), (10, 60), (20, 90)))
        if pick < 0.72:
            text = self.text(self.prose(least, most), main=True)
            style = self.r.random()
            if style < 0.8:
                self.emit(f"<p>{text}</p>")
            elif style < 0.9:
                self.emit(f"<p>{text}")
            else:
                self.emit(f"<p><b>{text}<br>")
        elif pick < 0.8:
            h = self.r.choice(("h2", "h3", "h4"))
            self.emit(f"<{h}>{self.text(self.prose(1, 9), main=True)}</{h}>")
        elif pick < 0.87:
            tag = self.r.choice(("ul", "ol"))
            most = self.r.choice((4, 20))
            items = "".join(f"<li>{self.text(self.prose(1, most), main=True)}</li>" for _ in range(self.r.randint(1, 6)))
            self.emit(f"<{tag}>{items}</{tag}>")
        elif pick < 0.91:
            self.emit(f"<blockquote>{self.text(self.prose(4, 40), main=True)}</blockquote>")
        elif pick < 0.94:
            self.emit(f"<pre>{self.text(self.prose(4, 20), main=True)}</pre>")
        elif pick < 0.97:
            self.table()
        else:
            self.emit(f"<div>{self.text(self.prose(5, 50), main=True)}</div>")

    def table(self) -> None:
        columns, numbers = self.r.randint(2, 5), self.r.random() < 0.6
        cell = lambda tag, least, most: f"<{tag}>{self.text(self.prose(least, most), main=True)}</{tag}>"
        rows = ["".join(cell("th", 1, 3) for _ in range(columns))] if self.r.random() < 0.5 else []
        for _ in range(self.r.choice((1, 2, 3, 5))):
            rows.append("".join(f"<td>{self.text(self.number(), main=True)}</td>" if numbers and self.r.random() < 0.7
                                else cell("td", 1, 6) for _ in range(columns)))
        self.emit("<table>" + "".join(f"<tr>{x}</tr>" for x in rows) + "</table>")

    def body(self) -> None:
        r = self.r
        before = [k for k, p in (("notice", 0.25), ("header", 0.5), ("nav", 0.7), ("advert", 0.35), ("side", 0.15),
                                 ("form", 0.12), ("nav", 0.12)) if r.random() < p]
        after = [k for k, p in (("share", 0.2), ("advert", 0.25), ("side", 0.35), ("comment", 0.4), ("form", 0.15),
                                ("footer", 0.75), ("notice", 0.15)) if r.random() < p]
        r.shuffle(before)
        tags = {"nav": ("nav", "div", "ul", "header"), "header": ("header", "div"), "footer": ("footer", "div"),
                "side": ("aside", "div", "section"), "notice": ("div", "section"), "advert": ("div", "aside", "ins"),
                "comment": ("div", "section"), "share": ("div", "p", "ul"), "form": ("div", "section")}
        part = lambda k: self.boiler(k if k != "form" else "form", r.choice(tags[k])) if k != "form" else self.form()
        wraps = r.randint(0, 2)
        for _ in range(wraps):
            self.emit(f"<div{self.attributes('neutral')}>")
        for k in before:
            part(k)
        shape = r.random()
        if shape < 0.45:
            open_, close = f"<article{self.attributes('main', 0.4)}>", "</article>"
        elif shape < 0.6:
            open_, close = f"<main{self.attributes('main', 0.3)}>", "</main>"
        elif shape < 0.88:
            tag = r.choice(("div", "div", "section", "td"))
            open_, close = f"<{tag}{self.attributes('main', 1.0)}>", f"</{tag}>"
            if tag == "td":
                open_, close = f"<table><tr>{open_}", f"{close}</tr></table>"
        else:
            open_, close = f"<div{self.attributes('neutral')}>", "</div>"
        self.emit(open_)
        inner = r.randint(0, 1)
        if inner:
            self.emit(f"<div{self.attributes('main' if r.random() < 0.5 else 'neutral')}>")
        if r.random() < 0.85:
            words = self.prose(1, 14)
            title = f"<h1>{self.text(words, main=True, inline=False)}</h1>"
            self.emit(f"<header>{title}</header>" if r.random() < 0.15 else title)
            if r.random() < 0.12:  # a headline that the text repeats
                again = words if r.random() < 0.4 else f"{words} {self.prose(3, 30)}"
                self.emit(f"<p><b>{self.text(again, main=True, inline=False)}<br>")
            if r.random() < 0.25:
                self.boiler("share", r.choice(("div", "p", "ul")))
        for i in range(r.choice((0, 1, 2, 3, 5, 8, 12, 18))):
            self.paragraph()
            if r.random() < 0.04:
                part(r.choice(("advert", "side", "notice", "share", "form", "nav")))
        if r.random() < 0.12:
            part(r.choice(("comment", "side", "share", "advert", "footer")))
        if inner:
            self.emit("</div>")
        self.emit(close)
        for k in after:
            part(k)
        for _ in range(wraps):
            self.emit("</div>")


def generated_pages(count: int, seed: int) -> Iterator[tuple[str, set[str]]]:
    """(page, texts of its main blocks)"""
    rng = Random(seed)
    for i in range(count):
        m = Maker(rng)
        m.body()
        title = html.escape(m.prose(1, 8))
        head = f"<head><title>{title}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head>"
        yield (f"<!DOCTYPE html><html>{head if rng.random() < 0.8 else ''}<body>"
               f"{'<!-- x -->' if rng.random() < 0.5 else ''}{''.join(m.parts)}</body></html>", set(m.main))
