"""Marked pages to train the extractor on: pages put together at random from the parts that web pages have.

Elements whose whole subtree is not main text carry the attribute data-boilerplate; the extractor reads it as the
label and never as a feature. Pages marked by hand can be added in the same form.
"""

from __future__ import annotations

import random

# What classes and ids of such elements are called on the web.
CONTENT_NAMES = "content article post entry story main-content post-content entry-content article-body story-body page-content text prose blog-post".split()
BOILERPLATE_NAMES = {
    "ad": "ad ads advert advertisement ad-slot ad-banner banner sponsored sponsor promo promotion ad_unit adsbox".split(),
    "menu": "nav navbar menu main-menu navigation breadcrumbs breadcrumb pagination pager toolbar top-nav site-nav skip-links".split(),
    "header": "header site-header masthead topbar page-header branding logo".split(),
    "footer": "footer site-footer copyright colophon bottom page-footer legal".split(),
    "side": "sidebar side-bar widget widgets right-rail rail aside related related-posts recommended popular trending more-stories".split(),
    "notice": "cookie cookie-notice cookie-banner consent gdpr notice alert popup modal overlay newsletter subscribe signup-box disclaimer".split(),
    "comments": "comments comment-list comment reader-comments discussion responses replies user-comments disqus_thread".split(),
    "share": "share social share-buttons social-links sharing follow-us".split(),
    "form": "search search-form login-form contact-form signup form feedback".split(),
}
_SYLLABLES = "ba co di fu ge ha ki lo mu ne or pa qui re sta tor un vel xi zan".split()


class _Page:
    def __init__(self, seed: int):
        self.random = random.Random(seed)

    def words(self, low: int, high: int) -> str:
        r = self.random
        made = ["".join(r.choice(_SYLLABLES) for _ in range(r.randint(1, 3))) for _ in range(r.randint(low, high))]
        for i in range(0, len(made), r.randint(6, 14)):
            made[i] = made[i].capitalize()
            if i:
                made[i - 1] += "."
        return " ".join(made) + r.choice([".", "", "!", " &amp; "])

    def name(self, names: list[str]) -> str:
        value = self.random.choice(names)
        kind = self.random.choice(["class", "class", "id"])
        return f' {kind}="{value}"' if kind == "id" else f' class="{value}{self.random.choice(["", "", " box", " clearfix"])}"'

    def links(self, low: int, high: int, each: int = 2) -> str:
        items = [f'<a href="/{i}">{self.words(1, each)}</a>' for i in range(self.random.randint(low, high))]
        return self.random.choice(["<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>", " | ".join(items), "<div>" + " ".join(items) + "</div>"])

    def boilerplate(self, kind: str) -> str:
        r, mark = self.random, " data-boilerplate"
        names = self.name(BOILERPLATE_NAMES[kind])
        named = names if r.random() < 0.8 else ""
        prose = r.choice([self.words(3, 12), f"<p>{self.words(5, 60)}</p>", f"<span>{self.words(2, 9)}</span>"])
        match kind:
            case "menu":
                tag, own = r.choice([("nav", named), ("nav", ""), ("div", names), ("ul", names)])
                return f"<{tag}{own}{mark}>{self.links(2, 9)}</{tag}>"
            case "header":
                tag, own = r.choice([("header", named), ("div", names)])
                title = r.choice(["<h1>%s</h1>", "<div>%s</div>", '<a href="/">%s</a>', "<p>%s</p>"]) % self.words(1, 6)
                return f"<{tag}{own}{mark}>{title}{r.choice(['', self.links(2, 6)])}</{tag}>"
            case "footer":
                tag, own = r.choice([("footer", named), ("footer", ""), ("div", names)])
                return f"<{tag}{own}{mark}>{r.choice(['&copy; ', ''])}{self.words(2, 40)}{r.choice(['', self.links(2, 6)])}</{tag}>"
            case "side":
                tag, own = r.choice([("aside", named), ("aside", ""), ("div", names), ("section", names)])
                return f"<{tag}{own}{mark}>{r.choice(['', f'<h3>{self.words(1, 4)}</h3>'])}{r.choice([self.links(2, 8, 6), prose])}</{tag}>"
            case "comments":
                one = "".join(f'<{t}{r.choice([" class=comment", "", self.name(BOILERPLATE_NAMES[kind])])}><p>{self.words(3, 50)}</p></{t}>' for t in [r.choice(["div", "li", "article"])] * r.randint(1, 4))
                tag = r.choice(["div", "section", "ol"])
                return f"<{tag}{names}{mark}>{r.choice(['', f'<h2>{self.words(1, 3)}</h2>'])}{one}</{tag}>"
            case "form":
                fields = "".join(r.choice(['<label>%s</label><input type="text">', "<textarea>%s</textarea>", "<button>%s</button>", "<p>%s</p><select><option>a</option></select>"]) % self.words(1, 5) for _ in range(r.randint(1, 3)))
                return f"<form{named}{mark}>{fields}</form>"
            case _:
                tag = r.choice(["div", "div", "section", "p", "aside"]) if not prose.startswith("<p") else r.choice(["div", "section", "aside"])
                return f"<{tag}{names}{mark}>{prose}</{tag}>"

    def paragraph(self, short: bool = False) -> str:
        r = self.random
        text = self.words(1, 4) if short else self.words(*r.choice([(1, 8), (8, 40), (40, 120)]))
        if r.random() < 0.25:
            text = text.replace(" ", f" <a href=#>{self.words(1, 3)}</a> ", 1)
        if r.random() < 0.25:
            text = f"<b>{text}<br>" if r.random() < 0.4 else text.replace(" ", " <em>x</em> ", 1)
        return r.choice([f"<p>{text}</p>"] * 5 + [f"<p>{text}", f"<div>{text}</div>", f"<blockquote><p>{text}</p></blockquote>"])

    def body_part(self) -> str:
        r = self.random
        roll = r.random()
        if roll < 0.72:
            return self.paragraph()
        if roll < 0.82:
            return f"<h{(n := r.randint(2, 4))}>{self.words(1, 8)}</h{n}>"
        if roll < 0.92:
            tag = r.choice(["ul", "ol"])
            return f"<{tag}>" + "".join(f"<li>{self.words(1, 20)}</li>" for _ in range(r.randint(2, 5))) + f"</{tag}>"
        if roll < 0.96:
            return "<table>" + "".join(f"<tr><td>{self.words(1, 3)}</td><td>{self.words(1, 5)}</td></tr>" for _ in range(r.randint(1, 4))) + "</table>"
        return r.choice([f"<pre>{self.words(3, 15)}</pre>", f"<figure><img src=x><figcaption>{self.words(2, 9)}</figcaption></figure>", f"<section>{self.paragraph()}</section>"])

    def main(self) -> str:
        r = self.random
        title = f"<h1>{self.words(1, 12)}</h1>"
        parts = [self.body_part() for _ in range(r.choice([0, 1, 2, r.randint(3, 12)]))]
        if r.random() < 0.2:
            # verses, lists of lines, code: many short blocks
            parts += [self.paragraph(short=True) for _ in range(r.randint(2, 40))]
        for _ in range(r.choice([0, 0, 1, 2])):
            parts.insert(r.randint(0, len(parts)), self.boilerplate(r.choice(["ad", "share", "side", "form", "notice", "comments"])))
        head = r.choice([title, title, f"<header>{title}</header>", f'<div class="{r.choice(["entry-header", "post-header", "title"])}">{title}</div>', ""])
        inner = head + "".join(parts)
        tag, own = r.choice([("article", ""), ("article", ""), ("article", self.name(CONTENT_NAMES)), ("main", ""), ("div", self.name(CONTENT_NAMES)), ("section", self.name(CONTENT_NAMES))])
        if r.random() < 0.12:
            # no container at all, or one without a name
            return r.choice([inner, f"<div>{inner}</div>"])
        inner = f"<{tag}{own}>{inner}</{tag}>"
        return r.choice([inner, inner, f"<main>{inner}</main>", f'<div id="page">{inner}</div>'])

    def html(self) -> str:
        r = self.random
        before = [self.boilerplate(k) for k in ("notice", "header", "menu", "ad", "form", "menu") if r.random() < 0.4]
        after = [self.boilerplate(k) for k in ("share", "comments", "side", "ad", "notice", "form", "footer") if r.random() < 0.4]
        r.shuffle(before)
        page = "".join(before) + self.main() + "".join(after)
        if r.random() < 0.3:
            page = f'<div class="{r.choice(["wrapper", "container", "page", "site"])}">{page}</div>'
        tail = "</body></html>" if r.random() < 0.8 else ""
        return f"<!DOCTYPE html><html><head><title>{self.words(1, 6)}</title><style>p{{}}</style></head><body>{page}{tail}"


def marked_pages(count: int, seed: int) -> list[str]:
    return [_Page(seed * 1_000_003 + i).html() for i in range(count)]
