"""Main-text extraction from HTML: a linear-chain conditional random field over leaf blocks.

A page is cut into leaf blocks (text between block-level tags; scripts, styles, templates, titles, form
controls and comments of the markup are no text; the head ends where something starts that it cannot hold). Each block has features of its ancestor tags and their
class and id words, and of its text; labels are main text or not, decoded by Viterbi.

Training pages: the ``fit_pages`` pages with the smallest hashes of page_id and markup among
those that mark their article themselves (an article or main element) and have at most
``FIT_CHARS`` characters, all while there are fewer, copies once; blocks inside any outer article are main text, others
and those of articles nested in one (reader comments) are not. Each also enters in altered forms whose
labels are known by construction: the article element renamed to a division; sidebars, notices, adverts,
forms, headers and reader comments with text of other pages set around and inside it; and its text poured into other
markup (lists, tables, quotes, preformatted text, figures, definitions, divisions, bare text with line breaks, sections with
headings, a header of its own). Where no page is marked, the built-in pages of ``PLAIN_PAGES`` take their place. The
weights, a fixed number of them, maximise the penalised likelihood.

A null, empty or text-free page gives an empty text.
Repeated rows and ids keep a row each.
"""

from __future__ import annotations

import random
import re
import zlib
from html import escape
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import append, narrow

DIM, FIT_CHARS, LONGEST = 1 << 13, 200_000, 64
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style template textarea select title".split())
#: What a head may hold; any other element or text ends it, as its own end tag does.
HEADED = frozenset("head title base basefont bgsound link meta noframes noscript script style template".split())
BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul""".split())
#: An opening tag ends an open element of these kinds, up to the nearest container.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = frozenset("ul ol dl table body html article section div main".split())
_WORD = re.compile(r"[a-z]+").findall


class Blocks(HTMLParser):
    """Leaf blocks of a page in order: (names of ancestor features, own tag, text, share of linked text, label)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, tuple[str, ...], str | None]] = []
        self.active: dict[str, int] = {}
        self.found: list[tuple[tuple[str, ...], str, str, float, str | None]] = []
        self.parts: list[str] = []
        self.linked = self.silent = 0

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                tag = next((t for t, _, _ in reversed(self.stack) if t in BLOCK), "")
                label = next((x for _, _, x in reversed(self.stack) if x), None)
                self.found.append((tuple(self.active), tag, text, min(1.0, self.linked / len(text)), label))
            self.parts, self.linked = [], 0

    def push(self, tag: str, names: tuple[str, ...], label: str | None) -> None:
        self.stack.append((tag, names, label))
        for n in names:
            self.active[n] = self.active.get(n, 0) + 1
        self.silent += tag in SILENT

    def pop(self) -> None:
        tag, names, _ = self.stack.pop()
        for n in names:
            self.active[n] -= 1
            if not self.active[n]:
                del self.active[n]
        self.silent -= tag in SILENT

    def leave_head(self) -> None:
        while "t:head" in self.active:
            self.pop()

    def handle_starttag(self, tag, attrs):
        if "t:head" in self.active and tag not in HEADED and "t:template" not in self.active and (tag in BLOCK or "t:title" not in self.active):
            self.leave_head()
        if tag in BLOCK:
            self.flush()
            ends = {"p"} | CLOSES.get(tag, set())
            for k in range(len(self.stack) - 1, -1, -1) if any("t:" + e in self.active for e in ends) else ():
                if self.stack[k][0] in ends:
                    while len(self.stack) > k:
                        self.pop()
                    break
                if self.stack[k][0] in HOLDS:
                    break
        elif tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        names, label = ["t:" + tag], None
        for key, value in attrs:
            if value and key in ("class", "id", "role"):
                names += ["c:" + w for w in dict.fromkeys(_WORD(value.lower()))]
            elif key == "data-cadence-label":
                label = value
        self.push(tag, tuple(names), label)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in SILENT:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self.flush()
        if "t:" + tag in self.active:
            while self.pop_until(tag):
                pass

    def pop_until(self, tag: str) -> bool:
        last = self.stack[-1][0]
        self.pop()
        return last != tag

    def handle_data(self, data):
        if not self.silent:
            if "t:head" in self.active and data.strip():
                self.leave_head()
            self.parts.append(data)
            if "t:a" in self.active:
                self.linked += len(data)


def blocks(html: str | None) -> list[tuple[tuple[str, ...], str, str, float, str | None]]:
    if not html:
        return []
    p = Blocks()
    p.feed(html)
    p.close()
    p.flush()
    return p.found


_BUCKET: dict[str, int] = {}


def bucket(name: str) -> int:
    got = _BUCKET.get(name)
    if got is None:
        if len(_BUCKET) > 100_000:
            _BUCKET.clear()
        got = _BUCKET[name] = zlib.crc32(name.encode()) % (DIM - 1) + 1
    return got


def features(found: list) -> list[list[int]]:
    """Buckets of each block's features; bucket 0 is the bias."""
    out = []
    for k, (names, tag, text, linked, _) in enumerate(found):
        own = [*names, "own:" + tag, f"len:{min(10, len(text).bit_length())}", f"linked:{int(linked * 3)}",
               "end:" + ("stop" if text[-1] in ".!?…\"”»" else "open"), "mark:" + ("©" if "©" in text else "-"),
               f"commas:{min(3, text.count(','))}", "first" if k == 0 else "last" if k == len(found) - 1 else "inner"]
        out.append([0, *map(bucket, own)])
    return out


def viterbi(score: np.ndarray, move: np.ndarray) -> list[bool]:
    """Best labels of a chain; score: of label 1 over label 0, move: 2 x 2 transitions, then the two starts."""
    (a, b), (c, d) = move[:2].tolist()
    x, y = float(move[2, 0]), float(move[2, 1])
    back: list[tuple[bool, bool]] = []
    for k, s in enumerate(score.tolist()):
        if k:
            back.append((y + c > x + a, y + d > x + b))
            x, y = max(x + a, y + c), max(x + b, y + d)
        y += s
    out = [y > x]
    for to0, to1 in reversed(back):
        out.append(to1 if out[-1] else to0)
    return out[::-1]


def extract(html: str | None, weights: np.ndarray, move: np.ndarray) -> str:
    found = blocks(html)
    if not found:
        return ""
    score = np.array([weights[f].sum() for f in features(found)])
    return "\n\n".join(b[2] for b, keep in zip(found, viterbi(score, move), strict=True) if keep)


#: Comments and silent elements are passed over; article and main tags are what is looked for.
_MARKS = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|template|textarea)\b.*?(?:</\1\s*>|\Z)|<(/?)(article|main)\b([^>]*)>", re.S | re.I)
NAMES = ("content", "post", "entry", "story", "article-body", "main-content", "post-body")
ASIDES = ('<aside>{}</aside>', '<div class="sidebar"><p>{}</p></div>', '<div class="notice">{}</div>', '<div class="ad">{}</div>', '<div class="advert banner"><p>{}</p></div>',
          '<div class="cookie consent">{}</div>', '<form><label>{}</label><button>Send</button></form>', '<section class="comments"><h2>Comments</h2><div class="comment"><p>{}</p></div></section>',
          '<div id="comments"><ol><li><p>{}</p></li><li>{}</li></ol></div>', '<header><p>{}</p></header>', '<div class="related"><ul><li><a href="#">{}</a></li></ul></div>',
          '<nav><a href="#">{}</a></nav>', '<div class="newsletter subscribe"><p>{}</p></div>', '<footer><p>{}</p></footer>', '<div class="share social"><a href="#">{}</a></div>',
          '<div class="menu"><ul><li>{}</li></ul></div>', '<div role="alert" class="warning"><p>{}</p></div>',
          '<aside><h3>{}</h3><ul><li><a href="#">{}</a></li><li><a href="#">{}</a></li></ul></aside>', '<div class="sidebar"><h2>{}</h2><p>{}</p><table><tr><td>{}</td><td>{}</td></tr></table></div>',
          '<footer><h4>{}</h4><ul><li><a href="#">{}</a></li></ul><p>{}</p></footer>', '<section class="comments"><h3>{}</h3><blockquote>{}</blockquote><p>{}</p></section>',
          '<section id="comments"><article class="comment"><h3>{}</h3><p>{}</p></article><article class="comment"><p>{}</p></article></section>',
          '<div class="ad"><figure><figcaption>{}</figcaption></figure></div>', '<nav><h3>{}</h3><ol><li>{}</li><li><a href="#">{}</a></li></ol></nav>', '<aside><dl><dt>{}</dt><dd>{}</dd></dl></aside>')


SHAPES = ("p", "p", "p", "div", "br", "ul", "ol", "quote", "pre", "table", "figure", "section", "dl", "h3", "link", "nested")

#: Pages that stand in where a table has no marked page.
PLAIN_PAGES = tuple(f"""<html><head><title>{title}</title></head><body><header><a href="/">Home</a></header><nav><ul><li><a href="/a">News</a></li><li><a href="/b">About us</a></li></ul></nav>
<article><h1>{title}</h1><p>{first}</p><p>{second}</p><p>{third}</p></article><aside><h3>Related</h3><ul><li><a href="/c">More like this</a></li></ul></aside><footer>&copy; Example</footer></body></html>"""
                    for title, first, second, third in (
    ("The river in spring", "The water rose for nine days, and on the tenth it reached the lower gardens.", "Nobody had expected it so early, though the old people had spoken of such years.", "By evening the road was dry again."),
    ("How bread is made", "Flour, water, salt and time are all that is needed.", "The dough is folded every half hour; between the folds it rests under a cloth.", "A hot stone does the rest, and the crust sings when it cools."),
    ("A short history of the lamp", "Before glass was cheap, lamps were open bowls with a wick of rush.", "Oil came from olives, seeds or fish, and the smell told a guest which.", "With the chimney came a steady flame, and with it the evening."),
    ("Rules of the game", "Each player draws five cards and keeps three.", "Whoever holds the lowest card begins, unless two are equal.", "The round ends when a player has no card left, and points are counted."),
    ("Letters from the coast", "We arrived late, since the ferry waits for the tide.", "The house stands where you said, but the second door is gone.", "I shall write again when the post boat comes on Friday.")))


def outer(html: str) -> list[tuple[int, int, int, list[int]]]:
    """Outermost article elements of a page, or main elements if it has none: start, end of the opening tag, start of
    the closing tag, and the ends of the opening tags of articles nested inside."""
    marks = [m for m in _MARKS.finditer(html) if m[3]]
    kind = "article" if any(m[3].lower() == "article" for m in marks) else "main"
    out, depth, start, inner = [], 0, None, []
    for m in marks:
        if m[3].lower() != kind:
            continue
        if not m[2]:
            depth += 1
            if depth == 1:
                start, inner = m, []
            else:
                inner.append(m.end())
        elif depth:
            depth -= 1
            if not depth:
                out.append((start.start(), start.end(), m.start(), inner))
    if depth:
        out.append((start.start(), start.end(), len(html), inner))
    return out


def labelled(html: str, spans: list[tuple[int, int, int, list[int]]]) -> str:
    """The page with its articles marked as main text, articles nested in them as none."""
    at = sorted([(b, "1") for _, b, _, _ in spans] + [(x, "0") for *_, inner in spans for x in inner], reverse=True)
    for end, label in at:  # before the closing angle bracket, or before the slash of a tag that closes itself
        cut_at = end - 2 if html[end - 2] == "/" else end - 1
        html = f'{html[:cut_at]} data-cadence-label="{label}"{html[cut_at:]}'
    return html


def reshape(texts: list[tuple[str, str]], pick: random.Random) -> str:
    """Main text (own tag, text of each block), whole or only its beginning, in other markup: of one kind or mixed."""

    def pieces(words: list[str], most: int) -> list[str]:
        size = max(1, -(-len(words) // pick.randint(2, most)))
        return [escape(" ".join(words[k:k + size])) for k in range(0, len(words), size)]

    if pick.random() < 0.4:
        texts = texts[:pick.randint(1, 5)]
    style, out = pick.choice(SHAPES) if pick.random() < 0.5 else None, []
    for k, (tag, text) in enumerate(texts):
        words, whole = text.split(), escape(text)
        if tag in ("h1", "h2"):
            out.append(f"<header><{tag}>{whole}</{tag}></header>" if not k and pick.random() < 0.4 else f"<{tag}>{whole}</{tag}>")
            continue
        shape = style or pick.choice(SHAPES)
        head, rest = escape(" ".join(words[:4])), escape(" ".join(words[4:]) or text)
        if shape in ("ul", "ol"):
            out.append(f"<{shape}>" + "".join(f"<li>{x}</li>" for x in pieces(words, 5)) + f"</{shape}>")
        elif shape == "table":
            cells = pieces(words, 6)
            rows = [cells[j:j + 2] for j in range(0, len(cells), 2)]
            top = pick.random() < 0.5
            out.append("<table>" + "".join("<tr>" + "".join(f"<th>{x}</th>" if top and not j else f"<td>{x}</td>" for x in r) + "</tr>" for j, r in enumerate(rows)) + "</table>")
        else:
            out.append({"p": f"<p>{whole}</p>", "div": f"<div>{whole}</div>", "br": f"{whole}<br><br>", "quote": f"<blockquote><p>{whole}</p></blockquote>" if pick.random() < 0.5 else f"<blockquote>{whole}</blockquote>",
                        "pre": f"<pre>{whole}</pre>", "figure": f'<figure><img src="x.png"><figcaption>{head}</figcaption></figure><p>{rest}</p>',
                        "section": f"<section><h2>{head}</h2><p>{rest}</p></section>", "dl": f"<dl><dt>{head}</dt><dd>{rest}</dd></dl>", "h3": f"<h3>{head}</h3><p>{rest}</p>",
                        "link": f'<p><a href="/x">{head}</a> {rest}</p>', "nested": f"<div><div><p>{whole}</p></div></div>"}[shape])
    return "".join(out)


def training_pages(pages: list[str], seed: int = 7) -> list[str]:
    """Labelled pages: each as it is, in two forms with foreign text around and inside, and in three with its text reshaped."""
    pick = random.Random(seed)
    texts = [t for h in pages for t in re.findall(r"<p>([^<]{20,300})</p>", h)[:5]] or ["text"]
    out = []
    for h in pages:
        if not (spans := outer(h)):
            continue
        whole = labelled(h, spans)
        out.append(whole)
        start, opened, closed, _ = max(outer(whole), key=lambda x: x[2] - x[1])
        before, body, after = whole[:start], whole[opened:closed], re.sub(r"^</\w+\s*>", "", whole[closed:])
        own = [(tag, text) for _, tag, text, _, label in blocks(f'<div data-cadence-label="1">{body}</div>') if label == "1"]
        some = lambda _: " ".join(pick.choice(texts).split()[:pick.choice([1, 2, 4, 60, 60])])
        noise = lambda: "".join(re.sub(r"^<(\w+)", r'<\1 data-cadence-label="0"', re.sub(r"\{\}", some, a)) for a in pick.sample(ASIDES, 3))
        cuts = [x.start() for x in re.finditer(r"<p>", body)]
        for form in range(5):
            if form < 2:
                at = pick.choice(cuts) if cuts else len(body)
                inside = f"{body[:at]}{noise()}{body[at:]}{noise()}"
            else:
                inside = reshape(own, pick) + (noise() if pick.random() < 0.5 else "")
            name, extra = (("article", ""), ("div", f' class="{pick.choice(NAMES)}"'), (pick.choice(("article", "main")), ""), ("div", f' class="{pick.choice(NAMES)}"'), ("div", ""))[form]
            around = noise if form < 2 else (lambda: noise() if pick.random() < 0.5 else "")
            out.append(f'{before}{around()}<{name}{extra} data-cadence-label="1">{inside}</{name}>{around()}{after}')
    return out


def train(labelled: list[str], steps: int = 120, rate: float = 0.15, ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions that maximise the penalised likelihood (Adam on the whole gradient,
    all chains a step at a time)."""
    chains = []
    for h in labelled:
        found = blocks(h)
        rows, labels = features(found), [b[4] == "1" for b in found]
        chains += [(rows[k:k + LONGEST], labels[k:k + LONGEST]) for k in range(0, len(rows), LONGEST)]
    weights, move = np.zeros(DIM + 1), np.zeros((3, 2))
    if not chains:
        weights[0] = -50.0
        return weights[:DIM], move
    n, t = len(chains), max(len(r) for r, _ in chains)
    width = max(len(f) for r, _ in chains for f in r)
    at, y, on = np.full((n, t, width), DIM), np.zeros((n, t), int), np.zeros((n, t), bool)
    for i, (rows, labels) in enumerate(chains):
        for k, f in enumerate(rows):
            at[i, k, :len(f)] = f
        y[i, :len(rows)], on[i, :len(rows)] = labels, True
    total = on.sum()
    m = [np.zeros(DIM + 7), np.zeros(DIM + 7)]
    for step in range(1, steps + 1):
        weights[DIM] = 0
        emit = np.stack([np.zeros((n, t)), weights[at].sum(axis=2)], axis=2)
        fwd, bwd = np.zeros((n, t, 2)), np.zeros((n, t, 2))
        fwd[:, 0] = move[2] + emit[:, 0]
        for k in range(1, t):
            new = np.logaddexp(fwd[:, k - 1, :1] + move[0], fwd[:, k - 1, 1:] + move[1]) + emit[:, k]
            fwd[:, k] = np.where(on[:, k, None], new, fwd[:, k - 1])
        for k in range(t - 2, -1, -1):
            ahead = emit[:, k + 1] + bwd[:, k + 1]
            new = np.stack([np.logaddexp(*(move[s] + ahead).T) for s in (0, 1)], axis=1)
            bwd[:, k] = np.where(on[:, k + 1, None], new, 0)
        z = np.logaddexp(*fwd[:, -1].T)
        p1 = np.exp(fwd[:, :, 1] + bwd[:, :, 1] - z[:, None]) * on
        diff = (y - p1) * on
        grad = np.zeros(DIM + 7)
        grad[:DIM + 1] = np.bincount(at.ravel(), np.repeat(diff.ravel(), width), minlength=DIM + 1)
        pair = np.zeros((3, 2))
        for a in (0, 1):
            for b in (0, 1):
                want = ((y[:, :-1] == a) & (y[:, 1:] == b) & on[:, 1:]).sum()
                have = (np.exp(fwd[:, :-1, a] + move[a, b] + emit[:, 1:, b] + bwd[:, 1:, b] - z[:, None]) * on[:, 1:]).sum()
                pair[a, b] = want - have
        first = np.exp(fwd[:, 0] + bwd[:, 0] - z[:, None])
        pair[2] = [(y[:, 0] == s).sum() - first[:, s].sum() for s in (0, 1)]
        grad[DIM + 1:] = pair.ravel()
        now = np.concatenate([weights, move.ravel()])
        grad = grad / total - ridge * now
        m[0], m[1] = 0.9 * m[0] + 0.1 * grad, 0.99 * m[1] + 0.01 * grad ** 2
        now = now + rate * (m[0] / (1 - 0.9 ** step)) / (np.sqrt(m[1] / (1 - 0.99 ** step)) + 1e-8)
        weights, move = now[:DIM + 1], now[DIM + 1:].reshape(3, 2)
    return weights[:DIM], move


def fit(pages: DataFrame, fit_pages: int = 200) -> tuple[np.ndarray, np.ndarray]:
    able = (pages.where(F.col("html").rlike("(?i)<(article|main)[ >]") & (F.length("html") <= FIT_CHARS) & F.col("page_id").isNotNull())
            .select(F.xxhash64("page_id", "html").alias("h"), "html"))
    chosen = [r.h for r in able.select("h").distinct().orderBy("h").limit(fit_pages).collect()]
    own = able.where(F.col("h").isin(chosen)).groupBy("h").agg(F.min("html").alias("html"))  # one row of each, before anything moves
    return train(training_pages(sorted(r.html for r in own.collect()) or list(PLAIN_PAGES) * 8))


def main_text(df: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", fit_pages: int = 200) -> DataFrame:
    """page_id, url, text, n_chars, one row for each input row."""
    pages = narrow(df, page_id=page_id, url=url, html=html)
    shared = pages.sparkSession.sparkContext.broadcast(fit(pages, fit_pages))

    def start():
        weights, move = shared.value
        return lambda texts: [[extract(t, weights, move) for t in texts]]

    return append(pages, "html", "text string", start).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
