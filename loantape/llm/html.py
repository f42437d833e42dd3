"""Main text of web pages by two passes of rules over their blocks.

First every block is judged by itself: by the tags and names it stands under, then by its length, the
share of its text in links and the density of stop words. Blocks too short or too mixed to tell stay
open; in the second pass they take the label of the nearest decided neighbours.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loantape.llm.store import other_columns, prepare

# Frequent function words of some languages, and HTML's element names.
STOP_WORDS = frozenset(
    """a about after all also an and are as at be been but by can could for from had has have he her his
    how i if in into is it its more no not of on one or our out she so some than that the their them
    then there these they this to up was we were what when which who will with would you your
    aber als am an auch auf aus bei bin bis das dass dem den der des die durch ein eine einem einen einer
    er es für haben hat ich ihr im in ist kann man mit nach nicht noch nur oder sein sich sie sind so
    über um und uns unter vom von vor war was wenn werden wie wir wird zu zum zur
    au aux avec ce ces cette comme dans de des du elle en est et être il ils je la le les leur mais ne
    nous on ont ou où par pas plus pour qu que qui sa se ses si son sont sur un une vous à
    al como con cuando de del desde donde el ella en entre era es esta este fue ha hay la las lo los más me
    mi muy no o para pero por porque que se ser si sin sobre son su sus también un una y ya
    com da das do dos e em foi mais mas na nas nos não os pela pelo por são seu sua também uma
    che chi ci da dal della delle di è gli ha i il io lo ma nel non per più quella questo se si sono tra
    aan bij dan dat de die een en er het hij ik je maar met naar niet of om ook op te tot uit van voor
    w z na i nie to się że do jest jak o och att det som på är av för den till med har en inte""".split()
)
BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main
    menu nav noscript ol optgroup option p pre section select summary table tbody td tfoot th thead
    title tr ul""".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(
    """audio button canvas datalist head iframe math noframes noscript object option script select style
    svg template textarea title video""".split()
)
CHROME = frozenset("aside dialog fieldset footer form header legend menu nav".split())
CHROME_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
CHROME_NAMES = re.compile(
    r"""(?:^|[\s_-])(?:ad|ads|advert\w*|adsense|alert|banner\w*|breadcrumb\w*|comment\w*|consent|cookie\w*
    |copyright|disclaimer|disqus\w*|foot|footer\w*|gdpr|header|login|masthead|menu\w*|modal|nav|navbar|navigation
    |newsletter|notice\w*|notification\w*|overlay|pagination|pager|popup|promo\w*|related|replies|reply|respond
    |share\w*|sharing|sidebar\w*|signup|skip-link|social\w*|sponsor\w*|subscribe|toolbar|widget\w*)(?=$|[\s_-]|\d)""",
    re.VERBOSE,
)
FIRM_NAMES = re.compile(r"(?:^|[_-])(?:ads?(?=$|[_-])|advert|comment|disqus|foot|nav|menu|pagination|pager|promo|related|repl|respond|sidebar|social|share|sponsor|widget)")
# Names that say what a page has, or how it shows it, and not what the element is.
COMPOUND = re.compile(r"^(?:has|no|not|with|without|is|show|hide|use|enable|disable)[_-]|[_-](?:fixed|sticky|enabled|disabled|closed|open|visible|layout)$")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements whose content is read as text.
RAW = frozenset("script style textarea title iframe noframes xmp noembed".split())
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_MARK = re.compile(r"<(?=/?[a-zA-Z]|/.|[!?])", re.DOTALL)
_BARE_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)>")
_GAP = re.compile(r"[\s/]*")
_ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*)(\s*=\s*)?")
_BARE = re.compile(r"[^\s>]*")
_COMMENT_END = re.compile(r"--!?>")
_NUMBER = re.compile(r"&#(?:[xX]([0-9a-fA-F]+)|([0-9]+));?")
_READ = frozenset(["class", "id", "role", "style", "hidden", "aria-hidden"])
ARTICLE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:article|articlebody|content|entry|main|post|story|text)(?=$|[\s_-]|body|content|text)"
)
# Elements that a start tag of the same kind closes, as their end tags may be left out.
CLOSED_BY = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
PARAGRAPH = frozenset(["p"])
LIMITS = frozenset(["ul", "ol", "dl", "table", "div", "section", "article", "main", "body"])

SHORT = 60
LONG = 160
STOP_LOW = 0.10
STOP_HIGH = 0.25
LINKS_HIGH = 0.35

GOOD, BAD, OPEN = 1, 0, -1
# How firm an inherited verdict is. A form or a wrapper named after something its page has may hold
# the article itself; comments, teasers and the like may not, although they hold articles too.
PLAIN, FORM, LOOSE, FIRM = 0, 1, 2, 3
_WORD = re.compile(r"[^\W\d_]+")


class Block:
    __slots__ = ("parts", "linked", "chars", "chrome", "article", "heading", "paragraph")

    def __init__(self, chrome: bool, article: bool, heading: bool, paragraph: bool) -> None:
        self.parts: list[str] = []
        self.linked = self.chars = 0
        self.chrome, self.article, self.heading, self.paragraph = chrome, article, heading, paragraph

    def text(self) -> str:
        return " ".join("".join(self.parts).split())


@lru_cache(maxsize=4096)
def verdict_of_names(names: str, in_article: bool) -> int:
    """What an element's class and id say: not chrome, wrapper of chrome or of a page that has some,
    or chrome whatever is inside."""
    found = PLAIN
    for name in names.split():
        if COMPOUND.search(name):
            continue
        if in_article:
            # The header of an article holds its title.
            name = name.replace("header", "")
        if CHROME_NAMES.search(name):
            found = max(found, FIRM if FIRM_NAMES.search(name) else LOOSE)
    return found


def _shorter(found: re.Match) -> str:
    base, digits = ("x", found[1]) if found[1] else ("", found[2])
    digits = digits.lstrip("0") or "0"
    return f"&#{base}{digits};" if len(digits) < 9 else "\ufffd"


def plain(text: str) -> str:
    """The text with its character references decoded."""
    if "&" not in text:
        return text
    # Numbers of thousands of digits are no characters, and slow to read.
    return unescape(_NUMBER.sub(_shorter, text) if "&#" in text else text)


class _Reader:
    """Cuts a page into blocks at block elements; what is never shown is left out.

    One pass forward: no part of the page is looked at more than a bounded number of times, and an
    element is found among the open ones by its name's own list of places.
    """

    def __init__(self) -> None:
        self.blocks: list[Block] = []
        # Open elements: name, hidden, chrome, article.
        self.stack: list[tuple[str, bool, int, bool]] = [("", False, PLAIN, False)]
        # Places in the stack of each name, of block elements and of containers.
        self.at: dict[str, list[int]] = {}
        self.block_at, self.limit_at = [0], [0]
        self.links = 0
        self.now: Block | None = None

    def read(self, page: str) -> list[Block]:
        at, end = 0, len(page)
        while at < end:
            found = _MARK.search(page, at)
            if found is None:
                self._text(page[at:])
                break
            mark = found.start()
            if mark > at:
                self._text(page[at:mark])
            at = self._markup(page, mark)
        self._cut()
        return self.blocks

    def _markup(self, page: str, at: int) -> int:
        """Read what begins with ``<`` and return where it ends."""
        end = len(page)
        if page.startswith("<!--", at):
            if page.startswith((">", "->"), at + 4):
                return page.index(">", at + 4) + 1
            found = _COMMENT_END.search(page, at + 4)
            return found.end() if found else end
        if page[at + 1] in "!?" or (page[at + 1] == "/" and not page[at + 2 : at + 3].isalpha()):
            if page.startswith("<![CDATA[", at):
                found = page.find("]]>", at)
                return found + 3 if found >= 0 else end
            found = page.find(">", at + 2)
            return found + 1 if found >= 0 else end
        found = _BARE_TAG.match(page, at) or _TAG.match(page, at)
        closing, tag = found[1], found[2].lower()
        attrs: dict[str, str] = {}
        at = found.end()
        if page[at - 1] == ">":
            at -= 1
        while True:
            at = _GAP.match(page, at).end()
            if at >= end:
                return end  # a tag that the page ends in is none
            if page[at] == ">":
                break
            found = _ATTRIBUTE.match(page, at)
            name, at = found[1].lower(), found.end()
            value = ""
            if found[2] is not None:
                quote = page[at : at + 1]
                if quote in ('"', "'") and quote:
                    close = page.find(quote, at + 1)
                    if close < 0:
                        return end
                    value, at = page[at + 1 : close], close + 1
                else:
                    found = _BARE.match(page, at)
                    value, at = found[0], found.end()
            if name in _READ and name not in attrs:
                attrs[name] = plain(value)
        own_end = page[at - 1] == "/"
        at += 1
        if closing:
            self._end(tag)
            return at
        self._start(tag, attrs)
        if tag in RAW:
            # What such an element holds is no markup.
            found = re.compile(f"</{tag}(?=[\\s/>])", re.IGNORECASE).search(page, at)
            if found is None:
                return end
            return self._markup(page, found.start())
        if own_end and tag not in VOID and tag != "br":
            self._end(tag)
        return at

    def _cut(self) -> None:
        if self.now is not None and self.now.chars:
            self.blocks.append(self.now)
        self.now = None

    def _start(self, tag: str, attrs: dict[str, str]) -> None:
        if tag == "br":
            self._add(" ")
            return
        if tag in BLOCKS:
            self._cut()
            self._close(CLOSED_BY.get(tag, PARAGRAPH))
        if tag in VOID:
            return
        _, hidden, chrome, article = self.stack[-1]
        named = f"{attrs.get('class', '')} {attrs.get('id', '')}".lower() if attrs else ""
        hidden = hidden or tag in HIDDEN or "hidden" in attrs or attrs.get("aria-hidden") == "true"
        if "style" in attrs:
            hidden = hidden or bool(re.search(r"display\s*:\s*none", attrs["style"]))
        inside = tag in ("article", "main") or (tag in BLOCKS and named != "" and bool(ARTICLE_NAMES.search(named)))
        if tag == "main" or (inside and chrome == FORM) or (tag == "article" and chrome == LOOSE):
            # The page's wrapper had a name of something that the page has besides.
            chrome = min(chrome, PLAIN) if chrome < FIRM or tag == "main" else chrome
        if (attrs or tag in CHROME) and tag not in ("html", "body", "article", "main"):
            by_tag = FIRM if tag in CHROME else PLAIN
            if tag == "form":
                by_tag = FORM
            if tag == "header" and (article or inside):
                by_tag = PLAIN
            if attrs.get("role", "").lower() in CHROME_ROLES:
                by_tag = max(by_tag, FORM if attrs["role"].lower() == "form" else FIRM)
            chrome = max(chrome, by_tag, verdict_of_names(named, article or inside))
        if tag == "a":
            self.links += 1
        place = len(self.stack)
        self.at.setdefault(tag, []).append(place)
        if tag in BLOCKS:
            self.block_at.append(place)
        if tag in LIMITS:
            self.limit_at.append(place)
        self.stack.append((tag, hidden, chrome, article or inside))

    def _last(self, tag: str) -> int:
        held = self.at.get(tag)
        return held[-1] if held else 0

    def _close(self, names: frozenset[str]) -> None:
        """End the innermost of these elements, unless it lies outside the container we are in."""
        place = max(map(self._last, names))
        if place > self.limit_at[-1]:
            self._leave(place)

    def _leave(self, place: int) -> None:
        for tag, *_ in reversed(self.stack[place:]):
            self.at[tag].pop()
            self.links -= tag == "a"
        del self.stack[place:]
        for held in (self.block_at, self.limit_at):
            while held[-1] >= place:
                held.pop()

    def _end(self, tag: str) -> None:
        if tag in BLOCKS:
            self._cut()
        place = self._last(tag)
        if place and (tag in BLOCKS or place > self.block_at[-1]):
            self._leave(place)

    def _text(self, text: str) -> None:
        self._add(plain(text))

    def _add(self, data: str) -> None:
        tag, hidden, chrome, article = self.stack[-1]
        if hidden:
            return
        if self.now is None:
            near = {e[0] for e in self.stack[-3:]}
            self.now = Block(chrome > PLAIN, article, bool(near & HEADINGS), self.stack[self.block_at[-1]][0] == "p")
        seen = len(data) - data.count(" ") if data.strip() else 0
        self.now.parts.append(data)
        self.now.chars += seen
        if self.links:
            self.now.linked += seen


def blocks_of(page: str) -> list[Block]:
    return _Reader().read(page)


def judge(block: Block, text: str, has_article: bool) -> int:
    """The label that a block earns by itself."""
    if block.chrome:
        return BAD
    links = block.linked / block.chars
    if links > LINKS_HIGH and not block.heading and not (block.article and block.paragraph):
        return BAD
    if text[0] in "©" and len(text) < LONG:
        return BAD
    if has_article:
        # A page that marks its article has told what lies outside it.
        if not block.article:
            return BAD
    if len(text) < SHORT:
        return OPEN
    words = _WORD.findall(text.lower())
    stops = sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0
    if stops >= STOP_HIGH or (stops >= STOP_LOW and len(text) >= LONG):
        return GOOD
    return OPEN


def settle(labels: list[int], tie: list[int]) -> list[int]:
    """Open labels take the nearest decided one; at equal distance, or with none, ``tie`` decides."""
    n = len(labels)
    before, after = [None] * n, [None] * n
    last = None
    for i in range(n):
        last = i if labels[i] != OPEN else last
        before[i] = last
    last = None
    for i in range(n - 1, -1, -1):
        last = i if labels[i] != OPEN else last
        after[i] = last
    out = []
    for i, label in enumerate(labels):
        if label == OPEN:
            b, a = before[i], after[i]
            if b is None and a is None:
                label = tie[i]
            elif b is None or (a is not None and a - i < i - b):
                label = labels[a]
            elif a is None or i - b < a - i:
                label = labels[b]
            else:
                label = labels[b] if labels[a] == labels[b] else tie[i]
        out.append(label)
    return out


def main_text(page: str | None) -> str:
    """The article's blocks in page order, one per line; empty if there is none.

    In a page that marks an article, an open block keeps the label of its neighbours among the
    article's blocks alone; without marks, everything that is not judged bad competes.
    """
    blocks = [(b, b.text()) for b in blocks_of(page or "")]
    blocks = [(b, t) for b, t in blocks if t]
    has_article = any(b.article and not b.chrome for b, _ in blocks)
    labels = [judge(b, t, has_article) for b, t in blocks]
    if has_article:
        inner = [i for i, (b, _) in enumerate(blocks) if b.article and not b.chrome]
    else:
        inner = list(range(len(blocks)))
    tie = [GOOD if blocks[i][0].article or blocks[i][0].heading else BAD for i in inner]
    for i, label in zip(inner, settle([labels[i] for i in inner], tie)):
        labels[i] = label
    return "\n".join(t for (_, t), label in zip(blocks, labels) if label == GOOD)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text``, the main text, and ``n_chars``, its code points, in place of columns
    of these names.

    A null or empty page, or one without an article, has the empty text. No length is too long.
    Repeated rows each get their answer; an empty table stays empty.
    """
    prepare(pages.sparkSession)

    @F.arrow_udf("struct<text:string,n_chars:bigint>")
    def run(htmls: pa.Array) -> pa.Array:
        texts = [main_text(h.as_py()) for h in htmls]
        return pa.StructArray.from_arrays(
            [pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["text", "n_chars"]
        )

    kept = other_columns(pages, ["text", "n_chars"])
    row = F.struct(*[F.col(f"`{c}`") for c in kept])
    held = pages.select(row.alias("row"), run(F.col(f"`{html_col}`")).alias("made"))
    return held.select(*[F.col(f"row.`{c}`") for c in kept], "made.text", "made.n_chars")
