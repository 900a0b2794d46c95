"""HTML extraction (operator 10) by consensus paths of hosts.

Pass one parses every page into blocks of text and scores its containers: the
text that a container holds, less the text inside links. Each page casts a vote
for the generalised path of its best container (tags and classes, digits
replaced), and Spark adds up the votes of each host. Pass two extracts every
page again from the winning container of its host, or, where the page has none
of that path, from its own best one; either is widened to the lowest container
that leaves no main text beside it. Boxes directly in the body are told apart by
the votes alone. A page has one
vote, so a host's winner is the path that is best on most of its pages; a page that
has little text on that path still takes it, its other boxes being taken for what
the host puts beside its articles.

What never counts as main text: navigation, headers, footers, sidebars, forms,
scripts and styles by tag or role, and elements whose class or id is a name for
adverts, menus, notices or comments. A block with such a word only as a part of its
name (search-results-study), or a section with such an id, counts as furniture
outside the container chosen and directly in a body; headings never do by name.
Inside an article or main element, a header is the article's own, and a name that
may as well be a topic (sharing, search, related) makes furniture only of a block that
is more links than text.

Memory is linear in the page: a container knows its parent, a path is built for a
winner only, and other containers are told from it by a digest of their path.

Defined cases: null and empty pages, and pages without text, give an empty text;
a page without a usable URL votes under the empty host; unclosed, unopened and
wrongly nested tags are tolerated (a link that is never closed links only the
block it begins in); a page of nothing but links gives its text; repeated rows are extracted alike; ties
between paths go to the path first in string order.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.llm.common import append_columns, fresh_name, written
from tickwise.llm.urlfilter import host_and_path

# HTML elements by what they do to a page's text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea title svg iframe object canvas".split())
CHROME = set("nav header footer aside form menu dialog button select option label fieldset "
             "audio video map head".split())
BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset "
             "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav "
             "ol p pre section summary table tbody td tfoot th thead tr ul".split())
CONTAINERS = set("article body div main section td".split())
CHROME_ROLES = set("navigation banner contentinfo complementary search form menu menubar dialog "
                   "alert alertdialog".split())
CHROME_WORDS = set("ad ads adv advert adverts advertisement advertising sponsor sponsored promo "
                   "banner nav navbar navigation menu breadcrumb breadcrumbs header masthead footer "
                   "sidebar aside widget cookie cookies consent gdpr notice notices popup modal "
                   "overlay newsletter subscribe signup comment comments reply replies discussion "
                   "disqus respond share sharing social related recommended pagination pager "
                   "skip toolbar search login".split())

# Words that say nothing against a name of furniture, as in ad-box or share_buttons.
NEUTRAL_WORDS = set("box block container wrapper wrap inner outer list links link buttons button bar icons "
                    "slot unit area top bottom left right site posts articles stories".split())
# Words of furniture that are topics of articles as well.
TOPICS = set("search share sharing social related recommended discussion header respond login overlay skip".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())

# a quote begins a value only after an equals sign; elsewhere it is a character like others
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
                   r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*)(?:>|$)", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")
DIGITS = re.compile(r"\d+")
LETTERS = re.compile(r"[^a-z]+")


def _attributes(text: str) -> dict[str, str]:
    if "=" not in text and "hidden" not in text.lower():
        return {}
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(text)}


def _is_chrome(tag: str, attributes: dict[str, str], article: bool) -> int:
    """2 for furniture, 1 for a block that is furniture outside an article only, else 0."""
    if tag in CHROME and not (article and tag == "header"):
        return 2
    if attributes.get("role", "").lower() in CHROME_ROLES or "hidden" in attributes:
        return 2
    if "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return 2
    classes, ident = attributes.get("class", ""), attributes.get("id", "")
    if tag in ("html", "body", "main", "article") or tag in HEADINGS or not (classes or ident):
        return 0
    # the id of a section is most often a title of its own
    names = classes.split() + ([ident] if tag != "section" else [])
    if any(_is_furniture(n) and not (article and n.lower() in TOPICS) for n in names):
        return 2
    words = WORDS.findall(f"{classes} {ident}")
    return int(tag in BLOCKS and any(w.lower() in CHROME_WORDS for w in words))


def _is_furniture(name: str) -> bool:
    """Whether a class or id is a word of furniture, or several with nothing but neutral ones."""
    words = {w.lower() for w in WORDS.findall(name)}
    return LETTERS.sub("", name.lower()) in CHROME_WORDS or (
        not words.isdisjoint(CHROME_WORDS) and words <= CHROME_WORDS | NEUTRAL_WORDS)


class Containers:
    """The containers of a page by number: parent, own name and path digest of each; 0 is the page."""

    def __init__(self):
        self.parent, self.name, self.body = [-1], [""], [True]
        self._state = [xxhash.xxh3_128()]

    def add(self, parent: int, name: str, body: bool) -> int:
        state = self._state[parent].copy()
        state.update(f"/{name}".encode("utf-8", "replace"))
        self._state.append(state)
        self.parent.append(parent)
        self.name.append(name)
        self.body.append(body)
        return len(self.parent) - 1

    def __len__(self) -> int:
        return len(self.parent)

    def __getitem__(self, c: int) -> str:
        """The generalised path of a container."""
        if c >= len(self.parent):
            raise IndexError(c)
        names = []
        while c > 0:
            names.append(self.name[c])
            c = self.parent[c]
        return "".join("/" + n for n in reversed(names))

    def at(self, path: str) -> set[int]:
        """The containers of a path."""
        wanted = xxhash.xxh3_128_digest(path.encode("utf-8", "replace"))
        return {c for c, state in enumerate(self._state) if state.digest() == wanted}

    def sums(self, own: dict[int, float]) -> list[float]:
        """For every container the sum over itself and all within it."""
        out = [own.get(c, 0) for c in range(len(self.parent))]
        for c in range(len(out) - 1, 0, -1):  # parents have smaller numbers
            out[self.parent[c]] += out[c]
        return out

    def within(self, chosen: set[int]) -> list[bool]:
        """For every container whether it is one of ``chosen`` or inside one."""
        out: list[bool] = []
        for c, parent in enumerate(self.parent):
            out.append(c in chosen or c > 0 and out[parent])
        return out


def parse(page: str) -> tuple[list[tuple[str, int, int, int]], Containers]:
    """Blocks of main text in page order, and the containers.

    A block is (text, innermost container, characters of it in links, innermost
    container around all of the possible furniture it is in, or -1).
    """
    blocks: list[tuple[str, int, int, int]] = []
    paths = Containers()
    # tag, whether hidden, innermost container, container of the possible furniture
    stack: list[tuple[str, bool, int, int]] = [("", False, 0, -1)]
    open_tags: Counter = Counter()
    parts: list[str] = []
    linked = at = 0
    link: tuple[int, int] | None = None  # place in the stack and first block of the open link

    def flush() -> None:
        nonlocal linked
        if parts:
            if text := " ".join("".join(parts).split()):
                blocks.append((text, stack[-1][2], min(linked, len(text)), stack[-1][3]))
            parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw and not stack[-1][1]:
            text = entities.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if link:
                linked += len(text)

    def opened(tag: str) -> int:
        if not open_tags[tag]:
            return 0
        return next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)

    def cut(depth: int, closed: bool = False) -> None:
        """Close the elements from ``depth`` on; a link among them that no </a> closed ends with its first block."""
        open_tags.subtract(x[0] for x in stack[depth:])
        del stack[depth:]
        if link and link[0] >= depth:
            unlink(closed)

    def unlink(closed: bool) -> None:
        nonlocal link, linked
        if not closed and len(blocks) > link[1]:
            linked = 0
            for i in range(link[1] + 1, len(blocks)):
                blocks[i] = (*blocks[i][:2], 0, *blocks[i][3:])
        link = None

    end = len(page)
    while at < end:
        m = TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in BLOCKS:
                flush()
            depth = opened(tag)
            if depth:
                cut(depth, tag == "a")
            continue
        if tag in RAW:
            close = re.compile(f"</{re.escape(tag)}(?:[\\s/][^>]*)?(?:>|$)", re.I).search(page, at)
            at = close.end() if close else (end if tag in ("script", "style") else at)
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in BLOCKS:
            flush()
        if tag in VOID:
            continue
        if tag == "a" and (depth := opened("a")):  # links do not nest
            if link:
                unlink(False)
            del stack[depth]
            open_tags["a"] -= 1
        # a paragraph ends where another block begins, an item where the next one does
        if tag in BLOCKS:
            while stack[-1][0] == "p" or stack[-1][0] == tag == "li":
                cut(len(stack) - 1)
        attributes = _attributes(m[3])
        _, hidden, inner, doubt = stack[-1]
        chrome = _is_chrome(tag, attributes, bool(open_tags["article"] or open_tags["main"]))
        if tag == "main":
            doubt = -1
        elif chrome == 1 and doubt < 0:
            doubt = inner
        if tag in CONTAINERS:
            names = ".".join(sorted(DIGITS.sub("#", attributes.get("class", "")).split()))
            inner = paths.add(inner, tag + (f".{names}" if names else ""), tag == "body")
        if not m[3].endswith("/") or tag in BLOCKS:
            if tag == "a" and "href" in attributes:
                link = (len(stack), len(blocks))
            open_tags[tag] += 1
            stack.append((tag, hidden or chrome == 2, inner, doubt))
    flush()
    cut(1)
    return blocks, paths


def _plain(blocks) -> list:
    """The blocks that are in no possible furniture; all if there are none such."""
    return [b for b in blocks if b[3] < 0] or blocks


def best_container(blocks, paths: Containers) -> int:
    """The number of the container with the most unlinked text for its size.

    Among containers that hold nearly all of the best score the innermost wins,
    so that a page's body does not beat the article that holds its text; ``whole``
    then adds what the article holds around it. Where no container has more text
    than links, all text is taken as main text.
    """
    plain, own, held = _plain(blocks), Counter(), Counter()
    for text, c, linked, _ in plain:
        own[c] += len(text) - 1.5 * linked
        held[c] += 1
    score, held = paths.sums(own), paths.sums(held)
    top = max(s for s, n in zip(score, held, strict=True) if n)
    if top <= 0:
        return max(c for c, n in enumerate(held) if n == len(plain))
    return whole({max(c for c, s in enumerate(score) if held[c] and s >= 0.9 * top)}, blocks, paths).pop()


def whole(chosen, blocks, paths: Containers) -> set[int]:
    """The containers ``chosen``, each widened until no main text of its surroundings is left out.

    Main text is a block with more text than links. Boxes directly in the body
    compete with each other, so a body is taken only for text of its own.
    """
    plain = _plain(blocks)
    main = Counter(c for text, c, linked, _ in plain if len(text) > 1.5 * linked)
    any_text, held = paths.sums(Counter(b[1] for b in plain)), paths.sums(main)
    widened: dict[tuple[int, float], int] = {}  # by parent and text held; -1 for no wider one
    out = set()
    for first in chosen:
        if not any_text[first]:
            continue
        place = (paths.parent[first], held[first])
        if place not in widened:
            c, a, best = first, paths.parent[first], -1
            while a >= 0:
                if main[a] if paths.body[a] else held[a] > held[c]:
                    c = best = a
                a = paths.parent[a]
            widened[place] = best
        out.add(first if widened[place] < 0 else widened[place])
    return out


def container_vote(page: str) -> str | None:
    """The generalised path of a page's best container; none for a page without text."""
    blocks, paths = parse(page)
    return paths[best_container(blocks, paths)] if blocks else None


def main_text(page: str, path: str | None) -> str:
    """The text in and around containers of ``path``, or in the page's best one if it has none."""
    blocks, paths = parse(page)
    if not blocks:
        return ""
    chosen = whole(paths.at(path), blocks, paths) if path is not None else set()
    if not chosen:
        chosen = {best_container(blocks, paths)}
    inside = paths.within(chosen)
    article = paths.within({c for c in chosen if not paths.body[c]})
    doubtful = all(b[3] >= 0 for b in blocks)  # a page with nothing else
    return "\n".join(text for text, c, linked, doubt in blocks if (
        article[doubt] and len(text) > 1.5 * linked if doubt >= 0 and not doubtful else inside[c]))


def host_paths(pages: DataFrame, url: str, html: str) -> DataFrame:
    """The winning container path of every host (columns host, path)."""
    rows = pages.select(host_and_path(F.col(url))[0].alias("host"), F.col(html).alias("html"))

    def make():
        return lambda values: [pa.array([container_vote(v.decode("utf-8", "replace")) for v in values],
                                        pa.string())]

    votes = append_columns(rows, "html", [T.StructField("path", T.StringType())], make)
    return (votes.filter("path IS NOT NULL").groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("host").agg(F.min(F.struct((-F.col("n")).alias("n"), "path")).alias("best"))
            .select("host", "best.path"))


def extract_text(pages: DataFrame, url: str, html: str, out: str = "text") -> DataFrame:
    """``pages`` with the main text of ``html`` in column ``out`` in its place."""
    if out != html and out in pages.columns:
        pages = pages.drop(out)
    winners = written(host_paths(pages, url, html), "paths")  # with known size
    host, path = (fresh_name(n, pages.columns) for n in ("page_host", "page_path"))
    joined = (pages.withColumn(host, host_and_path(F.col(url))[0])
              .join(winners.select(F.col("host").alias(host), F.col("path").alias(path)), host, "left"))
    source = fresh_name("page_source", joined.columns)
    # path and page travel as one string: a path holds no line break
    joined = joined.withColumn(source, F.concat(
        F.translate(F.coalesce(path, F.lit("")), "\n", " "), F.lit("\n"), F.coalesce(html, F.lit(""))))

    def make():
        def one(value: bytes) -> str:
            path, _, page = value.decode("utf-8", "replace").partition("\n")
            return main_text(page, path or None)

        return lambda values: [pa.array([one(v) for v in values], pa.string())]

    return append_columns(joined.drop(host, path, html), source,
                          [T.StructField(out, T.StringType(), False)], make)
