"""Wrapper inference for pages of one host: union-free regular expressions over tag tokens.

A page becomes a stream of tokens: opening and closing tags (with their classes) and texts.
Repeated neighbouring groups fold into ``( ... )+``. The wrapper starts as the first page and
is aligned with the next ones in turn: equal tokens stay, differing texts become slots, and
tokens on one side only become ``( ... )?``. There is no alternation, so the result is a
union-free expression, and it can be matched against a page as an ordinary pattern.

The labelled slots say what the article is. Tags, roles and class words are evidence for the
labels; a page's own marks decide only where its texts stand at places that no sampled page has.

Work is near linear in a page's tokens: an element's path is one interned name made from its
parent's, and streams are aligned by anchors (``common``).
"""

from __future__ import annotations

import bisect
import html
import re
from collections import Counter, defaultdict
from collections.abc import Hashable, Sequence
from dataclasses import dataclass, field
from functools import lru_cache
from hashlib import blake2b

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|title|svg|iframe)\b.*?(?:</\1\s*>|\Z)"
    r"|<[/!?]?[a-zA-Z!?](?:[^<>\"']|\"[^\"]*\"|'[^']*')*>",
    re.S | re.I,
)
NAME = re.compile(r"<(/?)([a-zA-Z][\w:-]*)")
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
# Elements, roles and class words that mark what is not the article.
ASIDE_TAGS = frozenset("nav footer aside form button select menu dialog head object".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu".split())
ASIDE_WORDS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments commentlist consent cookie "
    "cookies copyright disqus discussion footer login masthead menu modal nav navbar navigation newsletter notice "
    "notices pagination popup promo promotion recommended related replies respond share sharing sidebar signup "
    "social sponsor sponsored subscribe toolbar widget".split()
)
MAIN_TAGS = frozenset(("article", "main"))
MAIN_WORDS = frozenset("article content entry main post story".split())


@dataclass
class Text:
    """A text of a page: where it stands (block path), which block, its characters, inside a link.

    A path names an element by its own signature and a digest of all that are around it, so its
    length does not grow with the depth.
    """

    path: str
    block: int
    text: str
    link: bool
    aside: bool
    main: bool


@dataclass
class Page:
    tokens: list[str] = field(default_factory=list)  # tags, and "" for a text
    texts: list[Text] = field(default_factory=list)
    above: dict[str, str] = field(default_factory=dict)  # path -> path of the block around it, outer ones first
    named: set[str] = field(default_factory=set)  # paths with a word of an article in or around them

    def under(self, holder: str) -> set[str]:
        """Paths at or below ``holder``; everything lies below the root ''."""
        found = {holder}
        for path, parent in self.above.items():
            if parent in found:
                found.add(path)
        return found


@lru_cache(maxsize=1024)
def _element(tag: str, source: str) -> tuple[str, bool, bool, bool]:
    """(signature, marks an aside, has a class word of one, marks the article) of an opening tag."""
    words, role, hidden = [], "", False
    if " " in source or "\n" in source or "\t" in source:
        for name, value in ATTRIBUTE.findall(source):
            value = value.strip("\"'")
            match name.lower():
                case "class" | "id":
                    words += re.findall(r"[a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())
                case "role":
                    role = value.lower()
                case "hidden":
                    hidden = True
                case _:
                    hidden |= value.lower() == "true"
    aside = hidden or tag in ASIDE_TAGS or role in ASIDE_ROLES
    worded = tag not in ("html", "body") and not ASIDE_WORDS.isdisjoint(words)
    main = tag in MAIN_TAGS or role in ("main", "article")
    signature = ".".join([tag, *sorted({w for w in words if not w.isdigit()})])
    return signature, aside, worded, main and not aside


@dataclass(eq=False)
class Main:
    """An article or main element: innermost open element with class words of an aside, itself one of them."""

    worded: int
    own: bool
    outer: Main | None
    size: int = 0


def _wrapping(page: Page, worded: list[int], inside: list[Main | None], mains: list[Main], chain: list[tuple[int, int]]) -> set[int]:
    """Elements whose class words are void, as they wrap the article (``has-sidebar``, ``comments-on``).

    Words count for what stands beside or inside an article. So the article or main elements
    with the fewest worded elements around them come first, and one in more of them, such as a
    comment, must be longer than those; one with such a word itself also than the rest of the page.
    ``chain`` has (worded element around it, number of them) of every worded element. With an
    element, all around it are void too.
    """
    total = rest = 0
    for t, w, m in zip(page.texts, worded, inside, strict=True):
        if t.aside:
            continue
        size = len(t.text.strip())
        if m and m.worded == w:
            m.size += size
        if not w:
            total += size if m else 0
            rest += 0 if m or t.link else size
    for x in reversed(mains):
        if x.outer and x.outer.worded == x.worded:
            x.outer.size += x.size
    void = {0}
    for x in sorted(mains, key=lambda x: (chain[x.worded][1], -x.size)):
        if x.worded and (x.worded in void or x.size > total + (rest if x.own else 0)):
            at = x.worded
            while at not in void:
                void.add(at)
                at = chain[at][0]
            total += x.size
    return void


@dataclass
class Open:
    """An open element; what it says also holds for all inside it."""

    tag: str
    path: str
    aside: bool
    worded: int
    main: Main | None
    links: int


# A block ends an open paragraph, an item the item before it, unless one of STOPS stands between.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd")}
STOPS = ("ul", "ol", "dl", "div", "article", "section", "td", "table", "body", "main", "aside", "nav")


def read(source: str | None) -> Page:
    """Tokens and texts of a page; unclosed elements end where their parent does."""
    page = Page()
    source = source or ""
    root = Open("", "", False, 0, None, 0)
    stack: list[Open] = []
    places: dict[str, list[int]] = defaultdict(list)  # tag -> its places in the stack
    blocks: list[int] = []  # places of block elements
    names: dict[tuple[str, str], str] = {}
    block, at = 0, 0
    chain = [(0, 0)]
    mains: list[Main] = []
    worded_at: list[int] = []  # of every text
    main_at: list[Main | None] = []

    def text(raw: str) -> None:
        if raw.strip():
            here = stack[-1] if stack else root
            page.tokens.append("")
            words = html.unescape(raw) if "&" in raw else raw
            page.texts.append(Text(here.path, block, words, here.links > 0, here.aside, here.main is not None))
            worded_at.append(here.worded)
            main_at.append(here.main)
        elif raw and page.texts and page.texts[-1].block == block:
            page.texts[-1].text += " "

    def last(tags: Sequence[str]) -> int:
        return max((places[t][-1] for t in tags if places[t]), default=-1)

    def cut(place: int) -> None:
        while len(stack) > place:
            places[stack.pop().tag].pop()
            if blocks and blocks[-1] == len(stack):
                blocks.pop()

    def inner(path: str, signature: str) -> str:
        name = names.get((path, signature))
        if name is None:
            name = f"{blake2b(f'{path}/{signature}'.encode(errors='surrogatepass'), digest_size=8).hexdigest()}/{signature}"
            names[path, signature] = name
            page.above[name] = path
            if path in page.named or not MAIN_WORDS.isdisjoint(signature.split(".")):
                page.named.add(name)
        return name

    for m in TOKEN.finditer(source):
        if m.start() > at:
            text(source[at : m.start()])
        at = m.end()
        piece = m.group()
        name = NAME.match(piece)
        if m.group(1) or not name:
            continue  # scripts, styles, comments, declarations
        tag = name[2].lower()
        inline = tag in INLINE
        if tag == "br":
            if page.texts and page.texts[-1].block == block:
                page.texts[-1].text += " "
            continue
        if not inline:
            block += 1
        if name[1]:
            place = last((tag,))
            if place < 0 or (inline and blocks and blocks[-1] > place):
                continue
            cut(place)
            page.tokens.append(f"/{tag}")
            continue
        if not inline:
            ended = last(ENDS.get(tag, ("p",)))
            if ended > last(STOPS):
                cut(ended)
        signature, off, by_word, is_main = _element(tag, piece)
        around = stack[-1] if stack else root
        if tag == "header" and not around.main:
            off = True
        page.tokens.append(signature)
        if tag not in VOID:
            worded, main = around.worded, around.main
            if by_word:
                chain.append((worded, chain[worded][1] + 1))
                worded = len(chain) - 1
            if is_main and not (around.aside or off):
                main = Main(worded, by_word, main)
                mains.append(main)
            path = around.path if inline else inner(around.path, signature)
            places[tag].append(len(stack))
            if not inline:
                blocks.append(len(stack))
            stack.append(Open(tag, path, around.aside or off, worded, main, around.links + (tag == "a")))
    if at < len(source):
        rest = source[at:]
        text(rest[: rest.rfind("<")] if re.search(r"<[/!a-zA-Z][^>]*\Z", rest) else rest)
    if len(chain) > 1:
        void = _wrapping(page, worded_at, main_at, mains, chain)
        for t, w in zip(page.texts, worded_at, strict=True):
            t.aside = t.aside or w not in void
    for t in page.texts:
        t.main = t.main and not t.aside
    return page


# A wrapper node: (token, text or None for a slot, children of a repetition, optional group or 0,
# hash of its token and its children's hashes).
Node = tuple[str, str | None, tuple, int, int]


def _node(token: str, value: str | None, children: tuple = (), group: int = 0) -> Node:
    return token, value, children, group, hash((token, *(c[4] for c in children)))


def _joined(a: Node, b: Node, group: int | None = None) -> Node:
    value = a[1] if a[1] == b[1] else None
    children = tuple(_joined(x, y) for x, y in zip(a[2], b[2], strict=True))
    return a[0], value, children, a[3] if group is None else group, a[4]


def fold(nodes: list[Node], longest: int = 12) -> list[Node]:
    """Fold neighbouring equal groups into repetitions, shortest period first, until none is left."""
    changed = True
    while changed:
        changed = False
        for size in range(1, longest + 1):
            out, at = [], 0
            shapes = [n[4] for n in nodes]
            while at < len(nodes):
                times = 1
                while shapes[at : at + size] == shapes[at + times * size : at + (times + 1) * size] != []:
                    times += 1
                if times > 1 and at + size <= len(nodes) and not (size == 1 and nodes[at][0] == "+"):
                    body = nodes[at : at + size]
                    for t in range(1, times):
                        body = [_joined(a, b) for a, b in zip(body, nodes[at + t * size : at + (t + 1) * size], strict=True)]
                    out.append(_node("+", None, tuple(body)))
                    at += times * size
                    changed = True
                else:
                    out.append(nodes[at])
                    at += 1
            nodes = out
    return nodes


def nodes_of(page: Page) -> list[Node]:
    texts = iter(page.texts)
    out: list[Node] = []
    for token in page.tokens:
        if token:
            out.append(_node(token, ""))
        else:
            t = next(texts)
            out.append(_node(f"#{t.path}", " ".join(t.text.split())))
    return fold(out)


SMALL = 4096  # cells of a table of common subsequences
LEVELS = 12  # of anchors inside gaps between anchors


def _longest(a: Sequence[Hashable], b: Sequence[Hashable]) -> list[tuple[int, int]]:
    """A longest common subsequence by the full table, for short sequences."""
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            table[i][j] = table[i + 1][j + 1] + 1 if a[i] == b[j] else max(table[i + 1][j], table[i][j + 1])
    pairs, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif table[i + 1][j] >= table[i][j + 1]:
            i += 1
        else:
            j += 1
    return pairs


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest part of ``pairs`` (ascending in the first place) that also ascends in the second."""
    ends: list[int] = []
    at: list[int] = []
    before = [-1] * len(pairs)
    for n, (_, j) in enumerate(pairs):
        k = bisect.bisect_left(ends, j)
        before[n] = at[k - 1] if k else -1
        ends[k : k + 1] = [j]
        at[k : k + 1] = [n]
    out, n = [], at[-1] if at else -1
    while n >= 0:
        out.append(pairs[n])
        n = before[n]
    return out[::-1]


def _anchors(a: Sequence[Hashable], b: Sequence[Hashable]) -> list[tuple[int, int]]:
    """Places of the rarest tokens that both have, equally often if there are such, the n-th with the n-th."""
    x, y = Counter(a), Counter(b)
    both = x.keys() & y.keys()
    alike = {t for t in both if x[t] == y[t]} or both
    least = min((x[t] + y[t] for t in alike), default=0)
    rare = {t for t in alike if x[t] + y[t] <= 2 * least}
    places: dict = defaultdict(list)
    for j, t in enumerate(b):
        if t in rare:
            places[t].append(j)
    seen: Counter = Counter()
    pairs = []
    for i, t in enumerate(a):
        if t in rare and seen[t] < len(places[t]):
            pairs.append((i, places[t][seen[t]]))
            seen[t] += 1
    return _rising(pairs)


def common(a: Sequence[Hashable], b: Sequence[Hashable]) -> list[tuple[int, int]]:
    """Places (i, j) of a common subsequence, ascending in both.

    Equal ends are taken off, then the rarest tokens anchor the rest, then the gaps between
    them are worked alike; short gaps get a longest common subsequence. A level costs about its
    tokens, and there are at most ``LEVELS``: a gap still long then counts as different.
    """
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b), 0)]
    while todo:
        a0, a1, b0, b1, level = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        if (a1 - a0) * (b1 - b0) <= SMALL:
            out += [(a0 + i, b0 + j) for i, j in _longest(a[a0:a1], b[b0:b1])]
            continue
        if level == LEVELS:
            continue
        pairs = [(a0 + i, b0 + j) for i, j in _anchors(a[a0:a1], b[b0:b1])]
        out += pairs
        i, j = a0, b0
        for x, y in [*pairs, (a1, b1)] if pairs else []:
            todo.append((i, x, j, y, level + 1))
            i, j = x + 1, y + 1
    return sorted(out)


def align(wrapper: list[Node], page: list[Node]) -> list[Node]:
    """The wrapper generalised so that it also covers ``page``."""
    out: list[Node] = []
    group = max((n[3] for n in wrapper), default=0)
    i = j = 0
    for x, y in [*common([n[4] for n in wrapper], [n[4] for n in page]), (len(wrapper), len(page))]:
        if i < x or j < y:
            out += [(*n[:3], n[3] or group + 1, n[4]) for n in wrapper[i:x]]
            out += [(*n[:3], group + 2, n[4]) for n in page[j:y]]
            group += 2
        if x < len(wrapper):
            out.append(_joined(wrapper[x], page[y]))
        i, j = x + 1, y + 1
    return out


def infer(pages: list[Page]) -> list[Node]:
    wrapper: list[Node] = []
    for n, page in enumerate(pages):
        nodes = nodes_of(page)
        wrapper = align(wrapper, nodes) if n else nodes
    return wrapper


def expression(wrapper: list[Node]) -> str:
    """The wrapper in readable form: tokens, text slots, ( )+ and ( )?."""
    out, group = [], 0
    for token, value, children, optional, _ in wrapper:
        if optional != group:
            if group:
                out.append(")?")
            if optional:
                out.append("(")
            group = optional
        if token == "+":
            out.append(f"({expression(list(children))})+")
        elif token.startswith("#"):
            out.append("#TEXT" if value is None else "'" + value[:40] + "'")
        else:
            out.append(f"<{token}>")
    if group:
        out.append(")?")
    return " ".join(out)


def constants(wrapper: list[Node]) -> dict[str, set[str]]:
    """Path -> texts that are part of the template (the same on every page aligned), by path."""
    fixed: dict[str, set[str]] = {}

    def walk(nodes) -> None:
        for token, value, children, optional, _ in nodes:
            if token.startswith("#") and value and not optional:
                fixed.setdefault(token[1:], set()).add(value)
            walk(children)

    walk(wrapper)
    return fixed


def _own(page: Page) -> dict[tuple[str, str], int]:
    """(path, text) -> characters of a page's texts outside links and asides."""
    return {(t.path, w): len(w) for t in page.texts if not (t.aside or t.link) for w in [" ".join(t.text.split())]}


def _copies(a: Page, b: Page) -> bool:
    """Whether two pages carry one text: they differ in less than a tenth and under 200 characters."""
    x, y = _own(a), _own(b)
    apart = max(sum(p[k] for k in p.keys() - q.keys()) for p, q in ((x, y), (y, x)))
    return apart < 200 and 10 * apart < max(sum(x.values()), sum(y.values()), 1)


def _varied(pages: list[Page]) -> bool:
    """Whether at least three of the pages are no copies of each other."""
    distinct: list[Page] = []
    for page in pages:
        if not any(_copies(page, d) for d in distinct):
            distinct.append(page)
    return len(distinct) > 2


def template(pages: list[Page], wrapper: list[Node]) -> dict[str, set[str]]:
    """Texts of the template: none unless the pages are varied."""
    return constants(wrapper) if _varied(pages) else {}


def layouts(pages: list[Page]) -> list[list[Page]]:
    """Pages grouped by layout, the largest group first, marked pages apart.

    Two pages have one layout if most of the characters that only one of them has stand at
    paths that the other one has, too.
    """

    def fits(a: dict, b: dict) -> bool:
        paths = {p for p, _ in b}
        alone = {k: n for k, n in a.items() if k not in b}
        return 2 * sum(n for (p, _), n in alone.items() if p in paths) >= sum(alone.values())

    groups: list[list[Page]] = []
    for page in pages:
        marked, own = any(t.main for t in page.texts), _own(page)
        for g in groups:
            first = _own(g[0])
            if any(t.main for t in g[0].texts) == marked and (marked or fits(own, first) or fits(first, own)):
                g.append(page)
                break
        else:
            groups.append([page])
    return sorted(groups, key=len, reverse=True)


OUTWEIGH = 4


def _weights(pages: list[Page], fixed: dict[str, set[str]]) -> tuple[dict[str, float], int]:
    """Characters in slots of an element's own blocks, outside links and asides, and those marked as article.

    Elements with a word of an article in or around them count half as much again.
    """
    weight: dict[str, float] = {}
    marked = 0
    for page in pages:
        for t in page.texts:
            words = " ".join(t.text.split())
            if t.aside or t.link or words in fixed.get(t.path, ()):
                continue
            if t.main:
                marked += len(words)
            else:
                parent = page.above.get(t.path, "")
                weight[parent] = weight.get(parent, 0.0) + len(words) * (1.5 if parent in page.named else 1.0)
    return weight, marked


def container(pages: list[Page], wrapper: list[Node]) -> str | None:
    """Path of the element that holds the article; None if the article and main elements do.

    It is the element with the most characters in slots of its own blocks; template texts do
    not count, which is what the wrapper is for. On pages with article or main elements the
    slots in those are the article, unless the slots of one element outside hold ``OUTWEIGH``
    times as much over three distinct pages or more: then the tags stand around something else,
    such as teasers.
    """
    fixed = template(pages, wrapper)
    weight, marked = _weights(pages, fixed)
    best = max(weight, key=lambda p: (weight[p], p)) if weight else ""
    if any(t.main for p in pages for t in p.texts):
        return best if best and weight[best] > OUTWEIGH * marked and _varied(pages) else None
    return best


HEADING = re.compile(r"/h[1-6](\.|\Z)")


@dataclass
class Model:
    """What a layout's wrapper says: which slots (by path) hold the article, and template texts.

    ``marked`` is a layout of pages with article or main elements. ``others`` has the same
    fields for the host's further layouts.
    """

    slots: dict[str, bool]
    holder: str | None
    fixed: dict[str, list[str]]
    marked: bool = False
    others: list[dict] = field(default_factory=list)

    def held(self, page: Page) -> list[Text]:
        """Texts of the article: those in slots labelled so; paths the wrapper has not seen go by its holder."""
        inside = set() if self.holder is None else page.under(self.holder)
        return [
            t for t in page.texts
            if not t.aside and self.slots.get(t.path, t.main if self.holder is None else not self.holder or t.path in inside)
        ]

    def is_fixed(self, t: Text) -> bool:
        return " ".join(t.text.split()) in self.fixed.get(t.path, ())


def _layout_model(pages: list[Page]) -> tuple[Model, list[Node]]:
    """Infer a layout's wrapper and label its slots, by the characters for and against on its pages."""
    wrapper = infer(pages)
    holder = container(pages, wrapper)
    votes: dict[str, int] = {}
    for page in pages:
        inside = set() if holder is None else page.under(holder)
        for t in page.texts:
            is_in = t.main if holder is None else not holder or t.path in inside
            size = len(t.text.strip())
            votes[t.path] = votes.get(t.path, 0) + (size if is_in and not t.aside else -size)
    slots: dict[str, bool] = {}

    def walk(nodes) -> None:
        for token, _, children, _, _ in nodes:
            if token.startswith("#"):
                slots[token[1:]] = votes.get(token[1:], 0) > 0
            walk(children)

    walk(wrapper)
    marked = any(t.main for p in pages for t in p.texts)
    # Headings that all articles share are still part of them where the pages mark their article.
    fixed = {k: sorted(v) for k, v in template(pages, wrapper).items() if not (marked and HEADING.search(k))}
    return Model(slots, holder, fixed, marked), wrapper


def model_of(pages: list[Page]) -> tuple[Model, list[Node]]:
    """The model of a host, its largest layout first, and the wrapper of that layout."""
    models = [_layout_model(group) for group in layouts(pages) or [[]]]
    model, wrapper = models[0]
    model.others = [{"slots": m.slots, "holder": m.holder, "fixed": m.fixed, "marked": m.marked} for m, _ in models[1:]]
    return model, wrapper


def chosen(page: Page, model: Model) -> Model:
    """The layout a page has: the one whose article is longest on it, else the page's own structure."""
    marked = any(t.main for t in page.texts)
    best, most = None, 0
    for m in (model, *(Model(**o) for o in model.others)):
        if m.marked != marked:
            continue
        # Everything lies under the root, so that holder says nothing about paths not seen.
        size = sum(
            len(t.text.strip()) for t in m.held(page)
            if (m.holder != "" or t.path in m.slots) and not t.link and not m.is_fixed(t)
        )
        if size > most:
            best, most = m, size
    return best or Model({}, container([page], []), {})


def article(page: Page, model: Model) -> str:
    """The article's blocks joined by line feeds."""
    layout = chosen(page, model)
    held = layout.held(page)
    # A page of nothing but texts that the sample shares is a copy, not a template.
    held = [t for t in held if not layout.is_fixed(t)] or held
    blocks: list[list[str]] = []
    last = None
    for t in held:
        if t.block != last:
            blocks.append([])
            last = t.block
        blocks[-1].append(t.text)
    lines = (" ".join("".join(b).split()) for b in blocks)
    return "\n".join(x for x in lines if x)
