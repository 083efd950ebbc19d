"""Main text of web pages by a minimum cut.

A page becomes its blocks of text, in order, each with the elements around it. A linear classifier gives every block a cost
for being labelled boilerplate or content: its elements, their classes and roles, its words, its links. The costs are the
capacities to the two terminals. Blocks that follow each other, and blocks of one container element, are tied by smoothness
edges (a container is a node of its own, so the edges grow with the blocks). The blocks on the source side of a minimum cut
are the main text. What is no text at all (scripts, styles, forms, menus, page footers) has an infinite capacity to the sink.

Every page is one row and one step of a batch; no shuffle. Work grows with the page's length.

A heading or an ``aria-label`` that names reader comments, other articles or the like ("3 Comments", "You might also like") speaks
for its section: the heading for what follows it there up to the next heading of its rank, the label for its element. A page's
title (h1) never does.

Markup is read as browsers do in the cases that matter: paragraphs, list items and cells end where the next begins, unmatched
end tags are passed over, unclosed comments, scripts and tags run to the end, character references without semicolon count.

Defined cases: null or empty html and pages without content give the empty text; repeated rows give repeated results; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

_TAG = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)"""
    r"""(?P<rest>(?>[^>"']|(?<==)"[^"]*"|(?<==)'[^']*'|(?<==\s)"[^"]*"|["'])*+)(?:>|\Z)|</[^>]*(?:>|\Z)""", re.S)
#: A whole name and its value; a value's text is passed over, so that it is never taken for a name.
_ATTRIBUTE = re.compile(r"""([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)(?:"|\Z)|'([^']*)(?:'|\Z)|([^\s"'>][^\s>]*)))?""")
_TOKEN = re.compile(r"[A-Za-z][a-z]*|[0-9]+")

_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes", "template", "svg", "math"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 header hgroup hr html head legend li main menu nav ol optgroup option p pre section select summary table tbody td
tfoot th thead tr ul button""".split())
_CLOSES_P = _BLOCK - {"body", "html", "head", "option", "optgroup", "legend", "button", "tbody", "td", "tfoot", "th", "thead", "tr", "caption"}
#: What a start tag ends, up to the elements that keep it inside.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
         "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}),
         "option": ({"option"}, {"select"}), "a": ({"a"}, {"td", "th", "table"}),
         "article": ({"nav", "header"}, {"article"}), "main": ({"nav", "header"}, {"main"})}
_NEVER = set("nav footer aside form button select menu dialog fieldset head object canvas audio video map datalist".split())
_NEVER_ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist".split())
_SECTIONS = set("article aside body div footer form header li main nav section table td ul ol dl blockquote figure details".split())

# Costs of the linear classifier: above 0 for content.
_BASE, _IN_ARTICLE, _HEADING, _PARAGRAPH, _PER_WORD, _MOST_WORDS, _LINKED, _FURNITURE, _BODY, _HEADER = -1.5, 4.0, 1.0, 1.0, 0.08, 2.5, -3.5, -9.0, 2.0, -6.0
_NEXT, _SAME = 0.4, 0.3
#: Names in classes and ids of page furniture, and of main text.
_BAD_NAMES = set("""ad ads advert adverts advertisement advertisements adsense adslot sponsor sponsored sponsors promo promos promotion
promoted banner banners cookie cookies consent gdpr notice notices sidebar sidebars rail nav navbar navigation menu menus breadcrumb
breadcrumbs crumbs footer masthead topbar toolbar comment comments commentlist disqus replies respond reviews share sharing social
related recommended recommendations newsletter subscribe subscription signup login popup modal overlay widget widgets pagination pager
paging skip copyright legal disclaimer outbrain taboola teaser teasers trending search paywall alert byline feedback""".split())
#: Furniture that is made of texts like the main one, which only <main> inside it tells apart; words of wrappers of the whole page.
_OTHER_TEXTS = set("""comment comments commentlist disqus replies respond reviews related recommended recommendations teaser teasers trending
promo promos promoted promotion sponsor sponsored sponsors outbrain taboola""".split())
_WRAPPERS = set("content main page wrap wrapper layout container site grid columns body article".split())
_HEADER_NAMES = {"header", "head", "top"}
_ABOUT = {"has", "with", "no", "without", "is", "js"}
_GOOD_NAMES = set("article articlebody post entry story content main body text prose".split())
_HARD = -1e9
#: Headings and labels of page furniture, whole, in lower case, without counts around them.
_SAYS = re.compile(r"""(?:(?:reader|user|all|recent|latest|your|top)\ )?(?:comments?|replies)(?:\ section)?|(?:comments?|replies|responses|thoughts?)\ (?:to|on)\ .+
|(?:leave|post|add|write)\ (?:a|your)\ (?:comment|reply|response)|join\ the\ (?:conversation|discussion)|what\ readers\ say
|(?:related|recommended|popular|similar|trending|more|latest|other)\ (?:articles?|posts?|stories|story|content|links|reading|topics|news)|trending(?:\ now)?
|you\ (?:might|may)\ also\ (?:like|enjoy|be\ interested\ in)|recommended(?:\ for\ you)?|more\ (?:from|like)\ .+|read\ (?:more|next)|up\ next|most\ (?:read|popular|viewed|shared|commented)
|advertisements?|sponsored(?:\ (?:content|links|stories))?|promoted(?:\ (?:content|stories))?|share\ this(?:\ (?:article|post|story|page))?|follow\ us(?:\ on\ .+)?
|(?:subscribe|sign\ up)(?:\ (?:to|for)\ .+)?|(?:our\ )?newsletter|breadcrumbs?|pagination|social(?:\ (?:media|links))?|cookie\ (?:notice|policy|settings)
|kommentare?|(?:schreibe?|hinterlasse)\ einen\ kommentar|(?:ähnliche|weitere|verwandte)\ (?:artikel|beiträge)|commentaires?|laisser\ un\ commentaire
|(?:articles|contenus)\ (?:similaires|liés|connexes)|comentarios?|deja\ (?:un\ comentario|una\ respuesta)|(?:artículos|noticias|entradas)\ (?:relacionados|relacionadas)""", re.X)
_AROUND = re.compile(r"^[(\[]?\d[\d.,]*[)\]]?\s+|\s*[(\[]?\d[\d.,]*[)\]]?$|[\s:!?.…»–-]+$")
_LONGEST_LABEL = 80


def _says_furniture(text: str) -> bool:
    if len(text) > _LONGEST_LABEL:  # no label, but a text
        return False
    text, before = " ".join(text.lower().split()), None
    while text != before:
        before, text = text, _AROUND.sub("", text)
    return _SAYS.fullmatch(text) is not None


class _Element:
    """An open element: its name, what the blocks inside it inherit, the section they belong to, and what lifts its furniture cost."""

    __slots__ = ("name", "cost", "article", "section", "hold")

    def __init__(self, name: str, cost: float, article: bool, section: int, hold: int):
        self.name, self.cost, self.article, self.section, self.hold = name, cost, article, section, hold


def _named(rest: str) -> tuple[float, int, int]:
    """What an element's attributes say: cost; whether they name the main text (1: a class or id, 2: an article, 3: main); the least
    such number that does not lift the cost from what is inside (0: a wrapper's, 1: other furniture's, 2: other texts')."""
    cost, good, hold, seen = 0.0, 0, 0, set()
    for key, *values in _ATTRIBUTE.findall(rest):
        key, value = key.lower(), entities.unescape(next((v for v in values if v), "")).lower()
        if key in seen:  # the first of a name counts
            continue
        seen.add(key)
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return _HARD, 0, 0
        if key == "aria-label" and _says_furniture(value):
            cost, hold = _FURNITURE, 2
        elif key == "role":
            if value in _NEVER_ROLES:
                return _HARD, 0, 0
            good = max(good, {"main": 3, "article": 2}.get(value, 0))
        elif key == "itemprop":
            good = max(good, 2 * (value == "articlebody"))
            if value == "comment":
                cost, hold = _FURNITURE, 2
        elif key in ("class", "id"):
            for name in value.split():
                parts = _TOKEN.findall(name)
                if parts and parts[0] in _ABOUT:  # says what else the page has, not what this element is
                    continue
                if not _BAD_NAMES.isdisjoint(parts) or name in _BAD_NAMES:
                    cost = _FURNITURE
                    hold = max(hold, 2 if not _OTHER_TEXTS.isdisjoint(parts) else 0 if not _WRAPPERS.isdisjoint(parts) else 1)
                elif not _HEADER_NAMES.isdisjoint(parts) and len(parts) == 1:
                    cost = min(cost, _HEADER)
                good = max(good, 0 if _GOOD_NAMES.isdisjoint(parts) else 1)
    return cost, 0 if cost else good, hold


def blocks(page: str) -> list[tuple[str, float, int]]:
    """(text, cost, section) of each block in page order; the cost is the classifier's, below 0 for boilerplate."""
    found: list[tuple[str, float, int]] = []
    levels: list[int] = []  # of headings, 0 of other blocks
    kinds, parents, ends = [""], [0], {}  # of the sections: element, section around it, number of blocks before its end
    stack = [_Element("", 0.0, False, 0, 0)]
    pieces: list[str] = []
    owner: _Element | None = None
    block_name, linked, links, sections = "", 0, 0, 0

    def flush() -> None:
        nonlocal owner, linked, pieces
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            if text and owner is not None:
                found.append((text, _cost(text, owner, block_name, linked), owner.section))
                levels.append(_level(block_name))
        pieces, owner, linked = [], None, 0

    def add(text: str) -> None:
        nonlocal owner, block_name, linked
        block = next((e for e in reversed(stack) if e.name in _BLOCK), stack[0])
        if stack[-1].cost <= _HARD < block.cost:  # an inline element that is not shown
            return
        # Inline elements speak for a block only if they hold all of its text.
        if not text.isspace() and (owner is None or stack[-1].cost > owner.cost):
            owner, block_name = stack[-1], block.name
        pieces.append(text)
        if links:
            linked += len(text)

    def pop(to: int) -> None:
        nonlocal links
        while len(stack) > to:
            gone = stack.pop()
            links -= gone.name == "a"
            if gone.name in _SECTIONS:
                ends[gone.section] = len(found)

    at, size = 0, len(page)
    while at < size:
        found_tag = _TAG.search(page, at)
        if found_tag is None:
            add(page[at:])
            break
        if found_tag.start() > at:
            add(page[at : found_tag.start()])
        at = found_tag.end()
        name = found_tag["name"]
        if name is None:
            continue
        name = name.lower()
        if found_tag["end"]:
            if name in _BLOCK:
                flush()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == name:
                    pop(i)
                    break
                if name not in _BLOCK and stack[i].name in _BLOCK:
                    break
            continue
        if name in _RAW:
            close = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else size
            continue
        if name in ("br", "hr"):
            add(" ")
        if name in _BLOCK:
            flush()
        if name in _VOID:
            continue
        if name in _ENDS:
            ended, kept = _ENDS[name]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in ended:
                    pop(i)
                    break
                if stack[i].name in kept:
                    break
        elif name in _CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == "p":
                    pop(i)
                    break
                if stack[i].name in _SECTIONS:
                    break
        rest, up = found_tag["rest"], stack[-1]
        cost, good, hold = _named(rest) if rest and not rest.isspace() else (0.0, 0, 0)
        if name in _NEVER:
            cost = _HARD
        elif name == "header":
            cost = min(cost, _HEADER)
        if name in _SECTIONS:
            sections += 1
            kinds.append(name)
            parents.append(up.section)
        inside = up.article or name in ("article", "main") or good > 0 and name != "body"
        body = name in ("html", "body")
        if not cost:
            good = max(good, {"main": 3, "article": 2}.get(name, 0))
        lifted = _HARD < up.cost <= _FURNITURE and good > up.hold and name in _BLOCK
        inherited = 0.0 if lifted else up.cost
        stack.append(_Element(name, up.cost if body else min(inherited, cost), up.article if body else inside, sections if name in _SECTIONS else up.section,
                              up.hold if body else max(0 if lifted else up.hold, hold)))
        links += name == "a"
    flush()
    return _headed(found, levels, kinds, parents, ends)


def _level(block: str) -> int:
    """Rank of a heading, 0 for other blocks."""
    return int(block[1]) if len(block) == 2 and block[0] == "h" and block[1].isdigit() else 6 if block == "summary" else 0


def _headed(found: list[tuple[str, float, int]], levels: list[int], kinds: list[str], parents: list[int], ends: dict[int, int]) -> list[tuple[str, float, int]]:
    """The blocks, those under a heading that names furniture at its cost."""
    out, at = list(found), 0
    while at < len(found):
        level, section = levels[at], found[at][2]
        if level < 2 or not _says_furniture(found[at][0]):
            at += 1
            continue
        # A heading alone in a box or header speaks for what the box stands in.
        while kinds[section] in ("div", "header") and ends.get(section, len(found)) == at + 1 and (not at or found[at - 1][2] < section):
            section = parents[section]
        stop = at + 1
        end = ends.get(section, len(found))
        while stop < end and not (0 < levels[stop] < level or levels[stop] == level and found[stop][2] <= found[at][2]):
            stop += 1
        for i in range(at, stop):
            out[i] = (found[i][0], found[i][1] + _FURNITURE, found[i][2])
        at = stop
    return out


def _cost(text: str, owner: _Element, block: str, linked: int) -> float:
    if owner.cost <= _HARD:
        return _HARD
    heading = block != "summary" and _level(block) > 0
    n = text.count(" ") + 1
    cost = _BASE + owner.cost + min(n * _PER_WORD, _MOST_WORDS) + _LINKED * min(1.0, linked / max(1, len(text)))
    if owner.article:
        cost += _IN_ARTICLE
        if heading and owner.cost == _HEADER:  # the article's own heading may stand in its header
            cost -= _HEADER
    if heading:
        cost += _HEADING
    elif block in ("p", "blockquote", "pre", "td", "dd"):
        cost += _PARAGRAPH
    if text[-1:] in ".!?:;…\"'”»。":
        cost += 0.5
    return cost


def min_cut(costs: list[float], edges: list[tuple[int, int, float]], nodes: int) -> list[bool]:
    """Which of the first len(costs) of ``nodes`` nodes lie on the source side of a minimum cut (Dinic's algorithm)."""
    source, sink = nodes, nodes + 1
    graph: list[list[int]] = [[] for _ in range(nodes + 2)]
    to: list[int] = []
    room: list[float] = []

    def edge(a: int, b: int, forth: float, back: float) -> None:
        graph[a].append(len(to))
        to.append(b)
        room.append(forth)
        graph[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, cost in enumerate(costs):
        if cost > 0:
            edge(source, i, cost, 0.0)
        elif cost < 0:
            edge(i, sink, -cost, 0.0)
    for a, b, capacity in edges:
        edge(a, b, capacity, capacity)
    while True:
        level = [-1] * (nodes + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in graph[a]:
                if room[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(len(costs))]
        next_edge = [0] * (nodes + 2)
        path: list[int] = []
        at = source
        while True:
            if at == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                first = next(i for i, e in enumerate(path) if room[e] <= 1e-9)
                del path[first:]
                at = to[path[-1]] if path else source
                continue
            while next_edge[at] < len(graph[at]):
                e = graph[at][next_edge[at]]
                if room[e] > 1e-9 and level[to[e]] == level[at] + 1:
                    path.append(e)
                    at = to[e]
                    break
                next_edge[at] += 1
            else:
                if at == source:
                    break
                level[at] = -1
                at = to[path.pop() ^ 1]


def main_text(page: str | None) -> str:
    """The content blocks joined by empty lines."""
    listed = blocks(page) if page else []
    if not listed:
        return ""
    costs = [cost for _, cost, _ in listed]
    if all(c <= 0 for c in costs):
        return ""
    of: dict[int, int] = {}
    edges = []
    for i, (_, _, section) in enumerate(listed):
        node = of.setdefault(section, len(listed) + len(of))
        edges.append((i, node, _SAME))
        if i:
            edges.append((i - 1, i, _NEXT))
    content = min_cut(costs, edges, len(listed) + len(of))
    return "\n\n".join(text for (text, _, _), keep in zip(listed, content, strict=True) if keep)


def extract(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page, url, text, n_chars (code points) of every row."""
    given = pages.select(page, url, html)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], [page, url, "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in given.schema.fields}
    return given.mapInArrow(run, f"`{page}` {kinds[page]}, `{url}` {kinds[url]}, text string, n_chars long")
