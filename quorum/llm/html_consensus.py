"""Main text of web pages by host consensus on container paths.

1. each page is parsed once and its containers scored: text outside links counts for the
   nearest container and by halves for those around it (linked text only where a page has
   no other); an article or main that is mostly kept text has all the text below it;
   containers whose tag or class names a menu, notice, advert and the like score nothing
   (parts with names that also stand on an article's wrapper count only where the page has
   no paragraph outside them, whatever their sizes); a paragraph, heading or cell inside an
   article goes only if its whole name is such a name, or it is mostly links;
2. a page votes for its best containers' generalised paths (tags with their class names,
   digits and order taken out); Spark adds the votes per host with partial sums and keeps a
   host's paths with at least ``SHARE`` of its votes;
3. each page is read again along its host's winning paths: the winner that the page has
   takes precedence over the page's own best container.

The text of a container is its blocks in page order, without the parts that are not the
article.  The winners join the pages by host: Spark broadcasts them below its size limit;
beyond it the join is one that it splits where a host is hot.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorum.llm.common import cut

SHARE = 0.01
VOTES = 3           # containers that one page votes for

_TAG = re.compile(r"<(?:!--.*?(?:--!?>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
                  r"|(/?)([a-zA-Z][^\s/>]*)([^>]*)>|[!?/][^>]*>?)", re.S)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?",
                        re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template iframe svg math object textarea title select noframes xmp".split())
_BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section "
                   "summary table tbody td tfoot th thead tr ul caption".split())
_CONTAINER = frozenset("article body center div main section".split())
_DROPPED = frozenset("nav footer aside form button dialog menu audio video canvas map head".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
# Blocks that hold text itself: inside an article their names mostly describe the text.
_PROSE = _HEADING | frozenset("p blockquote pre figure figcaption li dd dt td th tr table tbody caption address".split())
# Names of parts that are not the article: the first or last word of a class, id or role.
_FIRM = re.compile(
    r"(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|cookies?|consent|gdpr|menu|nav\w*|breadcrumbs?|footer|comments?|"
    r"(?:top|main|sub|site|side|page|left|right|bottom|foot)(?:nav|menu|bar)|"
    r"commentlist|replies|reply|disqus|respond|newsletter|subscribe|signup|login|popup|modal|overlay|pagination|pager|"
    r"skip|copyright|contentinfo|complementary|navigation|dialog)", re.I)
# Names that also stand on wrappers of articles.
_SOFT = re.compile(
    r"(?:banner|notices?|notification|alert|sidebar|side|widget|masthead|header|toolbar|social|share|sharing|related|"
    r"recommend\w*|search|print)", re.I)
_COMMENTS = re.compile(r"(?:comments?|commentlist|replies|reply|disqus|respond)", re.I)
# Words that make a name say what the layout has or lacks.
_STATE = frozenset("has no with without is not open closed fixed sticky enabled disabled".split())
SOFT, FIRM, ALWAYS = 1, 2, 3
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
           "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_KEEPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}


class Node:
    __slots__ = ("tag", "path", "noise", "hidden", "parent", "number", "doubt")

    def __init__(self, tag: str, path: str, noise: int, hidden: bool, parent: Node | None, number: int,
                 doubt: int = 0) -> None:
        self.tag, self.path, self.noise, self.hidden, self.parent, self.number = tag, path, noise, hidden, parent, number
        self.doubt = doubt          # the noise that it has if its text is mostly links


def _names(attributes: str) -> tuple[str, str, bool]:
    """Generalised class names, all names, whether the element is hidden."""
    classes, names, hidden = "", [], False
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), html.unescape(m[2] or m[3] or m[4] or "")
        if key == "class":
            classes = ".".join(sorted({x for x in re.sub(r"\d+", "", value).lower().split() if x.strip("-_")}))
        if key in ("class", "id", "role"):
            names.append(value)
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" \
                or key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            hidden = True
    return classes, " ".join(names), hidden


def _words(name: str) -> list[str]:
    """The words of a class, id or role: at hyphens, underscores and camel case."""
    name = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "-", name)
    return [w.lower() for w in re.split(r"[_-]+", name) if w and not w.isdigit()]


def _level(word: str) -> int:
    return ALWAYS if _COMMENTS.fullmatch(word) else FIRM if _FIRM.fullmatch(word) else SOFT if _SOFT.fullmatch(word) else 0


def _noise(names: str, whole: bool = False) -> int:
    """How surely names tell a part that is not the article: by the first or last word of a
    name, or by all of its words (``whole``)."""
    found = 0
    for name in names.split():
        words = _words(name)
        if not words or any(w in _STATE for w in words):
            continue
        if whole:
            levels = [_level(w) for w in words]
            found = max(found, max(levels) if all(levels) else 0)
        else:
            found = max(found, _level(words[0]), _level(words[-1]))
    return found


def blocks(page: str) -> list[tuple[Node, str, int, bool]]:
    """The page's text blocks in order: (innermost block element, text, linked chars, heading)."""
    out: list[tuple[Node, str, int, bool]] = []
    number = 0
    root = Node("", "", 0, False, None, 0)
    stack = [root]
    parts: list[str] = []
    linked = [0]
    links = 0

    def flush() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                node = next((n for n in reversed(stack) if n.tag in _BLOCK or not n.tag), root)
                if node.doubt > node.noise and 2 * linked[0] > len(text):
                    node = Node(node.tag, node.path, node.doubt, node.hidden, node.parent, node.number)
                out.append((node, text, linked[0], any(n.tag in _HEADING for n in stack)))
            parts.clear()
        linked[0] = 0

    def add(raw: str) -> None:
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if links:
                linked[0] += len(text)

    def pop(at: int) -> None:
        nonlocal links
        for node in stack[at:]:
            links -= node.tag == "a"
        del stack[at:]

    at, size = 0, len(page)
    while at < size:
        found = _TAG.search(page, at)
        if found is None:
            add(page[at:])
            break
        add(page[at:found.start()])
        at = found.end()
        closing, name, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if name is None:
            continue
        tag = name.lower()
        if closing:
            where = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if tag in _BLOCK:
                flush()
            if where and (tag in _BLOCK or not any(n.tag in _BLOCK for n in stack[where + 1:])):
                pop(where)
            continue
        if tag in _RAW:
            if not attributes.rstrip().endswith("/") or tag not in ("svg", "math", "object"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = end.end() if end else size
            if tag not in ("textarea", "select"):
                continue
            parts.append(" ")
            continue
        if tag in _VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                parts.append(" ")
            continue
        if tag in _BLOCK:
            flush()
            closes, keeps = _CLOSES.get(tag, ()), _KEEPS.get(tag, ())
            if tag in _CLOSES or tag in _BLOCK:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in closes or stack[i].tag == "p":
                        pop(i)
                        if tag not in ("tr",):
                            break
                    elif stack[i].tag in keeps or stack[i].tag in _BLOCK and stack[i].tag not in ("td", "th"):
                        break
        classes, names, hidden = _names(attributes) if attributes else ("", "", False)
        parent = stack[-1]
        number += 1
        noise, doubt = parent.noise, parent.doubt
        inside = any(n.tag in ("article", "main") for n in stack)
        if tag in ("article", "main") and noise < ALWAYS and not inside:
            noise = 0               # a wrapper's name says nothing about the article in it
        if tag in _DROPPED:
            noise = ALWAYS
        elif names and tag not in ("body", "html", "main", "article"):
            prose = inside and tag in _PROSE
            noise = max(noise, _noise(names, prose))
            doubt = max(doubt, _noise(names)) if prose else doubt
        if tag == "article" and any(_words(n) and _COMMENTS.fullmatch(_words(n)[0]) for n in names.split()):
            noise = ALWAYS
        if tag == "header" and not inside:
            noise = ALWAYS
        stack.append(Node(tag, f"{parent.path}>{tag}{'.' + classes if classes else ''}" if tag in _BLOCK else parent.path,
                          noise, parent.hidden or hidden, parent, number, doubt))
        links += tag == "a"
    flush()
    return out


def _ancestors(node: Node | None) -> Iterator[Node]:
    while node is not None:
        yield node
        node = node.parent


def kept(node: Node, heading: bool, noise: int = 0) -> bool:
    """Whether a block belongs to an article: at most that noise, and of headers only the headings."""
    if node.noise > noise or node.hidden:
        return False
    return heading or not any(n.tag == "header" for n in _ancestors(node))


def _limit(found: list[tuple[Node, str, int, bool]]) -> int:
    """The noise that a page's blocks may have: ``SOFT`` where no block but headings has less."""
    return 0 if any(kept(node, heading) and not heading for node, _, _, heading in found) else SOFT


def scores(page: str | None) -> dict[str, float]:
    """Scores of the generalised paths of a page's containers."""
    found = blocks(page or "")
    limit = _limit(found)
    own = [(node, max(0, len(text) - linked), len(text), kept(node, heading, limit)) for node, text, linked, heading in found]
    # A page whose kept text is all linked is judged by that.
    if not any(plain and good for _, plain, _, good in own):
        own = [(node, size, size, good) for node, _, size, good in own]
    # Text below each article or main, kept and in all.
    below: dict[int, list[int]] = {}
    for node, weight, _, good in own:
        for n in _ancestors(node):
            if n.tag in ("article", "main"):
                counts = below.setdefault(n.number, [0, 0])
                counts[0] += weight * good
                counts[1] += weight
    out: dict[str, float] = {}
    for node, weight, _, good in own:
        if not good:
            continue
        containers = [n for n in _ancestors(node) if n.tag in _CONTAINER or not n.tag]
        # The outermost article or main that is mostly kept text, else the nearest one, has
        # all the text below it.
        around = [n for n in containers if n.tag in ("article", "main")]
        whole = next((n for n in reversed(around) if 2 * below[n.number][0] >= below[n.number][1]), around[0] if around else None)
        share = 1.0
        for container in containers:
            if container is whole:
                out[container.path] = out.get(container.path, 0) + weight * 1.5
                break
            out[container.path] = out.get(container.path, 0) + weight * share
            share /= 2
    return {p: s for p, s in out.items() if s > 0}


def main_text(page: str | None, winners: list[str]) -> tuple[str, str]:
    """(path, text) along the first winner that the page has, else its own best container."""
    found = blocks(page or "")
    limit = _limit(found)
    paths = {n.path for node, _, _, heading in found if kept(node, heading, limit) for n in _ancestors(node)
             if n.tag in _CONTAINER or not n.tag}
    path = next((w for w in winners if w in paths), None)
    if path is None:
        own = scores(page)
        if not own:
            return "", ""
        path = max(own, key=lambda p: (own[p], p))
    texts = [text for node, text, _, heading in found
             if kept(node, heading, limit) and any(n.path == path and (n.tag in _CONTAINER or not n.tag) for n in _ancestors(node))]
    return path, "\n".join(texts)


def _votes(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        out: dict[str, list] = {"host": [], "path": [], "vote": []}
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = sorted(scores(page).items(), key=lambda x: (-x[1], x[0]))[:VOTES]
            for path, value in own:
                out["host"].append(host)
                out["path"].append(path)
                out["vote"].append(value / own[0][1])
        yield pa.RecordBatch.from_arrays([pa.array(out["host"], pa.string()), pa.array(out["path"], pa.string()),
                                          pa.array(out["vote"], pa.float64())], names=list(out))


def _extracted(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        found = [main_text(page, winners or []) for page, winners in
                 zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([p for p, _ in found], pa.string()),
             pa.array([t for _, t in found], pa.string())], names=["page_id", "url", "path", "text"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, path, text)`` per row of ``pages``; ``path`` names the container used.

    Defined cases: a null or empty page, or one without text, gives an empty text; pages
    with a null url, or one without a host, form a host of their own; markup that does not
    close is closed where its parent ends; null ids, repeated rows, an empty table and
    further columns are fine.
    """
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    base = base.withColumn("host", F.lower(F.coalesce(F.regexp_extract("url", r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#]*)", 1),
                                                      F.lit(""))))
    votes = base.select("host", "html").mapInArrow(_votes, "host string, path string, vote double") \
        .groupBy("host", "path").agg(F.sum("vote").alias("votes"))
    votes = cut(votes, "votes")
    totals = votes.groupBy("host").agg(F.sum("votes").alias("total"))
    # Every kept path has at least SHARE of the votes, so a host's list is bounded.
    winners = cut(votes.join(totals, "host").filter(F.col("votes") >= SHARE * F.col("total")).groupBy("host")
                  .agg(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("order"), "path"))),
                                   lambda x: x["path"]).alias("winners")), "winners")
    return base.join(winners, "host", "left").select("page_id", "url", "html", "winners") \
        .mapInArrow(_extracted, "page_id long, url string, path string, text string")
