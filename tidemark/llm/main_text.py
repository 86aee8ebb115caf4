"""HTML extraction (12): main text by consensus host paths.

Every page's containers are scored by the paragraphs they hold, and the page
votes for the generalised path of its best one (tags and classes from the root,
digits as ``#``).  Spark adds up the votes per host, pre-aggregated before the
shuffle, so a host of any size is only a few rows.  Paths with at least
``share`` of their host's votes win (so there are at most 1 / ``share``), and
every page is extracted again by the first winning path that it has and that
holds text, else by its own best container.  All containers of that path count,
in page order; menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and reader comments inside are left out.

Winners are joined on the host: Spark broadcasts them below its own size
threshold, else the join is a sorted one whose hot hosts are split.

Defined cases: null html is empty and gives an empty text; a page without a
host, or with a null url, uses its own best container.  Pages may be cut off
anywhere; an unfinished tag, comment, script or style ends with the page.
"""

from __future__ import annotations

import html as html_lib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop, only, tune

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
BLOCKS = frozenset("""address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead
    tr ul""".split())
CONTAINERS = frozenset("#root article body blockquote center dd details div dl figure html main ol section span table tbody td tr ul pre p li".split())
PARAGRAPHS = frozenset("p pre blockquote li dd dt td th h1 h2 h3 h4 h5 h6 figcaption".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: start tags that close an open element of the same kind, up to the element that holds them
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
          "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"})}
#: elements that are never part of the article
NEVER = frozenset("""head script style noscript template nav footer aside form button select textarea input label iframe object embed svg canvas
    audio video map dialog menu search noembed noframes title""".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form status".split())
#: words of class names and ids that mark what is not the article
WORDS = frozenset("""ad ads adv advert adverts advertisement advertising adsense adslot adbox sponsor sponsored promo promotion promoted banner
    sidebar aside rail menu menus nav navbar navigation navi breadcrumb breadcrumbs topbar header masthead footer foot copyright cookie cookies
    consent gdpr notice notices notification notifications alert popup popover modal overlay dialog lightbox newsletter subscribe subscription
    signup login signin register paywall share sharing social socials follow related recommended recommendations trending popular comment
    comments commentlist discussion disqus respond reply replies form search searchbox pagination pager pagenav toolbar widget widgets skip
    skiplink tags tagcloud toc""".split())
KEEP = frozenset("html body main article".split())  # not left out for their class names, comments apart
COMMENTS = frozenset("comment comments commentlist disqus respond reply replies discussion".split())
ATTR = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")
DIGITS = re.compile(r"[0-9]+")


@dataclass(frozen=True)
class Consensus:
    """Parameters of the vote."""
    share: float = 0.1   # of a host's votes that a winning path has at least


@dataclass(eq=False)
class Node:
    """An element; ``parts``: texts and elements in order."""
    tag: str
    path: str
    parent: Node | None
    out: bool = False            # left out
    role: str = ""
    parts: list = field(default_factory=list)
    score: float = 0.0
    size: int = 0                # characters of text inside, what is left out apart
    linked: int = 0              # of them in links


# --- parsing -------------------------------------------------------------------------------

def _tag_end(s: str, at: int) -> int:
    """Place of the ``>`` that ends the tag, quotes respected; -1 if the page ends within it."""
    end = s.find(">", at)
    if end < 0:
        return -1
    q = at
    while True:
        found = [x for x in (s.find('"', q, end), s.find("'", q, end)) if x >= 0]
        if not found:
            return end
        first = min(found)
        if not s[at:first].rstrip().endswith("="):  # a stray quote, no value
            q = first + 1
            continue
        close = s.find(s[first], first + 1)
        if close < 0:
            return end
        q = close + 1
        if close > end:
            end = s.find(">", close)
            if end < 0:
                return -1


def _events(s: str):
    """(kind, value, attributes): ('t', text), ('s', tag, attributes), ('e', tag)."""
    at, n, low = 0, len(s), None
    while at < n:
        lt = s.find("<", at)
        if lt < 0:
            yield "t", s[at:], ""
            return
        if lt > at:
            yield "t", s[at:lt], ""
        if s.startswith("<!--", lt):
            end = lt + 4 if s.startswith(">", lt + 4) else s.find("-->", lt + 4)
            at = n if end < 0 else end + (1 if s[end] == ">" else 3)
            continue
        if s.startswith("<![CDATA[", lt):
            end = s.find("]]>", lt)
            yield "t", html_lib.escape(s[lt + 9:n if end < 0 else end], quote=False), ""
            at = n if end < 0 else end + 3
            continue
        c = s[lt + 1:lt + 2]
        if c in ("!", "?"):
            end = s.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        closing = c == "/"
        m = NAME.match(s, lt + 1 + closing)
        if not m:
            if closing or not c:  # a stray end tag; a page that ends with "<" shows it
                end = s.find(">", lt)
                if not c:
                    yield "t", "<", ""
                at = n if end < 0 else end + 1
            else:
                yield "t", "<", ""
                at = lt + 1
            continue
        end = _tag_end(s, m.end())
        if end < 0:
            return  # cut off within a tag
        tag = m.group().lower()
        if closing:
            yield "e", tag, ""
            at = end + 1
            continue
        yield "s", tag, s[m.end():end]
        at = end + 1
        if tag in RAW:
            low = s.lower() if low is None and len(s.lower()) == n else low
            stop = (low or s).find(f"</{tag}", at)
            if stop < 0:
                return  # cut off within a script or the like
            end = s.find(">", stop)
            yield "e", tag, ""
            at = n if end < 0 else end + 1


def _words(value: str) -> list[str]:
    return [w for w in SPLIT.split(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value).lower()) if w]


def _left_out(tag: str, attrs: dict, holder: Node) -> bool:
    if tag in NEVER:
        return True
    if tag == "header":
        return True
    if attrs.get("role", "").strip().lower() in ROLES and tag not in KEEP:
        return True
    names = set(_words(f"{attrs.get('class', '')} {attrs.get('id', '')}"))
    if tag in KEEP or tag in HEADINGS:
        return bool(names & COMMENTS) and tag == "article"
    return bool(names & WORDS)


def parse(s: str) -> Node:
    """The tree of a page; elements that are left out are marked."""
    root = Node("#root", "", None)
    open_ = [root]

    def push(tag: str, attrs: dict) -> None:
        holder = open_[-1]
        classes = sorted({DIGITS.sub("#", c.lower()) for c in attrs.get("class", "").split()})
        node = Node(tag, f"{holder.path}/{'.'.join([tag, *classes])}", holder, role=attrs.get("role", "").strip().lower())
        node.out = holder.out or _left_out(tag, attrs, holder)
        # the headings of an article's own header are part of the article
        if holder.out and tag in HEADINGS and _own_header(holder):
            node.out = False
        holder.parts.append(node)
        open_.append(node)
    for kind, value, more in _events(s):
        if kind == "t":
            open_[-1].parts.append(value)
        elif kind == "s":
            attrs = {}
            if more and not more.isspace():
                for m in ATTR.finditer(more):
                    v = m.group(2) or ""
                    attrs.setdefault(m.group(1).lower(), html_lib.unescape(v[1:-1] if v[:1] in "\"'" and v else v))
            if value in BLOCKS and value != "br":
                _close(open_, {"p"}, {"button", "table", "td", "th", "caption", "object", "article", "section", "div", "main", "body"})
            if value in CLOSES:
                _close(open_, *CLOSES[value])
            push(value, attrs)
            if value in VOID or (more.endswith("/") and value not in BLOCKS and value not in RAW):
                open_.pop()
        else:
            for i in range(len(open_) - 1, 0, -1):
                if open_[i].tag == value:
                    del open_[i:]
                    break
                if open_[i].tag in ("td", "th", "table", "article", "main", "section", "aside", "nav", "footer", "header", "form") and value not in BLOCKS:
                    break  # a stray inline end tag closes nothing outside its block
    return root


def _own_header(node: Node) -> bool:
    """Whether what leaves the node out is a header inside an article or main element, and nothing else."""
    header = None
    while node is not None and node.out:
        header, node = node, node.parent
    return header is not None and header.tag == "header" and _above(header, ("article", "main")) is not None


def _close(open_: list[Node], kinds: set, until: set) -> None:
    """Close the outermost open element of ``kinds`` that no element of ``until`` lies above."""
    cut_at = None
    for i in range(len(open_) - 1, 0, -1):
        if open_[i].tag in kinds:
            cut_at = i
        elif open_[i].tag in until:
            break
    if cut_at is not None:
        del open_[cut_at:]


def _above(node: Node, tags: tuple) -> Node | None:
    """The outermost element of ``tags`` at or above the node."""
    found = None
    while node is not None:
        if node.tag in tags or (node.role == "main" and "main" in tags):
            found = node
        node = node.parent
    return found


# --- scoring -------------------------------------------------------------------------------

def _nodes(root: Node) -> list[Node]:
    """All elements, in page order (no recursion: pages may nest deeply)."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(x for x in reversed(node.parts) if isinstance(x, Node))
    return out


def best_container(root: Node) -> Node | None:
    """The container whose paragraphs score highest, widened to the article or main element around it."""
    nodes = _nodes(root)
    for node in reversed(nodes):
        for x in node.parts:
            if isinstance(x, Node):
                node.size += x.size
                node.linked += x.size if x.tag == "a" else x.linked
            elif not node.out:
                node.size += len(x.strip())
    top = None
    for node in nodes:
        if node.out or not node.size:
            continue
        if node.tag in PARAGRAPHS:
            plain = node.size - node.linked
            worth = 1 + plain / 25
        else:  # text that stands in a container without a paragraph of its own
            plain = sum(len(x.strip()) for x in node.parts if isinstance(x, str))
            worth = plain / 25
        if plain <= 0 or worth <= 0:
            continue
        holder, share = (node.parent if node.tag in PARAGRAPHS else node), 1.0
        while holder is not None and share > 0.2:
            if holder.tag in CONTAINERS:
                holder.score += worth * share
                share /= 2
            holder = holder.parent
    for node in nodes:
        if node.out or node.score <= 0:
            continue
        score = node.score * (1 - node.linked / max(1, node.size))
        if top is None or score > top[0]:
            top = (score, node)
    if top is None:
        return None
    node = top[1]
    wide = _above(node, ("article",)) or _above(node, ("main",))
    if wide is None:
        wide = node
        while wide.parent is not None and wide.parent.tag not in ("body", "html", "#root"):
            more = wide.parent
            first = any(isinstance(x, Node) and x.tag in ("h1", "h2") and not x.out for x in more.parts)
            if not first or (more.size - wide.size) * 2 > wide.size:
                break
            wide = more
    wide.score = top[0]
    return wide


# --- text ------------------------------------------------------------------------------------

def text_of(nodes: list[Node]) -> str:
    """The blocks of the elements in order, joined by one space; white space is one space."""
    out: list[str] = []
    for top in nodes:
        stack: list = [(top, None)]
        out.append(" ")
        while stack:
            item, closing = stack.pop()
            if isinstance(item, str):
                out.append(item)
                continue
            if closing:
                out.append(" ")
                continue
            if item.out and not any(isinstance(x, Node) for x in item.parts):
                continue
            if item.tag in BLOCKS:
                out.append(" ")
                stack.append((item, True))
            stack.extend((x, None) for x in reversed(item.parts) if isinstance(x, Node) or not item.out)
    return " ".join(html_lib.unescape("".join(out)).split())


def by_path(nodes: list[Node], path: str) -> list[Node]:
    return [n for n in nodes if n.path == path and not n.out]


def extract_page(s: str, paths: list[str]) -> str:
    """Text by the first path that the page has with text, else by its own best container."""
    if not s:
        return ""
    root = parse(s)
    nodes = _nodes(root)
    for path in paths:
        found = by_path(nodes, path)
        text = text_of(found) if found else ""
        if text:
            return text
    own = best_container(root)
    return text_of(by_path(nodes, own.path) or [own]) if own else ""


# --- operator ----------------------------------------------------------------------------------

def _votes(batches):
    for b in batches:
        host, path, score = [], [], []
        for h, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            best = best_container(parse(s)) if s else None
            if best is not None:
                host.append(h)
                path.append(best.path)
                score.append(best.score)
        yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(path, pa.string()), pa.array(score, pa.float64())],
                                         names=["host", "path", "score"])


def _extract(batches):
    for b in batches:
        text = [extract_page(s, paths or []) for s, paths in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                                         names=["page_id", "url", "text", "n_chars"])


def _pages(pages: DataFrame) -> DataFrame:
    p = only(pages, page_id="page_id", url="url", html="html")
    host = F.lower(F.regexp_extract("url", r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return p.withColumn("host", F.when(host != "", host))


def host_paths(pages: DataFrame, c: Consensus = Consensus()) -> DataFrame:
    """(host, paths): the winning paths of every host, most votes first. A written table."""
    tune(pages.sparkSession)
    votes = (_pages(pages).where("host is not null").select("host", "html").mapInArrow(_votes, "host string, path string, score double")
             .groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes"), F.sum("score").alias("score")))
    votes = cut(votes, "mt-votes")
    all_ = votes.groupBy("host").agg(F.sum("votes").alias("total"))
    won = votes.join(all_, "host").where(F.col("votes") >= F.col("total") * F.lit(c.share))
    out = cut(won.groupBy("host").agg(F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("v"), F.col("path")))).alias("w"))
              .select("host", F.col("w.path").alias("paths")), "mt-paths")
    drop(votes)
    return out


def extract(pages: DataFrame, c: Consensus = Consensus()) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    paths = host_paths(pages, c)
    return (_pages(pages).join(paths, "host", "left").select("page_id", "url", "html", "paths")
            .mapInArrow(_extract, "page_id long, url string, text string, n_chars long"))
