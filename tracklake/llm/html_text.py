"""Main text of web pages by scoring the element tree.

Every paragraph gives points for its length and its commas to its ancestors: all to the parent, half to the grandparent, less
further up. A container's points are discounted by the share of its text that stands in links. The best container and those
of its siblings that read like text are kept; elements that are never article text (scripts, controls) are taken out first.
Elements that seldom are (menus, forms, adverts, comments, ...) go too, unless the page's article stands in them: see
``spare``. Pages are independent: one pass beside the scan, no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.llm.common import drop_named, extended, fresh

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose start ends an open paragraph, and whose edges separate blocks of text.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead "
    "tr ul".split()
)
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Never part of an article.
DROPPED = frozenset(
    "audio button canvas datalist embed frame frameset head iframe input label math noframes noscript object option script "
    "select style svg template textarea title video".split()
)
#: Seldom part of an article, but may be wrapped around one.
DOUBTED = frozenset("aside dialog fieldset footer form header menu nav".split())
DROPPED_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search tablist toolbar".split()
)
DROPPED_NAMES = re.compile(
    r"(?:^|[_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|notification|alert|popup"
    r"|modal|overlay|newsletter|subscribe|subscription|sidebar|side|widget|comments?|commentlist|disqus|replies|reply|respond"
    r"|share|sharing|social|related|recommend\w*|outbrain|taboola|breadcrumbs?|menu|nav|navbar|navigation|header|footer"
    r"|masthead|copyright|legal|pager|pagination|login|signup|search|toolbar|skip|hidden)(?:$|[_-])",
    re.IGNORECASE,
)
#: These say what a page has or lacks, or how it is laid out, not what the element is.
LAYOUT_NAMES = re.compile(
    r"^(?:no|not|non|without|has|have|with)[_-]|(?:^|[_-])layout(?:$|[_-])|(?:^|[_-])content[_-]sidebar(?:$|[_-])"
    r"|(?:^|[_-])sidebar[_-]content(?:$|[_-])",
    re.IGNORECASE,
)
#: Parts of a name that add nothing to a dropped word beside them. Within an article a class counts only if all its parts are such.
NEUTRAL = re.compile(
    r"(?:area|articles?|bar|block|box|button|buttons|container|form|inner|item|items|links?|list|outer|panel|posts?|section|slot|top|bottom"
    r"|unit|widgets?|wrap|wrapper|\d+)",
    re.IGNORECASE,
)
#: Text of readers and hidden text may be longer than the article.
NEVER_BY_LENGTH = re.compile(r"(?:^|[_-])(?:comments?|commentlist|disqus|replies|reply|respond|hidden)(?:$|[_-])", re.IGNORECASE)
#: The class names of these say something about the page, not about a part of it.
WHOLE = frozenset("html body article main".split())
#: An open element of a key's set is closed when the key starts, if it stands above the key's stopping elements.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
UNCLOSED = re.compile(r"<[A-Za-z/!?][^<>]*\Z")


class Node:
    __slots__ = ("by_length", "children", "doubted", "drop", "inside", "parent", "tag")

    def __init__(self, tag: str, parent: Node | None, drop: bool = False, doubted: bool = False, by_length: bool = True) -> None:
        self.tag, self.parent, self.drop = tag, parent, drop
        self.doubted, self.by_length = doubted, by_length
        self.inside = parent is not None and (parent.inside or parent.tag in ("article", "main"))
        self.children: list[Node | str] = []


def names_a_part(token: str) -> bool:
    """Whether a whole class name says that its element is no text of the article it stands in: ``share-buttons``, not ``side-effects``."""
    parts = [part for part in re.split(r"[_-]+", token) if part]
    return any(DROPPED_NAMES.fullmatch(part) for part in parts) and all(
        DROPPED_NAMES.fullmatch(part) or NEUTRAL.fullmatch(part) for part in parts
    )


class TreeBuilder(HTMLParser):
    """Elements in document order in ``nodes``; a parent stands before its children."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes = [Node("#root", None)]
        self.open = [self.nodes[0]]

    def _close_to(self, names: set[str] | frozenset[str], stop: set[str]) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in names:
                del self.open[k:]
                return
            if self.open[k].tag in stop:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK:
            self._close_to({"p"}, {"table", "td", "th", "button", "object", "article", "section", "div"})
        if tag in HEADING:
            self._close_to(HEADING, {"div", "section", "article"})
        if tag in ENDS:
            self._close_to(*ENDS[tag])
        parent = self.open[-1]
        drop = parent.drop or tag in DROPPED
        doubted, by_length = tag in DOUBTED, True
        inside = parent.inside or parent.tag in ("article", "main")
        if tag == "header":
            doubted = not inside
        if not drop and attrs and tag not in WHOLE:
            for name, value in attrs:
                value = value or ""
                if name in ("class", "id"):
                    found = [t for t in value.split() if DROPPED_NAMES.search(t) and not LAYOUT_NAMES.search(t)]
                    if inside:  # headings and words have ids and classes of their own subject
                        named = name == "class" and tag in BLOCK and tag not in HEADING
                        found = [t for t in found if named and names_a_part(t)]
                    doubted = doubted or bool(found) and not (inside and "header" in value.lower())
                    by_length = by_length and not any(NEVER_BY_LENGTH.search(t) for t in found)
                elif name == "role":
                    doubted = doubted or value.strip().lower() in DROPPED_ROLES
                elif name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true":
                    doubted, by_length = True, False
        node = Node(tag, parent, drop, doubted, by_length)
        parent.children.append(node)
        self.nodes.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag not in ("html", "body"):  # text after them still belongs to the page
            self._close_to({tag}, {"td", "th"} if tag not in BLOCK else set())

    def handle_data(self, data: str) -> None:
        if not self.open[-1].drop:
            self.open[-1].children.append(data)


def spare(nodes: list[Node]) -> None:
    """Drop the doubted elements, but not those that hold the page's article.

    While no article or main element with text stands outside the doubted elements, the outermost one with the most such text
    is spared, and those inside it are doubted in turn. On a page without such elements it is spared if it holds most of
    the page's points (commas and length of text outside links), at least those of a short paragraph. Elements of readers'
    comments and hidden ones are not spared for their length, and for an article only if no other doubted element holds one.
    """
    if not any(n.doubted and not n.drop for n in nodes):
        return
    index = {id(n): k for k, n in enumerate(nodes)}
    count = len(nodes)
    points, whole, link = [0.0] * count, [0.0] * count, [False] * count
    outer = [-1] * count  # the doubted element nearest above
    below: dict[int, list[int]] = {}
    in_article = [False] * count
    for k, node in enumerate(nodes):
        up = index[id(node.parent)] if node.parent is not None else -1
        if up >= 0:
            link[k] = link[up]
            outer[k] = up if nodes[up].doubted else outer[up]
            in_article[k] = in_article[up]
        link[k] = link[k] or node.tag == "a"
        in_article[k] = in_article[k] or node.tag in ("article", "main")
        if node.doubted and not node.drop:
            below.setdefault(outer[k], []).append(k)
        if not node.drop and not link[k]:
            texts = [c for c in node.children if isinstance(c, str)]
            points[k] = sum(t.count(",") for t in texts) + sum(len(t.strip()) for t in texts) / 100.0
            whole[k] = points[k] if in_article[k] else 0.0
    clean = any(whole[k] and outer[k] < 0 and not node.doubted for k, node in enumerate(nodes))
    # Article text by the doubted element nearest above: sparing that element makes it clean.
    direct: dict[int, float] = {}
    for k, node in enumerate(nodes):
        owner = k if node.doubted else outer[k]
        direct[owner] = direct.get(owner, 0.0) + whole[k]
    for k in range(count - 1, 0, -1):
        up = index[id(nodes[k].parent)]
        points[up] += points[k]
        whole[up] += whole[k]
    spared: set[int] = set()
    outermost = list(below.get(-1, ()))
    while not clean and outermost:
        if whole[0]:
            chosen = max(outermost, key=lambda k: (whole[k] > 0 and nodes[k].by_length, whole[k], -k))
            good = whole[chosen] > 0
        else:
            able = [k for k in outermost if nodes[k].by_length]
            chosen = max(able, key=lambda k: (points[k], -k), default=-1)
            good = chosen >= 0 and points[chosen] >= 1.0 and points[chosen] > points[0] / 2
        if not good:
            break
        spared.add(chosen)
        outermost.remove(chosen)
        outermost += below.get(chosen, ())
        clean = direct.get(chosen, 0.0) > 0
    for k, node in enumerate(nodes):
        above = node.parent is not None and node.parent.drop
        node.drop = node.drop or above or node.doubted and k not in spared


def best_container(nodes: list[Node]) -> list[Node]:
    """The kept elements in page order: the best container (an article element around it, if there is one) and
    siblings."""
    index = {id(n): k for k, n in enumerate(nodes)}
    n = len(nodes)
    size, linked, points = [0] * n, [0] * n, [0.0] * n
    own: list[list[str]] = [[] for _ in range(n)]
    for k, node in enumerate(nodes):  # text goes to the block it stands in
        texts = [c for c in node.children if isinstance(c, str)] if not node.drop else []
        if not texts:
            continue
        chars = sum(len(t.strip()) for t in texts)
        block, in_link = node, False
        while block.parent is not None and block.tag not in BLOCK:
            in_link = in_link or block.tag == "a"
            block = block.parent
        b = index[id(block)]
        size[b] += chars
        linked[b] += chars if in_link else 0
        own[b].extend(texts)
    for k, node in enumerate(nodes):
        if not size[k]:
            continue
        gain = 1.0 + sum(t.count(",") for t in own[k]) + min(size[k] / 100.0, 3.0)
        # Text right in a container counts for it; a paragraph counts for those it stands in.
        target = node if node.tag in ("div", "section", "article", "main", "body", "#root", "td") else node.parent
        level = 0
        while target is not None:
            points[index[id(target)]] += gain / (1 if level == 0 else 2 if level == 1 else 3 * level)
            target, level = target.parent, level + 1
    for k in range(n - 1, 0, -1):
        p = index[id(nodes[k].parent)]
        size[p] += size[k]
        linked[p] += linked[k]
    score = [points[k] * (1.0 - linked[k] / size[k]) if size[k] else 0.0 for k in range(n)]
    top = max(range(n), key=lambda k: (score[k], -k))
    if score[top] <= 0 and not size[0]:
        return []
    best = nodes[top]
    around = best
    while around is not None and around.tag != "article":
        around = around.parent
    if around is None:
        around = best
        while around is not None and around.tag != "main":
            around = around.parent
    if around is not None:
        best, top = around, index[id(around)]
    if best.parent is None:
        return [best]
    kept = []
    for sibling in best.parent.children:
        if isinstance(sibling, str) or sibling.drop:
            continue
        s = index[id(sibling)]
        density = linked[s] / size[s] if size[s] else 1.0
        reads = sibling.tag == "p" and (density < 0.25 if size[s] > 80 else density == 0.0 and size[s] > 0)
        title = sibling.tag in HEADING and density < 0.25 and best.tag not in ("article", "main")
        if sibling is best or reads or title or score[s] >= max(10.0, 0.2 * score[top]):
            kept.append(sibling)
    return kept


def block_texts(kept: list[Node]) -> list[str]:
    """Blocks of text below the kept elements, white space folded."""
    blocks, now = [], []

    def end() -> None:
        text = " ".join("".join(now).split())
        now.clear()
        if text:
            blocks.append(text)

    stack: list = list(reversed(kept))
    while stack:
        item = stack.pop()
        if item is None:
            end()
        elif isinstance(item, str):
            now.append(item)
        elif not item.drop:
            if item.tag in BLOCK:
                end()
                stack.append(None)
            elif item.tag in ("br", "td", "th"):
                now.append(" ")
            stack.extend(reversed(item.children))
    end()
    return blocks


def main_text(html: str | None) -> str:
    """The article's text, one block a line; '' for NULL, empty or text-free pages."""
    if not html:
        return ""
    builder = TreeBuilder()
    builder.feed(UNCLOSED.sub("", html))
    builder.close()
    spare(builder.nodes)
    return "\n".join(block_texts(best_container(builder.nodes)))


def extract_text(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """All columns of ``pages`` but the HTML, with ``text`` and ``n_chars`` (code points).

    Columns of the added names are replaced. NULL, empty and text-free pages give ''. Repeated rows stay repeated, NULLs in
    other columns stay, an empty table gives an empty result.
    """
    html = fresh([*pages.columns, text_col, "n_chars"], "html_now")
    base = drop_named(pages.withColumn(html, F.col(f"`{html_col}`").cast("string")), (html_col, text_col, "n_chars"))
    at = base.columns.index(html)
    schema = extended(base.drop(html).schema, f"`{text_col}` string, n_chars bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(v.as_py()) for v in batch.column(at)]
            rest = [c for k, c in enumerate(batch.columns) if k != at]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=schema.names
            )

    return base.mapInArrow(run, schema)
