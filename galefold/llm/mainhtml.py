"""Main text of web pages by tree scoring.

A forgiving parser builds the element tree (void elements, implied ends of paragraphs, list items and
cells, raw-text elements, unclosed and stray tags). Elements that hold menus, headers, footers, sidebars,
notices, adverts, forms, scripts or reader comments are left out with all they hold: by tag, by role, or by a
class or id all of whose words name such a part (``cookie-notice`` and ``related-posts`` do, ``social-history``
and ``hidden-gem`` don't). Attributes are read as pairs of name and value.

Every block with text of its own passes points to its ancestors: one, one a comma and up to three for length;
all to the parent, half to the next, a third of a half further on. Scores get a bonus by tag and names and are
discounted by the share of text in links. The best container stands for the article; an article element
around it comes in its place. Inside of it nothing more is dropped; of a body or main element that
has the best score itself, children that are mostly links are. Then, from it up to the body, siblings at
each level are kept as well: those that score near it and text paragraphs with few links; as long as no article
(or main) element is passed, also headings, paragraphs, lists and sections that hold few links, however short, and
the loose text around them. Blocks are joined in page order.

Edge cases: a null or empty page, or one without text outside of what is left out, gives an empty text.
Nesting of any depth is handled without recursion; texts are never cut. Rows are independent of each
other, so repeated rows and ties of ids change nothing; of equally good containers the first wins. Extra
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galefold.llm.shared import texts_of, type_of

MARKUP = re.compile(r"""<(?:!--(.*?)(?:--!?>|\Z)|[!?][^>]*+>|(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)>)""", re.S)
PAIR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?|"[^"]*"|'[^']*'""")
WORDS = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
#: Tags whose start ends an open paragraph.
ENDS_P = BLOCKS - frozenset("dd dt li td th tr tbody thead tfoot option optgroup legend body html summary".split()) | frozenset("dd dt li".split())
#: A start tag ends the nearest open element of the first group, unless one of the second lies between.
ENDS = {
    "li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "option": ("option", "select"), "optgroup": ("option optgroup", "select"),
    "td": ("td th", "table tr"), "th": ("td th", "table tr"), "tr": ("tr", "table"), "tbody": ("tbody thead tfoot", "table"), "tfoot": ("tbody thead tfoot", "table"),
}
ENDS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in ENDS.items()}

LEFT_OUT = frozenset("head nav footer aside form button select option datalist dialog menu search template svg canvas map script style iframe textarea title noembed noframes".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
#: Words of class and id that mark what isn't the article.
FOREIGN = frozenset(
    "ad ads adsense advert adverts advertisement advertisements advertising adbox adslot adsbygoogle banner banners sponsor sponsored promo promos promotion cookie cookies consent gdpr notice notices notification notifications alert popup modal overlay newsletter subscribe subscription signup login menu menus nav navbar navigation breadcrumb breadcrumbs sidebar sidebars footer header masthead topbar toolbar comment comments commentlist disqus respond replies reply discussion share sharing social related recommended recommendations pagination pager".split()
)
COMMENTS = frozenset("comment comments commentlist disqus respond replies reply discussion".split())
#: Words that may stand beside them in a name of the same meaning.
PLAIN = frozenset(
    "a above area articles aside bar below block blocks body bottom box btn button buttons col column container content desktop entry fixed footer form global google group header home icon icons id inner item items left link links list main message mobile module nav navigation outer page panel policy post posts primary right row rows secondary section site slot small sticky stories story sub tertiary text thread title toggle top unit user widget widgets wp wrap wrapper".split()
)
OWN = frozenset("article content entry main post story text body".split())
#: Tags of written text: they stay beside the container, and a div that holds a heading or a paragraph does.
WRITTEN = frozenset("h1 h2 h3 h4 h5 h6 hgroup header p section blockquote pre ul ol dl table figure details address".split())
#: Elements that hold more than the article, and those of their children that may be lists of links.
WHOLE = frozenset("#page html body main".split())
LISTS = frozenset("div section ul ol dl table".split())
WRITING = frozenset("h1 h2 h3 h4 h5 h6 p".split())
BONUS = {"article": 25.0, "main": 25.0, "section": 5.0, "div": 5.0, "td": 3.0, "blockquote": 3.0, "pre": 3.0, "ul": -3.0, "ol": -3.0, "dl": -3.0, "li": -3.0, "address": -3.0, "h1": -5.0, "h2": -5.0, "h3": -5.0, "h4": -5.0, "h5": -5.0, "h6": -5.0, "th": -5.0}


class Tree:
    """Elements in page order, by number: tag, parent, attributes, whether left out; and the texts with their elements."""

    def __init__(self, html: str):
        self.tags, self.parents, self.names, self.out, self.inside = ["#page"], [-1], [frozenset()], [False], [False]
        #: (element, text or None where a block begins or ends)
        self.texts: list[tuple[int, str | None]] = []
        self.open = [0]
        at = 0
        while (m := MARKUP.search(html, at)) is not None:
            if m.start() > at:
                self.texts.append((self.open[-1], html[at : m.start()]))
            at = m.end()
            if (tag := m[3]) is None:
                continue
            tag = tag.lower()
            if m[2]:
                self.end(tag)
                continue
            self.start(tag, m[4])
            if tag in RAW and not m[4].rstrip().endswith("/"):
                close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, at)
                at = close.end() if close else len(html)
                self.end(tag)
        if at < len(html):
            self.texts.append((self.open[-1], html[at:]))

    def start(self, tag: str, attributes: str) -> None:
        if tag in ("html", "body", "head") and tag in [self.tags[i] for i in self.open[:4]]:
            return
        if tag == "body" or tag in BLOCKS and tag not in ("html",):
            self.close(frozenset(("head",)), frozenset())
        if tag in ENDS_P:
            self.close(frozenset("p"), frozenset("td th button object table caption".split()))
        if tag in ENDS:
            self.close(*ENDS[tag])
        if tag in BLOCKS or tag == "br":
            self.texts.append((self.open[-1], None))
        if tag in VOID:
            return
        parent = self.open[-1]
        words, foreign, hidden, role = self.read(attributes) if attributes.strip() else (frozenset(), 0, False, "")
        inside = self.inside[parent] or tag in ("article", "main") or role == "main"
        whole = tag in ("html", "body", "main")
        marked = foreign > self.inside[parent] and not whole
        out = self.out[parent] or hidden or tag in LEFT_OUT or role in ROLES or marked or tag == "header" and not self.inside[parent]
        self.open.append(len(self.tags))
        self.tags.append(tag)
        self.parents.append(parent)
        self.names.append(words)
        self.out.append(out)
        self.inside.append(inside)

    @staticmethod
    def read(attributes: str) -> tuple[frozenset[str], int, bool, str]:
        """Words of class and id, how far a name marks what isn't the article (0 not, 1 as a header, which an article may have, 2 wholly), whether hidden, role."""
        words: set[str] = set()
        foreign, own, comments, hidden, role = 0, False, False, False, ""
        for name, *values in PAIR.findall(attributes):
            name, value = name.lower(), next(filter(None, values), "").lower()
            if name in ("class", "id"):
                for one in value.split():
                    parts = frozenset(WORDS.findall(one))
                    words |= parts
                    bad = parts & FOREIGN
                    own |= bool(parts & OWN) and not bad
                    if bad and parts <= FOREIGN | PLAIN:
                        foreign = max(foreign, 1 if bad == {"header"} else 2)
                        comments |= bool(bad & COMMENTS)
            elif name == "role":
                role = value.strip()
            elif name == "hidden":
                hidden = True
            elif name == "aria-hidden":
                hidden |= value == "true"
            elif name == "style":
                hidden |= "display:none" in value.replace(" ", "")
        return frozenset(words), foreign if comments or not own else 0, hidden, role

    def close(self, tags: frozenset[str], within: frozenset[str]) -> None:
        """End the innermost open element of ``tags`` and what it holds, unless one of ``within`` lies between."""
        for k in range(len(self.open) - 1, 0, -1):
            tag = self.tags[self.open[k]]
            if tag in tags:
                self.cut(k)
                return
            if tag in within or tag in BLOCKS and tags == {"p"} and tag != "p":
                return

    def cut(self, k: int) -> None:
        while len(self.open) > k:
            i = self.open.pop()
            if self.tags[i] in BLOCKS:
                self.texts.append((i, None))

    def end(self, tag: str) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.tags[self.open[k]] == tag:
                self.cut(k)
                return
            if tag not in BLOCKS and self.tags[self.open[k]] in BLOCKS:
                return


def main_text(html: str | None) -> str:
    if not html:
        return ""
    tree = Tree(html)
    tags, parents, out, n = tree.tags, tree.parents, tree.out, len(tree.tags)
    length, commas, linked = [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    block = list(range(n))  # the nearest block around each element
    for i in range(1, n):
        in_link[i] = in_link[parents[i]] or tags[i] == "a"
        if tags[i] not in BLOCKS:
            block[i] = block[parents[i]]
    texts = [(i, t if t is None else unescape(t)) for i, t in tree.texts if not out[i]]
    for i, t in texts:
        if t and (size := len(t.strip())):
            own = block[i]
            length[own] += size
            commas[own] += t.count(",") + t.count("，") + t.count("、")
            linked[own] += size * in_link[i]
    score = [BONUS.get(tag, 0.0) + (25.0 if names & OWN else 0.0) for tag, names in zip(tags, tree.names, strict=True)]
    scored = [False] * n
    for i in range(n):
        if length[i]:
            points = (1 + commas[i] + min(3.0, length[i] / 100)) * (1 - linked[i] / length[i])
            at, share = i if tags[i] in ("body", "#page", "div", "article", "main", "section", "td") else parents[i], 1.0
            level = 0
            while at >= 0:
                if tags[at] in BLOCKS or at == 0:
                    scored[at] = True
                    score[at] += points * share
                    level += 1
                    share = 0.5 if level == 1 else 0.5 / (3 * (level - 1))
                at = parents[at]
    total, total_linked = length[:], linked[:]
    for i in range(n - 1, 0, -1):
        total[parents[i]] += total[i]
        total_linked[parents[i]] += total_linked[i]
    value = [score[i] * (1 - total_linked[i] / total[i]) if scored[i] and total[i] else float("-inf") for i in range(n)]
    best = max(range(n), key=value.__getitem__)
    if value[best] == float("-inf"):
        return ""
    least = max(10.0, 0.2 * value[best])
    # An article element around the best container comes in its place.
    at = best
    while at >= 0:
        if tags[at] == "article":
            best = at
        at = parents[at]
    children: dict[int, list[int]] = {}
    writes = [tag in WRITING and not o and size > 0 for tag, o, size in zip(tags, out, total, strict=True)]
    for i in range(n - 1, 0, -1):
        writes[parents[i]] |= writes[i]
        children.setdefault(parents[i], []).append(i)
    chosen, loose = {best}, set()
    at, marked = best, False
    while at > 0 and tags[at] not in ("html", "body"):
        marked |= tags[at] in ("article", "main")
        around = parents[at]
        for i in children[around]:
            if i != at and not out[i] and total[i] and total_linked[i] <= 0.25 * total[i]:
                if value[i] >= least or tags[i] == "p" and total[i] > 80:
                    chosen.add(i)
                elif not marked and (tags[i] in WRITTEN or tags[i] == "div" and (writes[i] or tree.inside[around])):
                    chosen.add(i)
        if not marked and linked[block[around]] <= 0.25 * length[block[around]]:
            loose.add(block[around])
        at = around
    kept = [False] * n
    for i in range(n):
        kept[i] = i in chosen or i > 0 and kept[parents[i]]
        if kept[i] and i > 0 and parents[i] == best and tags[best] in WHOLE and tags[i] in LISTS and total_linked[i] > 0.6 * total[i]:
            kept[i] = False  # teasers and menus beside the text, where no smaller container stands for the article
    return " ".join("".join(" " if t is None else t for i, t in texts if kept[i] or block[i] in loose).split())


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", keep_html: bool = False) -> DataFrame:
    """Per row: page_id, url, text (empty if there is none), n_chars; with ``keep_html`` also html, as it came."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(x) for x in texts_of(batch.column(2))]
            html = {"html": batch.column(2)} if keep_html else {}
            yield pa.RecordBatch.from_pydict({"page_id": batch.column(0), "url": batch.column(1), "text": pa.array(found, pa.string()), "n_chars": pa.array([len(x) for x in found], pa.int64()), **html})

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, f"page_id {type_of(rows, 'page_id')}, url {type_of(rows, 'url')}, text string, n_chars bigint" + (", html string" if keep_html else ""))
