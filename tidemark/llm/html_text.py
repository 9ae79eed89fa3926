"""Main text of web pages by composite text density.

A small forgiving reader turns the page into a tree (implied ends of paragraphs, list
items and table cells; void tags; comments, scripts and styles skipped; unclosed
elements end with their parent). Elements that are never part of an article go first:
controls (labels of a form too) and hidden elements, navigation, headers and footers, asides, forms, scripts,
and elements whose role, or a whole name in whose class or id, names an advert, a notice,
a menu, a sidebar or reader comments. A form or a named element stays, without its
controls, where it holds most of the characters outside links, a ``main`` element, or an
``article`` (teasers in a named element go if the page has an article outside of such
elements); a place beside the article stays only around a ``main`` or an article with most
of the text, and reader comments around a ``main`` or if the page has nothing else.

Every remaining node then has its characters C, tags T, link characters LC and link
tags LT, and the composite density

    C / T * log(C / LC * T / LT) to the base ln(C / nLC * LC + LCb / Cb * C + e)

(nLC: characters outside links, b: the body; divisors of 0 count as 1, and the base as
e^0.1 at least). The node whose
children's densities sum up highest among those at or above the threshold - the least
density on the path from that node to the body - is the main content; inside an
``article`` or ``main`` element, or around one that holds most of it, that element is; of
articles side by side that hold half as much or more, all are.

Null pages and pages without text give an empty text; tags without an end, stray ends
and very long or deep pages are read to the end. Repeated rows give equal texts.
Other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

_PIECE = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style|template|textarea|title|iframe|svg)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>"
    r"(?:(?<=/>)|.*?(?:</(?P=raw)\s*>|\Z))"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)", re.S | re.I)
#: one whole attribute, a name and its quoted or bare value
_ATTR = re.compile(r"([^\s=/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre "
    "section summary table tbody td tfoot th thead tr ul".split())
#: controls, never part of an article
CONTROLS = frozenset("button select input canvas audio video".split())
#: parts of a page beside the article
PLACES = frozenset("head nav header footer aside menu dialog".split())
FORMS = frozenset("form fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary menu menubar dialog alert".split())
FORM_ROLES = frozenset("search form".split())
ARTICLES = frozenset(("article", "main"))
#: words of a class or id that mark an element outside the article
MARKED = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login paywall "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toolbar header masthead footer "
    "sidebar aside rail widget widgets related recommended recommendations share sharing social search skip "
    "tags".split())
#: those that mark reader comments
READERS = frozenset("comment comments disqus respond replies reply commentlist".split())
#: parts a name may have beside marked ones: where an element stands and what it is, not what surrounds it
BESIDE = frozenset(
    "site page main top bottom left right primary secondary global inner outer fixed sticky mobile desktop box block "
    "list item items area section wrapper wrap container bar links link button buttons icons slot unit text title "
    "form col column google this us".split())
PAIRS = frozenset("sponsored-content promoted-content related-content related-posts related-articles related-stories "
                  "recommended-posts recommended-articles sponsored-post post-navigation posts-navigation "
                  "post-tags entry-header entry-footer post-header post-footer article-header article-footer".split())
READER_PAIRS = frozenset("comment-body comment-content comment-text comment-author comment-meta comment-count "
                         "comment-thread comment-metadata".split())
#: what an element's tag and attributes say about it
PLAIN, FORM, MARK, PLACE, READER, HIDDEN = range(6)
#: which open elements a start tag ends
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
           "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}


def _attributes(attrs: str) -> dict[str, str]:
    """Lower-cased names and values; of a repeated name the first counts."""
    out: dict[str, str] = {}
    for name, value in _ATTR.findall(attrs):
        if value[:1] in ("'", '"') and value[-1] == value[0]:
            value = value[1:-1]
        out.setdefault(name.lower(), value.strip().lower())
    return out


def _named(value: str) -> int:
    """What the names in a class or id say: a whole name that is marked, or made of marked parts and ``BESIDE``."""
    kind = PLAIN
    for name in value.split():
        parts = [x for x in re.split(r"[^a-z0-9]+", name) if x]
        marked = [x for x in parts if x in MARKED or x in READERS]
        whole = "-".join(parts)
        if whole in READER_PAIRS or whole in PAIRS or marked and all(
                x in BESIDE or x in MARKED or x in READERS or x[0].isdigit() for x in parts):
            kind = max(kind, READER if whole in READER_PAIRS or not READERS.isdisjoint(parts) else MARK)
    return kind


def _kind(tag: str, attrs: str) -> int:
    found = _attributes(attrs) if attrs else {}
    role = found.get("role")
    if tag in CONTROLS or "hidden" in found or found.get("aria-hidden") == "true":
        return HIDDEN
    named = max(_named(found.get("class", "")), _named(found.get("id", "")))
    if named == READER:
        return READER
    if tag in PLACES or role in ROLES:
        return PLACE
    return named or (FORM if tag in FORMS or role in FORM_ROLES else PLAIN)


class _Page:
    """The tree as parallel lists: parents come before their children."""

    def __init__(self, source: str):
        self.tag, self.parent, self.kind = ["html"], [-1], [PLAIN]
        #: (node, text) in page order; a text of None is a block boundary
        self.texts: list[tuple[int, str | None]] = []
        open_ = [0]
        #: depths at which each tag is open, so that no start or end looks through all open elements
        self.depths: dict[str, list[int]] = {}
        at = 0
        for piece in _PIECE.finditer(source):
            if piece.start() > at:
                self.texts.append((open_[-1], source[at:piece.start()]))
            at = piece.end()
            tag = piece["tag"] or piece["tag2"]
            if not tag:
                continue
            tag = tag.lower()
            attrs = piece["attrs"] or piece["attrs2"] or ""
            if piece["end"] or piece["end2"]:
                self._end(open_, tag)
            else:
                self._start(open_, tag, attrs)
        if at < len(source):
            self.texts.append((open_[-1], source[at:]))
        self.out = self._outside()

    def _innermost(self, tags: Iterable[str]) -> int:
        """The depth of the innermost open element of ``tags``, 0 if none is open."""
        return max((self.depths[t][-1] for t in tags if self.depths.get(t)), default=0)

    def _close(self, open_: list[int], depth: int) -> None:
        while len(open_) > depth:
            tag = self.tag[open_.pop()]
            self.depths[tag].pop()
            if tag in BLOCKS:
                self.texts.append((open_[-1], None))

    def _start(self, open_: list[int], tag: str, attrs: str) -> None:
        if tag == "html":
            return
        ends, scope = IMPLIED.get(tag, (set(), set()))
        if tag in BLOCKS:
            ends, scope = ends | {"p"}, scope | {"td", "th", "button", "object"}
        if tag == "body":
            ends = {"head"}
        while (depth := self._innermost(ends)) > self._innermost(scope - ends):
            name = self.tag[open_[depth]]
            if name in scope:
                break
            self._close(open_, depth)
            if name == "p":
                break
        parent = open_[-1]
        node = len(self.tag)
        self.tag.append(tag)
        self.parent.append(parent)
        self.kind.append(_kind(tag, attrs))
        if tag in BLOCKS:
            self.texts.append((parent, None))
        if tag == "br":
            self.texts.append((parent, " "))
        elif tag not in VOID:
            self.depths.setdefault(tag, []).append(len(open_))
            open_.append(node)

    def _end(self, open_: list[int], tag: str) -> None:
        depth = self._innermost((tag,))
        if depth:
            self._close(open_, depth)

    def _outside(self) -> list[bool]:
        """Which nodes are not looked at for the article."""
        n, parent, tag, kind = len(self.tag), self.parent, self.tag, self.kind
        # a document, a main element and an article go only where they are hidden; their names tell teasers apart
        named = [k in (MARK, READER) for k in kind]
        kind = [PLAIN if named[k] and tag[k] in ("body", "html", *ARTICLES) else kind[k] for k in range(n)]
        if not any(kind):
            return [False] * n
        link, gone, beside, read, form = ([False] * n for _ in range(5))
        for k in range(1, n):
            up = parent[k]
            form[k] = form[up] or kind[k] == FORM
            if tag[k] == "label" and form[up]:
                kind[k] = HIDDEN
            link[k] = link[up] or tag[k] == "a"
            gone[k] = gone[up] or kind[k] == HIDDEN
            beside[k] = beside[up] or kind[k] in (PLACE, READER)
            read[k] = read[up] or kind[k] == READER
        # characters outside links: all, and those not in places beside the article
        size, weight, words = [0] * n, [0] * n, [0] * n
        for node, text in self.texts:
            if text and not gone[node]:
                chars = len("".join(text.split()))
                words[node] += chars
                if not link[node]:
                    size[node] += chars
                    weight[node] += 0 if beside[node] else chars
        for k in range(n - 1, 0, -1):
            words[parent[k]] += words[k]
            size[parent[k]] += size[k]
            weight[parent[k]] += weight[k]
        # articles with text below each node, main elements around it, articles that stand in nothing marked
        holds, mains, free, above = [0] * n, [0] * n, [False] * n, [0] * n
        for k in range(1, n):
            free[k] = kind[k] == PLAIN and (parent[k] == 0 or free[parent[k]])
            if tag[k] in ARTICLES and words[k] and not gone[k]:
                mains[k] = tag[k] == "main"
                holds[k] = mains[k] or not named[k] and not read[k]
            above[k] = above[parent[k]] + (free[k] and mains[k])
        open_articles = sum(1 for k in range(1, n) if free[k] and holds[k])
        for k in range(n - 1, 0, -1):
            mains[parent[k]] += mains[k]
            holds[parent[k]] += holds[k]
        out = [kind[0] == HIDDEN] * n
        for k in range(1, n):
            what, stays = kind[k], True
            if what == HIDDEN:
                stays = False
            elif what != PLAIN and not mains[k]:
                if what == READER:
                    stays = not weight[0] and size[k] == size[0]
                elif what == PLACE:
                    stays = holds[k] and 2 * size[k] > size[0]
                else:
                    stays = 2 * weight[k] > weight[0] or holds[k] and (what == FORM or open_articles == above[k])
            out[k] = out[parent[k]] or not stays
        return out

    def main(self) -> int:
        """The node of the main content."""
        n = len(self.tag)
        chars, tags, link_chars, link_tags = ([0] * n for _ in range(4))
        in_link = [False] * n
        for k in range(1, n):
            in_link[k] = in_link[self.parent[k]] or self.tag[k] == "a"
        for node, text in self.texts:
            if text and not self.out[node]:
                size = len("".join(text.split()))
                chars[node] += size
                link_chars[node] += size * in_link[node]
        for k in range(n - 1, 0, -1):
            if not self.out[k]:
                up = self.parent[k]
                chars[up] += chars[k]
                link_chars[up] += link_chars[k]
                tags[up] += tags[k] + 1
                link_tags[up] += link_tags[k] + (self.tag[k] == "a")
        body = next((k for k in range(n) if self.tag[k] == "body"), 0)
        base_share = link_chars[body] / max(chars[body], 1)
        density = [0.0] * n
        for k in range(n):
            if chars[k] and not self.out[k]:
                c, t, lc, lt = chars[k], max(tags[k], 1), max(link_chars[k], 1), max(link_tags[k], 1)
                base = math.log(c / max(c - link_chars[k], 1) * link_chars[k] + base_share * c + math.e)
                density[k] = c / t * math.log(max(c / lc * t / lt, 1.0)) / math.log(max(base, math.e ** 0.1))
        sums = [0.0] * n
        for k in range(1, n):
            sums[self.parent[k]] += density[k]
        inside = [k for k in range(n) if not self.out[k] and chars[k]]
        if not inside:
            return body
        best = max(inside, key=lambda k: (sums[k], -k))
        path = [best]
        while path[-1] != body and self.parent[path[-1]] >= 0:
            path.append(self.parent[path[-1]])
        threshold = min(density[k] for k in path)
        best = max((k for k in inside if density[k] >= threshold), key=lambda k: (sums[k], -k))
        node = best
        while node > 0:  # inside an article, or one of several beside each other
            if self.tag[node] in ("article", "main"):
                alike = [k for k in inside if self.tag[k] == "article" and self.parent[k] == self.parent[node]
                         and 2 * chars[k] >= chars[node]]
                return self.parent[node] if self.tag[node] == "article" and len(alike) > 1 else node
            node = self.parent[node]
        for k in inside:  # around an article that holds most of the text, and no other holds half as much
            if (self.tag[k] in ("article", "main") and 2 * chars[k] >= chars[best]
                    and not any(self.tag[j] == "article" and self.parent[j] == self.parent[k] and 2 * chars[j] >= chars[k]
                                for j in inside if j != k)):
                node = k
                while node > 0 and node != best:
                    node = self.parent[node]
                if node == best:
                    return k
        return best

    def text(self) -> str:
        top = self.main()
        within = [False] * len(self.tag)
        within[top] = True
        for k in range(top + 1, len(self.tag)):
            within[k] = within[self.parent[k]]
        blocks, open_ = [], []
        for node, text in self.texts:
            if text is None:
                blocks.append("".join(open_))
                open_ = []
            elif within[node] and not self.out[node]:
                open_.append(html.unescape(text))
        blocks.append("".join(open_))
        return "\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)


def main_text(source: str | None) -> str:
    return _Page(source).text() if source else ""


def extract_text(pages: DataFrame, html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of ``pages`` (all but the page itself if None), text and n_chars.

    Columns of ``pages`` named text or n_chars give way to the new ones.
    """
    kept = [c for c in (pages.columns if keep is None else keep) if c not in (html_col, "text", "n_chars")]
    picked = pages.select(*kept, F.col(html_col).cast("string").alias("_html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x) for x in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[*kept, "text", "n_chars"])

    schema = picked.select(*kept).schema.add("text", "string").add("n_chars", "long")
    return picked.mapInArrow(run, schema)


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"), keep=["page_id", "url"])
