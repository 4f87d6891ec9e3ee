"""Main-text extraction with a tree-structured graphical model over the DOM.

Every block element is a node with a label, content or not. The joint probability is
a product over the tree: P(label | parent's label, kind of element) for each edge,
and P(feature | label) for each node's features (class and id words, length of
its own text, punctuation, share of link text in it). Sum-product messages go up from the leaves and down from
the root; a node is content if its marginal reaches one half.

Training: pages with an ``article`` (or else a ``main``) label themselves: what is inside, and not inside a
navigation, form or aside, is content, whatever its classes say. Words in class, id and role are a feature like the others: a few
values with a prior that counts overrule, within bounds, so that a heading's id or a class in an article doesn't decide alone. Counts are
summed over all such pages in the tasks and merged; their size is fixed. So that the model also
works where those elements are missing, a third of the labelled pages (by hash of the page) is counted with the
element seen as a plain ``div`` and a third with it taken out of the tree.

Text: character references are decoded, white space inside a block becomes one
blank, blocks are joined by newlines in page order; nothing else is dropped or cut.

Defined results: null and empty pages give an empty text; broken markup is closed
the way browsers do in the common cases; repeated rows are extracted each; null ids and urls
pass through; without labelled pages the edges' prior and the words in class
and id decide alone. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import html as html_lib
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, texts, tree_merge

#: HTML element names by how they are treated.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = set("script style textarea title noscript iframe template select canvas annotation annotation-xml".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span "
             "strike strong sub sup time tt u var br wbr object audio video picture "
             "math mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot mover munder munderover mtable mtr mtd mspace mstyle semantics "
             "svg g text tspan path circle ellipse rect line polygon polyline defs use".split())
ENDS_P = set("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
             "h6 header hgroup hr main menu nav ol p pre section table ul".split())
#: Elements whose class says something of the whole page, not of a part.
WHOLE = {"body", "article", "main"}
#: An element of the first kind ends an open one of the second, up to an element of the third.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
        "body": ({"head"}, {"html"})}
KIND_OF = {tag: kind for kind, tags in enumerate((
    "html body", "article main", "nav footer aside form button menu dialog fieldset legend", "header hgroup",
    "h1 h2 h3 h4 h5 h6", "p", "ul ol dl", "li dt dd", "table tbody thead tfoot tr td th caption", "blockquote pre",
    "figure figcaption", "section div center details address", "head")) for tag in tags.split()}
ROOT, WRAPPER, BOILERPLATE, HEADER, PLAIN, HEAD, OTHER, PHRASE, TOP, MASTHEAD = 0, 1, 2, 3, 11, 12, 13, 14, 15, 16
KINDS = 17
#: Words in class, id and role that speak against or for content.
AGAINST = re.compile(r"(?<![a-z])(?<!has-)(?<!with-)(?<!no-)(ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notice|popup|modal|overlay|nav\w*|menu|"
                     r"breadcrumbs?|sidebar|widget|footer|masthead|topbar|toolbar|share|sharing|social|related|"
                     r"recommend\w*|comments?|replies|disqus|newsletter|subscribe|signup|login|search|pagination|pager|tags?|"
                     r"copyright|legal|disclaimer|skip|hidden|complementary|contentinfo)(?![a-z])")
DISCUSSION = re.compile(r"(?<![a-z])(comments?|replies|disqus)(?![a-z])")  # what an id says as well as a class
FOR = re.compile(r"(?<![a-z])(article|content|main|post|entry|story|text|body)(?![a-z])")
NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
QUOTE_OR_END = re.compile("[\"'>]")
ATTRIBUTES = re.compile(r"(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
SIZES = (5, 6, 4, 5)  #: values of the features: class words (none, against, for, against in the id alone, discussion), own length, punctuation, link share
#: What the words of each value say before any count, content to others; an id, often made from a heading, says less than a class.
WORDS_BEFORE = np.array([[1, 1], [20, 1], [1, 2], [2, 1], [400, 1]]) * 1e-3
#: How far counts may go for each value: no word alone outweighs the text and what surrounds it, but a discussion is one.
WORDS_RANGE = (np.array([-0.3, -3, -2, -1.5, -6]), np.array([0.1, 0, 2, 0.5, -3]))
FEATURES = sum(SIZES)


def tag_end(page: str, at: int) -> int:
    """Place of the ``>`` that ends the tag whose attributes begin at ``at``; that of the next one if a quote stays open."""
    i = at
    while (m := QUOTE_OR_END.search(page, i)) is not None:
        if m[0] == ">":
            return m.start()
        i = page.find(m[0], m.end()) + 1
        if i == 0:
            break
    return page.find(">", at)


def tokens(page: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """``(start, end, is_end_tag, tag, attributes)`` of everything that isn't text; no tag: comments, declarations and skipped elements.

    For CDATA sections, whose content is text, the attributes are that text. A cursor goes over the page once.
    """
    last = page.rfind(">")
    at = page.find("<")
    while at >= 0:
        end = None
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4) + 3
            yield at, end if end > 2 else len(page), False, "", ""
        elif page.startswith("<![CDATA[", at):
            end = page.find("]]>", at + 9)
            yield at, len(page) if end < 0 else end + 3, False, "", page[at + 9:None if end < 0 else end]
            end = end + 3 if end >= 0 else 2
        elif at > last:
            return  # nothing ends a tag any more
        elif page[at + 1:at + 2] in ("!", "?"):
            end = page.find(">", at) + 1
            yield at, end, False, "", ""
        elif (m := NAME.match(page, at)) is not None:
            tag, stop = m[2].lower(), tag_end(page, m.end())
            if stop >= 0:
                end = stop + 1
                if tag in SKIPPED and not m[1]:
                    close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, end)
                    end = close.end() if close else len(page)
                    yield at, end, False, "", ""
                else:
                    yield at, end, bool(m[1]), tag, page[m.end():stop]
        if end is not None and end <= 2:
            return  # an open comment or section takes the rest
        at = page.find("<", at + 1 if end is None else end)


class Tree:
    """Nodes in page order (parents before children) and the text pieces with their blocks."""

    def __init__(self, page: str):
        self.parent, self.tag, self.words = [-1], ["html"], [0]
        self.pieces: list[tuple[int, int, str]] = []  # block, node, decoded text
        self.chars, self.linked, self.marks = [0], [0], [0]
        self.stack, self.solid, self.open = [0], [], Counter()  # open nodes, the places of blocks among them, open tags
        stack, block, link, at = self.stack, 0, 0, 0
        for start, end, close, tag, attributes in tokens(page):
            if start > at:
                self._text(stack[-1], block, link, page[at:start])
            at = end
            if not tag:
                if attributes:
                    self._text(stack[-1], block, link, attributes)
                continue
            if tag == "a":
                link = 0 if close else 1
            if close:
                if self.open[tag]:
                    self._cut(next(i for i in range(len(stack) - 1, 0, -1) if self.tag[stack[i]] == tag))
                    if tag not in INLINE:
                        block += 1
                        link = 0
                continue
            if tag == "html":
                continue
            words = self._class_words(attributes) if "=" in attributes and tag not in WHOLE else 0
            if tag in INLINE:
                if tag == "br":
                    self._text(stack[-1], block, 0, " ")
                if words in (0, 2) or tag in VOID:
                    continue
            else:
                block += 1
                link = 0
                self._close_for(tag)
                if tag in VOID:
                    continue
            self.parent.append(stack[-1])
            self.tag.append(tag)
            self.words.append(words)
            for column in (self.chars, self.linked, self.marks):
                column.append(0)
            if not attributes.endswith("/") or tag in KIND_OF:
                if tag not in INLINE:
                    self.solid.append(len(stack))
                stack.append(len(self.tag) - 1)
                self.open[tag] += 1
        if at < len(page):
            self._text(stack[-1], block, link, page[at:])

    def _cut(self, i: int) -> None:
        """Close the open nodes from place ``i`` on."""
        for node in self.stack[i:]:
            self.open[self.tag[node]] -= 1
        while self.solid and self.solid[-1] >= i:
            self.solid.pop()
        del self.stack[i:]

    def _close_for(self, tag: str) -> None:
        if tag in ENDS_P and self.open["p"] and self.tag[self.stack[self.solid[-1]]] == "p":
            self._cut(self.solid[-1])
        if tag in ENDS:
            ended, within = ENDS[tag]
            for i in range(len(self.stack) - 1, 0, -1):
                if not any(self.open[x] for x in ended):
                    break
                name = self.tag[self.stack[i]]
                if name in ended:
                    self._cut(i)
                    if tag not in ("tr", "tbody", "tfoot"):
                        break
                elif name in within:
                    break

    def _text(self, node: int, block: int, link: int, raw: str) -> None:
        text = html_lib.unescape(raw) if "&" in raw else raw
        self.pieces.append((block, node, text))
        n = len(text.strip())
        self.chars[node] += n
        self.linked[node] += n * link
        self.marks[node] += text.count(".") + text.count(",") + text.count("!") + text.count("?")

    @staticmethod
    def _class_words(attributes: str) -> int:
        found = ATTRIBUTES.findall(attributes.lower())
        named = " ".join(value for name, value in found if name != "id")
        own = " ".join(value for name, value in found if name == "id")
        if DISCUSSION.search(named) or DISCUSSION.search(own):
            return 4
        if AGAINST.search(named):
            return 1
        return 2 if FOR.search(named) else 3 if AGAINST.search(own) else 2 if FOR.search(own) else 0

    def kinds(self) -> list[int]:
        """Kind of each element; a part of the page (a division or header of the body itself) is another kind than one inside a part."""
        kinds = [PHRASE if t in INLINE else KIND_OF.get(t, OTHER) for t in self.tag]
        of_page = {PLAIN: TOP, HEADER: MASTHEAD}
        return [of_page.get(k, k) if kinds[up] == ROOT else k for k, up in zip(kinds, self.parent, strict=True)]

    def features(self) -> list[tuple[int, ...]]:
        """Index of each node's feature values in one table of ``FEATURES`` rows; only words for nodes without own text."""
        out = []
        for own, marks, words, links in zip(self.chars, self.marks, self.words, self.linked, strict=True):
            if not own:
                out.append((words,))
                continue
            length = 0 if own < 8 else 1 if own < 20 else 2 if own < 60 else 3 if own < 150 else 4 if own < 400 else 5
            share = links / own
            at = 0 if not links else 1 if share < 0.2 else 2 if share < 0.5 else 3 if share < 0.8 else 4
            out.append((words, 5 + length, 11 + min(marks, 3), 15 + at))
        return out

    def own_labels(self) -> list[int] | None:
        """Labels that the page's ``article``, or else its ``main``, gives its nodes; None without one."""
        wrapper = next((t for t in ("article", "main") if t in self.tag), None)
        if wrapper is None:
            return None
        inside, out = [False] * len(self.tag), [False] * len(self.tag)
        for i, tag in enumerate(self.tag):
            above = self.parent[i]
            inside[i] = tag == wrapper or i > 0 and inside[above]
            out[i] = KIND_OF.get(tag) in (BOILERPLATE, HEAD) or i > 0 and out[above]
        labels = [int(a and not b) for a, b in zip(inside, out, strict=True)]
        if wrapper == "article":  # a main holds its article
            for i in range(len(labels) - 1, 0, -1):
                if labels[i] and self.tag[self.parent[i]] == "main":
                    labels[self.parent[i]] = 1
        return labels

    def text(self, content: list[bool]) -> str:
        """Blocks of the content nodes, joined by newlines."""
        blocks: dict[int, list[str]] = {}
        for block, node, piece in self.pieces:
            if content[node]:
                blocks.setdefault(block, []).append(piece)
        lines = (" ".join("".join(pieces).split()) for pieces in blocks.values())
        return "\n".join(line for line in lines if line)


def counted(tree: Tree, mode: int) -> np.ndarray | None:
    """Label counts of one page: edges (kind, parent's label, label), then features (value, label).

    ``mode`` 1 sees wrappers as plain divisions, 2 takes them out of the tree.
    """
    labels = tree.own_labels()
    if labels is None:
        return None
    kinds, features = tree.kinds(), tree.features()
    if mode == 2:  # what held the wrapper holds the content itself
        for i in range(len(kinds) - 1, 0, -1):
            if kinds[i] == WRAPPER and labels[i]:
                labels[tree.parent[i]] = 1
    edges, values = np.zeros((KINDS, 2, 2)), np.zeros((FEATURES, 2))
    for i, (kind, label) in enumerate(zip(kinds, labels, strict=True)):
        up = tree.parent[i]
        if mode and kind == WRAPPER:
            if mode == 2:
                continue
            kind = TOP if kinds[up] == ROOT else PLAIN
        if mode == 2:
            while up > 0 and kinds[up] == WRAPPER:
                up = tree.parent[up]
        edges[kind, labels[up] if i else 0, label] += 1
        for f in features[i]:
            values[f, label] += 1
    return np.concatenate([edges.ravel(), values.ravel()])


class Model:
    """Edge log-probabilities and log-odds of features, from counts."""

    def __init__(self, counts: np.ndarray, prior: float = 2.0):
        edges, values = counts[:KINDS * 4].reshape(KINDS, 2, 2), counts[KINDS * 4:].reshape(FEATURES, 2)
        # before any count: containers may differ from what holds them, the blocks in them hardly
        before = np.tile(np.array([[0.998, 0.002], [0.05, 0.95]]), (KINDS, 1, 1))
        before[[ROOT, PLAIN, TOP, HEADER, OTHER]] = [[0.8, 0.2], [0.2, 0.8]]
        before[WRAPPER] = [[0.05, 0.95], [0.05, 0.95]]
        before[[BOILERPLATE, HEAD]] = [[0.998, 0.002], [0.9, 0.1]]
        before[MASTHEAD] = [[0.99, 0.01], [0.8, 0.2]]
        before[PHRASE] = [[0.99, 0.01], [0.01, 0.99]]  # a phrase goes with its sentence
        edges = edges + prior * before
        self.edge = (edges / edges.sum(2, keepdims=True)).tolist()
        # features of a node and of its siblings aren't independent: short or unpunctuated text says little
        # against content (articles have many such blocks), and the absence of links little for it
        odds, at = [], 0
        for size, (low, high) in zip(SIZES, (WORDS_RANGE, (-0.1, 2), (-0.1, 2), (-4, 0.3)), strict=True):
            part = values[at:at + size] + 1
            # rare words keep what they say before any count; the other features are smoothed
            part = values[at:at + size] / part.sum(0) + WORDS_BEFORE if at == 0 else 0.9 * part / part.sum(0) + 0.1 / size
            odds.append(np.clip(np.log(part[:, 1] / part[:, 0]), low, high))
            at += size
        self.odds = np.concatenate(odds).tolist()

    def marginals(self, tree: Tree) -> list[float]:
        """P(content) of each node, by messages up and down the tree (as log-odds)."""
        parent, n = tree.parent, len(tree.parent)
        edge = [self.edge[k] for k in tree.kinds()]
        odds = self.odds
        belief = [sum(odds[f] for f in of_node) for of_node in tree.features()]
        sent = [0.0] * n
        for i in range(n - 1, 0, -1):
            (p00, p01), (p10, p11) = edge[i]
            e = math.exp(max(-50.0, min(50.0, belief[i])))
            sent[i] = math.log((p11 * e + p10) / (p01 * e + p00))
            belief[parent[i]] += sent[i]
        total = belief  # the root itself is as likely content as not
        for i in range(1, n):
            (p00, p01), (p10, p11) = edge[i]
            e = math.exp(max(-50.0, min(50.0, total[parent[i]] - sent[i])))
            total[i] += math.log((p11 * e + p01) / (p10 * e + p00))
        return [1 / (1 + math.exp(max(-50.0, min(50.0, -t)))) for t in total]


def train(pages: DataFrame) -> Model:
    """Model from the labelled pages of a column of HTML; one row of fixed size comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(KINDS * 4 + FEATURES * 2)
        for batch in batches:
            for rows in slices(batch):
                for page in texts(rows.column(0)):
                    if "<article" in page or "<main" in page or "<ARTICLE" in page or "<MAIN" in page:
                        found = counted(Tree(page), zlib.crc32(page.encode("utf-8")) % 3)
                        if found is not None:
                            held += found
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([held.tobytes()], pa.binary())],
                                         names=["part", "payload"])

    def add(held: bytes | None, payload: bytes) -> bytes:
        return payload if held is None else (np.frombuffer(held) + np.frombuffer(payload)).tobytes()

    merged = tree_merge(pages.mapInArrow(run, "part int, payload binary"), add).collect()
    return Model(np.frombuffer(merged[0]["payload"]) if merged else np.zeros(KINDS * 4 + FEATURES * 2))


def extract(page: str, model: Model) -> str:
    """Main text of one page."""
    if not page:
        return ""
    tree = Tree(page)
    content = [m >= 0.5 for m in model.marginals(tree)]
    for i, tag in enumerate(tree.tag):  # nothing in the head is shown
        if tag == "head" or i and not content[i] and tree.tag[tree.parent[i]] == "head":
            content[i] = False
    return tree.text(content)


def main_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              model: Model | None = None) -> DataFrame:
    """``(page_id, url, text)`` for every row; the model is trained on the same pages unless one is given."""
    model = model or train(pages.select(html_col))
    known = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                done = [extract(p, known.value) for p in texts(rows.column(2))]
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(done, pa.string())],
                                                 names=["page_id", "url", "text"])

    return (pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), html_col)
            .mapInArrow(run, "page_id long, url string, text string"))
