"""Main text of web pages by a tree-structured graphical model over the DOM.

A page becomes a tree of its block elements; the text between two block boundaries is a leaf. Every node is content or not.
Node potentials come from tag, class, id and role words, length, punctuation and link share; parent-child potentials
say how labels follow each other down the tree. Sum-product messages, once up and once down, give each node's exact
marginal, and a leaf with a marginal of at least a half is part of the main text.

Both potentials are counted on labelled pages: pages that mark their article (an ``article`` or ``main`` element, or that role)
label themselves, boilerplate elements within excepted. A bounded sample of ``TRAIN_PAGES`` pages, chosen by a hash of
page_id, url and html, is enough for these counts; a table of prior counts covers words that the sample lacks.
"""

from __future__ import annotations

import html as html_lib
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.llm.common import clear_names, table

TRAIN_PAGES = 2000
#: Steps in which the sampled share of pages is cut: fine enough for any number of pages.
_FINE = 1_000_000_000_000_000
PRIOR = 30.0
#: Bounds of a feature's log odds: element names and class words say more than one measure of a text, as these overlap.
CLIP = {"tag": 2.0, "word": 2.0, "words": 1.0, "marks": 1.0, "links": 1.0}
#: Log odds of boilerplate names, which many paragraphs within must not outvote, and of elements that mark an article.
CLAMP, MARKED = -600.0, 20.0

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""",
    re.S,
)
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HINT = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe".split())  # no tags within; without an end tag they run to the page's end
DROPPED = frozenset("noscript template svg select option button object canvas".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav "
    "ol p pre section table ul".split()
)
CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "thead": {"thead", "tbody"},
    "tbody": {"thead", "tbody"},
}
#: Elements that end an open svg, as they can't be in one but for elements that hold HTML.
HTML_IN_SVG = frozenset(("foreignobject", "desc"))
NOT_SVG = ENDS_P | frozenset("b big body br center code dd dt em embed head i img li meta s small span strike strong sub sup tt u var".split())
SCOPES = frozenset("html body table ul ol dl menu article section div aside nav main header footer form td th blockquote".split())

BOILER_TAGS = frozenset("nav header footer aside form menu dialog fieldset head".split())
BOILER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright "
    "dialog disclaimer disqus footer form gdpr header login menu modal nav navbar navigation newsletter notice notification pager "
    "pagination popup promo promotion recommended related replies reply search share sharing sidebar signup skip social sponsor sponsored "
    "subscribe teaser toolbar topbar tracking widget widgets".split()
)
CONTENT_TAGS = frozenset("html body article main p h1 h2 h3 h4 h5 h6 blockquote pre figure".split())
CONTENT_WORDS = frozenset("article articlebody content entry main post prose story text".split())
LAYOUT = frozenset("html body main div section".split())
CONTENT_LEAF = ("words 4", "words 5", "words 6", "marks 1", "marks 2", "marks 3", "links 0")
BOILER_LEAF = ("words 0", "words 1", "marks 0", "links 3", "links 4")


@dataclass
class Node:
    tag: str
    parent: int
    hints: frozenset[str] = frozenset()
    text: list[str] = field(default_factory=list)
    linked: int = 0

    def block(self) -> str:
        return " ".join(html_lib.unescape("".join(self.text)).split())


def parse(page: str) -> list[Node]:
    """The page's block elements and text leaves (tag ``#``), parents before children, in page order.

    Raw and dropped elements (scripts, styles, form controls and the like), comments and declarations leave nothing. Unclosed and
    stray tags are put right in the usual way: a block ends an open paragraph, an item the item before it, an end tag all that
    is open within, dropped elements too. Time grows with the page's length, however broken it is: what is open is looked up by name.
    """
    nodes = [Node("html", -1)]
    stack = [0]
    open_at: dict[str, list[int]] = defaultdict(list)  # places in the stack by name, and of scopes
    scopes: list[int] = []
    leaf, links, at = None, 0, 0
    inline: Counter = Counter()  # inline elements opened since the last block boundary
    hidden: list[str] = []  # an open dropped element and the elements open in it
    in_hidden: Counter = Counter()
    last_end = page.rfind(">")  # no tag is complete behind it

    def add(text: str) -> None:
        nonlocal leaf
        if hidden:
            return
        if leaf is None:
            if not text.strip():
                return
            leaf = len(nodes)
            nodes.append(Node("#", stack[-1]))
        nodes[leaf].text.append(text)
        if links:
            nodes[leaf].linked += len(text)

    def close_from(k: int) -> None:
        while len(stack) > k:
            tag = nodes[stack.pop()].tag
            open_at[tag].pop()
            if tag in SCOPES:
                scopes.pop()

    def shut(names) -> None:
        k = max((open_at[n][-1] for n in names if open_at[n]), default=0)
        if k and k >= (scopes[-1] if scopes else 0):
            close_from(k)

    def hide(tag: str) -> None:
        hidden.append(tag)
        in_hidden[tag] += 1

    def show() -> None:
        hidden.clear()
        in_hidden.clear()

    def next_tag() -> re.Match | None:
        if at <= last_end:
            return _TAG.search(page, at)
        start = page.find("<!--", at)  # only a comment may go on to the page's end
        return _TAG.match(page, start) if start >= 0 else None

    while m := next_tag():
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        name, closing, attrs = name.lower(), m[1] or m[4], m[3] or m[6] or ""
        if hidden:
            if closing:
                if in_hidden[name]:
                    while True:
                        last = hidden.pop()
                        in_hidden[last] -= 1
                        if last == name:
                            break
                    continue
                if not inline[name] and not open_at[name]:
                    continue
                show()  # ends with an element around it
            elif hidden[0] == "option" and name in ("option", "optgroup") or hidden[0] == "svg" and name in NOT_SVG and not any(in_hidden[x] for x in HTML_IN_SVG):
                show()
            elif name not in RAW:
                if name not in VOID and not attrs.endswith("/"):
                    if name in ("option", "optgroup") and hidden[-1] == "option":
                        in_hidden[hidden.pop()] -= 1
                    hide(name)
                continue
        if closing:
            if inline[name]:
                inline[name] -= 1
            if name == "a":
                links = max(0, links - 1)
            elif name not in INLINE and name not in RAW and name not in DROPPED:
                if open_at[name]:
                    close_from(open_at[name][-1])
                leaf, links = None, 0
                inline.clear()
            continue
        if name in DROPPED:
            if leaf is not None:
                add(" ")
            if not attrs.endswith("/"):
                hide(name)
            continue
        if name in RAW:
            if not attrs.endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            if leaf is not None:
                add(" ")
            continue
        if name in INLINE:
            if name not in VOID and not attrs.endswith("/"):
                inline[name] += 1
            if name == "a":
                links += 1
            elif name == "br" and leaf is not None:
                add(" ")
            continue
        leaf, links = None, 0
        inline.clear()
        if name in ENDS_P:
            shut({"p"})
        if name in CLOSES:
            shut(CLOSES[name])
        if name in VOID or name == "html":
            continue
        hints = frozenset(
            w for a in _ATTR.finditer(attrs) for w in _HINT.findall(_CAMEL.sub(" ", a[2] or a[3] or a[4] or "").lower())
        )
        nodes.append(Node(name, stack[-1], hints))
        open_at[name].append(len(stack))
        if name in SCOPES:
            scopes.append(len(stack))
        stack.append(len(nodes) - 1)
    if at < len(page):
        add(page[at:])
    return nodes


def features(node: Node) -> list[str]:
    if node.tag != "#":
        wide = node.tag in ("html", "body", "main", "article")  # what their classes name is the page's layout
        return [f"tag {node.tag}", *[f"word {w}" for w in sorted(node.hints) if not wide]]
    text = node.block()
    words = len(text.split())
    marks = sum(map(text.count, ".,;:!?"))
    size = sum(map(len, node.text)) or 1
    return [
        f"words {min(int(math.log2(words + 1)), 6)}",
        f"marks {min(4, 20 * marks // (words or 1))}",
        f"links {round(4 * min(1, node.linked / size))}",
    ]


def boilerplate(node: Node) -> bool:
    return node.tag in BOILER_TAGS or node.tag not in ("main", "article") and bool(node.hints & BOILER_WORDS)


def labels(nodes: list[Node]) -> list[int] | None:
    """1 for nodes in a marked article, without boilerplate elements within, and for its ancestors; None if none is marked."""
    state = [0] * len(nodes)  # 2: inside
    roots = []
    for i, n in enumerate(nodes[1:], 1):
        if state[n.parent] == 2:
            state[i] = 0 if boilerplate(n) else 2
        elif n.tag in ("article", "main") or "main" in n.hints and n.tag == "div":
            state[i] = 2
            roots.append(i)
    if not roots:
        return None
    for i in roots:
        up = nodes[i].parent
        while up >= 0 and not state[up]:
            state[up], up = 1, nodes[up].parent
    return [min(s, 1) for s in state]


def relation(child: Node, parent: Node) -> int:
    """The kind of parent-child pair: 0 in a layout element, 1 in any other, 2 for a text leaf."""
    return 2 if child.tag == "#" else int(parent.tag not in LAYOUT)


def counts(page: str) -> Counter:
    """(feature, label) counts of a labelled page, parent-child pairs among them.

    What a boilerplate element's name explains is not held against the plain elements within it, nor against its other names.
    """
    nodes = parse(page)
    out: Counter = Counter()
    if (own := labels(nodes)) is None:
        return out
    within = [False] * len(nodes)
    for i, n in enumerate(nodes):
        inside = i > 0 and within[n.parent]
        within[i] = inside or not own[i] and boilerplate(n)
        if n.tag == "#" or not within[i]:
            out.update((f, own[i]) for f in features(n))
        elif not inside:
            out.update((f, 0) for f in features(n) if f.split(" ")[1] in BOILER_TAGS | BOILER_WORDS)
        if i and not inside:
            out[f"pair {relation(n, nodes[n.parent])} {own[n.parent]}", own[i]] += 1
    return out


@dataclass(frozen=True)
class Model:
    """Log odds of content per feature; chances of a child's label by its parent's, for each kind of pair."""

    odds: dict[str, float]
    follows: tuple[tuple[tuple[float, float], tuple[float, float]], ...]

    def node_odds(self, node: Node) -> float:
        return sum(self.odds.get(f, 0.0) for f in features(node))


def fit(counted: Counter) -> Model:
    """Counts plus prior counts, as smoothed log odds relative to each kind of feature, clipped.

    Names in the boilerplate tables are clamped, unless labelled pages have them around their articles more often than not.
    """
    prior: Counter = Counter()
    for kind, names in (("tag", CONTENT_TAGS), ("word", CONTENT_WORDS)):
        prior.update({(f"{kind} {n}", 1): PRIOR for n in names})
    prior.update({(f, 1): PRIOR for f in CONTENT_LEAF} | {(f, 0): PRIOR for f in BOILER_LEAF})
    total = Counter()
    for (f, label), n in counted.items():
        total[f.split(" ")[0], label] += n
    odds = {}
    for f in {f for f, _ in [*counted, *prior] if not f.startswith("pair")}:
        kind = f.split(" ")[0]
        base = (total[kind, 1] + 1) / (total[kind, 0] + 1)
        one, none = (counted[f, x] / (base if x else 1) + prior[f, x] + 1 for x in (1, 0))
        odds[f] = max(-CLIP[kind], min(CLIP[kind], math.log(one / none)))
    for kind, names in (("tag", BOILER_TAGS), ("word", BOILER_WORDS)):
        odds |= {f: CLAMP for n in names if counted[f := f"{kind} {n}", 1] <= counted[f, 0]}
    odds |= {f: MARKED for f in ("tag article", "tag main") if counted[f, 1] >= counted[f, 0]}
    seen = lambda kind, p, c: counted[f"pair {kind} {p}", c] + (8 if p == c else 2 if p else 0.02)
    follows = tuple(
        tuple(tuple(seen(kind, p, c) / (seen(kind, p, 0) + seen(kind, p, 1)) for c in (0, 1)) for p in (0, 1)) for kind in (0, 1, 2)
    )
    return Model(odds, follows)


def marginals(nodes: list[Node], model: Model) -> list[float]:
    """Each node's probability of being content: messages from the leaves up, then from the root down."""
    pair = [model.follows[relation(x, nodes[x.parent])] for x in nodes]
    n = len(nodes)
    own = [1 / (1 + math.exp(-max(CLAMP, min(-CLAMP, model.node_odds(x))))) for x in nodes]
    b0, b1 = [1 - x for x in own], own  # own potential times the messages of the children
    m0, m1 = [1.0] * n, [1.0] * n  # message to the parent
    for i in range(n - 1, 0, -1):
        (p00, p01), (p10, p11) = pair[i]
        u0, u1 = p00 * b0[i] + p01 * b1[i], p10 * b0[i] + p11 * b1[i]
        total = u0 + u1
        m0[i], m1[i] = u0 / total, u1 / total
        p = nodes[i].parent
        x0, x1 = b0[p] * m0[i], b1[p] * m1[i]
        total = x0 + x1
        b0[p], b1[p] = max(x0 / total, 1e-280), max(x1 / total, 1e-280)
    for i in range(1, n):  # parents come first, so b of a parent is its marginal by now
        p = nodes[i].parent
        (p00, p01), (p10, p11) = pair[i]
        q0, q1 = b0[p] / max(m0[i], 1e-280), b1[p] / max(m1[i], 1e-280)
        x0, x1 = b0[i] * (q0 * p00 + q1 * p10), b1[i] * (q0 * p01 + q1 * p11)
        total = x0 + x1
        b0[i], b1[i] = max(x0 / total, 1e-280), max(x1 / total, 1e-280)
    return b1


def main_text(page: str | None, model: Model) -> str:
    """The blocks of the main text, one per line. Null, empty and unmarked pages are parsed like any other."""
    nodes = parse(page or "")
    if len(nodes) == 1:
        return ""
    content = marginals(nodes, model)
    blocks = (n.block() for n, c in zip(nodes, content, strict=True) if n.tag == "#" and c >= 0.5)
    return "\n".join(b for b in blocks if b)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total: Counter = Counter()
        for page in batch.column("html"):
            total.update(counts(page.as_py() or ""))
        rows = [(f, label, n) for (f, label), n in total.items()]
        cols = list(zip(*rows, strict=True)) if rows else [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64())], names=["f", "label", "n"])


def train(pages: DataFrame, sample: int = TRAIN_PAGES, key: tuple[str, ...] = ("page_id", "url", "html")) -> Model:
    """A model from about ``sample`` of the pages (at most twice as many), or all if there are fewer.

    The same pages give the same sample. Without any labelled page only the prior counts speak.
    """
    share = min(1.0, sample / max(pages.count(), 1))
    place = F.pmod(F.xxhash64(*key), F.lit(_FINE))
    chosen = pages.select("html", place.alias("_place")).where(F.col("_place") < int(share * _FINE)).orderBy("_place").limit(2 * sample).select("html")
    rows = chosen.mapInArrow(_counted, "f string, label int, n long").groupBy("f", "label").agg(F.sum("n").alias("n")).collect()
    return fit(Counter({(r["f"], r["label"]): r["n"] for r in rows}))


def extract(pages: DataFrame, model: Model, html: str = "html") -> DataFrame:
    """``pages`` with ``text`` (the main text, empty if there is none) and ``n_chars`` (its code points).

    Null and empty html give an empty text. Rows are extracted one by one, so repeated rows get equal texts; columns of
    ``pages`` named like an added one are kept as ``in_<name>``.
    """
    pages = clear_names(pages, ("text", "n_chars"))
    shared = pages.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(T.StringType())
    def text(html: pa.Array) -> pa.Array:
        model = shared.value
        return pa.array([main_text(x.as_py(), model) for x in html], pa.string())

    return pages.withColumn("text", text(F.col(html))).withColumn("n_chars", F.length("text").cast("long"))


def op6_tree_model(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages, train(pages)).select("page_id", "url", "text", "n_chars")


#: On pages that all mark their article, the model's text is that of the article's blocks.
OP6_SQL = """
WITH a AS (SELECT page_id, url, coalesce(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '') AS body FROM pages),
b AS (SELECT page_id, url, unnest(string_split(regexp_replace(body, '</?(h1|p|article)>', chr(1), 'g'), chr(1))) AS raw,
             generate_subscripts(string_split(regexp_replace(body, '</?(h1|p|article)>', chr(1), 'g'), chr(1)), 1) AS i FROM a),
c AS (SELECT page_id, url, i, trim(regexp_replace(replace(regexp_replace(replace(replace(regexp_replace(regexp_replace(
             regexp_replace(raw, '<[^>]*>', ' ', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;', '"'), '&#x27;', ''''), '&amp;?', '&', 'g'), '&middot;', '·'),
             '\\s+', ' ', 'g')) AS t FROM b),
d AS (SELECT page_id, url, coalesce(string_agg(t, chr(10) ORDER BY i) FILTER (t <> ''), '') AS text FROM c GROUP BY page_id, url)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM d
"""
