"""Main text of web pages, by deducing the template that pages of a host share.

Tokens of a page are its elements (paths of tags, ids and classes) and its text
blocks.  Tokens with the same occurrence vector over the distinct pages of a
host (on the same pages, as often on each) form an equivalence class.  A class
is valid if it has an element, at least ``MIN_PAGES`` pages, and nests: its
elements lie in slots of one other class.  The elements of valid classes are the
slots of the host's template, with the prose they hold on a page on average and
the share of their own text that other pages repeat; a text of a valid class is
the template's own.

The article of a page is found from its slots.  From the top, a slot is entered
that holds nearly all of what is prose and not the template's, as long as what
stays outside is little; bare text beside it may be more, and more still if other
pages repeat it.  Names of tags, classes and roles only say which parts are menus,
adverts and the like, and widen the place found to an element called article.
A page without a template is judged by its own prose and names.

Vectors are compared by a hash that is summed up ahead of the shuffle, so a
host with very many pages is no bottleneck.  What is kept of a host is one row.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import broadcast_if_small, fresh, settled
from tallybook.llm.markup import Block, Page, names, parsed, tag_of

MIN_PAGES = 3
PROSE_WORDS = 5  # words of a block that counts as prose
WRAPPERS = frozenset("form dialog menu".split())  # no boilerplate if around most of a page's prose

MOST = 0.6  # share of the prose that a slot must hold to be entered
LITTLE, BARE, REPEATED = 0.1, 0.35, 0.6  # shares that may stay outside: of paragraphs, of bare text, of bare text that other pages repeat
HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
TOKENS = "host string, page bigint, element boolean, token bigint, parent bigint, n bigint, prose bigint"

# Names of parts that are no article.  A step of a path is split at its marks, so "top-menu" has the name "menu".
BOILERPLATE_TAGS = frozenset("nav footer aside form head button dialog menu".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar menu nav "
    "navbar navigation breadcrumb breadcrumbs cookie cookies consent gdpr notice notices notification alert popup modal "
    "overlay subscribe subscription newsletter signup login register search comment comments disqus respond reply "
    "replies discussion share sharing social related recommended recommendations footer toolbar widget "
    "widgets pagination pager hidden contentinfo complementary skip".split()
)
BOILERPLATE_STEMS = tuple("comment advert cookie newsletter breadcrumb sidebar sponsor recommend subscri".split())
HEAD_NAMES = frozenset(["header", "masthead"])
CONTENT_TAGS = ("article", "main")
CONTENT_NAMES = frozenset("article main content post entry story".split())
PROSE_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre td th dd dt".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


OPEN, HEADINGS_ONLY, SHUT = range(3)


def _tells(named: set[str]) -> bool:
    """Whether names are those of a part that is no article."""
    return any(name in BOILERPLATE_NAMES or name.startswith(BOILERPLATE_STEMS) for name in named)


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _is_prose(block: Block) -> bool:
    return block.text.count(" ") + 1 >= PROSE_WORDS


class Layout:
    """A page with what is told by names and by sums over its elements.

    ``tokens`` identify elements by their paths, ``called`` has the element
    that names the article around each (0 if there is none): the first article,
    else the first main part, else the first with a class, id or role of that name.
    """

    def __init__(self, page: Page):
        self.page = page
        self.tags = [tag_of(step) for step in page.steps]
        self.tokens = [0]
        self.called = [0]
        first: list[tuple[int, int, int]] = [(0, 0, 0)]
        for k in range(1, len(page.steps)):
            parent, step, tag = page.parents[k], page.steps[k], self.tags[k]
            self.tokens.append(_hash(f"{self.tokens[parent]}>{step}"))
            article, main, named = first[parent]
            article = article or (k if tag == "article" else 0)
            main = main or (k if tag == "main" else 0)
            named = named or (k if tag not in ("html", "body") and names(step) & CONTENT_NAMES else 0)
            first.append((article, main, named))
            self.called.append(article or main or named)
        self.blocks = page.blocks
        self.text_tokens = [_hash(f"{self.tokens[b.element]}\n{b.text}") for b in page.blocks]
        whole = self.summed(_is_prose)
        self.wrappers = {k for k, tag in enumerate(self.tags) if tag in WRAPPERS and 2 * whole[k] > whole[0]}

    def summed(self, counts) -> list[int]:
        """Characters of the blocks that count, in each element with all it holds."""
        total = [0] * len(self.tags)
        for block in self.blocks:
            if counts(block):
                total[block.element] += len(block.text)
        for k in range(len(total) - 1, 0, -1):  # a parent has the smaller number
            total[self.page.parents[k]] += total[k]
        return total

    def container(self, element: int) -> int:
        """The lowest element around a place that may hold an article, other than a paragraph or a heading."""
        while element and self.tags[element] in PROSE_TAGS:
            element = self.page.parents[element]
        return element

    def below(self, root: int) -> list[bool]:
        """Whether each element is a place or lies in it."""
        inside = [False] * len(self.tags)
        for k in range(len(inside)):
            inside[k] = k == root or (k > 0 and inside[self.page.parents[k]])
        return inside

    def shut(self, roots: list[int]) -> list[int]:
        """Which elements are part of a menu, an advert or the like, given the article's element around each.

        Headings keep their place in the head of an article.  Around the
        article a whole name must match, as a frame may be named "with-sidebar".
        """
        state, outside = [OPEN] * len(self.tags), [OPEN] * len(self.tags)
        for k in range(1, len(self.tags)):
            parent, root = self.page.parents[k], roots[k]
            outside[k] = max(outside[parent], self._own(k, whole_names=True))
            if not root:
                state[k] = max(state[parent], self._own(k, whole_names=False))
            elif k == root:
                state[k] = max(outside[parent], self._own(k, whole_names=False))
            elif roots[parent] == root:
                own = self._own(k, whole_names=False, inside=True)
                state[k] = max(state[parent], own)
            else:  # around the article of a block further down
                state[k] = outside[k]
        return state

    def _own(self, element: int, whole_names: bool, inside: bool = False) -> int:
        tag, step = self.tags[element], self.page.steps[element]
        if tag in BOILERPLATE_TAGS and element not in self.wrappers:
            return SHUT
        named = names(step)
        if tag not in ("html", "body") and _tells(set(re.split(r"[#.\[\]]", step)[1:]) if whole_names else named):
            return SHUT
        if tag == "header" or named & HEAD_NAMES:
            return HEADINGS_ONLY if inside else SHUT
        return OPEN

    def usable(self, block: Block, state: list[int]) -> bool:
        return state[block.element] == OPEN or (state[block.element] == HEADINGS_ONLY and self.tags[block.element] in HEADINGS)


# -- templates -------------------------------------------------------------------


def _page_tokens(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Elements and texts of pages: how often each occurs, and the characters of prose in it."""
    columns = [x.split()[0] for x in TOKENS.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    for batch in batches:
        rows: list[tuple] = []
        for host, key, html in zip(*(batch.column(k).to_pylist() for k in range(3))):
            layout = Layout(parsed(html or "", _tells))
            state = layout.shut([0] * len(layout.tags))
            prose = layout.summed(lambda b: _is_prose(b) and layout.usable(b, state))
            begun = Counter(e for block in layout.blocks for e in block.begun)
            for k, n in begun.items():
                held = prose[k] if layout.tags[k] not in PROSE_TAGS else 0
                rows.append((host, key, True, layout.tokens[k], layout.tokens[layout.page.parents[k]], n, held))
            texts: dict[int, tuple[int, int]] = {}
            for block, token in zip(layout.blocks, layout.text_tokens):
                texts[token] = layout.tokens[block.element], texts.get(token, (0, 0))[1] + 1
            lengths = {token: len(b.text) for b, token in zip(layout.blocks, layout.text_tokens)}
            rows += [(host, key, False, token, parent, n, n * lengths[token]) for token, (parent, n) in texts.items()]
        arrays = zip(*rows) if rows else [[] for _ in columns]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(arrays, kinds)], columns)


def host(url: str = "url"):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def _distinct(pages: DataFrame) -> DataFrame:
    """Hosts with their distinct htmls; only htmls that occur more than once are moved."""
    keyed = pages.select(host().alias("host"), F.xxhash64("html").alias("page"), "html").where("host <> ''")
    repeated = settled(keyed.groupBy("host", "page").count().where("count > 1").select("host", "page"))
    if repeated.isEmpty():
        return keyed
    repeated = broadcast_if_small(repeated)
    copies = keyed.join(repeated, ["host", "page"], "left_semi").groupBy("host", "page").agg(F.max("html").alias("html"))
    return keyed.join(repeated, ["host", "page"], "left_anti").unionByName(copies)


def templates(pages: DataFrame) -> DataFrame:
    """One row per host with a template: host, slots (token, prose, repeated), fixed.

    ``slots`` has the elements of valid classes with the prose they hold on a
    page that has them, and the share of the text right in them that is on
    other pages too; ``fixed`` the text tokens of the template.  Pages without a
    host have no template.  Equal htmls of a host count once.
    """
    tokens = _distinct(pages).mapInArrow(_page_tokens, TOKENS)
    vector = F.bit_xor(F.xxhash64("page", "n")).alias("vector")
    tokens = tokens.groupBy("host", "element", "token", "parent").agg(
        F.count("*").alias("pages"), F.sum("n").alias("n"), F.sum("prose").alias("prose"), vector
    )
    tokens = settled(tokens.where("pages > 1 or not element").withColumn("class", F.xxhash64("pages", "n", "vector")))
    elements = tokens.where(F.col("element") & (F.col("pages") >= MIN_PAGES))
    valid = _nested(elements)
    texts = tokens.where("not element")
    again = texts.groupBy("host", F.col("parent").alias("token")).agg(
        (F.sum(F.when(F.col("pages") > 1, F.col("prose")).otherwise(0)) / F.sum("prose")).alias("repeated")
    )
    slots = elements.join(valid, ["host", "class"], "left_semi").join(again, ["host", "token"], "left")
    slot = F.struct("token", (F.col("prose") / F.col("pages")).cast("bigint").alias("prose"), F.coalesce("repeated", F.lit(0.0)).alias("repeated"))
    slots = slots.groupBy("host").agg(F.sort_array(F.collect_set(slot)).alias("slots"))
    fixed = texts.where(F.col("pages") >= MIN_PAGES).join(valid, ["host", "class"], "left_semi")
    fixed = fixed.groupBy("host").agg(F.sort_array(F.collect_set("token")).alias("fixed"))
    return settled(slots.join(fixed, "host", "left").select("host", "slots", "fixed"))


def _nested(elements: DataFrame) -> DataFrame:
    """Classes (host, class) whose elements lie in slots of one other class, or of none at the top."""
    inner = elements.select("host", "class", "parent")
    outer = elements.select("host", F.col("token").alias("parent"), F.col("class").alias("around"))
    around = inner.join(outer, ["host", "parent"], "left").where("around is null or around <> class")
    around = around.groupBy("host", "class").agg(F.countDistinct(F.coalesce("around", F.lit(0))).alias("n"))
    return settled(around.where("n = 1").select("host", "class"))


# -- extraction ------------------------------------------------------------------


class Template:
    """What is known of a host, for looking up."""

    def __init__(self, slots: Iterable[dict] = (), fixed: Iterable[int] = ()):
        self.slots = {x["token"]: (x["prose"], x["repeated"]) for x in slots}
        self.fixed = frozenset(fixed)


def main_text(html: str | None, template: Template | None = None) -> str:
    """The article of a page, block by block, given what is known of its host's template."""
    layout = Layout(parsed(html or "", _tells))
    if template is not None and template.slots and (chosen := _from_slots(layout, template)):
        return "\n".join(block.text for block in chosen)
    chosen = _by_names(layout) or _by_prose(layout)
    return "\n".join(block.text for block in chosen)


def _from_slots(layout: Layout, template: Template) -> list[Block]:
    """The blocks of the slot that is the article."""
    free = layout.shut([0] * len(layout.tags))
    own = {id(b) for b, token in zip(layout.blocks, layout.text_tokens) if token in template.fixed}
    # An article that all pages share is no template's own; then nothing is.
    if not any(_is_prose(b) and id(b) not in own and layout.usable(b, free) for b in layout.blocks):
        own = set()
    state = layout.shut(layout.called)

    def counts(block: Block) -> bool:
        usable = layout.usable(block, free) or (layout.called[block.element] and layout.usable(block, state))
        return bool(usable) and _is_prose(block) and id(block) not in own

    root, beside = _descent(layout, template, counts)
    if root is None:
        return []
    around = layout.called[root]
    if around and layout.tokens[around] in template.slots:
        root, beside = around, set()  # an element called article is taken whole
    inside = layout.below(root)
    roots = [c or (root if inside[k] else 0) for k, c in enumerate(layout.called)] if root else layout.called
    if root and not around:
        roots = [root if inside[k] else c for k, c in enumerate(layout.called)]
    state = layout.shut(roots)
    ancestors, at = set(), root
    while at:
        at = layout.page.parents[at]
        ancestors.add(at)
    left_out = [False] * len(layout.tags)
    for k in range(1, len(left_out)):
        left_out[k] = k in beside or left_out[layout.page.parents[k]]

    chosen = []
    for block in layout.blocks:
        e = block.element
        if inside[e] and not left_out[e]:
            bare = id(block) in own and not _in_paragraph(layout, e, root)
            if layout.usable(block, state) and not bare:
                chosen.append(block)
        elif layout.tags[e] == "h1" and layout.page.parents[e] in ancestors and id(block) not in own and layout.usable(block, free):
            chosen.append(block)  # the title of the article stands ahead of its slot
    return chosen if any(map(_is_prose, chosen)) or not _by_names(layout) else []


def _in_paragraph(layout: Layout, element: int, root: int) -> bool:
    while element != root and element:
        if layout.tags[element] in PROSE_TAGS:
            return True
        element = layout.page.parents[element]
    return layout.tags[element] in PROSE_TAGS


def _descent(layout: Layout, template: Template, counts) -> tuple[int | None, set[int]]:
    """The slot that holds the article, and the slots right in it that are left out; None without any prose.

    A slot weighs what it holds on the host's pages on average, but for the
    template's own text; an element that is no slot weighs what it holds here.
    """
    here, whole = layout.summed(counts), layout.summed(_is_prose)
    if not here[0]:
        return None, set()
    children: dict[int, list[int]] = {}
    bare = [0] * len(layout.tags)  # text that stands in a container itself
    for block in layout.blocks:
        if counts(block):
            container = layout.container(block.element)
            if container == block.element:
                bare[container] += len(block.text)
    direct = [0] * len(layout.tags)
    for block in layout.blocks:
        if counts(block):
            direct[layout.container(block.element)] += len(block.text)
    for k in range(1, len(layout.tags)):
        if here[k] and layout.tags[k] not in PROSE_TAGS:
            children.setdefault(layout.container(layout.page.parents[k]), []).append(k)

    def weight(k: int) -> float:
        slot = template.slots.get(layout.tokens[k])
        return max(1.0, slot[0] - (whole[k] - here[k])) if slot else here[k]

    def allowed(k: int) -> float:
        """The share that an element beside the article may have."""
        if bare[k] < here[k] or layout.tokens[k] not in template.slots:
            return LITTLE
        return REPEATED if template.slots[layout.tokens[k]][1] >= 0.5 else BARE

    root = 0
    while True:
        inner = children.get(root, [])
        weights = {k: weight(k) for k in inner}
        total = sum(weights.values()) + direct[root]
        if not inner:
            return root, set()
        # What may stay outside goes; what is left must be one slot, to be entered.
        outside = {k for k in inner if weights[k] <= allowed(k) * total}
        kept = [k for k in inner if k not in outside]
        if len(kept) == 1 and direct[root] <= LITTLE * total and weights[kept[0]] >= MOST * (total - sum(weights[k] for k in outside)):
            root = kept[0]
            continue
        return root, {k for k in outside if bare[k] == here[k] and layout.tokens[k] in template.slots}


def _by_names(layout: Layout) -> list[Block]:
    """The blocks of the elements called article, else main, else by a name of that kind."""
    state = layout.shut(layout.called)
    usable = [b for b in layout.blocks if layout.called[b.element] and layout.usable(b, state)]
    for tag in (*CONTENT_TAGS, None):
        if chosen := [b for b in usable if tag is None or layout.tags[layout.called[b.element]] == tag]:
            return chosen
    return []


def _by_prose(layout: Layout) -> list[Block]:
    """The blocks of the lowest element around all prose of a page."""
    state = layout.shut([0] * len(layout.tags))
    left = [b for b in layout.blocks if layout.usable(b, state)]
    mass = layout.summed(lambda b: _is_prose(b) and layout.usable(b, state))
    root = 0
    for k in range(1, len(mass)):  # the parent comes first, so this ends at the lowest
        if mass[k] and mass[k] == mass[0] and layout.tags[k] not in PROSE_TAGS:
            root = k
    inside = layout.below(root)
    return [b for b in left if inside[b.element]]


def _extracted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, Template] = {}
    for batch in batches:
        texts = []
        for k, (name, html) in enumerate(zip(*(batch.column(c).to_pylist() for c in (2, 3)))):
            if name not in known:
                if len(known) > 1000:
                    known.clear()
                known[name] = Template(batch.column(4)[k].as_py() or (), batch.column(5)[k].as_py() or ())
            texts.append(main_text(html, known[name]))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """One row a page: page_id, url, text.

    A NULL or empty html has the empty text; a page whose host has no template
    (NULL url, fewer than ``MIN_PAGES`` pages) is judged by itself.  Repeated
    rows each give a row; other columns are ignored.  Pages are not moved while
    the table of templates is small, by its rows and by the tokens in them.
    """
    hosts = templates(pages)
    hosts = broadcast_if_small(hosts, 20_000, F.size("slots") * 32 + F.coalesce(F.size("fixed"), F.lit(0)) * 8)
    name = fresh(pages, "host")
    rows = pages.select("page_id", "url", host().alias(name), "html").join(hosts.withColumnRenamed("host", name), name, "left")
    return rows.select("page_id", "url", name, "html", "slots", "fixed").mapInArrow(
        _extracted, "page_id bigint, url string, text string"
    )
