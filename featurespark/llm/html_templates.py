"""Main text of web pages: what is left when a site's template is removed.

Every element's subtree gets a digest of its tags and text. Spark counts on how many different
pages of a host each digest occurs; subtrees that recur on many of them are template and deleted.
What elements say of themselves (``nav``, ``footer``, ``class="ad"``) removes the boilerplate that
varies from page to page, and a page that marks its article or main part keeps that part alone.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurespark.llm.common import slices, text_or_empty
from featurespark.session import materialize

# A subtree is template when it is on so many different pages of its host, and on this share.
LEAST_PAGES = 5
LEAST_SHARE = 0.05
# On so many pages it is template whatever the share, so that large hosts keep no more of it.
MANY_PAGES = 100
ROWS_AT_ONCE = 128

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']+|\"[^\"]*\"|'[^']*')*+>|[^>]*>?)",
    re.DOTALL,
)
LABEL = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:$|[\s=/>])", re.IGNORECASE)
NAME = re.compile(r"[a-z]+")

# Names of HTML elements and of the parts that pages mark.
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# What holds one of these inside the main part is part of the text.
PROSE = HEADINGS | {"p", "blockquote", "pre", "table"}
RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby"
    " s samp small span strike strong sub sup time tt u var wbr img".split()
)
# Elements without a place on the page: text goes on around them.
UNSEEN = {"script", "style", "template", "noscript", "meta", "link"}
DROPPED = RAW | set(
    "aside button canvas dialog footer form head menu nav noscript object select svg template".split()
)
MAIN = {"article", "main"}
# Flow text: never template inside the main part, as an article may quote what others say.
FLOW = INLINE | set(
    "p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table thead tbody tfoot tr td th caption"
    " figure figcaption br hr".split()
)
# Never the text of a page, and what may be its only text after all.
FOREIGN = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored sidebar cookie cookies consent"
    " gdpr notice notices comment comments replies respond disqus".split()
)
BOILERPLATE = FOREIGN | set(
    "banner promo promotion nav navbar navigation menu breadcrumb breadcrumbs complementary footer"
    " contentinfo masthead popup modal alert newsletter subscribe related share sharing social widget"
    " toolbar pagination pager login signup search".split()
)
# Words that are written together with one of these: ``commentlist``, ``sitefooter``.
BEFORE = "top bottom left right main site page post user side".split()
BEHIND = (
    "list area box bar section wrap wrapper container form links item items block slot thread entry"
    " banner menu".split()
)
JOINED = {joined: name for name in BOILERPLATE for joined in [*(b + name for b in BEFORE), *(name + b for b in BEHIND)]}
# What follows in a class or id tells of another element: ``has-sidebar``, ``no-comments``.
ABOUT = {"has", "no", "with", "without"}
# An open element that ends when one of these starts.
ENDED_BY = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr"},
    "td": {"td", "th", "tr"},
    "th": {"td", "th", "tr"},
    "option": {"option"},
}
ROOTS = {"html", "body"}


class Page:
    """A page's elements in document order, and its text in pieces."""

    def __init__(self, source: str):
        self.tag, self.parent = ["html"], [-1]
        self.boilerplate, self.main = [False], [False]
        # Elements that only their class, id or role calls boilerplate, and whether it is foreign.
        self.labelled: dict[int, bool] = {}
        self.prose = [False]
        self.digest: list[int] = [0]
        self.size = [0]
        # (element, text), or (element, None) where a block starts or ends.
        self.pieces: list[tuple[int, str | None]] = []
        self.parts: list[list[bytes]] = [[]]
        self._read(source)
        self._judge()

    def _open(self, parent: int, tag: str, attributes: str) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.main.append(self.main[parent] or tag in MAIN)
        self.boilerplate.append(self.boilerplate[parent] or self._marked(parent, tag, attributes))
        if not self.boilerplate[-1] and (names := self._called(parent, tag, attributes)):
            self.labelled[len(self.tag) - 1] = not FOREIGN.isdisjoint(names)
        self.prose.append(tag in PROSE)
        self.digest.append(0)
        self.size.append(0)
        self.parts.append([tag.encode(), b" "])
        return len(self.tag) - 1

    def _marked(self, parent: int, tag: str, attributes: str) -> bool:
        if tag in DROPPED or tag == "header" and not self.main[parent]:
            return True
        return tag not in ROOTS and bool(attributes.strip("/> ")) and bool(HIDDEN.search(attributes))

    def _called(self, parent: int, tag: str, attributes: str) -> set[str]:
        """The names of boilerplate that an element gives itself."""
        if tag in ROOTS or tag in MAIN and not self.main[parent] or not attributes.strip("/> "):
            return set()
        called = set()
        for found in LABEL.finditer(attributes):
            is_place = self.main[parent] and found[1].lower() == "id"
            if is_place and tag in HEADINGS:
                continue
            for label in "".join(found.groups("")[1:]).lower().split():
                names = [JOINED.get(n, n) for n in NAME.findall(label)]
                if is_place and tag == "section" and not BOILERPLATE.issuperset(names):
                    continue  # a heading's anchor: ``related-work``
                for name in names:
                    if name in ABOUT:
                        break
                    if name in BOILERPLATE:
                        called.add(name)
        return called

    def _judge(self) -> None:
        """Drop labelled elements but those around a main part.

        Where that leaves no text, the largest one stays whose label does not tell of foreign text.
        """
        if not self.labelled:
            return
        marked, foreign = self.boilerplate, [False] * len(self.tag)
        for i in range(1, len(self.tag)):
            foreign[i] = foreign[self.parent[i]] or self.labelled.get(i, False)
        # An article inside another one is a comment on it, and so is one inside the comments.
        mains = [i for i, t in enumerate(self.tag) if t in MAIN and not self.main[self.parent[i]] and not marked[i]]
        around = set()
        for i in [i for i in mains if not foreign[i]] or mains:
            up = self.parent[i]
            while up > 0 and up not in around:
                around.add(up)
                up = self.parent[up]

        def without(dropped: set[int]) -> list[bool]:
            gone = list(marked)
            for i in range(1, len(self.tag)):
                gone[i] = gone[i] or i in dropped or gone[self.parent[i]]
            return gone

        dropped = {i for i in self.labelled if i not in around}
        self.boilerplate = without(dropped)
        if not any(t and not t.isspace() and not self.boilerplate[i] for i, t in self.pieces):
            able = [i for i in dropped if not foreign[i] and self.size[i]]
            if able:
                self.boilerplate = without(dropped - {max(able, key=lambda i: (self.size[i], -i))})

    def _close(self, node: int) -> None:
        self.digest[node] = xxhash.xxh64_intdigest(b"".join(self.parts[node])) - (1 << 63)
        up = self.parent[node]
        self.parts[up].append(b"<%d>" % self.digest[node])
        self.parts[node] = []
        self.size[up] += self.size[node]
        self.prose[up] = self.prose[up] or self.prose[node]

    def _text(self, node: int, text: str) -> None:
        if "&" in text:
            text = html.unescape(text)
        words = " ".join(text.split())
        self.pieces.append((node, text))
        if words:
            self.parts[node].append(words.encode("utf-8", "surrogatepass"))
            self.size[node] += len(words)

    def _read(self, source: str) -> None:
        open_nodes, place, lower = [0], 0, ""

        def close_to(depth: int) -> None:
            while len(open_nodes) > depth:
                self._close(open_nodes.pop())

        for found in iter(lambda: TOKEN.search(source, place), None):
            start, end = found.span()
            if start > place:
                self._text(open_nodes[-1], source[place:start])
            place = end
            if found[2] is None:
                continue
            tag = found[2].lower()
            if tag not in INLINE and tag not in UNSEEN:
                self.pieces.append((open_nodes[-1], None))
            if found[1]:
                for depth in range(len(open_nodes) - 1, 0, -1):
                    name = self.tag[open_nodes[depth]]
                    if name == tag:
                        close_to(depth)
                        break
                    if tag in INLINE and name not in INLINE:
                        break
                continue
            if tag in ROOTS:
                continue
            if tag not in INLINE and tag not in UNSEEN:
                for depth in range(len(open_nodes) - 1, 0, -1):
                    name = self.tag[open_nodes[depth]]
                    if name == "p" and tag not in VOID - {"hr"} or tag in ENDED_BY.get(name, ()):
                        close_to(depth)
                        break
                    if name not in INLINE and name not in ENDED_BY:
                        break
            node = self._open(open_nodes[-1], tag, found[3])
            if tag in VOID:
                self._close(node)
            elif tag in RAW:
                lower = lower or source.lower()
                at = lower.find(f"</{tag}", place)
                place = len(source) if at < 0 or len(lower) != len(source) else at
                if at >= 0 and len(lower) != len(source):
                    # Lower-casing changed the length: look in the source itself.
                    tail = re.compile(f"</{tag}", re.IGNORECASE).search(source, end)
                    place = tail.start() if tail else len(source)
                self.parts[node].append(source[end:place].encode("utf-8", "surrogatepass"))
                open_nodes.append(node)
            else:
                open_nodes.append(node)
        if place < len(source):
            self._text(open_nodes[-1], source[place:])
        close_to(1)

    def _can_recur(self, node: int) -> bool:
        """Whether a subtree may be template: not the main part, nor text of it."""
        if not self.size[node] or self.tag[node] in MAIN:
            return False
        return not (self.main[node] and (self.tag[node] in FLOW or self.prose[node]))

    def candidates(self) -> set[int]:
        """Digests of the subtrees that may be template."""
        return {self.digest[i] for i in range(1, len(self.tag)) if self._can_recur(i)}

    def text(self, templates: set[int]) -> str:
        """The words of the main part without boilerplate and ``templates``, joined by blanks.

        Where templates are all of a page, those that hold most of it are its text, or else all.
        """
        for share in (1.0, 0.5, 0.0):
            template = [False] * len(self.tag)
            for i in range(1, len(self.tag)):
                template[i] = template[self.parent[i]] or (
                    self.digest[i] in templates and self.size[i] <= share * self.size[0] and self._can_recur(i)
                )
            kept = [not b and not t for b, t in zip(self.boilerplate, template, strict=True)]
            if any(k and m and s for k, m, s in zip(kept, self.main, self.size, strict=True)):
                kept = [k and m for k, m in zip(kept, self.main, strict=True)]
            words = " ".join("".join(" " if t is None else t for i, t in self.pieces if kept[i]).split())
            if words or not templates:
                break
        return words


def host_of(url: str) -> Column:
    """The host of a URL in lower case; empty where there is none."""
    host = F.regexp_extract(F.col(url).cast("string"), "^[a-zA-Z][^:/?#]*://([^/?#]*)", 1)
    return F.lower(F.coalesce(host, F.lit("")))


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, ROWS_AT_ONCE):
        digests = [sorted(Page(source.as_py()).candidates()) for source in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("host"), pa.array(digests, pa.list_(pa.int64()))],
            ["key", "host", "digests"],
        )


def site_templates(
    pages: DataFrame,
    least_pages: int = LEAST_PAGES,
    least_share: float = LEAST_SHARE,
    many_pages: int = MANY_PAGES,
) -> DataFrame:
    """``key, templates``: the recurring subtrees of every page ``(key, host, html)`` with any.

    Equal pages of a host count once. A digest is counted where it occurs, map-side first, so a
    large host's common menu is no hot key; rows that join to a common digest can be split.
    """
    found = pages.mapInArrow(_subtrees, "key string, host string, digests array<long>")
    found = materialize(found.dropDuplicates(["key"]), "subtrees")
    each = found.select("key", "host", F.explode("digests").alias("digest"))
    sizes = found.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    recurring = (
        each.groupBy("host", "digest")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= least_pages)
        .join(sizes, "host")
        .where(F.col("n") >= F.least(F.col("pages") * least_share, F.lit(float(many_pages))))
        .select("host", "digest")
    )
    known = materialize(recurring, "templates")
    return each.join(known, ["host", "digest"]).groupBy("key").agg(
        F.collect_set("digest").alias("templates")
    )


def extract_main_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_pages: int = LEAST_PAGES,
    least_share: float = LEAST_SHARE,
) -> DataFrame:
    """``id_col, url_col, text, n_chars`` for every row of ``pages``.

    Character references are decoded; white space becomes one blank; blocks are joined by one
    blank in page order. Inside the main part, flow text (paragraphs, headings, lists, tables) and
    what holds it is never taken for template. Null html counts as empty and gives the empty text; pages with a null URL form a host of their own. Repeated rows
    give a row each, an empty table none. Other columns are ignored.
    """
    # Keys of equal pages of a host are equal: what is template on one is on the other.
    whole = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).alias("url"),
        host_of(url_col).alias("host"),
        text_or_empty(html_col).alias("html"),
    ).withColumn("key", F.md5(F.concat("host", F.lit("\n"), "html").cast("binary")))
    templates = site_templates(whole.select("key", "host", "html"), least_pages, least_share)
    # Written, so that rows of a page with very many copies can be split in the join.
    templates = materialize(templates, "page-templates")
    joined = whole.join(templates, "key", "left").select("id", "url", "html", "templates")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS_AT_ONCE):
            texts = [
                Page(source.as_py()).text(set(digests.as_py() or ()))
                for source, digests in zip(batch.column(2), batch.column(3), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["id", "url", "text", "n_chars"],
            )

    kinds = {c: pages.schema[c].dataType.simpleString() for c in (id_col, url_col)}
    schema = f"id {kinds[id_col]}, url {kinds[url_col]}, text string, n_chars long"
    return joined.mapInArrow(extract, schema).select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars"
    )
