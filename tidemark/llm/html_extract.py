"""Main text of web pages by a site style tree.

Pages of one host are merged: elements with the same path of tags and classes
are one node of the host's tree. A node's presentations are the child sequences
it has on pages, its contents the texts it holds. A presentation or content
that is spread evenly over all pages is template; the more varied, the more
important. As in the published method, importance is the entropy of presentations
for inner nodes, mixed with that of their children, and one minus the mean
entropy of contents for text. Branches below ``least`` are removed, as are
branches that their tag, role or class names as menu, header, footer, sidebar,
notice, advert, form, script or reader comment. If a page marks its article, only
that is read, and its unmarked text elements always stay.

Per block of text, character references are decoded and white space becomes one
space; blocks are joined by two line breaks in page order. Nothing is cut. Null
and empty html give the empty text. A host with one page has no template: all
its nodes count as important. Pages without a host form one. Repeated page ids
are extracted each; malformed html is read as far as tags can be matched.
Extra columns are not read. An empty table gives none.

The tree is counts by host, node and content hash, summed per task before they
are shuffled; a page is joined only with its host's list of removed nodes, which
holds no content, so a hot host is split like any other rows.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, arrow_chunks, arrow_rows, join_checked

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "noscript", "template", "textarea", "iframe", "xmp", "noembed", "noframes")
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike "
                   "strong sub sup time tt u var wbr br img".split())
# Start tags that end an open paragraph, and elements that end another of their kind.
ENDS_P = frozenset("address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                   "header hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
            "option": ("option",)}
NOISE_TAGS = frozenset("head title nav footer aside form script style noscript template iframe object svg canvas button select option "
                       "dialog menu textarea label fieldset header".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
NOISE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|adsense|sponsor(?:ed|s)?|promo(?:tion)?s?|banner|cookies?|consent|gdpr|notices?|"
    r"alert|popup|modal|overlay|newsletter|subscribe|signup|login|nav|navbar|navigation|menus?|breadcrumbs?|sidebar|side|rail|footer|"
    r"masthead|comments?|commentlist|disqus|reply|replies|respond|share|sharing|social|related|recommended|toolbar|pagination|pager|"
    r"widgets?|skip|hidden|header)(?:$|[\s_-])", re.I)
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
SPACE = re.compile(r"\s+")


def _hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


class Page:
    """Blocks of text and style-tree nodes of one page."""

    __slots__ = ("blocks", "children", "has_article")

    def __init__(self, source: str):
        # (path, noise, in article, plain element of the article, text); path -> child labels in order.
        self.blocks: list[tuple[str, bool, bool, bool, str]] = []
        self.children: dict[str, list[str]] = {}
        self.has_article = False
        self._read(source)

    def _read(self, source: str) -> None:
        # Open elements: tag, path, noise, in article, plain inside the article.
        stack = [("", "", False, False, False)]
        words: list[str] = []
        at, end = 0, len(source)

        def flush():
            text = SPACE.sub(" ", entities.unescape("".join(words))).strip()
            words.clear()
            if text:
                depth = len(stack) - 1
                while depth and stack[depth][0] in INLINE:
                    depth -= 1
                _, path, noise, article, plain = stack[depth]
                self.blocks.append((path, noise or stack[-1][2], article, plain, text))

        def close(tag):
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    del stack[depth:]
                    return

        while at < end:
            found = TOKEN.search(source, at)
            if not found:
                words.append(source[at:])
                break
            words.append(source[at : found.start()])
            at = found.end()
            tag = (found[2] or "").lower()
            if not tag:
                if found[0].startswith("<![CDATA["):
                    words.append(found[0][9:].removesuffix("]]>").replace("&", "&amp;"))
                continue
            if not found[0].endswith(">"):
                break  # a tag that the page's end cuts off
            if tag == "br":
                words.append(" ")
                continue
            if tag not in INLINE:
                flush()
            if found[1]:
                close(tag)
                continue
            if tag in ENDS_P and any(s[0] == "p" for s in stack):
                close("p")
            for sibling in SIBLINGS.get(tag, ()):
                if stack[-1][0] == sibling or stack[-1][0] in INLINE and len(stack) > 2 and stack[-2][0] == sibling:
                    close(sibling)
            _, path, noise, article, plain = stack[-1]
            label, marked, named, role = tag, False, False, ""
            if found[3] and "=" in found[3] or " hidden" in found[3]:
                given = {a[0].lower(): a[1] or a[2] or a[3] for a in ATTRIBUTE.findall(found[3])}
                role = given.get("role", "").lower()
                names = f"{given.get('class', '')} {given.get('id', '')}"
                if given.get("class") or role:
                    label = f"{tag}.{given.get('class', '').strip()}.{role}"
                marked = bool(names.strip() or role)
                hit = NOISE_NAMES.search(names) if marked and tag not in ("html", "body", "article", "main") or tag == "article" and article else None
                named = bool(hit) and not (article and "header" in hit[0].lower())
                named |= "hidden" in given or given.get("aria-hidden") == "true" or bool(re.search(r"display\s*:\s*none", given.get("style", ""), re.I))
            begins = tag == "article" or tag == "main" or role in ("main", "article")
            noise = noise or named or role in NOISE_ROLES or tag in NOISE_TAGS and not (tag == "header" and article)
            article = article or begins and not noise
            self.has_article |= article
            self.children.setdefault(path, []).append(label)
            inner = f"{path}>{label}"
            if tag in RAW:
                stop = re.compile(rf"</{tag}\s*>?", re.I).search(source, at)
                at = stop.end() if stop else end
                self.children.setdefault(inner, [])
                continue
            if tag not in VOID and not found[0].endswith("/>"):
                self.children.setdefault(inner, [])
                stack.append((tag, inner, noise, article, article and not marked and (plain or begins)))
            elif tag == "hr":
                words.append(" ")
        flush()

    def text(self, removed: frozenset[int] | set[int]) -> str:
        kept = []
        for path, noise, article, plain, text in self.blocks:
            if noise or self.has_article and not article:
                continue
            if removed and not (article and plain) and any(_hash(p) in removed for p in _branches(path)):
                continue
            kept.append(text)
        return "\n\n".join(kept)


def _branches(path: str) -> list[str]:
    parts = path.split(">")
    return [">".join(parts[: i + 1]) for i in range(1, len(parts))]


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1))


def _nodes(pages: DataFrame) -> DataFrame:
    """(host, path, parent, kind, item, pages): how many pages of a host show an item at a node."""
    import pyarrow as pa

    fields = [("host", pa.string()), ("path", pa.int64()), ("parent", pa.int64()), ("kind", pa.int32()), ("item", pa.int64()), ("pages", pa.int64())]
    schema = pa.schema(fields)

    def count(batches: Iterator) -> Iterator:
        def rows():
            seen: Counter = Counter()
            for host, source in arrow_rows(batches, ["host", "html"]):
                page, items = Page(source or ""), set()
                for path, labels in page.children.items():
                    # Runs of equal children are one style: how many paragraphs there are is no presentation.
                    style = " ".join(b for a, b in zip([None, *labels], labels, strict=False) if a != b)
                    items.add((path, 0, _hash(style)))
                items.update((path, 1, _hash(text)) for path, _, _, _, text in page.blocks)
                for path, kind, item in items:
                    seen[(host, _hash(path), _hash(path.rpartition(">")[0]), kind, item)] += 1
                if len(seen) > 200_000:
                    yield from ((*k, n) for k, n in seen.items())
                    seen.clear()
            yield from ((*k, n) for k, n in seen.items())

        yield from arrow_chunks(rows(), schema, 20_000)

    parts = pages.mapInArrow(count, "host string, path long, parent long, kind int, item long, pages long")
    return parts.groupBy("host", "path", "parent", "kind", "item").agg(F.sum("pages").alias("pages"))


def node_importance(pages: DataFrame, scratch: Scratch, damping: float = 0.9) -> DataFrame:
    """(host, path, importance) of every node of every host's style tree. ``pages``: host, html."""
    items = scratch.put(_nodes(pages), "nodes")
    # Each page shows one presentation of each of its nodes, so presentations add up to the pages of a node.
    m = items.where("kind = 0").groupBy("host", "path").agg(F.sum("pages").alias("m"))
    joined = items.join(m, ["host", "path"])
    share = F.col("pages") / F.col("m")
    base = F.log(F.greatest(F.col("m"), F.lit(2)).cast("double"))
    style, text = F.col("kind") == 0, F.col("kind") == 1
    own = joined.groupBy("host", "path", "parent").agg(
        F.max("m").alias("m"), F.sum(F.when(style, -share * F.log(share) / base)).alias("style"),
        F.count(F.when(style, 1)).alias("styles"),
        F.avg(F.when(text, 1 - F.least(F.log(F.col("pages").cast("double")) / base, F.lit(1.0)))).alias("text"),
    )

    def combine(pdf):
        """Bottom-up over one host's tree, which has no content and one row per node."""
        import pandas as pd

        below: dict[int, list[int]] = {}
        rows = {r.path: r for r in pdf.itertuples()}
        for r in rows.values():
            if r.parent != r.path:
                below.setdefault(r.parent, []).append(r.path)
        found: dict[int, float] = {}
        todo = [p for p, r in rows.items() if r.parent not in rows or r.parent == p]
        order = []
        while todo:
            p = todo.pop()
            order.append(p)
            todo.extend(below.get(p, ()))
        for p in reversed(order):
            r = rows[p]
            parts = [found[c] for c in below.get(p, ())] + ([] if pd.isna(r.text) else [r.text])
            held = damping ** r.styles
            inner = sum(parts) / len(parts) if parts else 1.0
            found[p] = 1.0 if r.m <= 1 else max((1 - held) * (r.style or 0.0) + held * inner, 0.0 if pd.isna(r.text) else r.text)
        return pd.DataFrame({"host": pdf.host.iloc[0], "path": list(found), "importance": list(found.values())})

    return own.groupBy("host").applyInPandas(combine, "host string, path long, importance double")


def extract(pages: DataFrame, least: float = 0.1, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """page_id, url, text, n_chars; one row per page."""
    import pyarrow as pa

    scratch = Scratch(pages.sparkSession, "html")
    rows = pages.select(
        F.col(id_column).cast("long").alias("page_id"), F.col(url_column).alias("url"), F.col(html_column).alias("html"),
        host_of(F.col(url_column)).alias("host"),
    )
    low = node_importance(rows.select("host", "html"), scratch).where(F.col("importance") < least)
    removed = scratch.put(low.groupBy("host").agg(F.collect_set("path").alias("removed")), "removed")
    joined = join_checked(rows, removed, "host", "left", most=20_000)
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator) -> Iterator:
        def out():
            for page_id, url, source, gone in arrow_rows(batches, ["page_id", "url", "html", "removed"]):
                text = Page(source or "").text(frozenset(gone or ()))
                yield page_id, url, text, len(text)

        yield from arrow_chunks(out(), schema, 1000)

    return joined.select("page_id", "url", "html", "removed").mapInArrow(run, "page_id long, url string, text string, n_chars long")
