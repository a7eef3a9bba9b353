"""Main text of web pages by wrappers: union-free regular expressions over tag tokens (after Crescenzi, Mecca, Merialdo, 2001).

The wrapper of a host starts as one page and is generalised page by page: equal tags match, differing texts become slots, and a mismatch of tags is
resolved by a repeated group (the tags before it are one more round of the same group) or by an optional group (a side skips to
the other's next tag). A page is then read by its host's wrapper: a text that all sampled pages have in one slot is the template's (a menu, a notice, a
footer, whatever its elements are named) and is left out, if nearly all of the host's pages have it; the texts that differ are content. Of the content, what lies in
elements that HTML or a usual class name marks as navigation, header, footer, sidebar, notice, advert, form or comments is left out too, for it may differ from page to page.
A page that its wrapper doesn't cover is read by the wrapper generalised to it, or else by itself.

Nodes of a wrapper: tags are strings, [TEXT, constant or None], [MANY, nodes], [MAYBE, nodes].
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import tidy, written

TEXT, MANY, MAYBE = "x", "r", "o"
#: pages of a host that its wrapper is made from, at most
SAMPLE = 8
#: share of all pages of a host that must have a constant text of its wrapper before that is dropped as the template's
SHARED = 0.9
#: bytes of wrappers up to which they are broadcast; beyond, they are joined
BROADCAST = 16 << 20
#: how far, in tokens, a side may skip to the other's next tag, and how deep groups nest; a page that needs more isn't covered and is read by itself
REACH, DEPTH = 400, 3
#: share of all text of a host's sampled pages that must differ, or they are copies of one another
ALIKE = 0.2

# attributes of a tag. A value ends with a quote that white space, a slash or the tag's end follows and that does not open another value; a quote without such an end
# is one nobody closed, and the tag ends at the next ">"
_ATTRS = r"(?:[^>\"']|\"[^\"]*(?<!=)\"(?=[\s/>]|$)|\"\"|'[^']*(?<!=)'(?=[\s/>]|$)|''|[\"'])*"
_LEX = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    rf"|<(script|style|noscript|template|svg|math|textarea|iframe|object|select|title)\b{_ATTRS}>.*?(?:</\1\s*>|$)"
    rf"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)({_ATTRS})(?:>|$)",
    re.S | re.I,
)
_ATTR = re.compile(r"""\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
VOID = {"br", "hr", "img", "input", "meta", "link", "wbr", "area", "base", "col", "embed", "source", "track"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img", "br"}
OUTSIDE = {"nav", "header", "footer", "aside", "form", "button", "head", "dialog", "menu", "input", "fieldset"}
#: text beside an article and inside the main part, in lengths of the article, from which on the article is not the page's own
TEASER = 3
_BAD = re.compile(r"^(?:nav(?:bar|igation)?|menu|side-?bar|footer|header|masthead|ads?|advert\w*|banner|promo\w*|sponsor\w*|cookies?|consent|gdpr|notices?|popup|modal|overlay|comments?|disqus|repl(?:y|ies)|respond|shar(?:e|ing)|social|related|recommend\w*|breadcrumbs?|newsletter|subscri\w+|signup|login|search|widget|toolbar|pagination|pager|skip|hidden|sr-only|complementary|contentinfo|alert)$")
#: compound class names are judged by their last word, if that is a part of a page's layout: related-work or search-history are ordinary sections
_PART = re.compile(r"[-_](?:nav(?:bar|igation)?|menu|sidebar|footer|header|masthead|banner|breadcrumbs?|ads?|comments?|popup|modal|newsletter)$")
_GOOD = re.compile(r"^(?:article|content|main|post|entry|story|body)$")
#: an element that closes the open one of the same kind
RESTART = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}
_ENDS_P = {"p", "div", "ul", "ol", "table", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article", "aside", "header", "footer", "nav", "form", "blockquote", "pre", "main", "figure", "dl", "hr", "fieldset"}


def tokens(page: str) -> list:
    """Tags as ``<name.class#id`` or ``</name``, texts as [decoded text]."""
    out: list = []
    at = 0

    def text(raw: str) -> None:
        if raw and not raw.isspace():
            out.append([html.unescape(raw) if "&" in raw else raw])
        elif raw and out and isinstance(out[-1], list):
            out[-1][0] += " "

    for m in _LEX.finditer(page):
        if m.start() > at:
            text(page[at : m.start()])
        at = m.end()
        name = m[3]
        if not name:
            if page.startswith("<![CDATA[", m.start()):
                text(html.escape(page[m.start() + 9 : m.end()].removesuffix("]]>")))
            continue
        name = name.lower()
        if m[2]:
            out.append("</" + name)
            continue
        tag = "<" + name
        if m[4]:
            for a in _ATTR.finditer(m[4]):
                kind, value = a[1].lower(), (a[2] or "").strip("\"'").lower()
                if kind in ("hidden", "aria-hidden"):
                    tag += ".hidden" if kind == "hidden" or value == "true" else ""
                else:
                    tag += "".join("." + re.sub(r"\d+", "0", w) for w in value.split())
        out.append(tag)
    if at < len(page):
        text(page[at:])
    return out


def read(nodes: list, page: list, j: int, seen: list | None = None, where: tuple = ()) -> int:
    """The place in page after nodes are matched from j on, -1 if they don't. seen gets (place of a text, path of its slot)."""
    n = len(page)
    for k, node in enumerate(nodes):
        if isinstance(node, str):
            if j < n and page[j] == node:
                j += 1
            else:
                return -1
        elif node[0] == TEXT:
            if j < n and isinstance(page[j], list):
                if seen is not None:
                    seen.append((j, (*where, k)))
                j += 1
        else:
            rounds = 0
            while j < n:
                mark = len(seen) if seen is not None else 0
                to = read(node[1], page, j, seen, (*where, k))
                if to <= j:
                    if seen is not None:
                        del seen[mark:]
                    break
                j, rounds = to, rounds + 1
                if node[0] == MAYBE:
                    break
            if node[0] == MANY and not rounds:
                return -1
    return j


def _as_nodes(page: list) -> list:
    return [t if isinstance(t, str) else [TEXT, t[0]] for t in page]


def align(nodes: list, page: list, depth: int = 0) -> list | None:
    """The wrapper generalised to cover page as well, None if it can't be."""
    out: list = []
    i = j = 0
    while i < len(nodes) and j < len(page):
        node, token = nodes[i], page[j]
        if node == token:
            out.append(node)
            i, j = i + 1, j + 1
        elif isinstance(node, list) and node[0] == TEXT:
            if isinstance(token, list):
                node, j = (node if node[1] == token[0] else [TEXT, None]), j + 1
            out.append(node)
            i += 1
        elif isinstance(token, list):
            out.append([TEXT, None])
            j += 1
        elif isinstance(node, list):
            to = read([node], page, j)
            if to < 0 and depth < DEPTH:
                grown = _grow(node[1], page, j, depth)
                if grown:
                    node, to = [node[0], grown[0]], grown[1]
                    more = read([[MANY, node[1]]], page, to) if node[0] == MANY else -1
                    to = max(to, more)
            if to < 0:
                node, to = [MAYBE, node[1]] if node[0] == MAYBE else [MAYBE, [node]], j
            out.append(node)
            i, j = i + 1, max(to, j)
        else:
            step = _resolve(nodes, page, i, j, out, depth)
            if step is None:
                return None
            i, j = step
    if i < len(nodes):
        if any(isinstance(x, str) for x in nodes[i:]):
            out.append([MAYBE, nodes[i:]])
        else:
            out += nodes[i:]
    if j < len(page):
        square = _square(out, page, j, depth)
        if square is not None:
            out, j = square
        if j < len(page):
            out.append([MAYBE, _as_nodes(page[j:])])
    return out


def _grow(group: list, page: list, j: int, depth: int) -> tuple[list, int] | None:
    """(group generalised to cover one more round at j, the place after it), if the round starts and ends with the group's tags."""
    tags = [x for x in group if isinstance(x, str)]
    if not tags or page[j] != tags[0]:
        return None
    for k in range(j + 1, min(len(page), j + REACH)):
        if page[k] == tags[-1]:
            new = align(group, page[j : k + 1], depth + 1)
            return (new, k + 1) if new else None
    return None


def _square(out: list, page: list, j: int, depth: int) -> tuple[list, int] | None:
    """Page side of a repeated group: what was matched last is a round of the group that starts again at j."""
    if not out or depth >= DEPTH or not isinstance(page[j], str) or page[j].startswith("</"):
        return None
    if isinstance(out[-1], list) and out[-1][0] == MANY:
        grown = _grow(out[-1][1], page, j, depth)
        if grown:
            to = max(grown[1], read([[MANY, grown[0]]], page, grown[1]))
            return [*out[:-1], [MANY, grown[0]]], to
        return None
    s = next((k for k in range(len(out) - 1, max(-1, len(out) - REACH), -1) if out[k] == page[j]), None)
    if s is None or not isinstance(out[-1], str):
        return None
    group = out[s:]
    to = read(group, page, j)
    if to < 0:
        grown = _grow(group, page, j, depth)
        if not grown:
            return None
        group, to = grown
    while (more := read(group, page, to)) > to:
        to = more
    return [*out[:s], [MANY, group]], to


def _resolve(nodes: list, page: list, i: int, j: int, out: list, depth: int) -> tuple[int, int] | None:
    """Resolves a mismatch of tags at nodes[i], page[j]; changes out and gives the places to go on from."""
    square = _square(out, page, j, depth)
    if square is not None and square[1] > j:
        out[:] = square[0]
        return i, square[1]
    # the wrapper's side: its next tags are one more round of what was matched last
    if depth < DEPTH and isinstance(nodes[i], str):
        flat = []
        for x in nodes[i : i + REACH]:
            if isinstance(x, list) and x[0] != TEXT:
                break
            flat.append(x if isinstance(x, str) else ["" if x[1] is None else x[1]])
        square = _square(out, flat, 0, depth) if flat and isinstance(flat[0], str) else None
        if square is not None and square[1] > 0:
            out[:] = square[0]
            return i + square[1], j
    there = next((k for k in range(j + 1, min(len(page), j + REACH)) if page[k] == nodes[i]), None)
    here = next((k for k in range(i + 1, min(len(nodes), i + REACH)) if nodes[k] == page[j]), None)
    if there is None and here is None:
        return None
    if here is None or there is not None and there - j <= here - i:
        out.append([MAYBE, _as_nodes(page[j:there])])
        return i, there
    out.append([MAYBE, nodes[i:here]])
    return here, j


def _walk(items, stack: list[str]) -> Iterator[tuple[object, list[str]]]:
    """(item, open elements) along a token stream, with the closings that HTML leaves out."""
    for item in items:
        if isinstance(item, str):
            if item.startswith("</"):
                name = item[2:]
                k = next((k for k in range(len(stack) - 1, -1, -1) if _name(stack[k]) == name), None)
                if k is not None:
                    del stack[k:]
            else:
                name = _name(item)
                if name not in VOID:
                    if name in RESTART or name in _ENDS_P:
                        closes = {name} if name in RESTART else {"p"}
                        if name in _ENDS_P:
                            closes.add("p")
                        k = len(stack) - 1
                        while k >= 0 and (_name(stack[k]) in INLINE or _name(stack[k]) in closes):
                            if _name(stack[k]) in closes:
                                del stack[k:]
                                break
                            k -= 1
                    stack.append(item)
        yield item, stack


def _name(tag: str) -> str:
    return tag[1:].split(".", 1)[0]


def _kind(tag: str) -> int:
    """-1: no article text inside; 3, 2, 1: an article, the main part, a content box; 0: neither."""
    name, *words = tag[1:].split(".")
    if name in OUTSIDE or name not in ("body", "html", "article", "main") and any(_BAD.match(w) or _PART.search(w) for w in words):
        return -1
    if name == "article":
        return 3
    if name == "main" or "main" in words:
        return 2
    return int(name in ("div", "section", "td") and any(_GOOD.match(p) for w in words for p in re.split(r"[-_]+", w)))


def _level(stack: list[str]) -> int:
    kinds = [_kind(t) for t in stack]
    return -1 if -1 in kinds else max(kinds, default=0)


def _kept(page: list) -> set[int]:
    """Places of the texts at a page's best level: inside an article, the main part, a content box, or none of these, and nothing that is left out."""
    at = levels(page)
    best = max((x for x, _ in at), default=0)
    size = {x: sum(len(_said(page[j][0])) for y, j in at if y == x) for x in range(1, best + 1)}
    # an article that is a small part of the main part or content box around it is a teaser there
    low = next((x for x in range(1, best) if size[x] > TEASER * sum(size[y] for y in range(x + 1, best + 1))), best)
    return {j for x, j in at if x >= low and x >= 0}


def _said(text: str) -> str:
    return " ".join(text.split())


def learn(pages: list[str]) -> dict:
    """The wrapper of a host's pages: nodes, and the template's own texts as [path of their slot, text].

    A slot of the wrapper is content where the pages differ. A text that every page has in the same slot (in any round of a repeated group) is
    the template's, if four or more differing pages show it; unless what differs is less than ALIKE of all text, for then the
    pages are copies of one another and show nothing.
    """
    streams = list({json.dumps(s): s for s in map(tokens, dict.fromkeys(pages))}.values())
    streams.sort(key=lambda s: (len(s), json.dumps(s)))
    nodes, used = _as_nodes(streams[0]), [streams[0]]
    for s in streams[1:]:
        new = align(nodes, s)
        if new is not None and read(new, s, 0) == len(s):
            nodes = new
            used.append(s)
    common: set[tuple] | None = None
    total = fixed = 0
    found = []
    for s in used:
        seen: list = []
        if read(nodes, s, 0, seen) != len(s):
            continue
        kept = _kept(s)
        has = [(path, _said(s[j][0])) for j, path in seen if j in kept]
        found.append(has)
        common = set(has) if common is None else common & set(has)
    common = {c for c in common or () if c[1]}
    for has in found:
        total += sum(len(t) for _, t in has)
        fixed += sum(len(t) for p, t in has if (p, t) in common)
    sure = len(found) >= 4 and total - fixed >= ALIKE * total
    return {"nodes": nodes, "template": [[list(p), t] for p, t in sorted(common)] if sure else []}


class Wrapper:
    def __init__(self, learnt: dict):
        self.nodes, self.template = learnt["nodes"], {(tuple(p), t): k for k, (p, t) in enumerate(learnt["template"])}
        self.texts = {t for _, t in self.template}

    def _slots(self, page: list) -> list[tuple[int, tuple | None]] | None:
        """(place, path of its slot) of a page's texts; no paths if the wrapper had to be generalised to the page; None if it can't be."""
        seen: list = []
        if read(self.nodes, page, 0, seen) == len(page):
            return seen
        grown = align(self.nodes, page)
        seen = []
        if grown is None or read(grown, page, 0, seen) != len(page):
            return None
        return [(j, None) for j, _ in seen]

    def extract(self, page: list) -> str | None:
        """The article of a page's tokens, by the wrapper or else by the wrapper generalised to this page; None if that can't be.

        The article is what lies at the page's best level, without the blocks that only hold the template's own texts.
        """
        at = self._slots(page)
        if at is None:
            return None
        kept = _kept(page)
        return blocks(page, {j for j, _ in at if j in kept}, {j for j, path in at if j in kept and self._fixed(page[j][0], path)})

    def _fixed(self, text: str, path: tuple | None) -> bool:
        if not self.template:
            return False
        text = _said(text)
        return text in self.texts if path is None else (path, text) in self.template

    def has(self, page: list) -> list[int]:
        """For each of the template's texts, 1 if the page has it in its slot (or at all, if the wrapper doesn't cover the page), else 0."""
        out = [0] * len(self.template)
        kept = _kept(page)
        for j, path in self._slots(page) or ():
            if j in kept:
                said = _said(page[j][0])
                for (p, t), k in self.template.items() if path is None and said in self.texts else ():
                    out[k] |= t == said
                if (path, said) in self.template:
                    out[self.template[path, said]] = 1
        return out


def blocks(page: list, kept: set[int], fixed: set[int] = frozenset()) -> str:
    """The kept texts of a token stream: block-level tags part blocks, white space inside a block becomes one space, blocks are joined by line feeds.

    A block of fixed texts alone is left out; one that holds other text too is kept whole.
    """
    out: list[str] = []
    now: list[str] = []
    own = False

    def end() -> None:
        nonlocal own
        if now:
            block = " ".join("".join(now).split())
            if block and own:
                out.append(block)
            now.clear()
            own = False

    for j, t in enumerate(page):
        if isinstance(t, list):
            if j in kept:
                now.append(t[0])
                own = own or j not in fixed and not t[0].isspace()
        elif now:
            name = t.removeprefix("</").removeprefix("<").split(".", 1)[0]
            if name == "br":
                now.append(" ")
            elif name not in INLINE:
                end()
    end()
    return "\n".join(out)


def levels(page: list) -> list[tuple[int, int]]:
    """(level, place) of each text of a token stream."""
    return [(_level(stack), j) for j, (t, stack) in enumerate(_walk(page, [])) if isinstance(t, list)]


def alone(page: list) -> str:
    """The article of a token stream read by itself."""
    return blocks(page, _kept(page))


def host(url_col):
    """Host of a URL column in lower case, empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url_col, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def learn_hosts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", sample: int = SAMPLE) -> DataFrame:
    """host, wrapper (JSON) of every host. A host's wrapper is made from up to ``sample`` of its pages, one for each value of a hash of the id.

    The template's texts that it finds are then counted over all of the host's pages and kept in the wrapper if SHARED of them have them.
    """
    rows = pages.select(host(F.col(url_col)).alias("host"), F.xxhash64(id_col, url_col).alias("h"), F.col(html_col).alias("html")).where(F.col("html").isNotNull() & (F.col("html") != ""))
    least = rows.groupBy("host", F.pmod("h", F.lit(sample)).alias("slot")).agg(F.min("h").alias("h")).select("host", "h")
    picked = rows.join(least, ["host", "h"], "left_semi").groupBy("host", "h").agg(F.min("html").alias("html"))
    grouped = picked.groupBy("host").agg(F.sort_array(F.collect_list("html")).alias("pages"))

    @arrow_udf("string")
    def run(lists: pa.Array) -> pa.Array:
        return pa.array([json.dumps(learn(p), ensure_ascii=False) for p in lists.to_pylist()], pa.string())

    return _confirmed(pages, written(grouped.select("host", run("pages").alias("wrapper")), "wrapperdrafts"), url_col, html_col)


def _confirmed(pages: DataFrame, drafts: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """drafts (host, wrapper) without the template's texts that less than SHARED of the host's pages have."""
    some = drafts.where("get_json_object(wrapper, '$.template[0]') is not null")
    rows = pages.select(F.col(html_col).cast("string").alias("html"), host(F.col(url_col)).alias("host")).where(F.col("html").isNotNull() & (F.col("html") != ""))
    size = some.agg(F.sum(F.length("wrapper") + 64)).first()[0]
    if size is None:
        return drafts
    if size <= BROADCAST:
        shared = drafts.sparkSession.sparkContext.broadcast({r["host"]: r["wrapper"] for r in some.collect()})
        rows, find = rows.where(F.col("host").isin(list(shared.value))) if len(shared.value) <= 200 else rows, lambda h, _: shared.value.get(h)
    else:
        rows, find = rows.join(some, "host").select("html", "host", "wrapper"), lambda _, w: w

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts = batch.column(1).to_pylist()
            given = batch.column(2).to_pylist() if batch.num_columns > 2 else [None] * len(hosts)
            kept: dict[str, Wrapper | None] = {}
            counts: Counter = Counter()
            for page, h, w in zip(batch.column(0).to_pylist(), hosts, given):
                if h not in kept:
                    learnt = find(h, w)
                    kept[h] = Wrapper(json.loads(learnt)) if learnt else None
                if kept[h]:
                    counts[h, -1] += 1
                    counts.update({(h, k): n for k, n in enumerate(kept[h].has(tokens(page)))})
            yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in counts], pa.string()), pa.array([k for _, k in counts], pa.int32()), pa.array(list(counts.values()), pa.int64())], ["host", "k", "n"])

    found = rows.mapInArrow(tidy(run), "host string, k int, n long").groupBy("host", "k").agg(F.sum("n").alias("n"))
    counts = found.groupBy("host").agg(F.map_from_entries(F.collect_list(F.struct("k", "n"))).alias("n"))

    @arrow_udf("string")
    def settle(wrappers: pa.Array, counts: pa.Array) -> pa.Array:
        out = []
        for w, n in zip(wrappers.to_pylist(), counts.to_pylist()):
            if n is not None:
                w, n = json.loads(w), dict(n)
                w["template"] = [t for k, t in enumerate(w["template"]) if n.get(k, 0) >= SHARED * n[-1]]
                w = json.dumps(w, ensure_ascii=False)
            out.append(w)
        return pa.array(out, pa.string())

    return drafts.join(counts, "host", "left").select("host", settle("wrapper", "n").alias("wrapper"))


EXTRACTED = "page_id long, url string, text string, n_chars long"


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", wrappers: DataFrame | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages. Null and empty html give the empty text, null urls share the empty host, repeated rows are read each. Other columns are not read.

    wrappers: as learn_hosts() gives them; learnt from pages if left out.
    """
    spark = pages.sparkSession
    table = written(learn_hosts(pages, id_col, url_col, html_col) if wrappers is None else wrappers, "wrappers")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"), host(F.col(url_col)).alias("host"))
    size = table.agg(F.sum(F.length("wrapper") + 64)).first()[0] or 0
    if size <= BROADCAST:
        shared = spark.sparkContext.broadcast({r["host"]: r["wrapper"] for r in table.collect()})
        return rows.mapInArrow(tidy(_extractor(lambda h, _: shared.value.get(h))), EXTRACTED)
    return rows.join(table, "host", "left").select("page_id", "url", "html", "host", "wrapper").mapInArrow(tidy(_extractor(lambda _, w: w)), EXTRACTED)


def _extractor(find):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, Wrapper | None] = {}
        for batch in batches:
            html_, hosts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            given = batch.column(4).to_pylist() if batch.num_columns > 4 else [None] * len(hosts)
            out = []
            for page, h, w in zip(html_, hosts, given):
                if not page:
                    out.append("")
                    continue
                if h not in kept:
                    if len(kept) > 2000:
                        kept.clear()
                    learnt = find(h, w)
                    kept[h] = Wrapper(json.loads(learnt)) if learnt else None
                stream = tokens(page)
                text = kept[h].extract(stream) if kept[h] else None
                out.append(alone(stream) if text is None else text)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return run


def op7_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages -> main text of each."""
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
