"""Operator 2: main text of pages by wrapper induction.

Pages of a host are aligned with one page of that host by simple tree matching.
A node of that page whose text is the same on most pages that have it is template; nodes
whose text varies are slots.  Matches and equal texts are counted over all
pages of the host by a grouped aggregation, so a host of any size is spread over all
tasks.  A page's main text is its content region without template nodes and without
parts whose element or class says menu, header, footer, sidebar, notice, advert,
form, script, style or reader comment."""

from __future__ import annotations

import hashlib
import html
import pickle
import re
from bisect import bisect_left

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmine.llm.common import small_side
from tabmine.session import cut_lineage

# fixed values: HTML's own element groups
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr img br #text".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
                     "h5 h6 header hr main menu nav ol p pre section table ul".split())
SIBLING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
           "th": ("td", "th"), "option": ("option",)}
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"),
         "option": ("select",), "p": ("div", "article", "section", "main", "td", "li", "body", "aside", "blockquote", "button")}
#: elements that never hold main text, and those that do so only inside an article
NEVER = frozenset("head nav footer aside form script style noscript iframe template button select textarea svg object "
                  "canvas dialog menu title".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
LABEL = re.compile(r"(?:^|[\s_-])(?:ad|ads|advert\w*|adsense|sponsor\w*|promo\w*|banner|sidebar|side|aside|menu|nav|navbar|navigation|"
                   r"navi|breadcrumbs?|header|masthead|topbar|footer|colophon|copyright|notice|notices|cookie\w*|consent|gdpr|alert|"
                   r"popup|modal|overlay|newsletter|subscribe|subscription|signup|login|paywall|share|sharing|social|related|"
                   r"recommend\w*|trending|tags|toolbar|pagination|pager|widget|comments?|commentlist|replies|reply|disqus|form|"
                   r"search|skip|legal|disclaimer)(?=$|[\s_-])", re.I)
REMARK = re.compile(r"(?:(?:user|reader)s?[_-])?(?:comment|repl(?:y|ies)\b)", re.I)
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: elements that carry text by their nature; part of a class name is no word about them
TEXTUAL = frozenset("article main h1 h2 h3 h4 h5 h6 p pre blockquote table tbody tr td th figure figcaption li dl dt dd".split())
#: a named part of an article that holds more than this share of its text is the article's body, whatever its name
BODY_SHARE = 0.5
#: a comment, CDATA section, declaration or tag; nothing that was taken is given back, so one try is linear
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>|"
                   r"<(/?)([A-Za-z][^\s/>]*+)([^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+)>", re.S)
NAME = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)")
ATTRIBUTE = re.compile(r"(?<![^\s=/>])([^\s=/>]++)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++))")
#: after so many tags that do not end, ends are looked up in a table
FAILED_TAGS = 16
DEPTH = 200


class Node:
    """An element: its name, attributes and parts (nodes and raw text, in page order)."""

    __slots__ = ("attrs", "parts", "tag")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs, self.parts = tag, attrs, []

    def kids(self) -> list[Node]:
        return [p for p in self.parts if not isinstance(p, str)]


class Ends:
    """Where tags end, for pages with many that do not: every mark (``>`` and quotes) of the page is looked at once."""

    def __init__(self, source: str, at: int):
        self.source = source
        self.marks = [m.start() for m in re.finditer("[>\"']", source[at:])]
        self.marks = [m + at for m in self.marks]
        self.end = [-1] * (len(self.marks) + 1)         # end of a tag whose next mark outside of quotes is this one
        self.past = {">": len(self.marks), '"': len(self.marks), "'": len(self.marks)}
        self.declared = [-1] * (len(self.marks) + 1)
        for k in range(len(self.marks) - 1, -1, -1):
            kind = source[self.marks[k]]
            if kind == ">":
                self.end[k] = self.marks[k]
            elif self.past[kind] < len(self.marks):
                self.end[k] = self.end[self.past[kind] + 1]
            self.past[kind] = k
            self.declared[k] = self.marks[self.past[">"]] if self.past[">"] < len(self.marks) else -1

    def token(self, lt: int) -> tuple[int, tuple] | None:
        """End of the declaration or tag at ``lt`` and its ``(closing, name, attributes)``."""
        if self.source[lt + 1:lt + 2] in ("!", "?"):
            end = self.declared[bisect_left(self.marks, lt)]
            return (end + 1, (None, None, None)) if end >= 0 else None
        m = NAME.match(self.source, lt)
        if m is None:
            return None
        end = self.end[bisect_left(self.marks, m.end())]
        return (end + 1, (m[1], m[2], self.source[m.end():end])) if end >= 0 else None


class Scanner:
    """Finds the page's tags, and what else is no text, from left to right.  Time is linear."""

    def __init__(self, source: str):
        self.source, self.failed, self.last = source, 0, source.rfind(">")
        self.ends: Ends | None = None

    def after(self, at: int) -> tuple[int, int, tuple] | None:
        """``(start, end, (closing, name, attributes))`` of the next one; no name: a comment or the like."""
        source = self.source
        while (lt := source.find("<", at)) >= 0:
            if self.ends is None and lt < self.last and (m := TOKEN.match(source, lt)) is not None:
                return lt, m.end(), m.groups()
            free = source.startswith(("<!--", "<![CDATA["), lt)
            if lt > self.last and not free:
                if source.find("<!", lt) < 0:
                    return None
            elif self.ends is not None and not free:
                found = self.ends.token(lt)
                if found is not None:
                    return lt, *found
            elif (m := TOKEN.match(source, lt)) is not None:
                return lt, m.end(), m.groups()
            elif source[lt + 1:lt + 2] not in ("", " ", "\n", "<", "="):
                self.failed += 1
                if self.failed > FAILED_TAGS:
                    self.ends = Ends(source, lt)
            at = lt + 1
        return None


def parse(source: str) -> Node:
    """Tree of a page; unclosed elements are closed where HTML closes them."""
    root = Node("#root")
    open_, at, low = [root], 0, None
    scanner = Scanner(source)
    while (token := scanner.after(at)) is not None:
        start, stop, (closing, name, attrs) = token
        if start > at:
            open_[-1].parts.append(source[at:start])
        at = stop
        if name is None:
            if source.startswith("<![CDATA[", start):
                open_[-1].parts.append(html.escape(source[start + 9:stop].removesuffix("]]>")))
            continue
        name = name.lower()
        if closing:
            for k in range(len(open_) - 1, 0, -1):
                if open_[k].tag == name:
                    del open_[k:]
                    break
            continue
        ends = ("p",) if name in CLOSES_P else SIBLING.get(name, ())
        for k in range(len(open_) - 1, 0, -1) if ends else ():
            if open_[k].tag in ends:
                del open_[k:]
                break
            if open_[k].tag in SCOPE.get("p" if ends == ("p",) else name, ()):
                break
        node = Node(name, attrs)
        open_[-1].parts.append(node)
        if name in RAW:
            low = low or source.lower()                 # code points keep their place unless lower() grows one
            end = low.find(f"</{name}", at) if len(low) == len(source) else (
                e.start() if (e := re.compile(f"</{name}", re.I).search(source, at)) else -1)
            end = len(source) if end < 0 else end
            if name in ("title", "textarea"):
                node.parts.append(source[at:end])
            at = end
        if name in RAW or (name not in VOID and not attrs.endswith("/")):
            if len(open_) < DEPTH:
                open_.append(node)
    if at < len(source):
        open_[-1].parts.append(source[at:])
    return root


def attributes(node: Node) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(node.attrs)} if node.attrs.strip() else {}


def by_nature(node: Node, a: dict[str, str] | None = None) -> bool:
    """Does a role or a style hide the element or name it as no main text?"""
    a = attributes(node) if a is None else a
    return a.get("role", "").lower() in ROLES or a.get("aria-hidden", "").lower() == "true" or \
        bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", ""), re.I)) or \
        bool(re.search(r"(?:^|\s)hidden(?=\s|=|/|$)", ATTRIBUTE.sub(" ", node.attrs)))


def unwanted(node: Node, inside: bool) -> bool:
    """Does the element itself say that it is not main text?"""
    if node.tag in NEVER or (node.tag == "header" and not inside):
        return True
    if not node.attrs or node.tag in ("html", "body", "#root"):
        return False
    a = attributes(node)
    if by_nature(node, a):
        return True
    names = f"{a.get('class', '')} {a.get('id', '')}"
    if not names.strip():
        return False
    if node.tag in TEXTUAL:                             # articles, headings, paragraphs: only a whole name counts
        return any(LABEL.fullmatch(x) or REMARK.match(x) for x in names.split())
    return bool(LABEL.search(CAMEL.sub("-", names)))


def text_sizes(order: list[tuple[Node, bool]]) -> dict[int, int]:
    """Length of the text below every node of a preorder list."""
    sizes: dict[int, int] = {}
    for n, _ in reversed(order):
        sizes[id(n)] = sum(len(p.strip()) if isinstance(p, str) else sizes.get(id(p), 0) for p in n.parts) if n.tag not in RAW else 0
    return sizes


def skeleton(root: Node) -> list[tuple[str, bytes, int]]:
    """Preorder ``(tag, digest of own text, number of children)`` of the elements of a page.
    What stands in it is all that tree matching needs."""
    out, stack = [], [root]
    while stack:
        n = stack.pop()
        kids = [p for p in n.parts if not isinstance(p, str)]
        text = "".join([p for p in n.parts if isinstance(p, str)]).strip() if len(kids) < len(n.parts) else ""
        out.append((n.tag, hashlib.md5(text.encode("utf-8", "replace")).digest()[:6] if text else b"", len(kids)))
        stack += kids[::-1]
    return out


def _tree(flat: list) -> tuple[list[list[int]], list[tuple]]:
    """Children of every preorder node, and a signature of every subtree's shape."""
    kids: list[list[int]] = [[] for _ in flat]
    need = []
    for k, (_, _, n) in enumerate(flat):
        if need:
            kids[need[-1][0]].append(k)
            need[-1][1] -= 1
            while need and not need[-1][1]:
                need.pop()
        if n:
            need.append([k, n])
    shape: list = [None] * len(flat)
    for k in range(len(flat) - 1, -1, -1):
        shape[k] = hash((flat[k][0], *[shape[c] for c in kids[k]]))
    return kids, shape


class Aligner:
    """``match`` with one page, remembered for pages of one layout: two pages whose elements agree, and whose own texts agree
    wherever that page has the text too, are matched alike.  What is remembered is bounded."""

    def __init__(self, base: list, most: int = 2_000):
        self.base, self.tree, self.most, self.known = base, _tree(base), most, {}
        self.texts = {t: k for k, (_, t, _) in enumerate(base)}

    def match(self, own: list) -> list[tuple[int, int]]:
        key = tuple([(tag, self.texts.get(t, -1), n) for tag, t, n in own])
        found = self.known.get(key)
        if found is None:
            if len(self.known) >= self.most:
                self.known.clear()
            found = self.known[key] = match(self.base, own, self.tree)
        return found


def match(a: list, b: list, tree: tuple | None = None) -> list[tuple[int, int]]:
    """Pairs of nodes of two skeletons matched by simple tree matching: roots of the
    same element match, their children keep their order, and the number of matched
    nodes is the largest possible; of several such matchings one with more equal
    own texts is taken (children of equal text decide).  Equal shapes match node by node.  ``tree``: ``_tree(a)``, if at hand."""
    ka, sa = tree or _tree(a)
    kb, sb = _tree(b)
    memo: dict[tuple[int, int], tuple[int, list]] = {}
    one = 1 << 32                                       # a matched node outweighs all equal texts

    def size(kids, n):
        total, stack = 0, [n]
        while stack:
            x = stack.pop()
            total += 1
            stack += kids[x]
        return total

    def score(x, y):
        """Matched nodes below and with (x, y), and the pairs of children behind it."""
        if a[x][0] != b[y][0]:
            return 0, []
        if (x, y) in memo:
            return memo[x, y]
        p, q = ka[x], kb[y]
        equal = a[x][1] == b[y][1]
        if sa[x] == sb[y]:
            memo[x, y] = size(ka, x) * one + equal, list(zip(p, q, strict=True))
            return memo[x, y]
        table = [[0] * (len(q) + 1) for _ in range(len(p) + 1)]
        for i in range(1, len(p) + 1):
            above, row = table[i - 1], table[i]
            for j in range(1, len(q) + 1):
                row[j] = max(above[j], row[j - 1], above[j - 1] + score(p[i - 1], q[j - 1])[0])
        i, j, pairs = len(p), len(q), []
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                pairs.append((p[i - 1], q[j - 1]))
                i, j = i - 1, j - 1
        memo[x, y] = one + equal + table[-1][-1], pairs
        return memo[x, y]

    out, todo = [], [(0, 0)] if a and b and a[0][0] == b[0][0] else []
    while todo:
        x, y = todo.pop()
        out.append((x, y))
        todo += score(x, y)[1]
    return out


def main_text(root: Node, template: set[int]) -> str:
    """Text blocks of the content region, joined by blank lines.  ``template`` holds preorder
    numbers of template elements; they and unwanted elements give no text of their own."""
    number, order, stack = {}, [], [(root, False)]
    while stack:                                        # all nodes first: sizes decide about names
        n, inside = stack.pop()
        number[id(n)] = len(order)
        order.append((n, inside))
        inside = inside or n.tag in ("article", "main")
        stack += [(k, inside) for k in n.kids()[::-1]]
    sizes = None
    plain, order, stack = order, [], [(root, False, None)]
    while stack:
        n, bad, region = stack.pop()
        if not bad and unwanted(n, region is not None):
            bad = True
            if n.tag not in NEVER and (region is not None or n.tag in ("article", "main")) and "comment" not in n.attrs.lower():
                sizes = sizes or text_sizes(plain)
                whole = region or root
                bad = by_nature(n) or sizes[id(n)] <= BODY_SHARE * sizes[id(whole)]
        order.append((n, bad))
        region = n if n.tag in ("article", "main") and not bad else region
        stack += [(k, bad, region) for k in n.kids()[::-1]]
    regions = [n for n, bad in order if n.tag == "article" and not bad] or \
              [n for n, bad in order if not bad and (n.tag == "main" or "main" in attributes(n).get("role", ""))]
    bad_ids = {id(n) for n, bad in order if bad}
    out: list[str] = []

    def blocks(region: Node) -> None:
        line: list[str] = []

        def flush():
            text = " ".join(html.unescape("".join(line)).split())
            line.clear()
            if text:
                out.append(text)

        todo: list = [region]
        while todo:
            p = todo.pop()
            if p is flush:
                flush()
            elif isinstance(p, tuple):
                line.append(p[0])
            elif id(p) in bad_ids:
                if p.tag not in INLINE:
                    flush()
            elif p.tag in ("br", "wbr"):
                line.append(" " if p.tag == "br" else "")
            else:
                block = p.tag not in INLINE
                if block:
                    flush()
                    todo.append(flush)
                hide = number[id(p)] in template
                todo += [(q,) if isinstance(q, str) else q for q in p.parts[::-1] if not (hide and isinstance(q, str))]
        flush()

    held: set[int] = set()
    for r in regions or [root]:
        if id(r) not in held:
            blocks(r)
            stack = [r]
            while stack:
                n = stack.pop()
                held.add(id(n))
                stack += n.kids()
    return "\n\n".join(out)


def host_of(url: str) -> F.Column:
    """Lower-cased host of a url (empty when there is none)."""
    return F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]*)", 1), F.lit("")))


def extract_pages(pages: DataFrame, least_pages: int = 8, constant: float = 0.8, id_col: str = "page_id",
                  url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id, url, text, n_chars, host, template_nodes)`` per page.

    A node is template when at least ``least_pages`` different pages of the host
    have it and at least the share ``constant`` of them with the same text; on
    hosts with fewer pages only elements and classes decide.  The page that a host's pages are
    aligned with is the one of smallest id.  The content region is the page's
    articles, else its main element, else the page.  Null html gives an empty text; null
    urls share the empty host; repeated rows are kept; an unparsable page is read as far as it goes.
    Other columns are ignored."""
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("_html"), host_of(url_col).alias("host"))
    kind = rows.schema["_id"].dataType.simpleString()

    def skeletons(batches):
        for batch in batches:
            for part in range(0, batch.num_rows, 500):
                b = batch.slice(part, 500)
                blobs = [pickle.dumps(skeleton(parse(h))) for h in b.column("_html").to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column("host"), pa.array(blobs, pa.binary())], names=["host", "_model"])

    # one page per host: ids first, so that page texts need not meet by host
    first = cut_lineage(rows.groupBy("host").agg(F.min("_id").alias("_id"), F.countDistinct(F.xxhash64("_html")).alias("_n"))
                        .where(F.col("_n") >= least_pages).select("host", "_id"))
    chosen = rows.join(small_side(first), ["host", "_id"], "left_semi")
    model = cut_lineage(chosen.select("host", "_html").mapInArrow(skeletons, "host string, _model binary")
                        .groupBy("host").agg(F.min("_model").alias("_model")))

    aligners: dict[bytes, Aligner] = {}                 # of a Python worker, bounded

    def aligned(blob: bytes) -> Aligner:
        if blob not in aligners:
            if len(aligners) >= 200:
                aligners.clear()
            aligners[blob] = Aligner(pickle.loads(blob))   # written by skeletons() of this run
        return aligners[blob]

    def count(batches):
        for pdf in batches:
            seen: dict[tuple[str, int], list[int]] = {}
            for host, h, blob in zip(pdf["host"], pdf["_html"], pdf["_model"], strict=True):
                own, aligner = skeleton(parse(h)), aligned(blob)
                base = aligner.base
                for x, y in aligner.match(own):
                    c = seen.setdefault((host, x), [0, 0])
                    c[0] += 1
                    c[1] += base[x][1] == own[y][1]
            yield pd.DataFrame([(h, x, n, e) for (h, x), (n, e) in seen.items()], columns=["host", "node", "n", "same"])

    known = rows.join(small_side(model, 20_000), "host")               # some 2 KB a host
    # copies count as one page: of each group that repeats on a host one row is left
    known = known.withColumn("_key", F.md5("_html"))
    copies = cut_lineage(known.groupBy("host", "_key").agg(F.count(F.lit(1)).alias("_m"), F.min("_id").alias("_first"))
                         .where("_m > 1").select("host", "_key", "_first"))
    if not copies.isEmpty():
        copies = small_side(copies)
        kept = known.join(copies, ["host", "_key"]).where(F.col("_id").eqNullSafe(F.col("_first"))).drop("_first")
        known = known.join(copies, ["host", "_key"], "left_anti").unionByName(kept.dropDuplicates(["host", "_key"]))
    counts = (known.select("host", "_html", "_model").mapInPandas(count, "host string, node int, n bigint, same bigint")
              .groupBy("host", "node").agg(F.sum("n").alias("n"), F.sum("same").alias("same")))
    fixed = (counts.where((F.col("n") >= least_pages) & (F.col("same") >= constant * F.col("n")))
             .groupBy("host").agg(F.sort_array(F.collect_list("node")).alias("_fixed")))   # nodes of one page
    wrapper = cut_lineage(model.join(fixed, "host", "left").select("host", "_model", "_fixed"))

    def texts(batches):
        for batch in batches:
            for part in range(0, batch.num_rows, 500):
                b = batch.slice(part, 500)
                out, used = [], []
                for h, blob, nodes in zip(*[b.column(c).to_pylist() for c in ("_html", "_model", "_fixed")], strict=True):
                    root, hidden = parse(h), set()
                    if blob is not None and nodes:
                        flat, nodes, aligner = skeleton(root), set(nodes), aligned(blob)
                        base = aligner.base
                        hidden = {y for x, y in aligner.match(flat) if x in nodes and base[x][1] == flat[y][1]}
                    out.append(main_text(root, hidden))
                    used.append(len(hidden))
                yield pa.RecordBatch.from_arrays(
                    [b.column("_id"), b.column("url"), pa.array(out, pa.string()), b.column("host"), pa.array(used, pa.int32())],
                    names=["_id", "url", "text", "host", "template_nodes"])

    found = rows.join(small_side(wrapper, 20_000), "host", "left").select("_id", "url", "host", "_html", "_model", "_fixed")
    out = found.mapInArrow(texts, f"_id {kind}, url string, text string, host string, template_nodes int")
    return out.select(F.col("_id").alias(id_col), "url", "text", F.length("text").cast("bigint").alias("n_chars"),
                      "host", "template_nodes")
