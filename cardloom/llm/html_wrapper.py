"""Main text of web pages by wrappers inferred from all pages of a host.

A page becomes a token stream: start and end tags of blocks, and block texts. From the streams
of one host a union-free regular expression is inferred, its wrapper: streams are aligned
one after another with the expression so far, and every mismatch makes it more general.
A block that follows its like (or a run of blocks that does) becomes a repeated group, what
only one side has becomes optional, texts that differ become a slot. Texts that stay
equal over a host are its template, and a slot is article or not by where the
wrapper has it and by what all pages hold there: length, share of links, names of blocks.
Every page is then matched with its host's wrapper, which tells which of its texts go out.

On Spark: tasks fold each page and send one row per host and different folded stream, with
summed statistics. These rows are aligned in sorted order, a host's streams spread over
``BUCKETS`` tasks by their hash, so that a host with a third of all pages is not one task;
its at most ``BUCKETS`` partial wrappers are then aligned in turn. Both read a sorted stream
and hold one wrapper. Pages meet the wrappers in a join by host. Page sources are never shuffled
for the inference, and the result does not depend on the partitions.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import ascii_lower, staged

# Streams of a host are aligned in this many tasks first.
BUCKETS = 64
# Different folded streams a task holds before it sends them.
HELD = 2_000
# Blocks nested deeper lie beside each other; longer runs than PERIOD do not make a group.
DEPTH, PERIOD = 60, 8
# A level with more blocks than this is generalised: names go, then the order.
WIDE = 200

# Fixed names of the HTML language.
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var".split()
)
VOID = set("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
RAW = set("script style title textarea iframe noembed noframes xmp".split())
SHELL = {"html", "head", "body"}
BLOCKS = set(
    "address article aside blockquote button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup legend li main menu nav noscript object ol "
    "optgroup option p pre search section select summary svg table tbody td template tfoot th thead tr ul".split()
)
# An open block of the second kind ends where one of the first begins, up to the third.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "thead", "tbody", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "optgroup"}),
}
# Blocks that say nothing by themselves, as labels; what they hold tells them apart.
PLAIN = {"div||", "section||", "td||", "center||"}
TABLE = {"table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Blocks that are never the article's own text.
ASIDE_TAGS = set(
    "nav footer aside form menu dialog button select option fieldset noscript template svg object search".split()
)
ARTICLE_TAGS = {"article", "main"}
# Words in class, id or role that name such blocks.
ASIDE_WORDS = set(
    "ad ads advert advertisement advertising adverts banner banners breadcrumb breadcrumbs captcha comment "
    "comments commentlist consent contentinfo cookie cookies copyright disclaimer disqus footer form gdpr login "
    "menu menus modal nav navbar navigation newsletter notice notices notification pagination paging popup "
    "promo promoted promotion related recommended recommendations reply replies respond search share sharing "
    "sidebar sidebars signup skip social sponsor sponsored subscribe subscription teaser toolbar topbar "
    "widget widgets complementary navbox adsbygoogle".split()
)
HEAD_WORDS = {"header", "masthead"}
ARTICLE_WORDS = {"articlebody", "article", "main"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*))>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAMED = re.compile(r"class|id|role|style|hidden", re.IGNORECASE)
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")

# A node is [label, quantifier, children] or a text [TEXT, quantifier, statistics]; a label is
# "tag|kind|names" with kind A (aside), H (header), M (article) or none, GROUP a run of blocks.
TEXT, GROUP = "#", "()"


def host_of(url: Column) -> Column:
    """Between ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)), F.lit(""))


# ------------------------------------------------------------------ page to nodes


def _label(tag: str, attributes: str) -> str:
    kind = "A" if tag in ASIDE_TAGS else "H" if tag == "header" else "M" if tag in ARTICLE_TAGS else ""
    names: set[str] = set()
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "")
        if name in ("class", "id", "role", "itemprop"):
            for word in value.split():
                names.add(re.sub(r"\d+", "0", word)[:40])
                parts = {w.lower() for w in _WORDS.findall(word)} | {word.lower()}
                if kind or tag in SHELL:
                    continue
                if name in ("role", "itemprop") and word.lower() in ARTICLE_WORDS:
                    kind = "M"
                elif parts & ASIDE_WORDS:
                    kind = "A"
                elif parts & HEAD_WORDS:
                    kind = "H"
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            kind = "A"
        elif name == "style" and re.search(r"display\s*:\s*none", value, re.IGNORECASE):
            kind = "A"
    return f"{tag}|{kind}|{'.'.join(sorted(names))}"


def _shape(tags: set[str]) -> str:
    """Of a block without a name, what it holds: running text, lists, or blocks like itself."""
    if tags == {TEXT}:
        return ":text"
    if tags & (HEADINGS | {"p", "blockquote", "pre"}):
        return ":flow"
    return ":list" if tags & {"ul", "ol", "dl", "table", "li"} else ":nest"


def parse(source: str, labels: dict[tuple[str, str], str]) -> tuple[list, list[str]]:
    """The nodes of a page and its block texts in order. A text's statistics are
    ``[number, characters, characters in links]``. ``labels`` remembers labels."""
    root: list = ["", "1", []]
    open_: list[tuple[str, list]] = [("", root)]
    texts: list[str] = []
    pieces: list[str] = []
    linked = in_link = 0
    at = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(pieces).split())
        if text:
            open_[-1][1][2].append([TEXT, "1", [len(texts), len(text), min(linked, len(text))]])
            texts.append(text)
        pieces.clear()
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        raw = html.unescape(raw) if "&" in raw else raw
        pieces.append(raw)
        if in_link:
            linked += len(raw.strip())

    def close(n: int) -> None:
        """End blocks until n are open, leaving out those without text."""
        nonlocal in_link
        flush()
        in_link = 0
        while len(open_) > n:
            _, node = open_.pop()
            if not node[2]:
                open_[-1][1][2].pop()
            elif node[0] in PLAIN:
                node[0] += _shape({n[0].split("|")[0] for n in node[2]})

    while True:
        found = _TOKEN.search(source, at)
        if found is None:
            say(source[at:])
            break
        if found.start() > at:
            say(source[at : found.start()])
        at = found.end()
        tag = found[2] or found[5]
        if tag is None:
            continue
        tag, attributes = tag.lower(), found[3] or found[6] or ""
        if found[1] or found[4]:  # an end tag
            if tag == "a":
                in_link = 0
            if tag in SHELL or tag == "br":
                pieces.append(" " if tag == "br" else "")
            elif tag not in INLINE or any(t == tag for t, _ in open_):
                for n in range(len(open_) - 1, 0, -1):
                    if open_[n][0] == tag:
                        close(n)
                        break
                    if open_[n][0] in ("td", "th", "table") and tag not in TABLE:
                        break
                else:
                    if tag not in INLINE:
                        flush()
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(source, at)
            at = end.end() if end else len(source)
            continue
        if tag in VOID:
            if tag == "br":
                pieces.append(" ")
            elif tag == "hr":
                flush()
            continue
        if tag in SHELL:
            continue
        if tag in INLINE and not _NAMED.search(attributes):
            in_link = 1 if tag == "a" else in_link
            continue
        if (key := (tag, attributes)) not in labels:
            if len(labels) > 10_000:
                labels.clear()
            labels[key] = _label(tag if tag in BLOCKS or tag in INLINE else "div", attributes)
        label = labels[key]
        if tag in INLINE:
            if "|A|" not in label:
                in_link = 1 if tag == "a" else in_link
                continue
        elif tag in ENDS:
            gone, stop = ENDS[tag]
            for n in range(len(open_) - 1, 0, -1):
                if open_[n][0] in stop:
                    break
                if open_[n][0] in gone:
                    close(n)
        elif tag in BLOCKS and open_[-1][0] == "p":
            close(len(open_) - 1)
        elif tag in HEADINGS and open_[-1][0] in HEADINGS:
            close(len(open_) - 1)
        flush()
        if len(open_) <= DEPTH:
            node: list = [label, "1", []]
            open_[-1][1][2].append(node)
            open_.append((tag, node))
            if tag == "a":
                in_link = 1
    close(1)
    return root[2], texts


# ------------------------------------------------------------------ alignment


def _join_quantifiers(a: str, b: str) -> str:
    many = "+" in (a, b) or "*" in (a, b)
    maybe = "?" in (a, b) or "*" in (a, b)
    return ("*" if maybe else "+") if many else ("?" if maybe else "1")


def _optional(node: list) -> list:
    node[1] = {"1": "?", "+": "*"}.get(node[1], node[1])
    return node


def _repeated(node: list) -> list:
    node[1] = {"1": "+", "?": "*"}.get(node[1], node[1])
    return node


def _key(node: list) -> str:
    return node[0] if node[0] != GROUP else f"({' '.join(map(_key, node[2]))})"


class Aligner:
    """Alignment of node lists; ``texts`` joins the statistics of two texts that the
    expression makes one, within a page or of two pages."""

    def __init__(self, texts: Callable[[list, list], list]):
        self.texts = texts

    def one(self, a: list, b: list) -> list:
        quantifier = _join_quantifiers(a[1], b[1])
        if a[0] == TEXT:
            return [TEXT, quantifier, self.texts(a[2], b[2])]
        return [a[0], quantifier, self.lists(a[2], b[2])]

    def fold(self, nodes: list) -> list:
        """Runs of blocks that follow their like become repeated groups."""
        for size in range(1, PERIOD + 1):
            if len(nodes) < 2 * size:
                break
            keys, out, i = [_key(n) for n in nodes], [], 0
            while i < len(nodes):
                run = keys[i : i + size]
                if len(run) < size or run != keys[i + size : i + 2 * size]:
                    out.append(nodes[i])
                    i += 1
                    continue
                group = nodes[i : i + size]
                i += size
                while keys[i : i + size] == run:
                    group = [self.one(a, b) for a, b in zip(group, nodes[i : i + size])]
                    i += size
                out.append(_repeated(group[0] if size == 1 else [GROUP, "1", group]))
            nodes = out
        return nodes

    def tree(self, nodes: list) -> list:
        """Fold all levels, the inner ones first."""
        for n in nodes:
            if n[0] != TEXT:
                n[2] = self.tree(n[2])
        return self.fold(nodes)

    @staticmethod
    def regroup(nodes: list, other: list) -> list:
        """Runs of ``nodes`` that are one turn of a group of ``other`` become that group."""
        for group in [n for n in other if n[0] == GROUP]:
            run = [_key(n) for n in group[2]]
            keys, out, i = [_key(n) for n in nodes], [], 0
            while i < len(nodes):
                if keys[i : i + len(run)] == run:
                    out.append([GROUP, "1", nodes[i : i + len(run)]])
                    i += len(run)
                else:
                    out.append(nodes[i])
                    i += 1
            nodes = out
        return nodes

    @staticmethod
    def pairs(a: list, b: list) -> list[tuple[int, int, int]]:
        keys_a, keys_b = [_key(n) for n in a], [_key(n) for n in b]
        if keys_a == keys_b:
            return [(0, 0, len(a)), (len(a), len(b), 0)]
        return SequenceMatcher(None, keys_a, keys_b, autojunk=False).get_matching_blocks()

    def lists(self, a: list, b: list) -> list:
        """The expression of two lists: what matches is joined, the rest is optional."""
        a, b = self.regroup(a, b), self.regroup(b, a)
        out, i, j = [], 0, 0
        for x, y, n in self.pairs(a, b):
            out += [_optional(node) for node in a[i:x]] + [_optional(node) for node in b[j:y]]
            out += [self.one(p, q) for p, q in zip(a[x : x + n], b[y : y + n])]
            i, j = x + n, y + n
        return self.narrowed(self.fold(out))

    def narrowed(self, nodes: list) -> list:
        """A level with too many blocks loses the names of its labels, then the order."""
        if len(nodes) <= WIDE:
            return nodes
        for n in nodes:
            if n[0] not in (TEXT, GROUP):
                n[0] = f"{n[0].rsplit('|', 1)[0]}|"
        nodes = self.fold(nodes)
        if len(nodes) <= WIDE:
            return nodes
        by_key: dict[str, list] = {}
        for n in (m for n in nodes for m in (n[2] if n[0] == GROUP else [n])):
            n = _repeated(_optional(n))
            by_key[_key(n)] = self.one(by_key[_key(n)], n) if _key(n) in by_key else n
        return list(by_key.values())


def leaves(nodes: list) -> Iterator[list]:
    for n in nodes:
        if n[0] == TEXT:
            yield n
        else:
            yield from leaves(n[2])


def match(wrapper: list, nodes: list, out: dict[int, int]) -> None:
    """For the texts of a page's ``nodes`` (by identity of their statistics) the number that
    the wrapper's text has. A block out of order goes with the first of its label."""
    nodes, wrapper = Aligner.regroup(nodes, wrapper), Aligner.regroup(wrapper, nodes)
    alike, used = [], set()
    for x, y, n in Aligner.pairs(wrapper, nodes):
        alike += list(zip(wrapper[x : x + n], nodes[y : y + n]))
        used |= set(range(y, y + n))
    if len(used) < len(nodes):
        known: dict[str, list] = {}
        for n in (m for w in wrapper for m in ([w, *w[2]] if w[0] == GROUP else [w])):
            known.setdefault(_key(n), n)
            if n[0] != GROUP and n[0] != TEXT:
                known.setdefault(f"{n[0].rsplit('|', 1)[0]}|", n)
        for k, n in enumerate(nodes):
            if k not in used:
                for m in n[2] if n[0] == GROUP and _key(n) not in known else [n]:
                    bare = f"{m[0].rsplit('|', 1)[0]}|" if m[0] not in (TEXT, GROUP) else m[0]
                    if w := known.get(_key(m)) or known.get(bare):
                        alike.append((w, m))
    for w, n in alike:
        if n[0] == TEXT:
            out[id(n[2])] = w[2]
        else:
            match(w[2], n[2], out)


# ------------------------------------------------------------------ which slots are the article


def article_slots(nodes: list, pages: int, differ: bool) -> list[bool]:
    """For every text of a wrapper whether it is main text. A text's statistics are
    ``[pages, hash or None, characters, characters in links]``."""
    flat: list[dict] = []

    def walk(nodes: list, path: list[list]) -> None:
        for n in nodes:
            if n[0] == TEXT:
                flat.append({"stats": n[2], "path": path})
            else:
                walk(n[2], [*path, n])

    walk(nodes, [])
    kinds = lambda path: [(n[0].split("|") if n[0] != GROUP else ["", "", ""]) for n in path]
    holds_article: set[int] = set()
    for leaf in flat:
        path, kind = leaf["path"], kinds(leaf["path"])
        last = max((k for k, x in enumerate(kind) if x[1] == "M"), default=-1)
        holds_article |= {id(n) for n in path[:last]}

    def usual(leaf: dict, names: bool) -> bool:
        n, same, _, _ = leaf["stats"]
        if differ and same is not None and n >= 3 and 2 * n >= pages:
            return False  # the template's own text
        heading = any(x[0] in HEADINGS for x in kinds(leaf["path"]))
        article = False
        for node, (tag, kind, _) in zip(leaf["path"], kinds(leaf["path"])):
            article |= kind == "M"
            by_tag = tag in ASIDE_TAGS or tag == "header"
            if by_tag or (names and id(node) not in holds_article):
                if kind == "A" or (kind == "H" and not (article and heading)):
                    return False
        return True

    chosen: list[dict] = []
    for names in (True, False):
        chosen = [leaf for leaf in flat if usual(leaf, names)]
        if chosen:
            break
    weight: dict[int, int] = {}
    node_of: dict[int, list] = {}
    for leaf in chosen:
        plain = leaf["stats"][2] - leaf["stats"][3]
        for n in leaf["path"]:
            weight[id(n)] = weight.get(id(n), 0) + plain
            node_of[id(n)] = n
    marked = [i for i in weight if "|M|" in node_of[i][0] and weight[i]]
    region = None
    if marked:
        most = max(weight[i] for i in marked)
        depth = {i: next(k for leaf in chosen for k, n in enumerate(leaf["path"]) if id(n) == i) for i in marked}
        region = max((i for i in marked if 5 * weight[i] >= 4 * most), key=lambda i: (depth[i], weight[i]))
        inside = lambda leaf: any(id(n) == region for n in leaf["path"])
        titled = any(n[0].startswith("h1|") for leaf in chosen if inside(leaf) for n in leaf["path"])
        keep = {
            id(leaf)
            for leaf in chosen
            if inside(leaf)
            or (
                not titled
                and any(n[0].startswith("h1|") for n in leaf["path"])
                and any("|M|" in n[0] for n in leaf["path"])
            )
        }
    else:
        # The innermost container that still holds most of the text outside links.
        level, everything = 0, sum(leaf["stats"][2] - leaf["stats"][3] for leaf in chosen)
        inside_all = chosen
        while True:
            parts = {id(leaf["path"][level]) for leaf in inside_all if len(leaf["path"]) > level}
            parts = {i for i in parts if node_of[i][0].split("|")[0] in ("div", "section", "table", "tbody", "tr", "td", "center", GROUP)}
            best = max(parts, key=lambda i: weight[i], default=None)
            if best is None or 5 * weight[best] < 4 * everything:
                break
            inside_all = [x for x in inside_all if len(x["path"]) > level and id(x["path"][level]) == best]
            everything, level = weight[best], level + 1
        keep = {id(x) for x in inside_all if 2 * x["stats"][3] <= x["stats"][2]}
    return [id(leaf) in keep for leaf in flat]


# ------------------------------------------------------------------ tasks


def _in_page(a: list, b: list) -> list:
    """One text of a page for several: all their numbers."""
    return [*a, *b]


def _over_pages(a: list, b: list) -> list:
    return [a[0] + b[0], a[1] if a[1] == b[1] else None, a[2] + b[2], a[3] + b[3]]


def _in_wrapper(a: list, b: list) -> list:
    """As ``_over_pages``, but of two places that pages may have at the same time."""
    return [max(a[0], b[0]), a[1] if a[1] == b[1] else None, a[2] + b[2], a[3] + b[3]]


class _Wrappers(Aligner):
    """Alignment of pages: what folds together later on counts a page once."""

    def __init__(self) -> None:
        super().__init__(_over_pages)

    def fold(self, nodes: list) -> list:
        self.texts = _in_wrapper
        try:
            return super().fold(nodes)
        finally:
            self.texts = _over_pages


def _number(text: str) -> int:
    return zlib.crc32(text.encode()) << 32 | zlib.adler32(text.encode())


_PAGE = Aligner(_in_page)


def folded(source: str, labels: dict) -> tuple[list, list[str]]:
    """A page's folded nodes, each text's statistics three numbers per block text."""
    nodes, texts = parse(source, labels)
    return _PAGE.tree(nodes), texts


def skeleton(nodes: list) -> str:
    bare = lambda nodes: [[n[0], n[1], [] if n[0] == TEXT else bare(n[2])] for n in nodes]
    return json.dumps(bare(nodes), separators=(",", ":"))


ROWS = "host string, bucket int, stream string, pages long, low long, high long, same array<long>, chars array<long>, links array<long>"


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per host and different stream of some pages."""
    held: dict[tuple[str, str], list] = {}
    labels: dict = {}
    names = [c.split()[0] for c in ROWS.split(", ")]

    def rows() -> pa.RecordBatch:
        out = [[h, zlib.crc32(s.encode()) % BUCKETS, s, *v] for (h, s), v in held.items()]
        kinds = [pa.string(), pa.int32(), pa.string(), *[pa.int64()] * 3, *[pa.list_(pa.int64())] * 3]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out), kinds)], names
        )

    for batch in batches:
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            nodes, texts = folded(source or "", labels)
            digest = _number(source or "") - (1 << 63)
            stats = [n[2] for n in leaves(nodes)]
            same = [_number(texts[s[0]]) - (1 << 63) if len(s) == 3 else None for s in stats]
            chars = [sum(s[1::3]) for s in stats]
            links = [sum(s[2::3]) for s in stats]
            key = host, skeleton(nodes)
            v = held.get(key)
            if v is None:
                held[key] = [1, digest, digest, same, chars, links]
            else:
                v[0] += 1
                v[1], v[2] = min(v[1], digest), max(v[2], digest)
                v[3] = [x if x == y else None for x, y in zip(v[3], same)]
                v[4] = [x + y for x, y in zip(v[4], chars)]
                v[5] = [x + y for x, y in zip(v[5], links)]
        if len(held) >= HELD:
            yield rows()
            held.clear()
    if held:
        yield rows()


class _Growing:
    """The wrapper of the streams met so far."""

    def __init__(self) -> None:
        self.nodes: list | None = None
        self.pages, self.low, self.high = 0, 1 << 63, -(1 << 63)

    def add(self, nodes: list, pages: int, low: int, high: int) -> None:
        self.nodes = nodes if self.nodes is None else _Wrappers().lists(self.nodes, nodes)
        self.pages += pages
        self.low, self.high = min(self.low, low), max(self.high, high)


PARTIAL = "host string, bucket int, wrapper string, pages long, low long, high long"


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by host, bucket and stream to one wrapper per host and bucket."""
    names = [c.split()[0] for c in PARTIAL.split(", ")]
    at, stream, row, grown = None, None, None, _Growing()

    def add() -> None:
        nodes = json.loads(stream)
        for n, *stats in zip(leaves(nodes), row["same"], row["chars"], row["links"]):
            n[2] = [row["pages"], *stats]
        grown.add(nodes, row["pages"], row["low"], row["high"])

    def done() -> pa.RecordBatch:
        wrapper = json.dumps(grown.nodes, separators=(",", ":"))
        values = [*at, wrapper, grown.pages, grown.low, grown.high]
        return pa.RecordBatch.from_pylist(
            [dict(zip(names, values))],
            pa.schema(list(zip(names, [pa.string(), pa.int32(), pa.string(), *[pa.int64()] * 3]))),
        )

    for batch in batches:
        for new in batch.to_pylist():
            key = new["host"], new["bucket"]
            if key == at and new["stream"] == stream:
                for c in ("chars", "links"):
                    row[c] = [x + y for x, y in zip(row[c], new[c])]
                row["same"] = [x if x == y else None for x, y in zip(row["same"], new["same"])]
                row["pages"] += new["pages"]
                row["low"], row["high"] = min(row["low"], new["low"]), max(row["high"], new["high"])
                continue
            if at is not None:
                add()
            if key != at:
                if at is not None:
                    yield done()
                at, grown = key, _Growing()
            stream, row = new["stream"], new
    if at is not None:
        add()
        yield done()


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial wrappers sorted by host and bucket to one wrapper per host, whose texts hold
    whether they are main text."""

    def done(host: str, grown: _Growing) -> pa.RecordBatch:
        flags = article_slots(grown.nodes, grown.pages, grown.low != grown.high)
        for n, flag in zip(leaves(grown.nodes), flags):
            n[2] = int(flag)
        wrapper = json.dumps(grown.nodes, separators=(",", ":"))
        return pa.RecordBatch.from_arrays(
            [pa.array([host], pa.string()), pa.array([wrapper], pa.string())], ["host", "wrapper"]
        )

    at, grown = None, _Growing()
    for batch in batches:
        for row in batch.to_pylist():
            if row["host"] != at:
                if at is not None:
                    yield done(at, grown)
                at, grown = row["host"], _Growing()
            grown.add(json.loads(row["wrapper"]), row["pages"], row["low"], row["high"])
    if at is not None:
        yield done(at, grown)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    labels: dict = {}
    wrappers: dict[str, list] = {}
    flags: dict[tuple[str, str], list[int]] = {}
    for batch in batches:
        out = []
        for source, wrapper in zip(batch.column("html").to_pylist(), batch.column("wrapper").to_pylist()):
            nodes, texts = folded(source or "", labels)
            key = wrapper, skeleton(nodes)
            if key not in flags:
                if len(flags) > HELD:
                    flags.clear()
                    wrappers.clear()
                if wrapper not in wrappers:
                    wrappers[wrapper] = json.loads(wrapper)
                found: dict[int, int] = {}
                match(wrappers[wrapper], nodes, found)
                flags[key] = [found.get(id(n[2]), 0) for n in leaves(nodes)]
            mine = [k for n, flag in zip(leaves(nodes), flags[key]) if flag for k in n[2][::3]]
            out.append(" ".join(texts[k] for k in sorted(mine)))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"),
                batch.column("url"),
                pa.array(out, pa.string()),
                pa.array([len(t) for t in out], pa.int64()),
            ],
            ["page_id", "url", "text", "n_chars"],
        )


def wrappers(pages: DataFrame) -> DataFrame:
    """``host, wrapper`` of ``pages(host, html)``."""
    streams = pages.select("host", "html").mapInArrow(_streams, ROWS)
    partial = (
        streams.repartition("host", "bucket")
        .sortWithinPartitions("host", "bucket", "stream")
        .mapInArrow(_partial, PARTIAL)
    )
    return staged(
        partial.repartition("host")
        .sortWithinPartitions("host", "bucket")
        .mapInArrow(_finished, "host string, wrapper string"),
        "wrappers",
    )


def main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``.

    ``text`` joins the page's block texts that its host's wrapper has as article, in their order, by one
    space; white space inside a block is one space, character references are decoded, inline tags
    leave no trace, ``<br>`` is white space. Without tags the whole text is one block.

    A null or empty page, or one without main text, has an empty text. Pages without a host
    (null url, no ``://``) count as pages of one host with an empty name. A host with one page, or whose
    pages are all equal, has no template text: names and lengths of its blocks decide. Repeated rows
    and ids come out as often as they came in; an empty table gives an empty result; other columns
    are not read.
    """
    pages = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"),
        F.col(f"`{url_col}`").alias("url"),
        F.col(f"`{html_col}`").alias("html"),
        host_of(F.col(f"`{url_col}`")).alias("host"),
    )
    found = wrappers(pages)
    return (
        pages.join(found, "host")
        .select("page_id", "url", "html", "wrapper")
        .mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
    )
