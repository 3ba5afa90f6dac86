"""Main text of web pages by wrappers: expressions inferred from the pages of a host.

A page is a stream of tokens: the opening and closing tags of its blocks, and text.  Marks inside text
(bold, links, line breaks) and end tags that HTML lets authors leave out are no tokens.  A wrapper is a union-free
regular expression over tokens: literals, text slots, optional groups and repeated groups.

Inference is iterative.  A page's own runs of equal groups become repeated groups first; then the
wrapper so far and the next page are aligned: equal parts stay; texts that differ become a slot; a repeated
group meets one or more of its like; what only one side has becomes an optional group.  Wrappers
align with each other in the same way, so a host's pages are dealt into shares, each share makes a wrapper, and
these are aligned again until the host has one.  Every page takes part.

A host has one wrapper for each template.  Pages are of one template if the same element (its path, without
ids and numbers) holds half of their text.

Extraction matches each page with its template's wrapper.  A page's article or main element is its main part,
and all text in it counts, literals too, but for menus, adverts, forms, comments and the like.  Where only a part
of a class or id speaks for furniture (``side-effects``), the wrapper decides: what it has as a literal is furniture,
what changes from page to page is text.  On pages without such an element, text that the wrapper has as a
literal is furniture, so are slots inside menus, headers, footers, sidebars, notices, adverts, forms and comments, and
the main text is in the element whose slots hold most of the text that changes from page to page.
"""

import html as markup
import json
import re
from collections import Counter
from difflib import SequenceMatcher
from functools import lru_cache
from hashlib import blake2b
from operator import add, eq
from urllib.parse import urlsplit

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from turnout.llm.tables import checked_broadcast, rows_of, stored

LITERAL_PAGES = 3  # a text is constant only if so many different pages have it
SENT_BYTES = 32 << 20  # wrappers of this size together are sent to all executors, larger ones are joined
SHARE = 50  # pages or wrappers that one task aligns one after another
SLOT = "#text"

#: Elements of HTML by how they behave.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q "
    "s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = frozenset("script style noscript template iframe object svg math canvas audio video".split())
IMPLIED = frozenset("p li dt dd tr td th option thead tbody tfoot colgroup rt rp".split())
FURNITURE_TAGS = frozenset(
    "head nav header footer aside form button select textarea fieldset dialog menu title".split()
)
MAIN_TAGS = ("article", "main")
#: What an opening block ends, if it is still open: paragraphs end at any block.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th"),
    "tfoot": ("tbody", "tr", "td", "th"),
}
CONTAINERS = frozenset("ul ol dl table select".split())  # an end implied outside does not reach in

_FURNITURE_NAMES = re.compile(
    r"(?:^|[-_ ])(?:ad|ads|advert|adverts|advertisement|advertising|banner|sponsor|sponsored|promo|promotion|"
    r"cookie|cookies|consent|gdpr|notice|notices|alert|popup|modal|newsletter|subscribe|signup|login|"
    r"nav|navbar|navigation|menu|breadcrumb|breadcrumbs|sidebar|side|widget|related|share|sharing|social|"
    r"footer|foot|header|masthead|topbar|toolbar|comment|comments|respond|discussion|reply|replies|pagination|pager"
    r")(?:$|[-_ ])"
)
#: Inside the main part, names that speak for furniture also as a part of a longer one, and such that do not even alone.
_STRONG_PARTS = frozenset(
    "advert advertisement advertising sponsored cookie cookies newsletter navbar navigation breadcrumb breadcrumbs "
    "sidebar related comment comments pagination".split()
)
_AMBIGUOUS = frozenset("discussion side foot".split())
_FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu".split())
_NUMBER = re.compile(r"\d+")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
_SPACE = re.compile(r"\s+")


def host_of(url: str | None) -> str:
    """The host of an address in lower case, without port; empty if there is none."""
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


@lru_cache(1 << 14)
def _label(tag: str, attributes: str) -> str:
    """A tag with its class and role, and what in its id tells furniture from text.

    Ids and numbers differ from page to page, so that labels with them would not align.
    """
    found = dict((k.lower(), v.strip("\"'").lower()) for k, v in reversed(_ATTRIBUTE.findall(attributes)))
    name = _FURNITURE_NAMES.search(found.get("id", ""))
    found["id"] = name[0].strip("-_ ") if name else ""
    found["class"] = _NUMBER.sub("#", found.get("class", ""))
    parts = [f"{k}={_SPACE.sub(' ', found[k])}" for k in ("class", "id", "role") if found.get(k)]
    return " ".join([tag, *parts])


@lru_cache(1 << 14)
def is_furniture(label: str) -> bool:
    tag, *names = re.split(r" (?=(?:class|id|role)=)", label)
    if tag in FURNITURE_TAGS:
        return True
    values = dict(n.split("=", 1) for n in names)
    return values.get("role") in _FURNITURE_ROLES or (tag not in (*MAIN_TAGS, "body", "html") and any(
        _FURNITURE_NAMES.search(values.get(k, "")) for k in ("class", "id")
    ))


@lru_cache(1 << 14)
def _inside_main(label: str) -> bool | None:
    """Whether an element inside the main part is furniture; None if only the wrapper can tell."""
    tag, *names = re.split(r" (?=(?:class|id|role)=)", label)
    values = dict(n.split("=", 1) for n in names)
    if tag in FURNITURE_TAGS or values.get("role") in _FURNITURE_ROLES:
        return True
    if tag in MAIN_TAGS:
        return False
    unsure = False
    for token in f"{values.get('class', '')} {values.get('id', '')}".split():
        if _FURNITURE_NAMES.search(token):
            whole = _FURNITURE_NAMES.fullmatch(token) and token not in _AMBIGUOUS
            if whole or not _STRONG_PARTS.isdisjoint(re.split("[-_]", token)):
                return True
            unsure = True
    return None if unsure else False


def events(page: str):
    """("open", label), ("close", tag) and ("text", raw) of a page; a tag closes what it implies."""
    stack = []
    at = 0

    def close(tag):
        while stack:
            top = stack.pop()
            yield "close", top
            if top == tag:
                return

    size = len(page)
    while at < size:
        found = _TOKEN.search(page, at)
        if not found:
            yield "text", page[at:]
            break
        if found.start() > at:
            yield "text", page[at : found.start()]
        at = found.end()
        if found[2] is None:
            continue  # a comment or declaration
        tag, ends = found[2].lower(), bool(found[1])
        if not ends and tag in UNREAD:
            if not found[3].rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = end.end() if end else size
            yield "mark", tag
        elif tag in INLINE:
            yield "mark", tag
        elif ends:
            if tag in stack:
                yield from close(tag)
        else:
            ending = ENDS.get(tag, ("p",)) if tag in ENDS else ("p",)
            inner = []
            for open_tag in reversed(stack):
                if open_tag in CONTAINERS:
                    break
                inner.append(open_tag)
            outermost = next((t for t in reversed(inner) if t in ending), None)
            if outermost:
                yield from close(outermost)
            yield "open", _label(tag, found[3])
            if tag in VOID:
                yield "close", tag
            else:
                stack.append(tag)
    while stack:
        yield "close", stack.pop()


def clean(raw: str) -> str:
    return " ".join(markup.unescape(raw).split())


# --- wrappers -------------------------------------------------------------
# A node is [kind, value, children, seen]: "open"/"close" with a label, "text" with the
# constant text (its digest, if it is long) or SLOT, "many" (repeated) and "maybe" (optional) with children.  For
# texts, ``seen`` is [letters, pages, numbers of the page's blocks].


def read(page: str) -> tuple[list, list]:
    """The page's nodes, and (path, text) of each block; the path is the labels of the elements around it."""
    nodes, found = [], []
    path, parts = [], []

    def text():
        if parts and (block := clean("".join(parts))):
            value = block if len(block) <= 80 else f"#{blake2b(block.encode('utf-8', 'replace'), digest_size=12).hexdigest()}"
            nodes.append(["text", value, [], [len(block), 1, [len(found)]]])
            found.append((tuple(path), block))
        parts.clear()

    for kind, value in events(page):
        if kind == "text":
            parts.append(value)
        elif kind == "mark":
            parts.append(" " if value == "br" else "")
        else:
            text()
            if kind == "open":
                path.append(value)
                nodes.append(["open", value, [], 0])
            elif path and (label := path.pop()).split(" ")[0] not in IMPLIED:
                nodes.append(["close", label, [], 0])
    text()
    return fold(nodes), found


def page_nodes(page: str) -> list:
    """The page as nodes, runs of equal groups folded."""
    return read(page)[0]


def _without_blocks(nodes: list) -> list:
    return [[k, v, _without_blocks(c), [*seen[:2], []] if k == "text" else 0] for k, v, c, seen in nodes]


def template(found: list) -> str:
    """What tells a host's templates apart: the path of the innermost element with half of the letters."""
    letters, total = Counter(), 0
    for path, text in found:
        if any(map(is_furniture, path)):
            continue
        total += len(text)
        for depth in range(1, len(path) + 1):
            if path[depth - 1].split(" ")[0] not in IMPLIED:
                letters[path[:depth]] += len(text)
    half = [p for p, n in letters.items() if 2 * n >= total]
    return " > ".join(max(half, key=lambda p: (len(p), letters[p], p))) if half else ""


def shape(node: list) -> str:
    """What a node looks like, whatever its texts say."""
    kind, value, children, _ = node
    if kind == "text":
        return SLOT
    if children:
        return f"{kind}({' '.join(map(shape, children))})"
    return f"{kind} {value}"


def _merge(one: list, other: list, pages=max) -> list:
    """Two nodes of the same shape as one, of the same pages or (``pages=add``) of others."""
    kind, value, children, seen = one
    if kind == "text":
        more = other[3]
        both = [seen[0] + more[0], pages(seen[1], more[1]), seen[2] + more[2]]
        return [kind, value if value == other[1] else SLOT, [], both]
    return [kind, value, [_merge(a, b, pages) for a, b in zip(children, other[2], strict=True)], 0]


def fold(nodes: list, longest: int = 12) -> list:
    """Turn runs of equal groups of up to ``longest`` nodes into repeated groups, short groups first."""
    shaped = None
    for size in range(1, longest + 1):
        if nodes is not shaped:
            shapes, shaped = [shape(n) for n in nodes], nodes
        if not any(map(eq, shapes, shapes[size:])):
            continue
        out, at = [], 0
        while at < len(nodes):
            run = at + size
            while shapes[run : run + size] == shapes[at : at + size] and len(shapes[run : run + size]) == size:
                run += size
            group = nodes[at : at + size]
            if run > at + size and size == 1 and group[0][0] == "many":
                for again in range(at + 1, run):
                    group = [_merge(group[0], nodes[again])]
                out += group
                at = run
            elif run > at + size and any(n[0] == "open" for n in group):
                for again in range(at + size, run, size):
                    group = [_merge(a, b) for a, b in zip(group, nodes[again : again + size], strict=True)]
                out.append(["many", "", group, 0])
                at = run
            else:
                out.append(nodes[at])
                at += 1
        nodes = out
    return nodes


def _key(node: list) -> str:
    """Nodes of equal keys can be aligned: a group with its like, once or often, always or at times."""
    kind, _, children, _ = node
    if kind in ("many", "maybe"):
        return " ".join(map(_key, children))
    return shape(node)


def _joined(one: list, other: list) -> list:
    """Two nodes of equal keys as one."""
    if one[0] in ("many", "maybe") or other[0] in ("many", "maybe"):
        kinds = {one[0], other[0]}
        inner = [n[2] if n[0] in ("many", "maybe") else [n] for n in (one, other)]
        children = align(*inner)
        node = ["many", "", children, 0] if "many" in kinds else ["maybe", "", children, 0]
        if kinds == {"many", "maybe"}:
            return ["maybe", "", [node], 0]
        return node
    return _merge(one, other, add)


def _groups(nodes: list) -> list[tuple[str, list]]:
    """The repeated and optional groups among the nodes: kind, and the keys of what is in them."""
    found = []
    for n in nodes:
        while n[0] == "maybe" and len(n[2]) == 1 and n[2][0][2]:
            n = n[2][0]
        if n[2]:
            found.append((n[0], [_key(c) for c in n[2]]))
    return found


def _gathered(nodes: list, groups: list[tuple[str, list]]) -> list:
    """Nodes with each run of what the other side has as a group made such a group too."""
    own = [_key(n) for n in nodes]
    for kind, keys in groups:
        size, first = len(keys), keys[0]
        if first not in own:
            continue
        out, kept, at = [], [], 0
        while at < len(nodes):
            if own[at] == first and own[at : at + size] == keys and not (size == 1 and nodes[at][2]):
                out.append([kind, "", nodes[at : at + size], 0])
                kept.append(" ".join(keys))
                at += size
            else:
                out.append(nodes[at])
                kept.append(own[at])
                at += 1
        nodes, own = out, kept
    return fold(nodes, 1)


def align(one: list, other: list) -> list:
    """One list of nodes that matches what either matches."""
    one, other = _gathered(one, _groups(other)), _gathered(other, _groups(one))
    a, b = [_key(n) for n in one], [_key(n) for n in other]
    out = []
    for op, a0, a1, b0, b1 in SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
        if op == "equal":
            out += [_joined(x, y) for x, y in zip(one[a0:a1], other[b0:b1], strict=True)]
            continue
        for rest in (one[a0:a1], other[b0:b1]):
            if not rest:
                continue
            if all(n[0] == "maybe" for n in rest):
                out += rest
            elif len(rest) == 1 and rest[0][0] == "maybe":
                out.append(rest[0])
            else:
                flat = [m for n in rest for m in (n[2] if n[0] == "maybe" else [n])]
                out.append(["maybe", "", flat, 0])
    return out


def infer(pages: list[list]) -> list:
    """Align wrappers or pages one after another."""
    wrapper = pages[0]
    for page in pages[1:]:
        wrapper = align(wrapper, page)
    return wrapper


class Prepared:
    """A wrapper with what matching needs of it, kept for pages with the same groups."""

    def __init__(self, nodes: list):
        self.nodes, self.groups, self.forms, self.inner = nodes, _groups(nodes), {}, {}

    def gathered(self, groups: list) -> tuple[list, SequenceMatcher]:
        """Its nodes with the groups of a page, and a matcher that has looked through their keys."""
        name = str(groups)
        if name not in self.forms:
            if len(self.forms) >= 64:
                self.forms.clear()
                self.inner.clear()
            nodes = _gathered(self.nodes, groups)
            self.forms[name] = nodes, SequenceMatcher(None, (), [_key(n) for n in nodes], autojunk=False)
        return self.forms[name]

    def below(self, node: list) -> "Prepared":
        """The nodes inside one of its nodes; ``node`` is kept, so that its identity stays its own."""
        if id(node) not in self.inner:
            self.inner[id(node)] = node, Prepared(node[2] or [node])
        return self.inner[id(node)][1]


def match(page: list, wrapper: Prepared) -> dict[int, list]:
    """The wrapper's text node for each block of the page that has one."""
    one = _gathered(page, wrapper.groups)
    other, matcher = wrapper.gathered(_groups(page))
    matcher.set_seq1([_key(n) for n in one])
    found = {}
    for at, to, size in matcher.get_matching_blocks():
        for x, y in zip(one[at : at + size], other[to : to + size], strict=True):
            if x[2] or y[2]:
                found |= match(x[2] or [x], wrapper.below(y))
            elif x[0] == "text":
                found |= dict.fromkeys(x[3][2], y)
    return found


def _is_literal(node: list | None, pages: int = LITERAL_PAGES) -> bool:
    return node is not None and node[1] != SLOT and node[3][1] >= pages


def _main_part(slots: list) -> tuple:
    """The path of the innermost element that holds nearly all of the changing text."""
    letters = Counter()
    for path, seen in slots:
        for depth in range(1, len(path) + 1):
            if path[depth - 1].split(" ")[0] not in IMPLIED:
                letters[path[:depth]] += seen
    most = max(letters.values(), default=0)
    return max((p for p in letters if letters[p] >= 0.9 * most), key=lambda p: (len(p), p), default=())


def _is_main(label: str, tag: str) -> bool:
    return label.split(" ")[0] == tag or (tag == "main" and "role=main" in label.split(" "))


def _main_blocks(found: list, matched: dict, tag: str) -> list[str]:
    """The text in the elements of a tag that are not furniture themselves."""
    out = []
    for i, (path, text) in enumerate(found):
        at = next((d for d, label in enumerate(path) if _is_main(label, tag)), None)
        if at is None or any(map(is_furniture, path[:at])):
            continue
        kinds = set(map(_inside_main, path[at + 1 :]))
        if True in kinds or None in kinds and _is_literal(matched.get(i), 2):
            continue
        out.append(text)
    return out


def extract(page: str | None, wrappers: dict[str, tuple[int, Prepared]] | None = None) -> str:
    """The blocks of the main part, without furniture, joined by blank lines.

    ``wrappers`` holds the number of pages and the prepared wrapper for each template of the host.  A template of too
    few pages to tell literals is matched with the host's most frequent one.  A page of nothing but literals keeps them.
    """
    nodes, found = read(page or "")
    wrappers = wrappers or {}
    _, wrapper = own = wrappers.get(template(found), (0, None))
    if own[0] < LITERAL_PAGES and wrappers:
        wrapper = wrappers[max(wrappers, key=lambda t: (wrappers[t][0], t))][1]
    matched = match(nodes, wrapper) if wrapper else {}
    for tag in MAIN_TAGS:
        if inside := _main_blocks(found, matched, tag):
            return "\n\n".join(inside)
    # How far a block's slot speaks for its element: by the letters of all pages; a slot is counted once.
    kept, seen = [], set()
    for i, (path, text) in enumerate(found):
        if not any(map(is_furniture, path)):
            node = matched.get(i)
            new = node is None or id(node) not in seen
            seen.add(id(node))
            kept.append((path, text, _is_literal(node), (node[3][0] if node else len(text)) if new else 0))
    kept = [k for k in kept if not k[2]] or kept
    # Without other pages to compare with, all that is no furniture.
    main = _main_part([(path, letters) for path, _, _, letters in kept]) if matched and own[0] > 1 else ()
    return "\n\n".join(text for path, text, *_ in kept if path[: len(main)] == main)


# --- on tables ------------------------------------------------------------

WRAPPERS = "host string, template string, share long, pages long, wrapper string"


def _parsed(batches):
    """A row for each page: its host, its template, its nodes as a wrapper of one page, and a hash of all of it."""
    for batch in batches:
        out = []
        for host, html in rows_of(batch, "host", "html"):
            if html:
                nodes, found = read(html)
                texts = blake2b(json.dumps(found).encode(), digest_size=8).digest()
                out.append((host, template(found), int.from_bytes(texts, "big", signed=True), 1,
                            json.dumps(_without_blocks(nodes), ensure_ascii=False, separators=(",", ":"))))
        columns = zip(*out, strict=True) if out else [[]] * 5
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)],
            ["host", "template", "share", "pages", "wrapper"],
        )


def _joined_wrappers(rows: pd.DataFrame) -> pd.DataFrame:
    wrapper = infer([json.loads(w) for w in sorted(rows["wrapper"])])
    one = rows.iloc[:1][["host", "template", "share"]].copy()
    one["pages"] = rows["pages"].sum()
    one["wrapper"] = json.dumps(wrapper, ensure_ascii=False, separators=(",", ":"))
    return one


def host_wrappers(pages: DataFrame) -> DataFrame:
    """``host``, ``template``, ``pages`` and ``wrapper``: one row for each template, from ``host`` and ``html``.

    Pages of the same blocks are one.  A template's pages are dealt into shares of about SHARE, so that a host
    with a third of all pages is spread over many tasks; each round then aligns SHARE wrappers into one.
    """
    parsed = stored(
        pages.select("host", "html").mapInArrow(_parsed, WRAPPERS).dropDuplicates(["host", "template", "share"])
    )
    sizes = stored(parsed.groupBy("host", "template").agg(F.count("*").alias("size")))
    shares = -(-(sizes.agg(F.max("size")).first()[0] or 1) // SHARE)
    wrappers = parsed.join(checked_broadcast(sizes), ["host", "template"]).withColumn(
        "share", F.expr(f"pmod(share, (size + {SHARE} - 1) div {SHARE})")
    ).drop("size")
    while True:
        wrappers = stored(
            wrappers.groupBy("host", "template", "share").applyInPandas(_joined_wrappers, WRAPPERS)
        )
        if shares == 1:
            return wrappers.drop("share")
        shares = -(-shares // SHARE)
        wrappers = wrappers.withColumn("share", F.expr(f"pmod(share, {shares}L)"))


def _texts(batches):
    host = read_wrappers = None
    for batch in batches:
        out = []
        for i, u, h, own, rows in rows_of(batch, "page_id", "url", "html", "host", "wrappers"):
            if host != own or read_wrappers is None:
                host = own
                read_wrappers = {
                    r["template"]: (r["pages"], Prepared(json.loads(r["wrapper"]))) for r in rows or []}
            out.append((i, u, extract(h, read_wrappers)))
        ids, urls, texts = zip(*out, strict=True) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(texts, pa.string()),
             pa.array(list(map(len, texts)), pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` for each row of ``pages``.

    Character references are decoded, white space inside a block is one space, and blocks are
    joined in order by a blank line.  A null or empty page has an empty text.  Pages without a usable address
    share one wrapper.  Repeated rows and rows without an id are extracted one by one.  Other columns are
    ignored, pages are read whole, and an empty table gives no rows.
    """
    @F.pandas_udf("string")
    def host(urls):
        return urls.map(host_of)

    own = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")
    ).withColumn("host", host("url"))
    wrappers = stored(
        host_wrappers(own).groupBy("host")
        .agg(F.collect_list(F.struct("template", "pages", "wrapper")).alias("wrappers"))
    )
    size = wrappers.agg(F.sum(F.expr(
        "aggregate(wrappers, 0L, (n, w) -> n + octet_length(w.wrapper) + octet_length(w.template))"
    ))).first()[0] or 0
    return own.join(F.broadcast(wrappers) if size <= SENT_BYTES else wrappers, "host", "left").select(
        "page_id", "url", "html", "host", "wrappers"
    ).mapInArrow(_texts, "page_id long, url string, text string, n_chars long")
