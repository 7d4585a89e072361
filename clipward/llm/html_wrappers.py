"""Main text of web pages by wrappers that are inferred per host.

A page is a token stream of tags and texts. Streams of one host are aligned one after another into a
wrapper, a regular expression without alternatives: nested sequences whose members are required,
optional or repeated, with text slots. A tag that only one side has becomes optional; a tag that
comes again right after itself becomes repeated; tags that come in changing order become one
repeated group of optional members. A slot that held the same text on all of ``FIXED_PAGES`` pages or more is
fixed, any other is open; pages with the same longest text are one page here, so that copies of an article do not
make it fixed. Merging is a fold: tasks merge the pages they read, then salted groups merge the tasks' wrappers,
then hosts merge those.

The wrapper chooses the region: article elements, else main, else an element named as content, else
the body without fixed slots. Inside a region, whatever is named as navigation, header, footer, side
bar, notice, advert, form, script, style or comments is left out, and so are fixed slots that the
wrapper requires (no optional or repeated group around them up to the page). A page that has no text in
its host's best region falls back to the next; where only fixed slots are left, they are the text.

Class and id names leave out no body, main or article element and no element with a class of its own for content (unless
another class is itself such a name); nor one that holds the page's only article, main or content elements. A form
is a plain container where it holds the page's only article or main elements, or where nothing else has text.

Text: character references are decoded, white space inside a block becomes one space, blocks are
joined by one line break; ``br`` is white space. Nothing else is dropped or shortened.

Cases: null or empty html gives an empty text; a null or odd address is the host ''; unclosed and
unmatched tags are repaired as browsers do for the elements used here; wrappers describe
what is nested deeper than ``DEPTH`` as one flat sequence, texts are read at any depth; pages of one host with nothing in common still share
a wrapper of optional members; repeated rows get equal texts; empty tables give empty tables;
other columns are kept (an existing output column is replaced).
"""

from __future__ import annotations

import functools
import html as references
import itertools
import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipward.llm.frames import small_batches, stored
from clipward.llm.language import host_of

DEPTH = 150
FIXED_PAGES = 3
HOSTS_HELD = 2000
SALTS = 32
BROADCAST_BYTES = 8 << 20
SHARE_BYTES = 16 << 20  # html of one host in one group

OPTIONAL, REPEATED = 1, 2
TEXT = "#"

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noscript noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
IN_HEAD = frozenset("base link meta script style title noscript template".split())
CLOSED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
CONTAINERS = frozenset(
    "ul ol dl table article section div main body html nav aside footer header form".split()
)

SKIPPED = frozenset(
    "head script style noscript template iframe object embed svg canvas nav aside footer form button "
    "select textarea input menu dialog xmp noembed noframes title".split()
)
NAMED = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent "
    "gdpr notice notices banner alert ad ads adv advert adverts advertisement sponsor sponsored promo "
    "comment comments disqus respond share sharing social related newsletter subscribe popup modal "
    "login signup search pagination pager toolbar widget".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert".split())
WHOLE = frozenset("html body main article".split())  # never left out by class or id names
CONTENT = frozenset("content post entry article story".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"\shidden(?=[\s=/]|$)", re.I)
_DIGITS = re.compile(r"\d+")


def _label(tag: str, attributes: str) -> str:
    """Tag with its class, id and role names; digits do not count."""
    if not attributes.strip():
        return tag
    names = [
        f"{k.lower()[0] if k.lower() != 'role' else 'r'}:{_DIGITS.sub('', part).lower()}"
        for k, *values in _ATTRIBUTE.findall(attributes)
        for part in next((v for v in values if v), "").split()
    ]
    if _HIDDEN.search(attributes):
        names.append("hidden")
    return " ".join([tag, *sorted(names)])


@functools.lru_cache(maxsize=50_000)
def _kind(label: str) -> str:
    """skip, header, article, main, content, inline or block."""
    tag, *names = label.split(" ")
    if tag in SKIPPED or "hidden" in names:
        return "skip"
    values = {name[2:] for name in names if name[0] != "r"}
    named = tag not in WHOLE and (not values & CONTENT or bool(values & NAMED))
    for name in names:
        kind, _, value = name.partition(":")
        words = set(re.split(r"[-_]+", value))
        if (kind == "r" and value in ROLES) or (kind != "r" and named and words & NAMED):
            return "skip"
        if kind == "r" and value == "main":
            return "main"
    if tag in ("header", "article", "main"):
        return tag
    if tag in INLINE:
        return "inline"
    for name in names:
        if name[0] != "r" and set(re.split(r"[-_]+", name[2:])) & CONTENT:
            return "content"
    return "block"


def parse(page: str) -> list:
    """The page as [label, members]; a member is such a list or a text."""
    root = _parse(page)
    _unname(root)
    todo = [root]
    while todo:
        node = todo.pop()
        node[1] = _whole(node[1])
        todo += [m for m in node[1] if not isinstance(m, str)]
    return root


def _whole(members: list) -> list:
    """``members`` with neighbouring texts as one."""
    out: list = []
    for said, run in itertools.groupby(members, lambda m: isinstance(m, str)):
        out += ["".join(run)] if said else run
    return out


def _by_name(label: str) -> bool:
    """Left out for its class or id names only."""
    tag, *names = label.split(" ")
    others = " ".join([tag, *(n for n in names if n[:2] not in ("c:", "i:"))])
    return _kind(label) == "skip" and _kind(others) != "skip"


def _unname(root: list) -> None:
    """Where all regions are inside elements that names leave out, those lose their names."""
    held: list[list] = []
    todo: list[tuple[list, tuple]] = [(root, ())]
    while todo:
        node, around = todo.pop()
        kind = _kind(node[0])
        if kind == "skip":
            if not _by_name(node[0]) and node[0].split(" ", 1)[0] != "form":
                continue
            around = (node, around)
        elif kind in _ORDER:
            if not around:
                return
            if kind == "content" and any(n[0].split(" ", 1)[0] == "form" for n in _chain(around)):
                continue
            while around:
                held.append(around[0])
                around = around[1]
            continue
        todo += [(m, around) for m in node[1] if not isinstance(m, str)]
    for node in held:
        tag, *names = node[0].split(" ")
        tag = "div" if tag == "form" else tag
        node[0] = " ".join([tag, *(n for n in names if n[:2] not in ("c:", "i:"))])


def _chain(around: tuple) -> Iterator[list]:
    while around:
        yield around[0]
        around = around[1]


def _open_forms(root: list) -> bool:
    """Make all forms plain containers; whether there were any."""
    todo, found = [root], False
    while todo:
        node = todo.pop()
        if node[0].split(" ", 1)[0] == "form":
            node[0], found = "div" + node[0][4:], True
        todo += [m for m in node[1] if not isinstance(m, str)]
    return found


class _Open:
    """The open elements of a page, with the places of each tag and of containers."""

    def __init__(self, root: list) -> None:
        self.nodes = [root]
        self.tags = ["html"]
        self.places: dict[str, list[int]] = {}
        self.fences = [0]

    def add(self, tag: str, node: list) -> None:
        self.nodes[-1][1].append(node)
        self.places.setdefault(tag, []).append(len(self.nodes))
        if tag in CONTAINERS:
            self.fences.append(len(self.nodes))
        self.nodes.append(node)
        self.tags.append(tag)

    def cut(self, at: int) -> None:
        while len(self.nodes) > at:
            self.nodes.pop()
            self.places[self.tags.pop()].pop()
        while self.fences[-1] >= at:
            self.fences.pop()

    def place(self, tag: str) -> int:
        """Place of the innermost open element, 0 if there is none."""
        found = self.places.get(tag)
        return found[-1] if found else 0


def _parse(page: str) -> list:
    root: list = ["html", []]
    stack = _Open(root)
    at = 0
    while True:
        found = _TOKEN.search(page, at)
        end = found.start() if found else len(page)
        if end > at:
            said = page[at:end]
            if stack.tags[-1] == "head" and not said.isspace():
                stack.cut(len(stack.tags) - 1)
            stack.nodes[-1][1].append(said)
        if not found:
            return root
        at = found.end()
        tag = found[2] or found[5]
        if tag is None:
            continue
        tag, closing = tag.lower(), found[1] or found[4]
        if tag == "html":
            continue
        if closing:
            place = stack.place(tag)
            if place and (tag in CONTAINERS or place > stack.fences[-1]):
                stack.cut(place)
            continue
        label = _label(tag, found[3] or found[6] or "")
        if tag in RAW:
            close = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
            at = close.start() if close else len(page)
            continue
        if stack.tags[-1] == "head" and tag not in IN_HEAD:
            stack.cut(len(stack.tags) - 1)
        if tag in VOID:
            if tag == "br":
                stack.nodes[-1][1].append(" ")
            elif tag == "hr":
                stack.nodes[-1][1].append([label, []])
            continue
        if tag in INLINE:
            if _kind(label) == "skip":
                stack.add(tag, [label, []])
            elif stack.place(tag):
                # Its end tag must not close the marked element around it.
                stack.add(tag, [tag, []])
            continue
        if tag in CLOSED_BY:
            place = max(map(stack.place, CLOSED_BY[tag]))
            if place > stack.fences[-1]:
                stack.cut(place)
        elif stack.tags[-1] == "p":
            stack.cut(len(stack.tags) - 1)
        stack.add(tag, [label, []])


# ---------------------------------------------------------------- wrappers

# A wrapper is [label, fixed, items]; an item is [quantifier, members], more than one member being a
# repeated group of optional members. A slot is [#, fixed, [], pages]: ``fixed`` is its only text so far, as
# a hash, or null, ``pages`` the least hashes of longest texts of the pages that have it, at most FIXED_PAGES.


def own_wrapper(page: list) -> list:
    """The wrapper of one page's token stream."""
    wrapper = _own(page, 0)
    longest, todo = "", [page]
    while todo:
        node = todo.pop()
        if _kind(node[0]) != "skip":
            longest = max([longest, *(m for m in node[1] if isinstance(m, str))], key=len)
            todo += [m for m in node[1] if not isinstance(m, str)]
    key = _hash(longest)
    todo = [wrapper]
    while todo:
        node = todo.pop()
        if node[0] == TEXT:
            node[3] = [key] if node[1] is not None else []
        todo += [m for _, ms in node[2] for m in ms]
    return wrapper


def _hash(said: str) -> int:
    return xxhash.xxh64_intdigest(" ".join(references.unescape(said).split()))


def _flat(node: list) -> Iterator[list | str]:
    """All that is inside ``node``, in page order."""
    todo = node[1][::-1]
    while todo:
        member = todo.pop()
        yield member
        if not isinstance(member, str):
            todo += member[1][::-1]


def _own(node: list, depth: int) -> list:
    items: list = []
    for member in node[1] if depth < DEPTH else _flat(node):
        if isinstance(member, str):
            if not references.unescape(member).strip():
                continue
            inner = [TEXT, _hash(member), [], []]
        else:
            inner = _own(member, depth + 1) if depth < DEPTH else [member[0], None, []]
        _follow(items, inner)
    return [node[0], None, items]


def _place(items: list, label: str) -> int:
    return next((i for i, (_, ms) in enumerate(items) if any(m[0] == label for m in ms)), -1)


def _into(members: list, new: list) -> None:
    for i, member in enumerate(members):
        if member[0] == new[0]:
            members[i] = merge(member, new)
            return
    members.append(new)


def _group(items: list, a: int, b: int) -> None:
    """Items a .. b become one repeated group."""
    members: list = []
    for _, ms in items[a : b + 1]:
        for m in ms:
            _into(members, m)
    quantifier = REPEATED | (OPTIONAL if all(q & OPTIONAL for q, _ in items[a : b + 1]) else 0)
    items[a : b + 1] = [[quantifier, members]]


def _follow(items: list, new: list) -> None:
    """One more member of a page's own sequence."""
    at = _place(items, new[0])
    if at < 0:
        items.append([0, [new]])
        return
    if at < len(items) - 1:
        _group(items, at, len(items) - 1)
    items[at][0] |= REPEATED
    _into(items[at][1], new)


def merge(a: list, b: list) -> list:
    """The wrapper that both wrappers' pages match."""
    if a[0] == TEXT:
        if a[1] is None or a[1] != b[1]:
            return [TEXT, None, [], []]
        return [TEXT, a[1], [], sorted({*a[3], *b[3]})[:FIXED_PAGES]]
    items = [[q, list(ms)] for q, ms in a[2]]
    met: set[int] = set()  # identities of items that b has too
    last = -1
    for quantifier, members in b[2]:
        places = sorted({i for m in members if (i := _place(items, m[0])) >= 0})
        if not places:
            last += 1
            items.insert(last, [quantifier | OPTIONAL, list(members)])
            met.add(id(items[last]))
            continue
        lo, hi = places[0], places[-1]
        if lo < last:
            hi, lo = max(hi, last), lo
        if lo < hi:
            _group(items, lo, hi)
        item = items[lo]
        if len(members) > 1 or len(item[1]) > 1:
            item[0] |= REPEATED
        item[0] |= quantifier
        for m in members:
            _into(item[1], m)
        met.add(id(item))
        last = lo
    for item in items:
        if id(item) not in met:
            item[0] |= OPTIONAL
    return [a[0], None, items]


# ---------------------------------------------------------------- regions and text

_ORDER = ("article", "main", "content")


def regions(wrapper: list) -> list[str]:
    """The kinds of region the host has, best first."""
    found: set[str] = set()
    todo = [wrapper]
    while todo:
        label, _, items = todo.pop()
        kind = _kind(label)
        if kind != "skip":
            found.add(kind)
            todo += [m for _, ms in items for m in ms if m[0] != TEXT]
    return [k for k in _ORDER if k in found]


def main_text(page: str, wrapper: list) -> str:
    root = parse(page)
    said = _best(root, wrapper)
    return _best(root, wrapper) if not said and _open_forms(root) else said


def _best(root: list, wrapper: list) -> str:
    for kind in (*regions(wrapper), None):
        said = _text(root, wrapper, kind) or _text(root, None, kind)
        if said:
            return said
    return ""


def _text(root: list, wrapper: list | None, region: str | None) -> str:
    """Blocks inside elements of the region kind without fixed slots that are required; without a
    region, all but fixed slots."""
    blocks: list[str] = []
    held: list[str] = []

    def flush() -> None:
        said = " ".join(references.unescape("".join(held)).split())
        if said:
            blocks.append(said)
        held.clear()

    # A text, or None for the end of a block, or an element: its schema, whether it is inside the region
    # and an article, whether the wrapper requires it, and its depth.
    todo: list = [(root, wrapper, region is None, False, True, 0)]
    while todo:
        at = todo.pop()
        if at is None:
            flush()
            continue
        if isinstance(at, str):
            held.append(at)
            continue
        node, schema, inside, article, required, depth = at
        kind = _kind(node[0])
        if kind == "skip" or (kind == "header" and not article):
            if kind == "skip" and node[0].split(" ", 1)[0] in INLINE:
                held.append(" ")
            else:
                flush()
            continue
        if kind != "inline":
            flush()
            todo.append(None)
        inside = inside or kind == region
        article = article or kind in ("article", "main")
        members = {m[0]: (q, m) for q, ms in schema[2] for m in ms} if schema else {}
        asked, slot = members.get(TEXT, (0, None))
        fixed = slot is not None and slot[1] is not None and len(slot[3]) >= FIXED_PAGES
        fixed = fixed and (region is None or (required and not asked))
        for member in reversed(node[1]):
            if isinstance(member, str):
                if inside and not (fixed and member.strip() and _hash(member) == slot[1]):
                    todo.append(member)
            elif depth < DEPTH:
                q, inner = members.get(member[0], (0, None))
                todo.append((member, inner, inside, article, required and not q, depth + 1))
            else:
                todo.append((member, schema, inside, article, False, depth))
    flush()
    return "\n".join(blocks)


# ---------------------------------------------------------------- the operator


def _dump(wrapper: list) -> str:
    return json.dumps(wrapper, separators=(",", ":"))


@functools.lru_cache(maxsize=256)
def _load(wrapper: str) -> list:
    return json.loads(wrapper)


def infer(pages: DataFrame, html: str, host: str) -> DataFrame:
    """(host, wrapper, n_pages, n_bytes) of every host; ``host`` must not be null."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def out() -> pa.RecordBatch:
            rows = [(h, _dump(w), n, size) for h, (w, n, size) in held.items()]
            held.clear()
            columns = zip(*rows) if rows else ((), (), (), ())
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["host", "wrapper", "n_pages", "n_bytes"]
            )

        for batch in batches:
            for name, page in zip(batch.column(0), batch.column(1)):
                body = page.as_py()
                if not body:
                    continue
                name, own = name.as_py(), own_wrapper(parse(body))
                before, n, size = held.get(name, (None, 0, 0))
                held[name] = own if before is None else merge(before, own), n + 1, size + len(body)
                if len(held) >= HOSTS_HELD:
                    yield out()
        yield out()

    def fold(group: pd.DataFrame) -> pd.DataFrame:
        merged = functools.reduce(merge, map(json.loads, sorted(group["wrapper"])))
        row = {"host": group["host"].iloc[0], "wrapper": _dump(merged)}
        return pd.DataFrame([row | {c: group[c].sum() for c in ("n_pages", "n_bytes")}])

    small_batches(pages.sparkSession)
    schema = "host string, wrapper string, n_pages long, n_bytes long"
    partial = pages.select(F.col(host).alias("host"), html).mapInArrow(read, schema)
    salt = F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)).alias("salt")
    salted = partial.groupBy("host", salt).applyInPandas(fold, schema)
    return salted.groupBy("host").applyInPandas(fold, schema)


def extract(
    pages: DataFrame, html: str = "html", url: str = "url", text: str = "text"
) -> DataFrame:
    """``pages`` with ``text``.

    Wrappers of ``BROADCAST_BYTES`` in all are broadcast; more are brought to the pages of their host,
    once per group of about ``SHARE_BYTES`` of html.
    """
    host = F.coalesce(host_of(F.col(url).cast("string")), F.lit(""))
    rows = pages.drop(text) if text != html else pages
    read = pages.select(host.alias("__host"), F.col(html).cast("string").alias("__html"))
    wrappers = stored(infer(read, "__html", "__host"), "wrappers")
    size = wrappers.agg(F.sum(F.octet_length("wrapper") + F.octet_length("host"))).first()[0] or 0
    fields = [f for f in rows.schema.fields if f.name != text]
    schema = T.StructType([*fields, T.StructField(text, T.StringType())])
    keyed = rows.withColumn("__host", host)

    def texts(table: pa.Table | pa.RecordBatch, wrapper_of) -> list[pa.Array]:
        bodies = table.column(html).to_pylist()
        hosts = table.column("__host").to_pylist()
        said = [main_text(str(p), wrapper_of(h)) if p else "" for p, h in zip(bodies, hosts)]
        return [*(table.column(f.name) for f in fields), pa.array(said, pa.string())]

    if size <= BROADCAST_BYTES:
        shared = pages.sparkSession.sparkContext.broadcast(
            dict(tuple(r) for r in wrappers.select("host", "wrapper").collect())
        )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = shared.value
            for batch in batches:
                columns = texts(batch, lambda h: _load(held[h]))
                yield pa.RecordBatch.from_arrays(columns, schema.names)

        return keyed.mapInArrow(run, schema)

    def share(mine: pa.Table, its: pa.Table) -> pa.Table:
        wrapper = json.loads(its.column("wrapper")[0].as_py()) if its.num_rows else ["html", None, []]
        return pa.Table.from_arrays(texts(mine, lambda _: wrapper), schema.names)

    shares = wrappers.select(
        F.col("host").alias("__host"), "wrapper", (F.lit(1) + F.expr(f"n_bytes div {SHARE_BYTES}")).alias("__n")
    )
    # Pages without html are in no wrapper's count; they take part in the first share of their host.
    dealt = keyed.join(shares.select("__host", "__n"), "__host", "left").withColumn(
        "__share", F.coalesce(F.pmod(F.xxhash64(html, url), F.col("__n")), F.lit(0).cast("long"))
    )
    each = shares.withColumn("__share", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1)))
    groups = dealt.drop("__n").groupBy("__host", "__share")
    return groups.cogroup(each.drop("__n").groupBy("__host", "__share")).applyInArrow(share, schema)
