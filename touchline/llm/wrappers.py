"""Main text of web pages by union-free wrappers, inferred from the pages of each host.

A page is read as a stream of tags and texts, and its repetitions are folded: equal neighbours
become a repeated group, and so do runs like ``h2 p h2 p``. The folded streams of one host are
aligned one after the other; what one of two has and the other lacks becomes optional, what
repeats becomes a repeated group, and texts at the same place become a slot, which remembers
whether all pages have the same text there. The result is an expression without alternatives,

    <body><nav>(<a>#</a>)+</nav>(<div!>#</div!>)?<article><h1>#</h1>(<p>#</p>)*</article></body>

where ``!`` marks elements that names or tags declare as boilerplate. Lists of more than
``LIMIT`` members become ``(a? b? c?)*``, so an expression stays small however pages differ.

A page is then aligned with its host's wrapper, which tells for each of its texts whether it is
data or template. Outside boilerplate elements, the main text is the data in its article, else
in its main element, else in an element named as content; pages without any of these give the
data outside lists of links. Texts are template if at least ``PAGES`` pages have the same one
in a place that does not repeat, while other places of the wrapper vary.

Streams are counted per host and shape before any shuffle. Each host's distinct shapes are dealt
to ``SALTS`` groups by their hash, folded in sorted order one at a time, and the groups' wrappers
are folded once more, so that a hot host is no single task's group and reruns agree.

Null html is empty, as is the text of pages without any; a null url has the host ''. Repeated
rows give one row each, and count as pages of their own. Tags may be unclosed, closed twice or
cut off; a comment without an end hides the rest. White space is what ``str.split`` takes for
it. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import html as references
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import staged

SALTS = 32
PAGES = 20
LIMIT = 48  # members of one list in a wrapper
PERIOD = 6  # longest repeated run that is looked for
DEPTH = 48  # nesting, below which elements count as their ancestor's
HELD = 20_000  # shapes or results kept in a task
OPTIONAL, REPEATED = 1, 2
DROP, KEEP, KEEP_UNLINKED = 0, 1, 2
ARTICLE, MAIN, CONTENT = 1, 2, 3

# Element names of HTML by their part in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr audio math nobr picture video".split()
)
RAW = set("script style textarea title xmp".split())
BOILERPLATE = set(
    "aside button canvas dialog footer form head iframe menu nav noscript object script select style svg template "
    "textarea title xmp".split()
)
# Words in class, id or role that declare an element as boilerplate.
NAMED = set(
    "ad ads adv advert advertisement advertising adverts alert aside banner breadcrumb breadcrumbs comment comments "
    "complementary consent contentinfo cookie cookies dialog disqus footer gdpr login masthead menu modal nav navbar "
    "navigation newsletter notice notification pager pagination popup promo promoted promotion related replies reply "
    "respond search share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget".split()
)
# Those of them that a page's layout may bear as well, around its article.
LAYOUT = set(
    "alert banner complementary consent cookie cookies login menu modal nav navbar navigation notice pager pagination "
    "search share sharing sidebar signup social subscribe subscription toolbar widget".split()
)
CONTENT_NAMES = {"content", "main-content", "article-body", "post-content", "post-body", "entry-content", "story-body"}
ENDS_WITHIN = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}}
ENDS_WITHIN |= {"th": ENDS_WITHIN["td"], "option": {"select"}}
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}}
ENDS |= {"option": {"option"}}

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*+)>""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_NAMES = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORDS = re.compile(r"[a-z]+|[A-Z](?:[a-z]+|[A-Z]*(?![a-z]))")

# Members of a list: a slot ["#", quantifier, pages, hash of the text or None if it varies,
# characters, characters in links, texts]; an element [label, quantifier, members]; a repeated
# group of several members ["*", quantifier, members].


class Page:
    """A page's texts in order, and its folded stream, whose slots name their texts."""

    def __init__(self, html: str):
        self.texts: list[str] = []
        self.links: list[bool] = []  # whether a text is mostly links
        self.run: list[str] = []
        self.linked = 0
        self.in_link = False
        self.root: list = []
        self.open: list[tuple[str, list]] = [("", ["", 0, self.root])]  # tag, element
        self._read(html)
        self._flush()
        self.members = folded(self.root)

    def main_text(self, keep: list[int]) -> str:
        """The texts of the slots that are kept, in page order."""
        chosen = []
        for how, slot in zip(keep, slots(self.members)):
            if how:
                chosen += [n for n in slot[6] if how == KEEP or not self.links[n]]
        return " ".join(self.texts[n] for n in sorted(chosen))

    def _read(self, html: str) -> None:
        at, n = 0, len(html)
        while at < n:
            start = html.find("<", at)
            if start < 0:
                self._text(html[at:])
                return
            self._text(html[at:start])
            kind = html[start + 1 : start + 2]
            if kind == "!" or kind == "?":
                comment = html.startswith("<!--", start)
                end = html.find("-->", start + 4) + 2 if comment else html.find(">", start)
                if end < start + 2:
                    return
                at = end + 1
            elif (kind.isalpha() and kind.isascii()) or kind == "/":
                tag = _TAG.match(html, start) or _LOOSE.match(html, start)
                if tag is None:
                    end = html.find(">", start)
                    if end < 0:
                        return  # a tag that was cut off
                    at = end + 1
                    continue
                at = tag.end()
                name = tag[2].lower()
                if tag[1]:
                    self._end(name)
                else:
                    self._start(name, tag[3])
                    if name in RAW:
                        found = re.compile(f"</{name}(?![a-z0-9])", re.I).search(html, at)
                        at = found.start() if found else n
            else:
                self._text("<")
                at = start + 1

    def _text(self, raw: str) -> None:
        if raw:
            text = references.unescape(raw) if "&" in raw else raw
            self.run.append(text)
            if self.in_link:
                self.linked += len("".join(text.split()))

    def _flush(self) -> None:
        if self.run:
            text = " ".join("".join(self.run).split())
            if text:
                mark = int.from_bytes(hashlib.blake2b(text.encode(errors="replace"), digest_size=7).digest())
                self.open[-1][1][2].append(["#", 0, 1, mark, len(text), self.linked, [len(self.texts)]])
                self.texts.append(text)
                self.links.append(2 * self.linked > len(text))
            self.run = []
        self.linked = 0

    def _start(self, name: str, attributes: str) -> None:
        if name == "a":
            self.in_link = True
        if name == "br":
            self.run.append(" ")
        if name in VOID:
            if name == "hr":
                self._flush()
            return
        label, weak = self._label(name, attributes)
        if name in INLINE and "!" not in label:
            return
        self._flush()
        if name not in INLINE:
            self._close_implied(name)
        element = [label, 0, []]
        if "@" in label:  # a layout named after its sidebar is no sidebar
            for _, outer in self.open:
                if outer[0].endswith("~"):
                    outer[0] = outer[0][:-2]
        elif weak:
            element[0] = label + "~"
        if len(self.open) < DEPTH:
            self.open[-1][1][2].append(element)
            self.open.append((name, element))
        else:
            self.open.append((name, self.open[-1][1]))

    def _label(self, name: str, attributes: str) -> tuple[str, bool]:
        """The element's label, and whether an article within it shows that it is no boilerplate."""
        named = {m[1].lower(): m[2].strip("\"'") for m in _NAMES.finditer(attributes)} if "=" in attributes else {}
        if name in ("html", "body"):
            return name, False
        if name in BOILERPLATE:
            return name + "!", False
        words = {w.lower() for value in named.values() for w in _WORDS.findall(value)}
        if name == "header" or "header" in words:
            if not any("@" in e[0] for _, e in self.open):
                return name + "!", True
        if name != "main" and words & NAMED:
            return name + "!", words & NAMED <= LAYOUT
        if name == "article" or named.get("role") == "article":
            return f"{name}@{ARTICLE}", False
        if name == "main" or named.get("role") == "main":
            return f"{name}@{MAIN}", False
        if any(v.lower() in CONTENT_NAMES for k in ("id", "class") for v in named.get(k, "").split()):
            return f"{name}@{CONTENT}", False
        return name, False

    def _close_implied(self, name: str) -> None:
        """Close what the element's start ends: an open paragraph, or its list's last member."""
        ended, within = ENDS.get(name, {"p"}), ENDS_WITHIN.get(name)
        for k in range(len(self.open) - 1, 0, -1):
            tag = self.open[k][0]
            if tag in ended:
                del self.open[k:]
                return
            if tag in within if within else tag not in INLINE:
                return

    def _end(self, name: str) -> None:
        if name == "a":
            self.in_link = False
        if name in VOID:
            return
        for k in range(len(self.open) - 1, 0, -1):
            tag = self.open[k][0]
            if tag == name:
                self._flush()
                del self.open[k:]
                return
            if tag in ("article", "main") and name not in ("article", "main", "body", "html"):
                return
        if name not in INLINE:
            self._flush()


def _key(member: list) -> str:
    return member[0]


def _names(group: list) -> set[str]:
    return {_key(m) for m in group[2]}


def _alike(a: list, b: list) -> bool:
    """Whether two members can stand at one place: plain elements share a kind of member."""
    if a[0] != b[0]:
        return False
    if a[0] == "#" or a[0] in ("html", "body") or "!" in a[0] or "@" in a[0]:
        return True
    return not a[2] or not b[2] or not _names(a).isdisjoint(_names(b))


def _repeats(a: list, b: list) -> bool:
    """Whether neighbours repeat each other: one has no kind of member that the other lacks."""
    if a[0] != b[0] or a[0] in "#*":
        return _alike(a, b)
    x, y = _names(a), _names(b)
    return x <= y or y <= x


def _with(member: list, quantifier: int) -> list:
    return member if member[1] | quantifier == member[1] else [member[0], member[1] | quantifier, *member[2:]]


def merged(a: list, b: list) -> list:
    """The member that stands for both of two alike ones."""
    if a[0] == "#":
        mark = a[3] if a[3] == b[3] else None
        return ["#", a[1] | b[1], a[2] + b[2], mark, a[4] + b[4], a[5] + b[5], a[6] + b[6]]
    if a[0] != "*":
        return [a[0], a[1] | b[1], aligned(a[2], b[2])]
    members = {_key(m): m for m in a[2]}
    for m in b[2]:
        members[_key(m)] = merged(members[_key(m)], m) if _key(m) in members else _with(m, OPTIONAL)
    missing = members.keys() - _names(b)
    same_order = [_key(m) for m in a[2]] == [_key(m) for m in b[2]]
    return ["*", a[1] | b[1], [_with(m, OPTIONAL) if not same_order or _key(m) in missing else m for m in members.values()]]


def _gathered(members: list, group: list) -> list:
    """``members`` with each run of what ``group`` consists of made such a group."""
    names, out, k = _names(group), [], 0
    order = [_key(m) for m in group[2]]
    while k < len(members):
        end = k
        while end < len(members) and _key(members[end]) in names:
            end += 1
        if end == k:
            out.append(members[k])
            end += 1
        elif [_key(m) for m in members[k:end]] == order:
            out.append(["*", 0, members[k:end]])
        else:
            out.append(_any_order(members[k:end]))
        k = end
    return out


def _any_order(members: list) -> list:
    """``(a? b? c?)*``, which holds any sequence of its members."""
    by: dict[str, list] = {}
    for m in members:
        for x in m[2] if m[0] == "*" else [m]:
            by[_key(x)] = merged(by[_key(x)], x) if _key(x) in by else x
    return ["*", OPTIONAL | REPEATED, [_with(by[k], OPTIONAL) for k in by]]


def folded(members: list) -> list:
    """Repetitions folded: neighbours alike, then runs of up to ``PERIOD`` members."""
    out: list = []
    for m in members:
        if m[0] not in "#*" and m[2]:
            m = [m[0], m[1], folded(m[2])]
        out.append(m)
    return _folded_row(out)


def _folded_row(members: list) -> list:
    out: list = []
    for m in members:
        if out and _repeats(out[-1], m):
            out[-1] = _with(merged(out[-1], m), REPEATED)
        else:
            out.append(m)
    for period in range(2, PERIOD + 1):
        k = 0
        while k + 2 * period <= len(out):
            run = out[k : k + period]
            keys = [_key(m) for m in run]
            if "*" in keys or len(set(keys)) < period or [_key(m) for m in out[k + period : k + 2 * period]] != keys:
                k += 1
                continue
            end = k + period
            while [_key(m) for m in out[end : end + period]] == keys:
                run = [merged(x, y) for x, y in zip(run, out[end : end + period])]
                end += period
            out[k:end] = [["*", REPEATED, run]]
            k += 1
    return out if len(out) <= LIMIT else [_any_order(out)]


def aligned(a: list, b: list) -> list:
    """One list for both: alike members in order merged, the others optional."""
    if not a or not b:
        return [_with(m, OPTIONAL) for m in a or b]
    if len(a) == len(b) and all(map(_alike, a, b)):
        return [merged(x, y) for x, y in zip(a, b)]
    for group in [m for m in b if m[0] == "*"]:
        a = _gathered(a, group)
    for group in [m for m in a if m[0] == "*"]:
        b = _gathered(b, group)
    first = 0
    while first < min(len(a), len(b)) and _alike(a[first], b[first]):
        first += 1
    last = 0
    while last < min(len(a), len(b)) - first and _alike(a[-1 - last], b[-1 - last]):
        last += 1
    out = [merged(x, y) for x, y in zip(a[:first], b[:first])]
    out += _common(a[first : len(a) - last], b[first : len(b) - last])
    out += [merged(x, y) for x, y in zip(a[len(a) - last :], b[len(b) - last :])]
    return _folded_row(out)


def _common(a: list, b: list) -> list:
    """Alignment by a longest common subsequence."""
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if _alike(a[i], b[j]) else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n and j < m:
        if _alike(a[i], b[j]):
            out.append(merged(a[i], b[j]))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            out.append(_with(a[i], OPTIONAL))
            i += 1
        else:
            out.append(_with(b[j], OPTIONAL))
            j += 1
    return out + [_with(x, OPTIONAL) for x in a[i:] + b[j:]]


def slots(members: list) -> Iterator[list]:
    for m in members:
        if m[0] == "#":
            yield m
        else:
            yield from slots(m[2])


def shape(members: list) -> str:
    """The expression alone, without what its slots have seen."""
    mark = {0: "", OPTIONAL: "?", REPEATED: "+", OPTIONAL | REPEATED: "*"}
    out = []
    for m in members:
        inner = "#" if m[0] == "#" else shape(m[2]) if m[0] == "*" else f"<{m[0]}>{shape(m[2])}</{m[0]}>"
        out.append(f"({inner}){mark[m[1]]}" if m[1] else inner)
    return "".join(out)


def _bare(members: list) -> list:
    """Members as they are stored: slots without their texts' numbers."""
    return [[*m[:6], []] if m[0] == "#" else [m[0], m[1], _bare(m[2])] for m in members]


def templates(members: list) -> list:
    """Marks each slot of a host's wrapper: [..., [template, in links]] in place of texts."""

    def fixed(slot: list, repeats: bool) -> bool:
        return slot[3] is not None and slot[2] >= PAGES and not repeats and not slot[1] & REPEATED

    def walk(members: list, repeats: bool, varies: bool) -> list:
        out = []
        for m in members:
            if m[0] == "#":
                out.append([*m[:6], [[varies and fixed(m, repeats), 2 * m[5] > m[4]]]])
            else:
                out.append([m[0], m[1], walk(m[2], repeats or bool(m[1] & REPEATED), varies)])
        return out

    def open_slots(members: list) -> Iterator[list]:
        for m in members:
            if m[0] == "#":
                yield m
            elif "!" not in m[0]:
                yield from open_slots(m[2])

    return walk(members, False, any(s[3] is None for s in open_slots(members)))


def kept(members: list, wrapper: list) -> list[int]:
    """Which of a page's slots, in order, are main text; some of them without lists of links."""
    numbered = [n for n, _ in enumerate(slots(members))]
    marked = iter(numbered)

    def number(members: list) -> list:
        return [[*m[:6], [next(marked)]] if m[0] == "#" else [m[0], m[1], number(m[2])] for m in members]

    known: dict[int, list] = {}
    for slot in slots(aligned(wrapper, number(members)) if wrapper else members):
        told = [t for t in slot[6] if isinstance(t, list)]
        for n in slot[6]:
            if not isinstance(n, list) and told:
                known[n] = [all(t[0] for t in told), all(t[1] for t in told)]
    where: list[tuple[bool, set[int]]] = []

    def place(members: list, boilerplate: bool, kinds: set[int]) -> None:
        for m in members:
            if m[0] == "#":
                where.append((boilerplate, kinds))
            else:
                here = kinds | {int(m[0].split("@")[1])} if "@" in m[0] else kinds
                place(m[2], boilerplate or "!" in m[0], here)

    def containers(members: list) -> Iterator[int]:
        for m in members:
            if m[0] != "#" and "!" not in m[0]:
                if "@" in m[0]:
                    yield int(m[0].split("@")[1])
                yield from containers(m[2])

    place(members, False, set())
    wanted = min(containers(members), default=0)
    out = []
    for n, (boilerplate, kinds) in zip(numbered, where):
        template, links = known.get(n, (False, False))
        main = not boilerplate and not template and (wanted in kinds if wanted else not links)
        out.append(DROP if not main else KEEP if wanted else KEEP_UNLINKED)
    return out


HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)"


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, html) -> host, shape, members: one row per host and shape of some pages."""
    held: dict[tuple[str, str], list] = {}

    def rows() -> pa.RecordBatch:
        columns = list(zip(*((host, s, json.dumps(_bare(m))) for (host, s), m in held.items())))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["host", "shape", "members"])

    for batch in batches:
        for host, html in zip(batch["host"].to_pylist(), batch["html"]):
            members = Page(html.as_py() or "").members
            name = (host, shape(members))
            held[name] = aligned(held[name], _bare(members)) if name in held else _bare(members)
            if len(held) >= HELD:
                yield rows()
                held.clear()
    if held:
        yield rows()


def _wrapped(final: bool):
    """Sorted (host, salt, members) -> host, salt, members: one row per run of host and salt."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, members = None, []

        def row() -> pa.RecordBatch:
            done = templates(members) if final else members
            columns = [pa.array([now[0]]), pa.array([now[1]], pa.int64()), pa.array([json.dumps(done)])]
            return pa.RecordBatch.from_arrays(columns, ["host", "salt", "members"])

        for batch in batches:
            for host, salt, found in zip(*(batch[c].to_pylist() for c in ("host", "salt", "members"))):
                found = json.loads(found)
                if (host, salt) == now:
                    members = aligned(members, found)
                else:
                    if now:
                        yield row()
                    now, members = (host, salt), found
        if now:
            yield row()

    return run


def _hosted(pages: DataFrame, url: str, html: str) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), HOST, 1))
    return pages.select(host.alias("host"), F.col(html).alias("html"))


def _fold(rows: DataFrame, *order: str, final: bool) -> DataFrame:
    dealt = rows.repartition("host", "salt").sortWithinPartitions("host", "salt", *order)
    return dealt.select("host", "salt", "members").mapInArrow(_wrapped(final), "host string, salt long, members string")


def infer(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, members): each host's wrapper, its slots marked as template or data."""
    streams = _hosted(pages, url, html).mapInArrow(_streams, "host string, shape string, members string")
    salted = streams.withColumn("salt", F.pmod(F.xxhash64("shape"), F.lit(SALTS)).cast("long"))
    parts = _fold(salted, "shape", "members", final=False)
    whole = parts.withColumn("order", F.col("salt")).withColumn("salt", F.lit(0).cast("long"))
    return _fold(whole, "order", final=True).select("host", "members")


def expressions(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, wrapper): each host's wrapper as an expression to read."""

    def shown(column: pa.Array) -> pa.Array:
        return pa.array([shape(json.loads(m)) for m in column.to_pylist()], pa.string())

    shown.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return infer(pages, url, html).select("host", F.arrow_udf(shown, "string")("members").alias("wrapper"))


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(page_id, url, html, members) -> page_id, url, text, n_chars."""
    results: dict[tuple[str, str], list[int]] = {}
    for batch in batches:
        found = []
        for html, wrapper in zip(batch["html"], batch["members"].to_pylist()):
            page = Page(html.as_py() or "")
            name = (wrapper, shape(page.members))
            if name not in results:
                if len(results) >= HELD:
                    results.clear()
                results[name] = kept(page.members, json.loads(wrapper or "[]"))
            found.append(page.main_text(results[name]))
        columns = [batch["page_id"], batch["url"], pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars: the main text of every page by its host's wrapper.

    Wrappers are few and small beside the pages; Spark sends them to all tasks if their written
    size allows it, and else joins them by shuffle, splitting hot hosts.
    """
    wrappers = staged(infer(pages, url, html))
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), HOST, 1))
    joined = rows.withColumn("host", host).join(wrappers, "host", "left").select("page_id", "url", "html", "members")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return joined.mapInArrow(_extracted, f"page_id {kinds['page_id']}, url string, text string, n_chars long")
