"""Main-text extraction by union-free wrapper inference.

Each page becomes a stream of tag and text tokens, which is folded into a
union-free regular expression: runs of equal elements become repeated groups,
texts become slots. The expressions of a host's pages are aligned one after
another; what only one side has becomes optional, what one side repeats becomes
a repeated group. Each page is then matched against its host's wrapper, which
gives every text the wrapper's slot that it fills: the alignment tells apart
siblings of the same tag path. What a slot holds over the host's pages decides
whether it is template text, and each page's whole text is read off its slots.
Elements that names mark as menus, notices, forms and the like are left out
before.

Pages meet only as distinct shapes, which are merged per host in groups of
bounded size, in rounds; wrappers go back to the pages by broadcast only while
their measured size is small, else by a salted join. A host that holds a third
of all pages is therefore never one task.

Defined results: null or empty html gives the empty text; a null or malformed
url belongs to the host of empty name; repeated rows give repeated results; an
empty table gives no rows; other columns are ignored. Tags are read as browsers
read them: a quote counts only after an equals sign, and a tag that the page's
end cuts off is dropped. Elements more than ``DEPTH`` levels deep add no level;
lists of very many different elements are aligned greedily.
"""

from __future__ import annotations

import html as html_lib
import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable
from hashlib import blake2b

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, per_batch, scratch, stored, strings

#: A tag of the usual form; possessive, so that a tag of any other form costs one look.
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:\s++[^\s"'<>/=]++(?:\s*+=\s*+(?:"[^"<]*+"|'[^'<]*+'|[^\s"'=<>`]++))?+)*+\s*+/?+)>""")
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
SPACE = re.compile(r"\s*")
ATTRIBUTE_NAME = re.compile(r"[\s/]*(=?[^\s/>=]*)\s*")
UNQUOTED = re.compile(r"[^\s>]*")
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
DEPTH = 60
#: Cells of an alignment table; longer lists are aligned greedily.
CELLS = 250_000
#: Shapes that one task merges at a time.
MERGED = 200

#: Fixed sets of element names of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe noframes textarea xmp title svg math".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q ruby rb rp rt s samp small span strike strong sub sup time tt u var".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "p": {"p"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}}
#: Elements and words of class, id or role that mark what is not main text, and what holds it.
OUTSIDE = set("nav footer aside form button select dialog menu head".split())
OUTSIDE_WORDS = set(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus disclaimer dropdown footer form masthead menu menubar modal nav navbar "
    "navigation newsletter notice notices notification pagination pager popup promo promoted promotion recommended related replies reply search share sharing sidebar signup skip social "
    "sponsor sponsored subscribe subscription toolbar widget widgets alert complementary contentinfo dialog alertdialog".split()
)
INSIDE = {"article", "main"}
INSIDE_WORDS = set("article articlebody main maincontent content post entry story".split())
SEP = "\x1f"


def words_of(attributes: str) -> set[str]:
    found: set[str] = set()
    for name, *values in ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id", "role"):
            found.update(re.findall(r"[a-z]+", "".join(values).lower()))
    return found


def signature(tag: str, attributes: str) -> str:
    """The element's name, marked - for outside the main text or + for a container of it."""
    words = words_of(attributes) if "=" in attributes else set()
    if tag in OUTSIDE or words & OUTSIDE_WORDS:
        return tag + "-"
    if tag in INSIDE or words & INSIDE_WORDS:
        return tag + "+"
    return tag


def tag_at(page: str, at: int) -> tuple[int, bool, str, str] | None:
    """(end, closes, name, attributes) of the tag that begins at ``at``; None if the page ends in it."""
    if m := TAG.match(page, at):
        return m.end(), bool(m[1]), m[2].lower(), m[3]
    closes = page.startswith("</", at)
    name = NAME.match(page, at + 1 + closes)
    at, found = name.end(), []
    while True:
        m = ATTRIBUTE_NAME.match(page, at)
        at = m.end()
        if at >= len(page):
            return None
        if page[at] == ">":
            return at + 1, closes, name[0].lower(), " ".join(found) + "/" * (page[at - 1] == "/")
        if page[at] != "=":
            continue
        at = SPACE.match(page, at + 1).end()
        if page[at : at + 1] in ('"', "'"):
            end = page.find(page[at], at + 1)
            if end < 0:
                return None
            value, at = page[at + 1 : end], end + 1
        else:
            value = UNQUOTED.match(page, at)[0]
            at += len(value)
        found.append(f'{m[1]}="{value.replace(chr(34), " ")}"')


def markup(page: str):
    """The page's texts as strings, and its tags as (closes, name, attributes, place behind)."""
    at = 0
    skipped = None
    while at < len(page):
        if page[at] != "<":
            end = page.find("<", at)
            end = len(page) if end < 0 else end
            yield page[at:end]
            at = end
            continue
        after = page[at + 1 : at + 2]
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            at = len(page) if end < 0 else end + 3
        elif after in ("!", "?") or (after == "/" and not page[at + 2 : at + 3].isascii()) or (after == "/" and not page[at + 2 : at + 3].isalpha()):
            end = page.find(">", at)
            at = len(page) if end < 0 else end + 1
        elif after == "/" or (after.isascii() and after.isalpha()):
            tag = tag_at(page, at)
            if tag is None:
                return
            at = tag[0]
            skipped = yield (*tag[1:], at)
            if skipped is not None:
                at, skipped = skipped, None
                yield ""
        else:
            yield "<"
            at += 1


def tokens(page: str):
    """Events of a page: ("open", signature), ("close", signature), ("text", string) and ("break", ""); without what is outside the main text."""
    stack: list[tuple[str, str]] = []
    opened: Counter[str] = Counter()
    outside = 0  # open elements that are marked as such

    def pop():
        nonlocal outside
        t, sig = stack.pop()
        opened[t] -= 1
        if sig.endswith("-"):
            outside -= 1
            return "break", ""
        return ("close", sig) if not outside else ("break", "")

    parts = markup(page)
    for part in parts:
        if isinstance(part, str):
            if part and not outside:
                yield "text", part
            continue
        closes, tag, attributes, behind = part
        if closes:
            if opened[tag]:
                while True:
                    t = stack[-1][0]
                    yield pop()
                    if t == tag:
                        break
            elif tag not in INLINE:
                yield "break", ""
            continue
        if tag in RAW:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, behind)
                parts.send(end.end() if end else len(page))
            continue
        if tag in VOID:
            if tag != "wbr":
                yield "break", ""
            continue
        sig = signature(tag, attributes)
        if tag in INLINE and not sig.endswith("-"):
            continue
        shut = CLOSES.get(tag, {"p"} if tag not in INLINE else set())
        scope = SCOPES.get(tag, set())
        if any(opened[t] for t in shut):
            for depth in range(len(stack) - 1, -1, -1):
                t = stack[depth][0]
                if t in scope or (t not in shut and tag not in SCOPES):
                    break
                if t in shut:
                    while len(stack) > depth:
                        yield pop()
        stack.append((tag, sig))
        opened[tag] += 1
        if sig.endswith("-"):
            outside += 1
        yield ("break", "") if outside else ("open", sig)
    while stack:
        yield pop()


# A wrapper is a list of nodes [signature, flags, children]; "#" is a text slot, "(a b)" a group, "?" and "+" are flags.
# A page's own nodes have a fourth entry, the numbers of the texts in a slot.


def merge_node(a: list, b: list) -> list:
    out = [a[0], _flag(a[1], b[1]), align(a[2], b[2])]
    return [*out, a[3] + b[3]] if len(a) > 3 and len(b) > 3 else out


def fold(nodes: list) -> list:
    """Adjacent repetitions of up to four elements become repeated groups."""
    for k in (1, 2, 3, 4):
        out: list = []
        i = 0
        while i < len(nodes):
            unit = nodes[i : i + k]
            sigs = [n[0] for n in unit]
            j = i + k
            while len(unit) == k and [n[0] for n in nodes[j : j + k]] == sigs:
                unit = [merge_node(x, y) for x, y in zip(unit, nodes[j : j + k])]
                j += k
            if j > i + k:
                out.append([unit[0][0], _flag(unit[0][1], "+"), *unit[0][2:]] if k == 1 else _group(sigs, "+", unit))
                i = j
            else:
                out.append(nodes[i])
                i += 1
        nodes = out
    return nodes


def _flag(flags: str, more: str) -> str:
    return "".join(sorted({*flags, *more}))


def _group(sigs: list[str], flags: str, unit: list) -> list:
    return [f"({' '.join(sigs)})", flags, unit, *([[]] if len(unit[0]) > 3 else [])]


def regroup(nodes: list, groups: dict[str, list]) -> list:
    """Single occurrences of the other side's repeated groups, as groups."""
    for unit in groups.values():
        sigs, k, out, i = [n[0] for n in unit], len(unit), [], 0
        while i < len(nodes):
            if [n[0] for n in nodes[i : i + k]] == sigs:
                out.append(_group(sigs, "", nodes[i : i + k]))
                i += k
            else:
                out.append(nodes[i])
                i += 1
        nodes = out
    return nodes


def common(a: list, b: list) -> list[tuple[int, int]]:
    """Places of a longest common sequence of two lists of nodes, in which one that neither side calls optional counts twice; of some common one where the lists are too long for a table."""
    weight = lambda x, y: 0 if x[0] != y[0] else 1 if "?" in x[1] + y[1] else 2
    low = 0
    while low < min(len(a), len(b)) and weight(a[low], b[low]) == 2:
        low += 1
    high = 0
    while high < min(len(a), len(b)) - low and weight(a[-1 - high], b[-1 - high]) == 2:
        high += 1
    x, y = a[low : len(a) - high], b[low : len(b) - high]
    n, m = len(x), len(y)
    found: list[tuple[int, int]] = []
    if n * m <= CELLS:
        best = [[0] * (m + 1) for _ in range(n + 1)]
        for i in range(n - 1, -1, -1):
            row, after, (sig, flags, *_) = best[i], best[i + 1], x[i]
            for j in range(m - 1, -1, -1):
                row[j] = max(after[j], row[j + 1])
                if sig == y[j][0]:
                    row[j] = max(row[j], after[j + 1] + (1 if "?" in flags + y[j][1] else 2))
        i = j = 0
        while i < n and j < m:
            if (w := weight(x[i], y[j])) and best[i][j] == best[i + 1][j + 1] + w:
                found.append((i, j))
                i, j = i + 1, j + 1
            elif best[i + 1][j] >= best[i][j + 1]:
                i += 1
            else:
                j += 1
    else:
        places: dict[str, list[int]] = {}
        for i, node in enumerate(x):
            places.setdefault(node[0], []).append(i)
        i = 0
        for j, node in enumerate(y):
            at = places.get(node[0], [])
            k = bisect_left(at, i)
            if k < len(at):
                found.append((at[k], j))
                i = at[k] + 1
    return [(k, k) for k in range(low)] + [(i + low, j + low) for i, j in found] + [(len(a) - k, len(b) - k) for k in range(high, 0, -1)]


def paired(a: list, b: list) -> tuple[list, list, list[tuple[int, int]]]:
    """Both lists with each other's groups, and which of their nodes belong together."""
    groups_a, groups_b = ({n[0]: n[2] for n in x if n[0][0] == "("} for x in (a, b))
    a, b = regroup(a, groups_b), regroup(b, groups_a)
    return a, b, common(a, b)


def align(a: list, b: list) -> list:
    """The union-free expression of both: common elements in order, the others optional."""
    if a == b:
        return a
    a, b, both = paired(a, b)
    optional = lambda x: [x[0], _flag(x[1], "?"), *x[2:]]
    out, i, j = [], 0, 0
    for p, q in [*both, (len(a), len(b))]:
        out += [optional(x) for x in a[i:p]] + [optional(x) for x in b[j:q]]
        if p < len(a):
            out.append(merge_node(a[p], b[q]))
        i, j = p + 1, q + 1
    # neighbours that the alignment has brought together repeat
    folded: list = []
    for node in out:
        if folded and folded[-1][0] == node[0]:
            one = merge_node(folded[-1], node)
            flags = one[1] if "?" in folded[-1][1] and "?" in node[1] else one[1].replace("?", "")
            folded[-1] = [one[0], _flag(flags, "+"), *one[2:]]
        else:
            folded.append(node)
    return folded


def parse(page: str) -> tuple[list, list[str | None]]:
    """The page's own expression, and its texts in order; None is a break between blocks."""
    root: list = []
    levels, parts = [root], []
    deeper = 0
    for kind, value in tokens(page):
        if kind == "text":
            if not value.isspace():
                if not levels[-1] or levels[-1][-1][0] != "#":
                    levels[-1].append(["#", "", [], []])
                levels[-1][-1][3].append(len(parts))
            parts.append(value)
            continue
        parts.append(None)
        if kind == "open":
            if len(levels) > DEPTH:
                deeper += 1
                continue
            levels[-1].append([value, "", [], []])
            levels.append(levels[-1][-1][2])
        elif kind == "close":
            if deeper:
                deeper -= 1
                continue
            children = levels.pop()
            children[:] = fold(children)
    return fold(root), parts


def bare(nodes: list) -> list:
    """A page's expression without its texts."""
    return [[n[0], n[1], bare(n[2])] for n in nodes]


def slots_of(nodes: list) -> list[list[int]]:
    """The numbers of the texts in each slot of a page's expression, in its order."""
    return [x for n in nodes for x in ([n[3]] if n[0] == "#" else slots_of(n[2]))]


def infer(shapes: list[str]) -> list:
    """The wrapper of all the shapes, aligned one after another."""
    wrapper = None
    for s in sorted(shapes):
        nodes = json.loads(s)
        wrapper = nodes if wrapper is None else align(wrapper, nodes)
    return wrapper or []


def slot_names(nodes: list, path: tuple = (), place: str = "") -> list[tuple[str, tuple]]:
    """(name, tag path) of the wrapper's slots, in page order; a slot's name is its place in the wrapper."""
    out = []
    for k, (sig, _, children, *_) in enumerate(nodes):
        if sig == "#":
            out.append((f"{place}{k}", path))
        else:
            out += slot_names(children, path if sig[0] == "(" else (*path, sig), f"{place}{k}.")
    return out


def match(wrapper: list, nodes: list, place: str = "", path: tuple = ()) -> list[str]:
    """For each slot of a page's expression, the name of the wrapper's slot; one that the wrapper lacks has its tag path as name."""
    grouped = regroup(nodes, {n[0]: n[2] for n in wrapper if n[0][0] == "("})
    at = {q: p for p, q in common(wrapper, grouped)}
    out = []
    for k, (sig, _, children, *_) in enumerate(grouped):
        below = path if sig[0] in "(#" else (*path, sig)
        if sig == "#":
            out.append(f"{place}{at[k]}" if k in at else "~" + SEP.join(path))
        elif k in at:
            out += match(wrapper[at[k]][2], children, f"{place}{at[k]}.", below)
        else:
            out += ["~" + SEP.join(p) for _, p in slot_names(children, below)]
    return out


class Rules:
    """Which slots hold main text: those in a container, articles first; on pages without one, all but template text; on pages with nothing else, template text too.

    constant: slots whose text is the same on all of several different pages, which outside a container is template text.
    """

    def __init__(self, wrapper: list, constant: Iterable[str]):
        self.paths = dict(slot_names(wrapper))
        self.constant = set(constant)
        self.articles = any("article+" in p for p in self.paths.values())

    def inside(self, name: str) -> bool:
        path = self.path(name)
        return "article+" in path if self.articles else any(s.endswith("+") for s in path)

    def plain(self, name: str) -> bool:
        return self.whole(name) and name not in self.constant

    def whole(self, name: str) -> bool:
        return not self.inside(name) and "header" not in self.path(name)

    def path(self, name: str) -> tuple | list:
        return name[1:].split(SEP) if name[0] == "~" else self.paths[name]


def text_of(parts: list[str | None], filled: list[tuple[list[int], bool]]) -> str:
    """What the page has in the slots that are taken, blocks and words apart by one space."""
    take = {k for texts, taken in filled if taken for k in texts}
    held = {k for texts, _ in filled for k in texts}
    out, on = [], False
    for k, part in enumerate(parts):
        if part is None:
            out.append(" ")
            on = False
        elif k in held:
            on = k in take
            if on:
                out.append(html_lib.unescape(part))
        else:
            out.append(" ")  # white space
    return " ".join("".join(out).split())


def shapes(rows: DataFrame) -> DataFrame:
    """host and shape (JSON) of each page."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [json.dumps(bare(parse(page)[0]), separators=(",", ":")) for page in strings(batch, "html")]
        return pa.RecordBatch.from_arrays([column(batch, "host"), pa.array(made, pa.string())], names=["host", "shape"])

    return rows.select("host", "html").mapInArrow(per_batch(run), "host string, shape string")


class Matcher:
    """Pages against wrappers; what equal shapes of a host have in common is found once per task."""

    def __init__(self) -> None:
        self.wrapper, self.loaded = None, []
        self.known: dict[str, list[str]] = {}

    def __call__(self, wrapper: str, page: str) -> tuple[list[str | None], list[tuple[str, list[int]]]]:
        """The page's parts, and name and texts of each slot that it fills."""
        if wrapper != self.wrapper:
            self.wrapper, self.loaded, self.known = wrapper, json.loads(wrapper), {}
        nodes, parts = parse(page)
        key = json.dumps(bare(nodes), separators=(",", ":"))
        if key not in self.known:
            if len(self.known) >= 1000:
                self.known.clear()
            self.known[key] = match(self.loaded, nodes)
        return parts, list(zip(self.known[key], slots_of(nodes)))


def merged_shapes(shapes: DataFrame) -> DataFrame:
    """host and shape: the wrapper of each host's distinct shapes, merged in rounds of groups of some ``MERGED`` at most."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": pdf["host"].iloc[:1], "shape": [json.dumps(infer(list(pdf["shape"])), separators=(",", ":"))]})

    now = stored(shapes.distinct(), "shapes")
    while True:
        parts = stored(now.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / MERGED).cast("int").alias("_parts")), "parts")
        dealt = now.join(parts, "host").withColumn("_salt", F.pmod(F.xxhash64("shape"), F.col("_parts")))
        now = stored(dealt.groupBy("host", "_salt").applyInPandas(run, "host string, shape string"), "shapes")
        if (parts.agg(F.max("_parts")).first()[0] or 0) <= 1:
            return now


def with_wrappers(rows: DataFrame, rules: DataFrame, broadcast_bytes: int, salts: int) -> DataFrame:
    """Rows with what ``rules`` has of their host, a host's rows together where they lie."""
    size = rules.agg(F.sum(F.length(F.to_json(F.struct(*rules.columns))))).first()[0] or 0
    if size <= broadcast_bytes:
        return rows.join(F.broadcast(rules), "host", "left")
    spread = rules.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int")).join(spread, ["host", "_salt"], "left")


def constant_slots(joined: DataFrame) -> DataFrame:
    """host, constant: the slots that hold the same text on all pages that have them, on three different pages at least."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        matcher = Matcher()
        hosts, slots, pages, hashes = [], [], [], []
        for host, wrapper, page in sorted(zip(strings(batch, "host"), strings(batch, "wrapper"), strings(batch, "html")), key=lambda x: x[0]):
            parts, filled = matcher(wrapper or "[]", page)
            texts = [(name, "".join(" ".join(parts[k].split()) for k in at)) for name, at in filled]
            content = _hash(json.dumps(texts))
            found: dict[str, list[str]] = {}
            for name, text in texts:
                found.setdefault(name, []).append(text)
            for name, held in found.items():
                hosts.append(host)
                slots.append(name)
                pages.append(content)
                hashes.append(_hash("\0".join(held)))
        return pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(slots, pa.string()), pa.array(pages, pa.int64()), pa.array(hashes, pa.int64())], names=["host", "slot", "page", "hash"])

    each = joined.select("host", "wrapper", "html").mapInArrow(per_batch(run), "host string, slot string, page long, hash long")
    same = (F.min("hash") == F.max("hash")).alias("same")
    seen = each.groupBy("host", "slot").agg(F.countDistinct("page").alias("pages"), same).where("same and pages >= 3")
    return seen.groupBy("host").agg(F.sort_array(F.collect_list("slot")).alias("constant"))


def _hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def wrappers(pages: DataFrame, broadcast_bytes: int = 4 << 20, salts: int = 32) -> DataFrame:
    """host, wrapper (JSON) and constant (names of slots) of each host; pages: page_id, url, host, html."""
    with scratch(pages.sparkSession):
        merged = merged_shapes(shapes(pages)).withColumnRenamed("shape", "wrapper")
        constant = constant_slots(with_wrappers(pages, merged, broadcast_bytes, salts))
        return stored(merged.join(constant, "host", "left"), "wrappers", keep=True)


def extract(pages: DataFrame, broadcast_bytes: int = 4 << 20, salts: int = 32) -> DataFrame:
    """page_id, url, text and n_chars of each page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    rows = rows.withColumn("host", host)
    joined = with_wrappers(rows, wrappers(rows, broadcast_bytes, salts), broadcast_bytes, salts)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        matcher = Matcher()
        texts: list[str] = [""] * batch.num_rows
        of, rules = None, Rules([], ())
        each = zip(strings(batch, "host"), range(batch.num_rows), strings(batch, "wrapper"), column(batch, "constant").to_pylist(), strings(batch, "html"))
        for host, row, wrapper, constant, page in sorted(each, key=lambda x: x[:2]):
            parts, filled = matcher(wrapper or "[]", page)
            if of != host:
                of, rules = host, Rules(matcher.loaded, constant or ())
            for taken in (rules.inside, rules.plain, rules.whole):
                texts[row] = text_of(parts, [(at, taken(name)) for name, at in filled])
                if texts[row]:
                    break
        return pa.RecordBatch.from_arrays(
            [column(batch, "page_id"), column(batch, "url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"]
        )

    return joined.select("page_id", "url", "host", "html", "wrapper", "constant").mapInArrow(per_batch(run), "page_id long, url string, text string, n_chars long")
