"""Main text of web pages by wrappers: one union-free regular expression over tokens a host.

A page's tokens are its block-level tags, with implied ends filled in, and its blocks of text. Neighbours that
repeat, alone or as a run of up to ``MAX_RUN`` elements, become a repeated group ``( )+``; text becomes a slot ``#``.
That is the page's own expression. Expressions of a host are aligned in rounds: the longest common
subsequence of two lists of parts is matched, matched parts are aligned inside, and what
only one side has becomes optional ``?``. A list that would grow beyond ``MAX_PARTS`` becomes a repeated group of optional
parts, which fits any order of them, so an expression is bounded by the different tags of its pages. Each round
aligns bounded groups, so a host of any size takes a few rounds of many tasks.

Slots carry numbers of pages, characters, characters in links, and whether their text is the same on all pages. With them the
host's wrapper decides which slots are the article: those inside ``article``, else inside ``main``, else inside the
smallest container with most of the text that varies and is not links, less text that is the same on
three or more pages. Menus, headers, footers, sidebars, notices, adverts, forms and comments are known by tag, role or by the
words of class and id, and are left out everywhere. The page's slots are then aligned with the wrapper's.

Pages are read twice, once for the expressions and once for the text; what is shuffled are
distinct expressions of a host with their counts, added up before. Text is joined with the list of its expression's slots: by broadcast
of up to ``BROADCAST_FORMS`` lists, beyond that by shuffle over ``SALTS`` copies of each.

Defined cases: null html is empty; null urls, and those without ``://``, are one host; elements deeper than
``MAX_DEPTH`` count to their ancestor there; pages may have any length and unfinished markup; rows may repeat, ids
may be null, extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctpulse.llm import arrays
from acctpulse.llm.tables import join_facts, keep

MAX_RUN = 8
MAX_PARTS = 40
MAX_DEPTH = 150
GROUP_FORMS = 32
BROADCAST_FORMS = 100_000
SALTS = 16
#: A container holds the article if it has this part of the text, and text on so many pages is the template's.
MOST, TEMPLATE_PAGES = 0.7, 3
TEXT, ANY = "#", "*"
FORM, SLOTS, FOUND = "_acct_form", "_acct_slots", "_acct_blocks"

#: Elements of HTML by their treatment.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol p "
    "pre search section summary table tbody td template tfoot th thead tr ul caption".split()
)
CONTAINERS = set(
    "article aside body center details div dl fieldset figure footer form header html main nav ol section "
    "table tbody td ul".split()
)
#: Inline elements that hold no running text.
CONTROLS = set("button select option optgroup datalist svg canvas audio video object map".split())
LEFT_OUT = set("head nav aside footer form dialog menu noscript template search fieldset".split()) | CONTROLS
#: What a new element ends, up to the element where the search stops.
ENDS_P = BLOCKS - set("body caption dd dt head html legend li noscript summary tbody td template tfoot th thead tr".split())
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr"}, {"table"}), "tfoot": ({"thead", "tbody", "tr"}, {"table"}),
    "body": ({"head"}, set()), "option": ({"option"}, {"select"}),
}
HOLDS_P = CONTAINERS - {"body", "html"} | {"td", "th", "li", "dd"}
TABLE = set("table caption thead tbody tfoot tr td th".split())
#: Words of classes, ids and roles.
NOISE = set(
    "ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored promo promos "
    "promotion banner banners cookie cookies consent gdpr notice notices alert alerts menu menus nav navbar "
    "navigation breadcrumb breadcrumbs sidebar sidebars complementary footer contentinfo comment comments "
    "commentlist disqus reply replies respond share sharing social related newsletter subscribe "
    "subscription signup login search popup modal overlay dialog toolbar pagination pager widget widgets".split()
)
HEAD_WORDS = set("header masthead banner topbar".split())
TOKEN = re.compile(
    r"""<!--(?:.*?-->|.*)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*+)>|</?[A-Za-z][^>]*\Z""",
    re.S,
)
NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
NUMBERS = re.compile(r"[\d_-]*\d[\d_-]*")


class Part:
    """A slot, an element or a group of an expression; ``data`` of a slot is what is known about it."""

    __slots__ = ("data", "key", "opt", "parts", "rep")

    def __init__(self, key: str, parts: list[Part] | None = None, data=None, opt=False, rep=False):
        self.key, self.parts, self.data, self.opt, self.rep = key, parts or [], data, opt, rep

    def slots(self) -> Iterator[Part]:
        if self.key == TEXT:
            yield self
        for part in self.parts:
            yield from part.slots()

    def told(self) -> list:
        return [self.key, self.opt + 2 * self.rep, [p.told() for p in self.parts]]

    def expression(self) -> str:
        """As a regular expression over tokens."""
        inside = " ".join(p.expression() for p in self.parts)
        group = self.key == ANY or self.key.startswith("(")
        plain = self.key if self.key == TEXT else f"({inside})" if group else f"{self.key}({inside})"
        return plain + ("+" if self.rep else "") + ("?" if self.opt else "")


def read_told(told: list, data: Iterator) -> Part:
    key, flags, parts = told
    part = Part(key, [read_told(p, data) for p in parts], None, bool(flags & 1), bool(flags & 2))
    if key == TEXT:
        part.data = next(data)
    return part


Join = Callable[[object, object], object]


def merge(x: Part, y: Part, join: Join) -> Part:
    """``y``, of the same key, taken into ``x``."""
    x.opt |= y.opt
    x.rep |= y.rep
    if x.key == TEXT:
        x.data = join(x.data, y.data)
    else:
        x.parts = align(x.parts, y.parts, join)
    return x


def align(xs: list[Part], ys: list[Part], join: Join) -> list[Part]:
    """One list of parts that fits both."""
    keys_x, keys_y = [p.key for p in xs], [p.key for p in ys]
    if keys_x == keys_y:
        return [merge(x, y, join) for x, y in zip(xs, ys, strict=True)]
    if keys_x == [ANY] or keys_y == [ANY]:
        return [any_order([*xs, *ys], join)]
    out, i, j = [], 0, 0
    for to_i, to_j in [*common(keys_x, keys_y), (len(xs), len(ys))]:
        for part in [*xs[i:to_i], *ys[j:to_j]]:
            part.opt = True
            out.append(part)
        if to_i < len(xs) and to_j < len(ys):
            out.append(merge(xs[to_i], ys[to_j], join))
        i, j = to_i + 1, to_j + 1
    return bounded(out, join)


def common(xs: list[str], ys: list[str]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence."""
    best = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
    for i in range(len(xs) - 1, -1, -1):
        row, below = best[i], best[i + 1]
        for j in range(len(ys) - 1, -1, -1):
            row[j] = below[j + 1] + 1 if xs[i] == ys[j] else max(below[j], row[j + 1])
    out, i, j = [], 0, 0
    while i < len(xs) and j < len(ys):
        if xs[i] == ys[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def any_order(parts: list[Part], join: Join) -> Part:
    """A repeated group of optional parts, each key once."""
    once: dict[str, Part] = {}

    def add(part: Part) -> None:
        if part.key == ANY or part.key.startswith("("):
            for inner in part.parts:
                add(inner)
        elif part.key in once:
            merge(once[part.key], part, join)
        else:
            part.opt = True
            once[part.key] = part

    for part in parts:
        add(part)
    return Part(ANY, [once[k] for k in sorted(once)], rep=True)


def bounded(parts: list[Part], join: Join) -> list[Part]:
    return [any_order(parts, join)] if len(parts) > MAX_PARTS else parts


def folded(parts: list[Part], join: Join) -> list[Part]:
    """Runs of several parts that repeat become groups; single parts are folded as they are read."""
    for run in range(2, MAX_RUN + 1):
        if len(parts) < 2 * run:
            break
        keys, out, i = [p.key for p in parts], [], 0
        while i < len(parts):
            if keys[i : i + run] != keys[i + run : i + 2 * run]:
                out.append(parts[i])
                i += 1
                continue
            group = Part("(" + " ".join(keys[i : i + run]) + ")", parts[i : i + run], rep=True)
            start = keys[i : i + run]
            i += run
            while keys[i : i + run] == start:
                group.parts = align(group.parts, parts[i : i + run], join)
                i += run
            out.append(group)
        parts = out
    return bounded(parts, join)


def key_of(tag: str, attributes: str) -> str:
    """A tag with what tells its elements apart.

    ``!`` marks noise and ``^`` a header by their names; a container also has its names without numbers.
    """
    told = NAMES.findall(attributes) if attributes else []
    if not told:
        return tag
    role, names = "", set()
    for kind, a, b, c in told:
        value = a or b or c
        if kind.lower() == "role":
            role = value.lower()
        names.update(value.split())
    if role in ("main", "article"):
        return role
    if tag not in ("html", "body", "main"):
        words = {w.lower() for n in names for w in name_words(n)}
        if words & NOISE:
            return f"{tag}!"
        if words & HEAD_WORDS:
            return f"{tag}^"
    if tag not in CONTAINERS or tag in ("html", "body", "article", "main"):
        return tag
    return ".".join([tag, *sorted({NUMBERS.sub("", n) for n in names} - {""})])


def name_words(name: str) -> list[str]:
    """Words of a class or id; one like ``has-sidebar`` tells of its element's neighbours and has none."""
    words = WORDS.findall(name)
    return [] if words and words[0].lower() in ("has", "with", "no", "without") else words


def joined_lists(x: list, y: list) -> list:
    x.extend(y)
    return x


class Page:
    """A page's expression; its slots' ``data`` are numbers of ``blocks``, of which ``linked`` characters are in links."""

    def __init__(self, source: str):
        self.blocks: list[str] = []
        self.linked: list[int] = []
        self.root = Part("page")
        self.open: list[tuple[str, Part]] = [("", self.root)]
        self.inline: list[str] = []
        self.pieces: list[str] = []
        self.in_link = 0
        self.link_chars = 0
        #: The inline element whose text is left out, and how many of its name are open.
        self.muted, self.mute_depth = "", 0
        self._read(source)
        self._block()
        while len(self.open) > 1:
            self._close()
        self.root.parts = folded(self.root.parts, joined_lists)

    def _read(self, source: str) -> None:
        at, skip = 0, 0
        while found := TOKEN.search(source, at):
            if found.start() > at:
                self._text(source[at : found.start()])
            at = found.end()
            tag = found[2]
            if not tag:
                continue
            tag = tag.lower()
            if found[1]:
                self._end(tag)
                continue
            if tag in RAW or tag in CONTROLS:
                end = END_OF[tag].search(source, at) if not (found[3] or "").endswith("/") or tag in RAW else None
                if end or tag in RAW:
                    at = end.end() if end else len(source)
                continue
            self._start(tag, found[3] or "")
        if at < len(source):
            self._text(source[at:])

    def _text(self, raw: str) -> None:
        if self.muted:
            return
        told = html.unescape(raw) if "&" in raw else raw
        self.pieces.append(told)
        if self.in_link:
            self.link_chars += len(told)

    def _block(self) -> None:
        """Ends the block at hand."""
        if not self.pieces:
            return
        text = " ".join("".join(self.pieces).split())
        if text:
            self._add(Part(TEXT, data=[len(self.blocks)]))
            self.blocks.append(text)
            self.linked.append(min(self.link_chars, len(text)))
        self.pieces.clear()
        self.link_chars = 0

    def _add(self, part: Part) -> None:
        parts = self.open[-1][1].parts
        if parts and parts[-1].key == part.key:
            merge(parts[-1], part, joined_lists).rep = True
        else:
            parts.append(part)

    def _close(self) -> None:
        _, part = self.open.pop()
        if part is self.open[-1][1]:
            return
        part.parts = folded(part.parts, joined_lists)
        self._add(part)

    def _start(self, tag: str, attributes: str) -> None:
        if tag not in BLOCKS:
            if tag == "br":
                self.pieces.append(" ")
            elif tag == "a":
                self.in_link = 1
            if self.muted == tag:
                self.mute_depth += 1
            elif not self.muted and tag not in VOID and "=" in attributes and key_of(tag, attributes)[-1] == "!":
                self.muted, self.mute_depth = tag, 1
            return
        self.muted = ""
        self._block()
        if tag in ENDS:
            self._end_until(*ENDS[tag])
        if tag in ENDS_P:
            self._end_until({"p"}, HOLDS_P)
        if tag != "hr":
            self._enter(tag, key_of(tag, attributes))

    def _enter(self, tag: str, key: str) -> None:
        self._block()
        deep = len(self.open) > MAX_DEPTH
        self.open.append((tag, self.open[-1][1] if deep else Part(key)))

    def _end_until(self, ended: set[str], stops: set[str]) -> None:
        """Ends the outermost open element of ``ended`` above the nearest of ``stops``."""
        depth = 0
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.open[i][0]
            if tag in ended:
                depth = i
            elif tag in stops:
                break
        while depth and len(self.open) > depth:
            self._close()

    def _end(self, tag: str) -> None:
        if tag not in BLOCKS:
            if tag == "a":
                self.in_link = 0
            if self.muted == tag:
                self.mute_depth -= 1
                self.muted = tag if self.mute_depth else ""
            return
        self.muted = ""
        self._block()
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == tag:
                while len(self.open) > i:
                    self._close()
                return
            if self.open[i][0] in ("td", "th") and tag not in TABLE:
                return


END_OF = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for t in RAW | CONTROLS}


def form_of(host: str, told: str) -> bytes:
    """Names an expression of a host."""
    return hashlib.blake2b(f"{host}\0{told}".encode(), digest_size=16).digest()


def spelled(part: Part) -> str:
    return json.dumps(part.told(), ensure_ascii=False, separators=(",", ":"))


def added(x: list, y: list) -> list:
    """Counts of two slots: pages, characters, of these in links, least and largest hash of a page's text."""
    return [x[0] + y[0], x[1] + y[1], x[2] + y[2], min(x[3], y[3]), max(x[4], y[4])]


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"://([^/?#]*)", 1)), F.lit(""))


def _pages(pages: DataFrame, keys: list[str]) -> DataFrame:
    return pages.select(
        *keys, host_of(F.col("url")).alias("_acct_host"), F.coalesce("html", F.lit("")).alias("_acct_html")
    )


FACTS = "host string, form binary, told string, slot int, pages bigint, chars bigint, links bigint, lo bigint, hi bigint"


def forms(pages: DataFrame) -> DataFrame:
    """``host``, ``form``, ``told`` (the expression), ``pages`` and ``slots`` of each distinct expression of a host."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["host", "form", "told", "slot", "pages", "chars", "links", "lo", "hi"]
        kinds = [pa.string(), pa.binary(), pa.string(), pa.int32(), *[pa.int64()] * 5]
        for batch in batches:
            seen: dict[tuple[str, str], list] = {}
            for part in arrays.blocks(batch, "_acct_html"):
                for host, source in zip(
                    part.column("_acct_host").to_pylist(), part.column("_acct_html").to_pylist(), strict=True
                ):
                    page = Page(source)
                    facts = []
                    for slot in page.root.slots():
                        texts = [page.blocks[i] for i in slot.data]
                        same = zlib.crc32("\n".join(texts).encode())
                        facts.append([1, sum(map(len, texts)), sum(page.linked[i] for i in slot.data), same, same])
                    name = (host, spelled(page.root))
                    if name in seen:
                        old = seen[name]
                        old[0] += 1
                        old[1] = [added(x, y) for x, y in zip(old[1], facts, strict=True)]
                    else:
                        seen[name] = [1, facts]
            rows = []
            for (host, told), (n, facts) in seen.items():
                form = form_of(host, told)
                rows.append((host, form, told, -1, n, 0, 0, 0, 0))
                rows += [(host, form, None, i, *f) for i, f in enumerate(facts)]
            columns = zip(*rows, strict=True) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
            )

    told = _pages(pages, []).mapInArrow(run, FACTS)
    slots = told.groupBy("host", "form", "slot").agg(
        F.max("told").alias("told"), *[F.sum(c).alias(c) for c in ("pages", "chars", "links")],
        F.min("lo").alias("lo"), F.max("hi").alias("hi"),
    )
    fact = F.struct("slot", F.array("pages", "chars", "links", "lo", "hi").alias("facts"))
    in_order = F.array_sort(F.collect_list(F.when(F.col("slot") >= 0, fact)))
    return slots.groupBy("host", "form").agg(
        F.max("told").alias("told"),
        F.sum(F.when(F.col("slot") < 0, F.col("pages"))).alias("pages"),
        F.transform(in_order, lambda s: s.facts).alias("slots"),
    )


EXPRESSION = "host string, form binary, told string, pages bigint, slots array<array<bigint>>"


def _aligned(group: pd.DataFrame) -> pd.DataFrame:
    """One expression for some of a host, in the order of their names."""
    group = group.sort_values("form")
    whole, pages = None, 0
    for told, n, slots in zip(group["told"], group["pages"], group["slots"], strict=True):
        part = read_told(json.loads(told), iter([list(map(int, s)) for s in slots]))
        whole = merge(whole, part, added) if whole else part
        pages += int(n)
    host, told = group["host"].iloc[0], spelled(whole)
    slots = [s.data for s in whole.slots()]
    return pd.DataFrame(
        {"host": [host], "form": [form_of(host, told)], "told": [told], "pages": [pages], "slots": [slots]}
    )


def wrappers(expressions: DataFrame) -> DataFrame:
    """One expression a host, aligned in rounds of groups of about ``GROUP_FORMS``."""
    now = expressions
    while True:
        sizes = now.groupBy(F.col("host").alias("h")).agg(F.count("*").alias("n"))
        if not sizes.where("n > 1").limit(1).count():
            return now
        sizes = keep(sizes, "hosts")
        dealt = join_facts(now, sizes.withColumnRenamed("h", "host"), "host", "n")
        n_groups = F.ceil(F.col("n") / GROUP_FORMS)
        dealt = dealt.withColumn("part", F.pmod(F.xxhash64("form"), n_groups))
        single = dealt.where("n = 1").select(*expressions.columns)
        more = dealt.where("n > 1").groupBy("host", "part").applyInPandas(_aligned, EXPRESSION)
        now = keep(single.unionByName(more), "wrappers")


def _is_noise(key: str) -> bool:
    return key.endswith("!") or key.split(".")[0] in LEFT_OUT


def _is_header(key: str) -> bool:
    return key.endswith("^") or key.split(".")[0] == "header"


def article_slots(wrapper: Part) -> set[int]:
    """Identities of the slots that hold the article."""
    regions: dict[str, list[Part]] = {"article": [], "main": []}

    def find(part: Part, inside: tuple[str, ...]) -> None:
        if (_is_noise(part.key) and not part.key.startswith("form")) or (_is_header(part.key) and not inside):
            return  # a form may hold a whole page
        if part.key in regions and part.key not in inside:
            regions[part.key].append(part)
            inside = (*inside, part.key)
        for inner in part.parts:
            find(inner, inside)

    def kept(part: Part, headers: bool) -> Iterator[Part]:
        if part.key == TEXT:
            yield part
        elif not _is_noise(part.key) and (headers or not _is_header(part.key)):
            for inner in part.parts:
                yield from kept(inner, headers)

    find(wrapper, ())
    for name in ("article", "main"):
        found = {id(s) for region in regions[name] for s in kept(region, True)}
        if found:
            return found

    def same(slot: Part) -> bool:
        pages, _, _, lo, hi = slot.data
        return pages >= TEMPLATE_PAGES and lo == hi

    repeated = all(same(s) for s in wrapper.slots())  # one page, often

    def own(slot: Part) -> int:
        _, chars, links, _, _ = slot.data
        return 0 if same(slot) and not repeated or 2 * links > chars else chars - links

    def mass(part: Part) -> int:
        return sum(own(s) for s in kept(part, False))

    region, whole = wrapper, mass(wrapper)
    while True:
        holders = region.parts
        inner = next((p for p in holders if p.key != TEXT and not _is_noise(p.key) and not _is_header(p.key)
                      and mass(p) > MOST * whole), None)
        if inner is None or not (inner.key.split(".")[0] in CONTAINERS or inner.key == ANY or inner.key[0] == "("):
            return {id(s) for s in kept(region, False) if own(s)}
        region = inner


def kept_slots(told: str, slots: list, wrapper_told: str, wrapper_slots: list) -> list[int]:
    """Numbers of an expression's slots that its host's wrapper counts to the article."""
    wrapper = read_told(json.loads(wrapper_told), iter(wrapper_slots))
    article = article_slots(wrapper)
    for slot in wrapper.slots():
        slot.data = [-1] if id(slot) in article else [-2]
    own = read_told(json.loads(told), iter([[i] for i in range(len(slots))]))
    both = merge(wrapper, own, joined_lists)
    return sorted(i for s in both.slots() if -1 in s.data for i in s.data if i >= 0)


def choose_slots(expressions: DataFrame, wrapped: DataFrame) -> DataFrame:
    """The chosen slots of each expression."""
    sizes = expressions.groupBy("host").agg(F.count("*").alias("_acct_n"))
    facts = keep(
        wrapped.select("host", F.col("told").alias("w_told"), F.col("slots").alias("w_slots")).join(sizes, "host"),
        "host-wrappers",
    )
    told = join_facts(expressions.select("host", "form", "told", "slots"), facts, "host", "_acct_n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("told", "slots", "w_told", "w_slots")]
            chosen = [kept_slots(*row) for row in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("form"), pa.array(chosen, pa.list_(pa.int32()))], [FORM, "_acct_chosen"]
            )

    return told.select("form", "told", "slots", "w_told", "w_slots").mapInArrow(
        run, f"{FORM} binary, _acct_chosen array<int>"
    )


def page_blocks(pages: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, the page's expression, and each block of text with its slot, in page order."""
    given = _pages(pages, keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrays.blocks(batch, "_acct_html"):
                out_forms, out_slots, out_blocks = [], [], []
                for host, source in zip(
                    part.column("_acct_host").to_pylist(), part.column("_acct_html").to_pylist(), strict=True
                ):
                    page = Page(source)
                    of = [0] * len(page.blocks)
                    for n, slot in enumerate(page.root.slots()):
                        for i in slot.data:
                            of[i] = n
                    out_forms.append(form_of(host, spelled(page.root)))
                    out_slots.append(of)
                    out_blocks.append(page.blocks)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(k) for k in keys], pa.array(out_forms, pa.binary()),
                     pa.array(out_slots, pa.list_(pa.int32())), pa.array(out_blocks, pa.list_(pa.string()))],
                    [*keys, FORM, SLOTS, FOUND],
                )

    kinds = ", ".join(f"`{k}` {given.schema[k].dataType.simpleString()}" for k in keys)
    return given.mapInArrow(run, f"{kinds}, {FORM} binary, {SLOTS} array<int>, {FOUND} array<string>")


def extract(
    pages: DataFrame, keys: list[str], broadcast_forms: int = BROADCAST_FORMS
) -> tuple[DataFrame, DataFrame]:
    """``keys``, ``text`` and ``n_chars`` of every page (``url``, ``html``), and the hosts' wrappers.

    Wrappers have ``host``, ``pages``, ``told`` and ``slots``; ``read_told`` and ``Part.expression`` spell one out.
    """
    expressions = keep(forms(pages), "page-forms")
    wrapped = wrappers(expressions)
    chosen = keep(choose_slots(expressions, wrapped), "form-slots")
    told = page_blocks(pages, keys)
    if chosen.count() <= broadcast_forms:
        joined = told.join(F.broadcast(chosen), FORM)
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_acct_salt")
        dealt = told.withColumn("_acct_salt", F.pmod(F.xxhash64(FOUND), F.lit(SALTS)).cast("int"))
        joined = dealt.join(chosen.select("*", salts), [FORM, "_acct_salt"])
    both = F.arrays_zip(SLOTS, FOUND)
    taken = F.filter(both, lambda b: F.array_contains("_acct_chosen", b[SLOTS]))
    text = F.array_join(F.transform(taken, lambda b: b[FOUND]), "\n")
    return joined.select(*keys, text.alias("text"), F.length(text).cast("bigint").alias("n_chars")), wrapped
