"""HTML extraction: wrappers inferred as union-free regular expressions, one for each host.

A page becomes a stream of block tags and texts; inline tags leave no token. Its own
expression comes first: neighbours that repeat, one by one or as groups, are folded into
repeated groups. Pages of one host are then aligned, level by level, at the tokens that they
share: what only one side has becomes optional, what repeats is folded again, and texts
become slots that are constant or vary. The expression has no alternatives. Where a level
has too many parts to be told apart by order, it becomes a repeated group of optional parts,
so a wrapper's size depends on the kinds of tags, not on the number of pages.

All pages take part. Tasks count pages by host and expression first, with sums for every
slot; only different expressions are aligned, a bounded number of one host at a time, in an
order that hangs on the expressions alone. So a host with a third of all pages is spread
over the tasks and meets in a few rows, and the result does not depend on how rows are dealt.

The wrapper says which parts hold the article: its ``article`` elements; else ``main`` ones;
else the smallest part that holds most of the text that varies between pages and is not in
links. Menus, headers, footers, sidebars, notices, adverts, forms and comments in it are left
out by their element, role, class or id. In the third case texts that all pages of the host
share, and texts made of links, are left out, too; an ``article`` element is trusted with
both. A header inside an article holds its title and stays. A page in which the first kind
has no text is read by the next.

Defined cases: null or empty html has an empty text; pages without a host in their url are one
host; repeated pages count as often as they stand, and each has its row. Unclosed and stray
tags are read as browsers do: a block ends an open paragraph, an item the item before. Text
inside scripts, styles and elements that are not shown is markup. Ends of a page cut a tag
off. A page is one unit of work, however long, and its texts are kept whole.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator
from hashlib import blake2b

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.llm.store import written
from hazeline.operators.sizing import lookup_join

#: Parts of a level that are kept in order; more become a repeated group of optional parts.
MAX_PARTS = 24
#: Levels of nesting that make parts; deeper tags only end blocks.
MAX_DEPTH = 48
#: The longest group of neighbours that is looked for as a repeat.
MAX_PERIOD = 6
#: Expressions of one host that are aligned by one task at a time.
MERGED = 200
#: Hosts and expressions that a task counts before it hands them on.
COUNTED = 20_000
#: A part that holds this share of its parent's text is followed in place of the parent.
SHARE = 0.6

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SKIPPED = frozenset(
    "script style textarea title iframe noembed noframes noscript template svg math object canvas video audio select xmp".split()
)
_OPEN_ENDED = frozenset("script style textarea title iframe xmp".split())
_BLOCKS = frozenset(
    "address article aside blockquote button caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup legend li main menu nav ol p pre search section summary table tbody td tfoot th thead "
    "tr ul".split()
)
#: Elements that an opening tag ends, and those that it does not look beyond.
_ENDS = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu", "dir"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "main": (frozenset({"nav", "header", "aside", "form"}), frozenset()),
    "article": (frozenset({"nav", "header", "form"}), frozenset({"aside", "article", "main", "section", "div"})),
    "footer": (frozenset({"nav"}), frozenset({"article", "main", "section", "div", "aside"})),
}
#: Containers that say nothing about what they hold unless they have a class or an id.
_BARE = frozenset({"div", "section", "td", "center", "table", "dl"})
_NOISE_TAGS = frozenset("nav footer aside form button dialog menu fieldset search".split())
_NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
_NOISE_WORDS = frozenset(
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer login masthead menu menubar modal nav navbar navigation newsletter notice notices notification pager pagination popup "
    "promo promotion related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe "
    "subscription toolbar widget widgets".split()
)

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<!(?!--)[^>]*>?|<\?[^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|))*+)(>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


# ---------------------------------------------------------------- pages as trees


class Part:
    """A tag with its parts, a group (``()``), or a text slot (``#``).

    A slot has its texts, as (place, text, characters in links), or sums over pages:
    [texts, characters, characters in links, least hash, greatest hash].
    """

    __slots__ = ("label", "many", "maybe", "parts", "free", "texts", "sums")

    def __init__(self, label: str, parts: list[Part] | None = None):
        self.label, self.parts = label, parts if parts is not None else []
        self.many = self.maybe = self.free = False
        self.texts, self.sums = [], None

    @property
    def key(self) -> str:
        return "(" + " ".join(p.key for p in self.parts) + ")" if self.label == "()" else self.label


def label_of(tag: str, attributes: str) -> str:
    """Tag, role, and words of class and id that matter; ``!`` before what is not shown."""
    if not attributes.strip(" /\n\t\r\f"):
        return tag
    words, role, hidden = [], "", False
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name in ("class", "id"):
            words += _WORD.findall(_CAMEL.sub(" ", value).lower())
        elif name == "role":
            role = "".join(_WORD.findall(value.lower()))
        elif name == "itemprop" and value.lower() == "articlebody":
            role = role or "articlebody"
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            hidden = True
        elif name == "style" and "display:none" in value.lower().replace(" ", ""):
            hidden = True
    unique = sorted(set(words), key=lambda w: (w not in _NOISE_WORDS, w))[:4]
    return "!" * hidden + tag + "".join(f".{w}" for w in unique) + (f":{role}" if role else "")


def tree(page: str) -> Part:
    """The page's blocks as nested parts with their texts, not yet folded."""
    root = Part("page")
    stack, tags = [root], [""]
    held, links, in_link, place, at, n = [], 0, False, 0, 0, len(page)

    def flush() -> None:
        nonlocal held, links, place
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            if text:
                slot = Part("#")
                slot.texts.append((place, text, min(links, len(text))))
                place += 1
                stack[-1].parts.append(slot)
        held, links = [], 0

    def close(depth: int) -> None:
        flush()
        del stack[depth:], tags[depth:]

    while at < n:
        met = _TOKEN.search(page, at)
        end = met.start() if met else n
        if end > at:
            held.append(page[at:end])
            if in_link:
                links += end - at
        if not met:
            break
        at = met.end()
        tag = met[2]
        if tag is None:
            continue
        tag, closing = tag.lower(), met[1]
        if tag in _SKIPPED:
            if not closing:
                over = re.compile(f"</{tag}[\\s/>]", re.I).search(page, at)
                if over:
                    at = page.find(">", over.start()) + 1 or n
                elif tag in _OPEN_ENDED:
                    at = n
            continue
        if tag == "a":
            in_link = not closing
            continue
        if tag == "br":
            held.append(" ")
            continue
        if tag == "hr":
            flush()
            continue
        if tag not in _BLOCKS:
            continue
        if closing:
            for depth in range(len(tags) - 1, 0, -1):
                if tags[depth] == tag:
                    close(depth)
                    break
            else:
                flush()
            in_link = False
            continue
        flush()
        if tags[-1] == "p":
            close(len(tags) - 1)
        ended, beyond = _ENDS.get(tag, (None, None))
        if ended:
            for depth in range(len(tags) - 1, 0, -1):
                if tags[depth] in ended:
                    close(depth)
                    break
                if tags[depth] in beyond:
                    break
        if tag[0] == "h" and tags[-1][:1] == "h" and len(tag) == len(tags[-1]) == 2:
            close(len(tags) - 1)
        part = Part(label_of(tag, met[3]))
        if len(stack) <= MAX_DEPTH:
            stack[-1].parts.append(part)
            stack.append(part)
        else:
            stack.append(stack[-1])
        tags.append(tag)
    flush()
    return root


# ---------------------------------------------------------------- alignment


def join(a: Part, b: Part) -> Part:
    """One part that stands for both; they have the same key."""
    a.many, a.maybe = a.many or b.many, a.maybe or b.maybe
    if a.label == "#":
        a.texts += b.texts
        if b.sums:
            s, t = a.sums or b.sums, b.sums
            a.sums = t if a.sums is None else [s[0] + t[0], s[1] + t[1], s[2] + t[2], min(s[3], t[3]), max(s[4], t[4])]
        return a
    a.parts, a.free = align(a.parts, b.parts, a.free or b.free)
    return a


def align(a: list[Part], b: list[Part], free: bool = False) -> tuple[list[Part], bool]:
    """Both lists as one: shared parts in order, others optional; and whether order was given up."""
    if not free:
        out = []
        for i, j in _shared(a, b):
            out.append(join(a[i], b[j]) if i is not None and j is not None else _optional(a[i] if j is None else b[j]))
        out = fold(out)
        if len(out) <= MAX_PARTS:
            return out, False
        a, b = out, []
    known = {}
    for part in [*_flat(a), *_flat(b)]:
        part.many = part.maybe = True
        known[part.key] = join(known[part.key], part) if part.key in known else part
    return [known[k] for k in sorted(known)], True


def _flat(parts: list[Part]) -> list[Part]:
    """Parts without groups around them."""
    return [q for p in parts for q in (_flat(p.parts) if p.label == "()" else [p])]


def _optional(part: Part) -> Part:
    part.maybe = True
    return part


def _likeness(a: Part, b: Part) -> float:
    """The share of kinds of parts that both hold."""
    mine, theirs = {p.key for p in a.parts}, {p.key for p in b.parts}
    return len(mine & theirs) / max(len(mine), len(theirs)) if mine or theirs else 1.0


def _fit(a: Part, b: Part) -> float:
    """How well two parts match, 0 if they do not: containers without a name need something in common."""
    if a.key != b.key:
        return 0.0
    alike = _likeness(a, b)
    return 0.0 if not alike and a.label in _BARE and a.parts and b.parts else 1.0 + alike


def _repeats(a: Part, b: Part) -> bool:
    """Whether neighbours are one repeated part: containers without a name must hold much the same."""
    return a.key == b.key and (a.label not in _BARE or _likeness(a, b) > 0.5)


def _shared(a: list[Part], b: list[Part]) -> list[tuple[int | None, int | None]]:
    """The alignment of two lists with the best sum of fits, others in between."""
    if len(a) == len(b) and all(_fit(x, y) for x, y in zip(a, b, strict=True)):
        return [(i, i) for i in range(len(a))]
    fits = [[_fit(x, y) for y in b] for x in a]
    best = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            met = best[i + 1][j + 1] + fits[i][j] if fits[i][j] else 0.0
            best[i][j] = max(met, best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and fits[i][j] and best[i][j] == best[i + 1][j + 1] + fits[i][j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif j == len(b) or i < len(a) and best[i + 1][j] >= best[i][j + 1]:
            out.append((i, None))
            i += 1
        else:
            out.append((None, j))
            j += 1
    return out


def fold(parts: list[Part]) -> list[Part]:
    """Neighbours that repeat as one repeated part: single ones first, then groups."""
    out = []
    for part in parts:
        if out and _repeats(out[-1], part):
            out[-1] = join(out[-1], part)
            out[-1].many = True
        else:
            out.append(part)
    for period in range(2, MAX_PERIOD + 1):
        if len(out) < 2 * period:
            break
        at, folded = 0, []
        while at < len(out):
            group, times = out[at : at + period], 1
            while _again(group, out[at + times * period : at + (times + 1) * period], period):
                times += 1
            if times == 1:
                folded.append(out[at])
                at += 1
                continue
            for again in range(1, times):
                group = [join(x, y) for x, y in zip(group, out[at + again * period :], strict=False)]
            folded.append(Part("()", group))
            folded[-1].many = True
            at += times * period
        out = folded
    return out


def _again(group: list[Part], other: list[Part], period: int) -> bool:
    return len(other) == period and all(_repeats(x, y) for x, y in zip(group, other, strict=True))


def expression(part: Part) -> Part:
    """The page's own union-free expression: folded from the leaves up."""
    for piece in part.parts:
        if piece.parts:
            expression(piece)
    part.parts = fold(part.parts)
    if len(part.parts) > MAX_PARTS:
        part.parts, part.free = align(part.parts, [], True)
    return part


def slots(part: Part) -> list[Part]:
    """Text slots from left to right."""
    if part.label == "#":
        return [part]
    return [slot for piece in part.parts for slot in slots(piece)]


def shown(part: Part) -> list:
    """A part as nested lists; slots follow from the order."""
    flags = part.many + 2 * part.maybe + 4 * part.free
    return [part.label, flags, [shown(p) for p in part.parts]]


def read(form: list, sums: Iterator[list]) -> Part:
    """A part from ``shown`` and the sums of its slots, in order."""
    label, flags, parts = form
    part = Part(label, [read(p, sums) for p in parts])
    part.many, part.maybe, part.free = bool(flags & 1), bool(flags & 2), bool(flags & 4)
    if label == "#":
        part.sums = next(sums)
    return part


def _hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big") >> 1


def summed(slot: Part) -> list[int]:
    hashes = [_hash(text) for _, text, _ in slot.texts]
    return [len(slot.texts), sum(len(t) for _, t, _ in slot.texts), sum(k for _, _, k in slot.texts), min(hashes), max(hashes)]


# ---------------------------------------------------------------- which parts hold the article


def _tag(label: str) -> str:
    return re.split(r"[.:]", label.lstrip("!"), maxsplit=1)[0]


def is_noise(label: str, inside: bool) -> bool:
    """Whether a part is no text of the article; ``inside`` of an article a header is."""
    if label[0] == "!":
        return True
    tag, role = _tag(label), label.partition(":")[2]
    words = set(label.partition(":")[0].split(".")[1:])
    if tag in ("header", "hgroup") and inside:
        return bool((words - {"header"}) & _NOISE_WORDS)
    outer = tag == "header" or not inside and "header" in words
    return outer or tag in _NOISE_TAGS or role in _NOISE_ROLES or bool(words & _NOISE_WORDS)


def _is_article(label: str) -> bool:
    return _tag(label) == "article" or label.endswith(":articlebody") or label.endswith(":article")


def _is_main(label: str) -> bool:
    return _tag(label) == "main" or label.endswith(":main")


def _under(part: Part, wanted, inside: bool = False) -> list[Part]:
    """Slots under the topmost parts that are ``wanted``, without noise."""
    out = []
    for piece in part.parts:
        if piece.label == "#":
            out += [piece] if inside else []
        elif inside and is_noise(piece.label, True):
            continue
        elif not inside and wanted(piece.label):
            out += [] if is_noise(piece.label, True) else _under(piece, wanted, True)
        elif inside or not is_noise(piece.label, False) or _holds(piece, wanted) and not _comments(piece.label):
            out += _under(piece, wanted, inside)
    return out


def _comments(label: str) -> bool:
    return bool({"comment", "comments", "related", "replies", "sidebar", "widget"} & set(re.split(r"[.:]", label))) or _tag(label) == "aside"


def _holds(part: Part, wanted) -> bool:
    return any(wanted(p.label) or _holds(p, wanted) for p in part.parts)


def _plain(part: Part) -> list[Part]:
    """All slots but those in noise."""
    if part.label == "#":
        return [part]
    return [s for p in part.parts if p.label == "#" or not is_noise(p.label, False) for s in _plain(p)]


def _constant(slot: Part) -> bool:
    return slot.sums[0] > 1 and slot.sums[3] == slot.sums[4]


def _dense(part: Part) -> list[Part]:
    """Slots of the smallest part that holds most of the varying text outside links."""
    every = _plain(part)
    varying = [s for s in every if not _constant(s)]
    live = {id(s) for s in (varying or every) if 2 * s.sums[2] <= s.sums[1]}
    if not live:
        return []

    def mass(piece: Part) -> int:
        if piece.label == "#":
            return piece.sums[1] - piece.sums[2] if id(piece) in live else 0
        return 0 if is_noise(piece.label, False) else sum(mass(p) for p in piece.parts)

    while True:
        best = max((p for p in part.parts if p.label != "#"), key=mass, default=None)
        if best is None or best.many or mass(best) < SHARE * mass(part) or mass(best) == 0:
            break
        part = best
    return [s for s in _plain(part) if id(s) in live]


def marks(wrapper: Part) -> list[list[int]]:
    """Places of the slots that hold the article: by ``article``, by ``main``, by mass of text."""
    place = {id(slot): i for i, slot in enumerate(slots(wrapper))}
    return [
        [place[id(s)] for s in found]
        for found in (_under(wrapper, _is_article), _under(wrapper, _is_main), _dense(wrapper))
    ]


def chosen(wrapper: Part, marked: list[list[int]], page: Part) -> list[int]:
    """Places of the page's slots that the wrapper marks, by the first way that finds any."""
    matched, wrapped = {}, {id(s): i for i, s in enumerate(slots(wrapper))}

    def match(mine: list[Part], theirs: list[Part], free: bool) -> None:
        if free:
            by_key = {p.key: p for p in theirs}
            pairs = [(p, by_key[p.key]) for p in _flat(mine) if p.key in by_key]
        else:
            shared = _shared(mine, theirs)
            pairs = [(mine[i], theirs[j]) for i, j in shared if i is not None and j is not None]
            missed = [mine[i] for i, j in shared if j is None]
            loose = {p.key: p for p in theirs}
            pairs += [(p, loose[p.key]) for p in missed if p.key in loose]
        for p, q in pairs:
            if p.label == "#":
                matched[id(p)] = wrapped[id(q)]
            else:
                match(p.parts, q.parts, q.free)

    match(page.parts, wrapper.parts, wrapper.free)
    own = slots(page)
    for way in marked:
        good = set(way)
        found = [i for i, s in enumerate(own) if matched.get(id(s)) in good]
        if found:
            return found
    return []


# ---------------------------------------------------------------- Spark jobs


def host(url: str = "url") -> Column:
    """The host named in an address, in small letters; empty without one."""
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))




def expressions(pages: DataFrame) -> DataFrame:
    """host, form and the sums of its slots, for all pages: one row per host and expression."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {}

        def handed() -> pa.RecordBatch:
            rows = [{"host": h, "form": f, "sums": s} for (h, f), s in known.items()]
            known.clear()
            return pa.RecordBatch.from_pylist(rows, _COUNTED)

        for batch in batches:
            for name, page in zip(batch.column(0), batch.column(1), strict=True):
                whole = expression(tree(page.as_py() or ""))
                form = json.dumps(shown(whole), separators=(",", ":"))
                sums = [summed(s) for s in slots(whole)]
                key = (name.as_py(), form)
                if key in known:
                    sums = [[a[0] + b[0], a[1] + b[1], a[2] + b[2], min(a[3], b[3]), max(a[4], b[4])] for a, b in zip(known[key], sums, strict=True)]
                known[key] = sums
                if len(known) >= COUNTED:
                    yield handed()
        if known:
            yield handed()

    rows = pages.select(host().alias("host"), "html").mapInArrow(count, "host string, form string, sums array<array<bigint>>")
    cells = rows.select("host", "form", F.posexplode_outer("sums").alias("slot", "sum"))
    sums = [F.sum(F.col("sum")[i]).alias(f"s{i}") for i in range(3)] + [F.min(F.col("sum")[3]).alias("s3"), F.max(F.col("sum")[4]).alias("s4")]
    by_slot = cells.groupBy("host", "form", "slot").agg(*sums)
    cell = F.struct("slot", F.array(*(f"s{i}" for i in range(5))).alias("sums"))
    whole = F.sort_array(F.collect_list(F.when(F.col("slot").isNotNull(), cell)))
    return by_slot.groupBy("host", "form").agg(F.transform(whole, lambda c: c["sums"]).alias("sums"))


_COUNTED = pa.schema([("host", pa.string()), ("form", pa.string()), ("sums", pa.list_(pa.list_(pa.int64())))])


def wrappers(found: DataFrame) -> DataFrame:
    """host, form and marks: one wrapper for each host, aligned from its expressions in rounds."""
    found = found.select("host", F.xxhash64("form").alias("name"), "form", "sums")

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["name", "form"])
        whole = None
        for form, sums in zip(frame["form"], frame["sums"], strict=True):
            part = read(json.loads(form), iter([[int(v) for v in s] for s in sums]))
            whole = part if whole is None else join(whole, part)
        return pd.DataFrame(
            {
                "host": [frame["host"].iloc[0]],
                "name": [int(frame["name"].iloc[0])],
                "form": [json.dumps(shown(whole), separators=(",", ":"))],
                "sums": [[s.sums for s in slots(whole)]],
            }
        )

    schema = "host string, name bigint, form string, sums array<array<bigint>>"
    rounds = 0
    while True:
        counts = found.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
        most = counts.agg(F.max("n")).first()[0] or 0
        bucket = F.floor(F.col("n") / MERGED).cast("long") + 1
        dealt = found.join(counts, "host").withColumn("bucket", F.pmod("name", F.when(F.col("n") <= MERGED, 1).otherwise(bucket)))
        found = dealt.groupBy("host", "bucket").applyInPandas(merge, schema)
        if most <= MERGED:
            break
        rounds += 1
        found = written(found, f"wrappers-{rounds}")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for form, sums in zip(batch.column("form").to_pylist(), batch.column("sums").to_pylist(), strict=True):
                out.append(json.dumps(marks(read(json.loads(form), iter(sums)))))
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("form"), pa.array(out, pa.string())], ["host", "form", "marks"])

    return found.mapInArrow(mark, "host string, form string, marks string")


_REMEMBERED = 2048


def apply_wrappers(pages: DataFrame, found: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of each page, read by its host's wrapper."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host().alias("host"))
    met = lookup_join(rows, found, "host", ["page_id", "url"]).select("page_id", "url", "html", "form", "marks")
    kind = pages.schema["page_id"].dataType
    schema = T.StructType().add("page_id", kind).add("url", "string").add("text", "string").add("n_chars", "long")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ways, known = {}, {}
        for batch in batches:
            texts = []
            for page, form, marked in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                whole = expression(tree(page))
                key = (form, marked, json.dumps(shown(whole)))
                if key not in ways:
                    if len(ways) >= _REMEMBERED:
                        ways.clear()
                        known.clear()
                    if (form, marked) not in known:
                        wrapper = read(json.loads(form), iter(lambda: [], None))
                        known[form, marked] = wrapper, json.loads(marked)
                    ways[key] = chosen(*known[form, marked], whole)
                own = slots(whole)
                blocks = sorted((place, text) for i in ways[key] for place, text, _ in own[i].texts)
                texts.append("\n".join(text for _, text in blocks))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                schema.names,
            )

    return met.mapInArrow(extract, schema)


def extract(pages: DataFrame) -> DataFrame:
    """The main text of every page: page_id, url, text and n_chars."""
    return apply_wrappers(pages, written(wrappers(written(expressions(pages), "page-forms")), "page-wrappers"))
