"""HTML extraction by union-free wrapper inference per host.

A page is a stream of tags and texts. Runs of equal groups are folded into one repeated group, so pages of one template
give few distinct streams. Per host the distinct streams are aligned one after the other: where the next stream and the
wrapper so far disagree, the group that only one of them has becomes optional, or repeated if it repeats its neighbour;
every text is a place of its own. The result is a wrapper: a union-free expression of tags, optional and repeated
groups, and text places.

Every page is then matched to its host's wrapper, which says the place of each of its texts. Texts are compared place by
place over the different pages of the host: what most of them say in one place is a constant of the template, everything
else fills a slot. Outside articles a place's pages decide, there also by its path where the alignment splits a place;
inside articles all pages with an article, and a page that would lose more than half of its article keeps it all, as it
is rather one of several near copies. Near copies outside articles count as different pages.

The main text is what fills the wrapper's slots in the content region: inside ``article``, else ``main``, else a content
container, else the body, without menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
comments (by fixed lists of elements, roles and class words; by ids outside content, in content if the id has no other
words, inside articles if most of the host's different pages have it, too). Character references are decoded, white space inside a
block becomes one space, blocks are joined by a line feed, and nothing else is dropped.

Streams are counted over all pages, then aligned in levels: groups of streams, then groups of the groups' wrappers, so no
task holds a host's pages or streams. Defined cases: a null or empty html gives an empty text; a null or broken url is a host of its own;
unclosed elements end with their parent, an unclosed script or comment at the end of the page; repeated rows give equal
results; an empty table gives an empty result. Columns other than page_id, url and html are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
import xxhash

from cohortlens.sources.scratch import written

#: Fixed lists: elements that hold no main text, elements whose content is no markup, elements without content, and
#: elements that start and end a block.
_NO_TEXT = frozenset("nav header footer aside form script style noscript template iframe svg select button object dialog menu".split())
_RAW = frozenset("script style textarea title noscript iframe xmp".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body br caption dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Fixed list: elements that a new one of the named kind closes.
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"},
}
#: Fixed list: words of classes, ids and roles that mark what is not main text, and what is.
_MARKS = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|topnav|subnav|sitenav|navigation|menu|mainmenu|submenu|menubar|breadcrumbs?|header|masthead|banner|footer|"
    r"side-?bar|aside|complementary|ads?|adbox|adslot|adsense|adunit|advert|adverts|advertisement|advertising|sponsor|sponsored|promo|promotion|cookies?|consent|notice|notices|alert|"
    r"popup|modal|newsletter|subscribe|subscription|signup|login|search|form|dialog|alertdialog|comments?|comment-?(?:list|section|area|box|form|thread)|respond|replies|disqus|"
    r"share|sharing|social|related|recommended|widget|pagination|pager|skip|toolbar|contentinfo)(?=$|[\s_-])"
)
_HEADINGS = ("header", "banner", "masthead")
_TITLED = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Fixed list: words of an id that say nothing of their own beside a mark, as in ``top-nav`` or ``comment-list``.
_BESIDE = frozenset(
    "top bottom left right main site page post posts global primary secondary mobile inner outer wrap wrapper container block box "
    "bar list item items area section links link buttons button icons thread content title text".split()
)
_CONTENT = re.compile(r"(?:^|[\s_-])(?:content|article|post|entry|story|main|text|articlebody)(?=$|[\s_-])")
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>\"'<]*+)"
    r"(?P<rest>[^>\"']*+(?:\"[^\"]*+\"[^>\"']*+|'[^']*+'[^>\"']*+)*+)>|<[!?/][^>]*+>?|</?[a-zA-Z][^>]*+(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|itemprop|hidden|aria-hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
#: A path inside a heading.
_HEADING = re.compile(r"(?:^|/)h[1-6](?=[./]|$)")
#: A text is a constant of its host's template if this many different pages, and this share of those that have the slot, hold it.
LEAST_PAGES, LEAST_SHARE = 3, 0.6
#: An article keeps its constants if they are more than this share of its characters.
MOST_CONSTANT = 0.5
#: Hosts whose wrappers, and streams whose places, a task keeps at hand.
_HOSTS, _MATCHED = 256, 4096
#: Streams that one task aligns, on average.
_STREAMS = 64
#: The hosts' slots and constants are broadcast if their text is no longer than this, else joined by a shuffle.
BROADCAST_BYTES = 16 << 20


@dataclass
class Text:
    """A text in a page: its path of elements, what it says, its block, and where it stands."""

    path: str
    said: str
    block: int
    dropped: bool
    region: int
    ids: tuple[str, ...] = ()  # around it inside an article, ids that mark what is not main text if the host repeats them


def _marking_id(value: str) -> bool:
    """Whether an id consists of marks and the words beside them; ids made of a title (related-work) have other words, too."""
    pieces = [piece for piece in re.split(r"[\s_-]+", value) if piece and not piece.isdigit()]
    return bool(_MARKS.fullmatch(value)) or any(_MARKS.search(piece) for piece in pieces) and all(piece in _BESIDE or _MARKS.search(piece) for piece in pieces)


@lru_cache(maxsize=4096)
def _attributes(rest: str) -> tuple[str, str, str, bool, bool]:
    """Class, id and role as words, class and role alone, the id, whether the element is hidden, whether it is marked as content."""
    words, roles, own, hidden, content = [], [], "", False, False
    for name, *values in _ATTRIBUTE.findall(rest):
        value, name = next((v for v in values if v), "").lower(), name.lower()
        if name in ("class", "id", "role"):
            words.append(value)
            if name == "id":
                own = own or value.strip()
            else:
                roles.append(value)
        hidden |= name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", "")
        content |= name in ("class", "id", "itemprop") and bool(_CONTENT.search(value))
        if name == "role" and value == "main":
            content = True
    return " ".join(words), " ".join(roles), own, hidden, content


def _spaced(said: str) -> str:
    """The text with every run of white space as one space."""
    words = said.split()
    if not words:
        return " " if said else ""
    return (" " if said[0].isspace() else "") + " ".join(words) + (" " if said[-1].isspace() else "")


def parse(page: str | None) -> tuple[list[str], list[Text]]:
    """The page's stream of tags and text places, and its texts."""
    stream: list[str] = []
    texts: list[Text] = []
    # name, path, dropped so far, region so far (0 body, 1 content container, 2 main, 3 article), ids that may mark
    stack: list[tuple[str, str, bool, int, tuple[str, ...]]] = [("", "", False, 0, ())]
    block, at, page = 0, 0, page or ""
    while at < len(page):
        token = _TOKEN.search(page, at)
        upto = token.start() if token else len(page)
        if upto > at:
            said = _spaced(html.unescape(page[at:upto]))
            if said and said != " ":
                path, dropped, region, ids = stack[-1][1:]
                texts.append(Text(path, said, block, dropped, region, ids))
                stream.append(f"#{'-' if dropped else region}{path}")
            elif said and texts and texts[-1].block == block:
                texts[-1].said += " "
        if token is None:
            break
        at, (end, name, rest) = token.end(), token.group("end", "name", "rest")
        if not name:
            continue
        name = name.lower()
        if end:
            if stack[-1][0] == name:
                stack.pop()
                stream.append(f"/{name}")
            elif depth := next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name), 0):
                del stack[depth:]
                stream.append(f"/{name}")
            block += name in _BLOCK
            continue
        if name in _BLOCK:
            block += 1
            closed = _CLOSES.get(name, ())
            while stack[-1][0] in closed:
                stack.pop()
            if name != "br":  # a block ends an open paragraph and the inline elements in it
                depth = len(stack) - 1
                while depth and stack[depth][0] not in _BLOCK:
                    depth -= 1
                if depth and stack[depth][0] == "p":
                    del stack[depth:]
        known = "=" in rest or "hidden" in rest
        words, roles, own_id, hidden, content = _attributes(rest) if known else ("", "", "", False, False)
        label = name + ("." + ".".join(words.split()) if words else "")
        stream.append(label)
        if name in _VOID or rest.endswith("/"):
            continue
        if name in _RAW:
            closing = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, at)
            if closing or name in ("script", "style"):
                at = closing.end() if closing else len(page)
            continue
        path, before, region, ids = stack[-1][1:]
        # A header inside an article is the article's own heading.
        own = name in _NO_TEXT and not (name == "header" and region == 3)
        # An id is often made of a title: it marks no heading, in content only as a whole, in an article if the host repeats it.
        marked = bool(words) and name not in ("body", "html", "article", "main")
        if marked and own_id:
            marking = name not in _TITLED and _marking_id(own_id)
            if region == 3 and marking and own_id not in _HEADINGS:
                ids += (own_id,)
            words = words if region == 0 and name not in _TITLED or region < 3 and marking else roles
        marked = marked and any(region < 3 or m.strip(" _-") not in _HEADINGS for m in _MARKS.findall(words))
        dropped = before or hidden or own or marked
        content = content and name not in ("body", "html")
        if name == "article" and words and re.search(r"(?:^|[\s_-])comments?(?=$|[\s_-])", words):
            dropped = True
        region = max(region, 3 if name == "article" else 2 if name == "main" else 1 if content and not dropped else 0)
        stack.append((name, f"{path}/{label}" if len(stack) > 1 else label, dropped, region, ids))
    return stream, texts


def main_text(page: str | None, slots: set[str], constants: set[tuple[str, int]], wrapper: Wrapper | None = None) -> str:
    """What fills the wrapper's content slots of the innermost region that the page has.

    ``slots`` are the wrapper's text places by region and path, ``constants`` (place, digest of the text) pairs.
    """
    stream, texts = parse(page)
    constant = _constant_texts(stream, texts, constants, wrapper) if constants and wrapper else set()
    if constants:
        for t in texts:
            t.dropped |= any((f"3:#{own}", 0) in constants for own in t.ids)
    kept: dict[int, list[tuple[Text, bool]]] = {}
    for i, t in enumerate(texts):
        if not t.dropped and f"{t.region}{t.path}" in slots and (t.region == 3 or i not in constant):
            kept.setdefault(t.region, []).append((t, i in constant))
    region = max(kept, default=0)
    chosen = kept.get(region, [])
    if region == 3:
        headings = _section_headings(chosen)
        chosen = [(t, c and t.block not in headings) for t, c in chosen]
        size, gone = sum(len(t.said) for t, _ in chosen), sum(len(t.said) for t, c in chosen if c)
        if gone <= MOST_CONSTANT * size:
            chosen = [(t, c) for t, c in chosen if not c]
    blocks: dict[int, list[str]] = {}
    for t, _ in chosen:
        blocks.setdefault(t.block, []).append(t.said)
    joined = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(b for b in joined if b)


def _section_headings(chosen: list[tuple[Text, bool]]) -> set[int]:
    """Blocks of an article's headings under which a slot stands: main text, though most of a host's articles repeat them."""
    found: set[int] = set()
    open_blocks: set[int] = set()
    after = True  # whether something else than a heading came since the last heading
    for t, constant in chosen:
        heading = bool(_HEADING.search(t.path))
        if heading and after:
            open_blocks = set()
        if not constant:
            found |= open_blocks
        if heading:
            open_blocks.add(t.block)
        after = not heading
    return found


def _digest(said: str) -> int:
    return xxhash.xxh3_64_intdigest(said.strip()) - (1 << 63)


class Wrapper:
    """A host's wrapper, to which its pages are matched."""

    def __init__(self, wrapper: str):
        self._cores = [_plain(item) for item in wrapper.split("\t")]
        self._known: dict[tuple[str, ...], list[str]] = {}
        self.slots = set(wrapper_slots(wrapper))

    def places(self, stream: list[str]) -> list[str]:
        """For each text of a page, in order, its place: the item of the wrapper and the text in it, or else its path."""
        items = folded(stream)
        found = self._known.get(name := tuple(items))
        if found is None:
            cores = [_plain(item) for item in items]
            item_of: dict[int, int] = {}
            for at, own, n in SequenceMatcher(None, self._cores, cores, autojunk=False).get_matching_blocks():
                item_of.update((own + k, at + k) for k in range(n))
            found = []  # per folded item, the places of its texts
            for i, core in enumerate(cores):
                words = [w for w in core.split(" ") if w.startswith("#")]
                found.append([f"{item_of[i]}.{k}" if i in item_of else f"/{w[1:]}" for k, w in enumerate(words)])
            if len(self._known) >= _MATCHED:
                self._known.clear()
            self._known[name] = found
        out: list[str] = []
        at = 0
        for item, own in zip(items, found):
            group = _plain(item).split(" ") if item.startswith("(") else [item]
            while True:
                out += own
                at += len(group)
                if not item.startswith("(") or stream[at : at + len(group)] != group:
                    break
        return out


def _named_places(t: Text, place: str) -> tuple[str, ...]:
    """The names under which a text is counted: its place, outside articles its path, too."""
    return (f"3:{place}",) if t.region == 3 else (place, f"/{t.region}{t.path}")


def _constant_texts(stream: list[str], texts: list[Text], constants: set[tuple[str, int]], wrapper: Wrapper) -> set[int]:
    """The numbers of the texts that are constants in their places."""
    digests = {d for _, d in constants}
    maybe = [(i, t, d) for i, t in enumerate(texts) if not t.dropped and (d := _digest(t.said)) in digests]
    places = wrapper.places(stream) if maybe else []
    return {i for i, t, d in maybe if any((place, d) in constants for place in _named_places(t, places[i]))}


def folded(stream: list[str], longest: int = 12) -> list[str]:
    """The stream with runs of equal groups written once, in brackets with a plus."""
    out: list[str] = []
    i = 0
    while i < len(stream):
        for width in range(1, min(longest, (len(stream) - i) // 2) + 1):
            if stream[i + width] != stream[i]:
                continue
            group = stream[i : i + width]
            times = 1
            while stream[i + times * width : i + (times + 1) * width] == group:
                times += 1
            if times > 1:
                out.append("(" + " ".join(group) + ")+")
                i += times * width
                break
        else:
            out.append(stream[i])
            i += 1
    return out


def _plain(item: str) -> str:
    return item[1:-2] if item.startswith("(") else item


def _optional(items: list[str]) -> list[str]:
    """Items that only some pages have: already optional ones stay, the rest becomes one optional group."""
    out: list[str] = []
    for item in items:
        if item.startswith("(") and item[-1] in "?*":
            out.append(item)
        elif item.endswith(")+"):
            out.append(item[:-1] + "*")
        else:
            out.append(f"({item})?")
    return out


def align(wrapper: list[str], stream: list[str]) -> list[str]:
    """The smallest change of the wrapper that also accepts the stream: mismatches become optional or repeated groups."""
    cores = [_plain(w) for w in wrapper]
    others = [_plain(s) for s in stream]
    out: list[str] = []
    for kind, a, b, c, d in SequenceMatcher(None, cores, others, autojunk=False).get_opcodes():
        if kind == "equal":
            for w, s in zip(wrapper[a:b], stream[c:d]):
                many = "+" in (w[-1] + s[-1]) and (w + s).startswith("(") or w.endswith(")*") or s.endswith(")*")
                maybe = w.endswith((")?", ")*")) or s.endswith((")?", ")*"))
                core = _plain(w)
                out.append(core if not (many or maybe) else f"({core}){'*' if many and maybe else '+' if many else '?'}")
            continue
        left, right = wrapper[a:b], stream[c:d]
        previous = _plain(out[-1]) if out else None
        for part in (left, right):
            if len(part) == 1 and _plain(part[0]) == previous:  # one more of the group before: it repeats
                out[-1] = f"({previous}){'*' if out[-1].endswith((')?', ')*')) else '+'}"
            else:
                out += _optional(part)
    return out


def wrapper_of(streams: list[str]) -> str:
    """Align streams one after the other, the most frequent first; the result is a stream of the same kind."""
    wrapper: list[str] | None = None
    for stream in streams:
        items = stream.split("\t")
        wrapper = items if wrapper is None else align(wrapper, items)
    return "\t".join(wrapper or [])


def host(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1)), F.lit(""))


def wrapper_slots(wrapper: str) -> list[str]:
    """The content slots of a wrapper, each as its region and path."""
    places = (word for item in wrapper.split("\t") for word in _plain(item).split(" "))
    return sorted({w[1:] for w in places if w.startswith("#") and w[1:2] != "-"})


def _page_digest(texts: list[Text]) -> int:
    """What tells a page from its copies: all that it says outside what is dropped."""
    said = "\0".join(f"{t.region}{t.path}\0{t.said.strip()}" for t in texts if not t.dropped)
    return xxhash.xxh3_64_intdigest(said) - (1 << 63)


def observed(pages: DataFrame) -> DataFrame:
    """(host, stream, pages): the distinct folded streams of every host and their pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = zip(batch.column(0).to_pylist(), batch.column(1))
            counts = Counter((name, "\t".join(folded(parse(page.as_py())[0]))) for name, page in each)
            columns = list(zip(*counts)) or [(), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.string()) for c in columns] + [pa.array(list(counts.values()), pa.int64())], names=["host", "stream", "pages"]
            )

    found = pages.select(host(F.col("url")).alias("host"), "html").mapInArrow(run, "host string, stream string, pages long")
    return found.groupBy("host", "stream").agg(F.sum("pages").alias("pages"))


def _at_hand(known: dict[str, Wrapper], name: str, wrapper: pa.Scalar) -> Wrapper:
    if name not in known:
        if len(known) >= _HOSTS:
            known.clear()
        known[name] = Wrapper(wrapper.as_py() or "")
    return known[name]


def placed_texts(rows: DataFrame) -> DataFrame:
    """(host, place, digest, pages): how many different pages of a host say a text in a place; with a null digest, how many
    have the place, and under the place ``3`` how many have an article; an id that may mark is a place ``3:#id`` with the
    digest 0. ``rows`` are host, html, wrapper. Copies count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Wrapper] = {}
        for batch in batches:
            seen: set[tuple] = set()
            for name, page, wrapper in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                stream, texts = parse(page.as_py())
                if all(t.dropped for t in texts):
                    continue
                places, voter = _at_hand(known, name, wrapper).places(stream), _page_digest(texts)
                for t, place in zip(texts, places):
                    if not t.dropped:
                        seen.update((name, f"3:#{own}", 0, voter) for own in t.ids)
                        names, digest = _named_places(t, place), _digest(t.said)
                        seen.update((name, p, digest, voter) for p in names)
                        seen.update((name, p, None, voter) for p in (("3",) if t.region == 3 else names))
            columns = list(zip(*seen)) or [(), (), (), ()]
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds)], names=["host", "place", "digest", "voter"]
            )

    found = rows.select("host", "html", "wrapper").mapInArrow(run, "host string, place string, digest long, voter long").distinct()
    return found.groupBy("host", "place", "digest").agg(F.count("*").alias("pages"))


def wrappers(counted: DataFrame) -> DataFrame:
    """(host, pages, wrapper, slots): the wrapper of every host, from all its distinct streams."""
    streams = counted.select("host", "stream", "pages")

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["pages", "stream"], ascending=[False, True])
        first = rows.iloc[0]
        return pd.DataFrame({
            "host": [first.host], "part": [first.part], "stream": [wrapper_of(rows.stream.tolist())], "pages": [rows.pages.sum()]
        })

    parts = -(-streams.count() // _STREAMS) or 1
    whole = streams.withColumn("part", F.xxhash64("stream"))
    while True:  # each level leaves a part of the streams, until a host has one
        dealt = whole.withColumn("part", F.pmod("part", F.lit(parts)))
        whole = dealt.groupBy("host", "part").applyInPandas(one, "host string, part long, stream string, pages long")
        if parts == 1:
            break
        parts = -(-parts // _STREAMS)
    whole = whole.select("host", "pages", F.col("stream").alias("wrapper"))

    @F.arrow_udf("array<string>")
    def slots(found: pa.Array) -> pa.Array:
        return pa.array([wrapper_slots(w) for w in found.to_pylist()], pa.list_(pa.string()))

    return whole.withColumn("slots", slots("wrapper"))


def template_constants(placed: DataFrame) -> DataFrame:
    """(host, constants): the texts that most of a host's different pages hold in the same place."""
    pages = placed.where("digest is null").select("host", F.col("place").alias("of"), F.col("pages").alias("all"))
    texts = placed.where(f"digest is not null and pages >= {LEAST_PAGES}")
    texts = texts.withColumn("of", F.when(F.col("place").startswith("3:"), "3").otherwise(F.col("place")))
    constant = texts.join(pages, ["host", "of"]).where(F.col("pages") >= LEAST_SHARE * F.col("all"))
    return constant.groupBy("host").agg(F.collect_set(F.struct("place", "digest")).alias("constants"))


def _with_hosts(rows: DataFrame, known: DataFrame) -> DataFrame:
    """``rows`` with what is known of their hosts."""
    size = known.agg(F.sum(F.length(F.to_json(F.struct("*")))).alias("n")).first()["n"] or 0
    return rows.join(F.broadcast(known) if size <= BROADCAST_BYTES else known, "host", "left")


def extracted(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    rows = pages.select("page_id", "url", "html").withColumn("host", host(F.col("url")))
    known = written(wrappers(written(observed(pages), "streams")).select("host", "wrapper"), "wrappers")
    placed = written(placed_texts(_with_hosts(rows.select("host", "html"), known)), "texts")
    rows = _with_hosts(rows, written(known.join(template_constants(placed), "host", "left"), "templates"))

    @F.arrow_udf("string")
    def extract(names: pa.Array, content: pa.Array, wrappers: pa.Array, constants: pa.Array) -> pa.Array:
        out: list[str] = []
        known: dict[str, Wrapper] = {}
        pairs: dict[str, set[tuple[str, int]]] = {}
        for name, page, wrapper, held in zip(names.to_pylist(), content, wrappers, constants):
            own = _at_hand(known, name, wrapper)
            if name not in pairs:
                pairs[name] = {(c["place"], c["digest"]) for c in held.as_py()} if held.is_valid else set()
            out.append(main_text(page.as_py(), own.slots, pairs[name], own))
        return pa.array(out, pa.string())

    done = rows.select("page_id", "url", extract("host", "html", "wrapper", "constants").alias("text"))
    return done.withColumn("n_chars", F.length("text").cast("long"))
