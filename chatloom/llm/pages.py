"""Main text of web pages: blocks by markup, and a suffix array for each host that finds what its pages repeat.

Pages are dealt by host, large hosts in shards, so that a task holds the token streams of a bounded number of characters. What a
large host repeats is counted over all its shards, by hashes of runs of tokens. For other hosts, a task concatenates the streams, with a mark between pages that is like nothing else, and sorts all suffixes by their first tokens: ranks of
single tokens, then of pairs, fours and so on, each from two ranks of half the length. Neighbours of one rank begin alike for
that long, so what distinct pages repeat are runs of suffixes of one rank, and longer repeats are covered by several. Blocks
that are covered are a host's template, unless the markup says that they belong to the article.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, reachable

#: Elements of HTML by what they do to text.
VOID = frozenset("area base basefont bgsound br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter nobr output progress q rb rp rt rtc ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Elements whose text is never the article's.
OUTSIDE = frozenset("script style textarea title xmp iframe noembed noframes noscript template head nav footer aside form button select option datalist dialog menu svg math canvas audio video object applet map".split())
PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th figcaption caption".split())
#: An opening element ends an open one of these, unless one of the others stands between.
ENDS = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)), "td": ("td th", ("table", "tr")), "th": ("td th", ("table", "tr")), "option": ("option", ("select",)), "optgroup": ("option optgroup", ("select",))}
#: Words of class, id and role that tell what is not the article, and what is.
ASIDE_WORDS = frozenset(
    "ad ads adsense adsbygoogle advert adverts advertisement advertising adslot adbox banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices disclaimer alert popup modal overlay newsletter subscribe subscription "
    "signup login sidebar menu menubar nav navbar navigation breadcrumb breadcrumbs pagination pager footer masthead topbar toolbar comment comments commentlist disqus reply replies respond share sharing social related recommended recommendations "
    "widget widgets teaser search skip skiplink complementary contentinfo dialog alertdialog".split()
)
HEADER_WORDS = frozenset(("header", "siteheader", "pageheader", "banner", "masthead"))
BODY_WORDS = frozenset("article articlebody articletext articlecontent main maincontent content pagecontent blogpost post postbody posttext postcontent singlepost entry entrycontent entrybody story storybody bodytext".split())
NOT_WORDS = frozenset(("has", "with", "no", "without", "show"))
#: What text stands in, from the surest of not being the article to the surest of being it. Inner is an article in what a class
#: tells to be aside; content, main and article are told by classes and roles, by main and by article.
LEVELS = ("outside", "aside", "inner", "open", "content", "main", "article")
NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
REST = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
WORDS = re.compile(r"[A-Za-z]+")
#: Large hosts that are sent to all tasks, at most; more are joined.
LARGE = 100_000
HIDDEN = re.compile(r"(?i)(?:display\s*:\s*none|visibility\s*:\s*hidden)")


class Block(NamedTuple):
    """Text between two boundaries, and its kind, which is one of LEVELS."""

    text: str
    kind: str
    links: int
    paragraph: bool
    parent: int


class _Open(NamedTuple):
    name: str
    kind: str
    link: bool
    paragraph: bool
    parent: int


@lru_cache(1 << 14)
def _kind(name: str, attributes: str, around: str) -> str:
    """What an element makes of the text in it, by what it stands in."""
    if around == "outside" or name in OUTSIDE:
        return "outside"
    said: list[str] = []
    whole: set[str] = set()
    for key, *values in ATTRIBUTE.findall(attributes) if attributes.strip(" /") else ():
        key, value = key.lower(), next(filter(None, values), "")
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and HIDDEN.search(value)):
            return "outside"
        if key in ("class", "id", "role", "itemprop"):
            for one in value.split():
                # sidebar, side-bar and sideBar-left are told by their parts; has-sidebar isn't one
                parts = [w.lower() for w in WORDS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", one))]
                parts = parts[: next((i for i, w in enumerate(parts) if w in NOT_WORDS), len(parts))]
                said += [*parts, *(a + b for a, b in zip(parts, parts[1:], strict=False))]
                whole.add("".join(parts))
    if name in ("html", "body"):
        return around
    within = LEVELS.index(around) > LEVELS.index("open")
    aside = not (ASIDE_WORDS - HEADER_WORDS if within else ASIDE_WORDS | HEADER_WORDS).isdisjoint(said)
    if aside or (name == "header" and not within):
        return "aside"
    level = "article" if name == "article" else "main" if name == "main" else "content" if name not in INLINE and not BODY_WORDS.isdisjoint(whole) else around
    if around in ("aside", "inner"):
        return "inner" if level in ("article", "main") else around
    return max(level, around, key=LEVELS.index)


def blocks_of(page: str) -> tuple[list[Block], set[str]]:
    """The texts of a page, block by block, in order, and the kinds of elements met, with text or without: character references decoded, white space made one space. Scripts, styles,
    comments and other markup are left out; unclosed and stray tags end where browsers end them, nearly."""
    stack = [_Open("", "open", False, False, 0)]
    out: list[Block] = []
    parts: list[str] = []
    links, made, at, n = 0, 0, 0, len(page)
    met: set[str] = set()

    def text(piece: str) -> None:
        nonlocal links
        if piece:
            top = stack[-1]
            piece = html.unescape(piece) if "&" in piece else piece
            parts.append(piece)
            links += len(piece.strip()) if top.link else 0

    def flush() -> None:
        nonlocal links
        if parts:
            top = stack[-1]
            joined = " ".join("".join(parts).split())
            if joined:
                # inline elements stand in the block that is around them
                box = next((e for e in reversed(stack) if e.name not in INLINE), stack[0])
                out.append(Block(joined, top.kind, links, box.paragraph, box.parent))
            parts.clear()
        links = 0

    def opened(name: str, attributes: str) -> None:
        nonlocal made
        top, inline = stack[-1], name in INLINE
        kind = _kind(name, attributes, top.kind)
        met.add(kind)
        if not inline or kind != top.kind:
            flush()
        made += not inline
        stack.append(_Open(name, kind, top.link or name == "a", name in PARAGRAPH, stack[-1].parent if inline else made if name not in PARAGRAPH else top.parent))

    def closed(until: int) -> None:
        if any(e.name not in INLINE for e in stack[until:]) or stack[until - 1].kind != stack[-1].kind:
            flush()
        del stack[until:]

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            text(page[at:])
            break
        text(page[at:lt])
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        found = NAME.match(page, lt + 1)
        if not found:
            if lt + 1 < n and page[lt + 1] in "!?/":
                end = page.find(">", lt)
                at = n if end < 0 else end + 1
            else:
                text("<")
                at = lt + 1
            continue
        name, start = found[1].lower(), found.end()
        rest = REST.match(page, start)
        end = rest.end() if rest else page.find(">", start) + 1
        if not end:
            break
        at, attributes = end, page[start : end - 1]
        if page[lt + 1] == "/":
            where = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name), 0)
            if where:
                closed(where)
            elif name not in INLINE:
                flush()
            continue
        if name == "br":
            text(" ")
            continue
        if name in VOID:
            if name not in INLINE:
                flush()
            continue
        if name not in INLINE:
            ended, between = ENDS.get(name, ("", ()))
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in ended.split() or (stack[i].name == "p" and name not in ENDS):
                    closed(i)
                    break
                if stack[i].name in between or (name not in ENDS and stack[i].name not in INLINE):
                    break
        elif name == "a":
            where = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == "a"), 0)
            if where and all(e.name in INLINE for e in stack[where:]):
                closed(where)
        opened(name, attributes)
        if name in RAW:
            stop = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            at = stop.start() if stop else n
    flush()
    return out, met


def repeated(tokens: np.ndarray, page: np.ndarray, key: np.ndarray, window: int, least: int) -> np.ndarray:
    """Which tokens lie in runs of `window` or more that stand on pages of at least `least` different keys.

    tokens are numbers, page (rising) tells the page of each, key that of its page. Runs don't go on from one page to the next.
    """
    n = len(tokens)
    if n < window:
        return np.zeros(n, bool)
    # suffixes ranked by their first tokens, twice as many each round; those that would leave their page are marked
    rank, size = np.unique(tokens, return_inverse=True)[1].astype(np.int64), 1
    while size < window:
        step = min(size, window - size)
        rank = np.unique(rank[: len(rank) - step] * np.int64(n + 1) + rank[step:], return_inverse=True)[1]
        size += step
    inside = page[: n - window + 1] == page[window - 1 :]
    order = np.flatnonzero(inside)
    order = order[np.argsort(rank[order], kind="stable")]
    # the suffix array, cut into runs that begin alike; a run counts by the different keys of its pages
    rank, keys = rank[order], key[order]
    pairs = np.unique(np.stack([rank, keys], 1), axis=0)[:, 0] if len(order) else rank
    enough = np.bincount(pairs, minlength=n) >= least
    ends = np.zeros(n + 1, np.int64)
    hits = order[enough[rank]]
    np.add.at(ends, hits, 1)
    np.add.at(ends, hits + window, -1)
    return ends[:n].cumsum() > 0


def chosen(blocks: list[Block], met: set[str], covered: list[float]) -> list[int]:
    """Which blocks are the article's: covered is the share of each that the host's pages repeat."""
    mass = {level: sum(len(b.text) for b in blocks if LEVELS.index(b.kind) >= LEVELS.index(level)) for level in LEVELS}
    named = [level for level in ("article", "main", "content") if level in met]
    if named:
        # the surest kind, unless nearly all of what the next one holds is beside it (a card within the article, say)
        while len(named) > 1 and 4 * mass[named[0]] < mass[named[1]]:
            del named[0]
        # what the markup calls the article stays, but for repeated text that isn't in paragraphs
        return [i for i, b in enumerate(blocks) if LEVELS.index(b.kind) >= LEVELS.index(named[0]) and (b.paragraph or covered[i] < 0.9)]
    free = [i for i, b in enumerate(blocks) if b.kind == "open" and 2 * b.links <= len(b.text)]
    own = [i for i in free if covered[i] < 0.5]
    sure = [i for i in own if blocks[i].paragraph or len(blocks[i].text) >= 80]
    if not own:
        return [i for i, b in enumerate(blocks) if b.kind == "inner" and covered[i] < 0.5]
    if not sure:
        return own
    # a passage that articles share lies among paragraphs of one box; a template lies around them
    boxes = {blocks[i].parent for i in sure}
    return [i for i in free if covered[i] < 0.5 or (sure[0] < i < sure[-1] and blocks[i].paragraph and blocks[i].parent in boxes)]


def _hashed(values: list[str]) -> np.ndarray:
    """64-bit hashes of texts, the same in all tasks."""
    return pd.util.hash_array(np.array(values, object), categorize=False) if values else np.zeros(0, np.uint64)


class _Streams(NamedTuple):
    """Token streams of pages of large hosts: the blocks of each, tokens of each block, hashes of all windows with their hosts (g), which lie
    within one page (inside), and the page of each token."""

    parsed: list
    sizes: np.ndarray
    g: np.ndarray
    inside: np.ndarray
    page: np.ndarray


def _streams(rows: list[tuple], window: int) -> _Streams:
    parsed = [blocks_of(r[4] or "") for r in rows]
    words = pc.split_pattern(pa.array([b.text for blocks, _ in parsed for b in blocks], pa.string()), " ")
    sizes, coded = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64), words.flatten().dictionary_encode()
    page = np.repeat(np.repeat(np.arange(len(rows)), [len(blocks) for blocks, _ in parsed]), sizes)
    n = max(0, len(page) - window + 1)
    value, g = _hashed(coded.dictionary.to_pylist())[coded.indices.to_numpy()], np.zeros(n, np.uint64)
    for i in range(window):
        g = g * np.uint64(0x9E3779B97F4A7C15) + value[i : i + n]
    g = (g ^ (g >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) + _hashed([r[0] for r in rows])[page[:n]]
    g = (g ^ (g >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return _Streams(parsed, sizes, g ^ (g >> np.uint64(32)), page[:n] == page[window - 1 :][:n], page)


def _parts(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[list[tuple]]:
    """Rows (h, s, id, url, x), up to about size characters at a time."""
    held: list[tuple] = []
    chars = 0
    for batch in batches:
        for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            held.append(r)
            chars += len(r[4] or "")
            if chars >= size:
                yield held
                held, chars = [], 0
    if held:
        yield held


#: Counts by which windows are ruled out before they are shuffled: two to the power of this many.
CELLS = 28


def _of_keys(rows: list[tuple], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of some pages with the key and the shard of each."""
    made = _streams(rows, window)
    at = np.flatnonzero(made.inside)
    page = made.page[at]
    key = _hashed([max((b.text for b in blocks), key=len, default="") for blocks, _ in made.parsed])
    return made.g[at], key[page], np.array([r[1] for r in rows], np.int64)[page]


def _firsts(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows by columns, and which of them in it differ from the one before."""
    order = np.lexsort(columns[::-1])
    new = np.ones(len(order), bool)
    new[1:] = False
    for c in columns:
        c = c[order]
        new[1:] |= c[1:] != c[:-1]
    return order, new


def _cells(size: int, window: int):
    """(block, offsets): the cells of windows; 65,536 cells a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flushed() -> pa.RecordBatch:
            cell = np.sort(np.concatenate(held))
            starts = np.flatnonzero(np.append(True, cell[1:] >> 16 != cell[:-1] >> 16)) if len(cell) else np.zeros(0, np.int64)
            low, ends = (cell & 0xFFFF).astype("<u2"), np.append(starts[1:], len(cell))
            return pa.record_batch([pa.array((cell[starts] >> 16).astype(np.int32)), pa.array([low[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary())], names=["block", "offsets"])

        held: list[np.ndarray] = []
        for rows in _parts(batches, size):
            # a key counts more than once here, which rules out less and never too much
            made = _streams(rows, window)
            held.append((made.g[made.inside] >> np.uint64(64 - CELLS)).astype(np.uint32))
            if sum(map(len, held)) > 4_000_000:
                yield flushed()
                held = []
        if held:
            yield flushed()

    return run


def _crowded(least: int):
    """(block, bits) of blocks (block, all offsets): which cells hold at least so many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [np.packbits(np.bincount(np.frombuffer(b"".join(o), "<u2"), minlength=1 << 16) >= least).tobytes() for o in batch.column("offsets").to_pylist()]
            yield pa.record_batch([batch.column("block"), pa.array(bits, pa.binary())], names=["block", "bits"])

    return run


def _few(g: np.ndarray, key: np.ndarray, shard: np.ndarray, least: int) -> pa.RecordBatch:
    """Of windows, the first `least` keys of each, and one row for each shard that has it: more tell nothing else."""
    keep = np.zeros(len(g), bool)
    order, new = _firsts(g, key)
    seen, starts = new.cumsum(), np.flatnonzero(np.append(True, g[order][1:] != g[order][:-1])[: len(g)])
    rank = seen - np.repeat(seen[starts], np.diff(np.append(starts, len(g))))
    keep[order[new & (rank < least)]] = True
    order, new = _firsts(g, shard)
    keep[order[new]] = True
    return pa.record_batch([pa.array(g[keep].view(np.int64)), pa.array(key[keep].view(np.int64)), pa.array(shard[keep])], names=["g", "key", "s"])


def _candidates(size: int, window: int, least: int, sent):
    """(g, key, s): windows in crowded cells, with keys and shards of their pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for rows in _parts(batches, size):
            found = _of_keys(rows, window)
            cell = (found[0] >> np.uint64(64 - CELLS)).astype(np.int64)
            some = np.flatnonzero(sent.value[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8) & 1)
            held.append(tuple(c[some] for c in found))
            if sum(len(h[0]) for h in held) > 2_000_000:
                yield _few(*map(np.concatenate, zip(*held, strict=True)), least)
                held = []
        if held:
            yield _few(*map(np.concatenate, zip(*held, strict=True)), least)

    return run


def _host_repeats(rows: DataFrame, size: int, window: int, least: int) -> DataFrame:
    """(s, known): windows that pages of at least `least` different longest blocks of a host hold, all shards together, for each shard
    the ones it has. Counts of hashes rule out most windows before the rest is shuffled; the rest is counted exactly."""
    found = rows.mapInArrow(_cells(size, window), "block int, offsets binary").groupBy("block").agg(F.collect_list("offsets").alias("offsets"))
    blocks = materialize(found.mapInArrow(_crowded(least), "block int, bits binary"), "crowded-cells").toArrow()
    crowded = np.zeros((1 << (CELLS - 16), 1 << 13), np.uint8)
    for block, bits in zip(blocks.column("block").to_pylist(), blocks.column("bits").to_pylist(), strict=True):
        crowded[block] = np.frombuffer(bits, np.uint8)
    sent = rows.sparkSession.sparkContext.broadcast(crowded.reshape(-1))
    each = rows.mapInArrow(_candidates(size, window, least, sent), "g long, key long, s long").groupBy("g").agg(F.collect_set("key").alias("keys"), F.collect_set("s").alias("s"))
    enough = each.filter(F.size("keys") >= least).select("g", F.explode("s").alias("s"))
    repeats = materialize(enough.groupBy("s").agg(F.collect_list("g").alias("known")), "host-repeats")
    # executors hold it on disk, too
    sent.destroy(blocking=True)
    return repeats


_OUT = pa.schema([("id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64()), ("n_blocks", pa.int64()), ("n_repeated", pa.int64())])


def _covered(hit: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The share of each block's tokens that are hit."""
    ends, below = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), np.concatenate([[0], np.cumsum(hit)])
    return (below[ends[1:]] - below[ends[:-1]]) / np.maximum(1, sizes) if len(sizes) else np.zeros(0)


def _written(rows: list[tuple], parsed: list, share: np.ndarray) -> pa.RecordBatch:
    out, at = [], 0
    for r, (blocks, met) in zip(rows, parsed, strict=True):
        covered = share[at : at + len(blocks)].tolist()
        at += len(blocks)
        text = " ".join(blocks[i].text for i in chosen(blocks, met, covered))
        out.append((r[2], r[3], text, len(text), len(blocks), sum(c >= 0.5 for c in covered)))
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * len(_OUT), _OUT, strict=True)], schema=_OUT)


def _extracted(rows: list[tuple], window: int, least: int) -> pa.RecordBatch:
    """Pages of some whole hosts, their streams concatenated; words of different hosts are different tokens."""
    parsed = [blocks_of(r[4] or "") for r in rows]
    known: dict = {}
    shards: dict = {}
    tokens, page, key, sizes = [], [], [], []
    for i, (r, (blocks, _)) in enumerate(zip(rows, parsed, strict=True)):
        shard = shards.setdefault((r[0], r[1]), len(shards))
        longest = max((b.text for b in blocks), key=len, default="")
        mine = hash(longest)
        for b in blocks:
            words = b.text.split(" ")
            tokens += [known.setdefault((shard, w), len(known)) for w in words]
            sizes.append(len(words))
        count = sum(sizes[len(sizes) - len(blocks) :]) if blocks else 0
        page.append(np.full(count, i, np.int32))
        key.append(np.full(count, mine, np.int64))
    joined = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    hit = repeated(np.array(tokens, np.int64), joined(page, np.int32), joined(key, np.int64), window, least)
    return _written(rows, parsed, _covered(hit, np.array(sizes, np.int64)))


def _of_shard(rows: list[tuple], window: int, known: np.ndarray) -> pa.RecordBatch:
    """Pages of a shard of a large host; known are the windows that the host repeats."""
    made = _streams(rows, window)
    known = np.sort(known)
    place = np.minimum(np.searchsorted(known, made.g), len(known) - 1)
    hits = np.flatnonzero(made.inside & (known[place] == made.g)) if len(known) else np.zeros(0, np.int64)
    ends = np.zeros(len(made.page) + window + 1, np.int64)
    np.add.at(ends, hits, 1)
    np.add.at(ends, hits + window, -1)
    return _written(rows, made.parsed, _covered(ends[: len(made.page)].cumsum() > 0, made.sizes))


def _tasks(size: int, window: int, least: int):
    """Rows come shard by shard, what its host repeats before the pages of a large host's shard; whole small hosts are taken together up to
    size characters, and pages of a shard up to as many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        chars, large, known = 0, None, np.zeros(0, np.uint64)

        def done() -> pa.RecordBatch:
            return _extracted(held, window, least) if large is None else _of_shard(held, window, known)

        for batch in batches:
            for *r, big, mine in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = r[1] if big else None
                if held and (at != large or (chars >= size and (big or tuple(held[-1][:2]) != tuple(r[:2])))):
                    yield done()
                    held, chars = [], 0
                if at != large:
                    large, known = at, np.zeros(0, np.uint64)
                if mine is not None:
                    known = np.array(mine, np.int64).view(np.uint64)
                    continue
                held.append(tuple(r))
                chars += len(r[4] or "")
        if held:
            yield done()

    return run


def extract_pages(pages: DataFrame, shard: int = 2_000_000, window: int = 8, least: int = 3, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The main text of every page.

    Returns id_col, url_col, text (blocks joined by a space, "" if there are none), n_chars (its code points), n_blocks (blocks of
    text on the page) and n_repeated (of them, those that the suffix array covers by half or more). Null and empty html give an
    empty text; null urls form one host; repeated rows are pages each, and copies of a page don't make what it says a template,
    as a repeat counts only by pages whose longest blocks differ. An empty table gives an empty one. Other columns are not read.

    Where markup names an article, its blocks are the text, less those that elements, classes or roles name as menus, adverts
    and the like, and less repeated ones outside paragraphs. Elsewhere blocks are the text that are neither links in the main,
    named so, nor covered by repeats; a repeated paragraph stays where it lies among others of its box that don't repeat.
    Repeats are runs of `window` tokens or more on at least `least` pages of a host. A host of more than `shard` characters is
    dealt by hash into shards of about as many; its repeats are counted over all of them, so that results don't depend on `shard`.
    """
    reachable(pages.sparkSession)
    host = F.lower(F.regexp_extract(F.coalesce(pages[url_col].cast("string"), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(host.alias("h"), pages[id_col].cast("long").alias("id"), pages[url_col].cast("string").alias("url"), pages[html_col].cast("string").alias("x"))
    rows = rows.withColumn("k", F.xxhash64("id", "url", "x"))
    sizes = rows.groupBy("h").agg(F.sum(F.coalesce(F.length("x"), F.lit(0))).alias("n")).filter(F.col("n") > shard)
    sizes = materialize(sizes.select("h", F.ceil(F.col("n") / shard).alias("n")), "large-hosts")
    if sizes.count() <= LARGE:
        rows = rows.join(F.broadcast(sizes), "h", "left")
    else:
        # a large host is known by every one of 64 salts, so that its pages don't meet in one task to learn of it
        salted = sizes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(63))))
        rows = rows.withColumn("salt", F.pmod("k", F.lit(64)).cast("int")).join(salted, ["h", "salt"], "left")
    # a shard's number is a hash of it and its host; small hosts have one of the host alone
    big = F.col("n").isNotNull()
    rows = rows.select("h", F.when(big, F.xxhash64("h", F.pmod(F.xxhash64("k"), F.col("n")))).otherwise(F.xxhash64("h")).alias("s"), "id", "url", "x", big.alias("big")).withColumn("known", F.lit(None).cast("array<long>"))
    if not sizes.isEmpty():
        repeats = _host_repeats(rows.filter("big").select("h", "s", "id", "url", "x"), shard, window, least)
        none = [F.lit(None).cast("long").alias("id"), *(F.lit(None).cast("string").alias(n) for n in ("url", "x"))]
        rows = rows.unionByName(repeats.select(F.lit(None).cast("string").alias("h"), "s", *none, F.lit(True).alias("big"), "known"))
    dealt = rows.repartition("s").sortWithinPartitions("s", F.col("known").isNull(), "h")
    out = dealt.mapInArrow(_tasks(shard, window, least), "id long, url string, text string, n_chars long, n_blocks long, n_repeated long")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars", "n_blocks", "n_repeated")
