"""HTML extraction by wrappers: union-free regular expressions inferred from all pages of a host.

A page is a stream of block elements and texts (inline elements belong to the text around them). Its wrapper is the same stream in
which neighbours that repeat, alone or as a sequence, are folded into a repeated group. Wrappers are aligned two at a time, level
by level: where texts differ they become a text slot, and what only one side has becomes an optional group. Each task folds the pages
that it reads into one wrapper a host; these meet in rounds of groups of bounded size, so every page takes part and a page's
text is never shuffled.

All pages are then matched against the wrapper of their host, and the texts of each slot are counted over all pages. Slots
say what is frame and what is content: a slot whose texts recur from page to page while the host's greatest slot does not is frame, as
is a single text that almost all pages have. The content is the element that
holds most of the text that is left; the names article and main count as a hint only. An article or main that is chosen stays whole,
headings and closing lines that all pages share included. In a content that only the counts have found, what recurs is left out where it
fills an element of its own (a box, a list, a section); a recurring heading or paragraph beside new text stays.

Left out before alignment: elements that hold no main text by their names (_SKIP: nav, aside, form ...) or whose class, id or role is
made of frame words alone (_FRAME with _NEUTRAL: cookie-notice, comment-list; but not side-story), as such text may vary as content does.

Defined cases: null html is empty and gives the empty text; pages without a host in their url, pages that do not fit the wrapper of
their host and hosts of one page use the page's own wrapper; cut-off pages and unclosed or wrongly closed elements are read as far as
they go; repeated rows give their rows each; extra columns are ignored. A form that spans most of a page is no form but the page's
frame of scripts, and is read. A wrapper keeps MOST_NODES nodes: of more, the optional ones that were seen least go, and their texts count
as unknown, which inside the content is content; most_nodes=None keeps them all.
"""

from __future__ import annotations

import difflib
import html as html_lib
import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import accumulate

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import map_arrow, save, strings

#: Longest sequence of neighbours that is looked for as a repeated group; nodes of a wrapper; wrappers that meet at once.
MOST_PERIOD, MOST_NODES, FAN = 4, 5000, 32
#: Frame: share of a text's pages, share of new text in a slot against that of the greatest slot, and pages that this takes.
ON_MOST, RECURRING, LEAST_PAGES = 0.9, 1 / 3, 6
#: Share of new text in the greatest slot from which a host's pages count as different ones; how much more named elements count.
DIFFERENT, HINT = 0.6, 1.5
#: Share of a page's bytes from which a form that spans them is read.
FORM_SHARE = 0.6
BROADCAST_BYTES = 64 << 20
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|[^<]+|<", re.S)
_ATTR = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea title svg math iframe object select".split())
_SKIP = frozenset("nav header footer aside form button menu dialog head script style noscript template textarea title svg math iframe object select option label canvas".split())
_BLOCK = frozenset("address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hr html li main ol p pre section summary table tbody td tfoot th thead tr ul".split())
_CLOSED_BY_LIKE = frozenset("li td th tr dd dt".split())
#: Elements that the content may be looked for in.
_INTO = frozenset("html body div section td table tbody tr article main".split())
#: Elements that may be left out of the content where all of their texts recur.
_BOX = frozenset("div section table ul ol dl figure details fieldset".split())
#: Words of class names that mark frame, and words that say nothing beside them.
_FRAME = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notification alert newsletter subscribe signup popup modal overlay share sharing social related recommended recommendations comment comments respond replies disqus sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead toolbar widget pagination pager login".split())
_NEUTRAL = frozenset("page site top bottom left right main global primary secondary list box area section wrapper container bar block item items link links buttons button form inner outer content unit slot posts articles stories thread wrap row group body text".split())
TEXT = "#"


@dataclass(slots=True)
class Node:
    """An element, a text, or (label +a, b ...) a sequence of neighbours that repeats."""

    label: str
    kids: list[Node] = field(default_factory=list)
    text: str | None = None  # of a page: the text; of a wrapper: its digest while it is the same everywhere, None in a slot
    seen: int = 1
    repeated: bool = False
    optional: bool = False
    at: int = -1  # place of a page's text among its texts; number of a wrapper's node in order
    end: int = -1  # one more than the number of the last node inside


# ---------------------------------------------------------------- pages


@lru_cache(1 << 14)
def _label(name: str, rest: str) -> tuple[str, bool]:
    """(name with class and id, whether such an element is left out)."""
    marks = " ".join(a or b or c for _, a, b, c in _ATTR.findall(rest)) if rest else ""
    out = name in _SKIP
    if marks and not out and name not in ("html", "body", "article", "main"):
        for mark in marks.lower().split():
            parts = [p for p in re.split(r"[-_\d]+", mark) if p]
            if any(p in _FRAME for p in parts) and all(p in _FRAME or p in _NEUTRAL for p in parts):
                out = True
    words = [] if name in ("article", "main") else re.sub(r"\d+", "", marks).split()[:2]
    return name + ("." + ".".join(words) if words else ""), out


def parse(page: str) -> tuple[Node, list[Node]]:
    """(tree of block elements and texts, its texts in page order). Time and memory are linear in the page, however deep it is."""
    first, last = page.lower().find("<form"), page.lower().rfind("</form")
    wrapped = first >= 0 and (last if last > first else len(page)) - first > FORM_SHARE * len(page)
    root = Node("")
    node, texts, raw = root, [], []
    stack: list[tuple[str, Node | None, bool, bool]] = []  # name, node around it where it made one, left out, block
    open_: Counter[str] = Counter()
    paragraphs: list[tuple[int, int]] = []  # of each open p: its place in the stack, open blocks at that time
    out = blocks = i = 0
    n = len(page)

    def flush() -> None:
        if raw:
            own = " ".join(html_lib.unescape("".join(raw)).split())
            raw.clear()
            if own:
                leaf = Node(TEXT, text=own)
                leaf.at = len(texts)
                texts.append(leaf)
                node.kids.append(leaf)

    def close(to: int) -> None:
        nonlocal node, out, blocks
        while len(stack) > to:
            name, around, was_out, is_block = stack.pop()
            open_[name] -= 1
            out -= was_out
            blocks -= is_block
            if around is not None:
                node = around
            if name == "p":
                paragraphs.pop()

    while i < n:
        m = _TOKEN.match(page, i)
        i = m.end()
        name = m[2]
        if not name:
            if not out and (m[0][0] != "<" or m[0] == "<"):
                raw.append(m[0])
            continue
        name, rest = name.lower(), m[3] or ""
        is_block = name in _BLOCK or (wrapped and name == "form")
        if is_block:
            flush()
        if m[1]:
            if open_[name] > 0:
                at = len(stack) - 1
                while stack[at][0] != name:
                    at -= 1
                if any(s[3] for s in stack[at:]):
                    flush()
                close(at)
            continue
        if is_block and paragraphs and paragraphs[-1][1] == blocks:  # a block ends an open paragraph and what is in it
            close(paragraphs[-1][0])
        if name in _CLOSED_BY_LIKE and stack and stack[-1][0] == name:
            close(len(stack) - 1)
        if name == "br":
            if not out:
                raw.append(" ")
            continue
        if name in _VOID or rest.endswith("/"):
            continue
        label, left_out = _label("div" if wrapped and name == "form" else name, rest)
        around = None
        if is_block and not out and not left_out:
            around, new = node, Node(label)
            node.kids.append(new)
            node = new
        stack.append((name, around, left_out, is_block))
        open_[name] += 1
        out += left_out
        blocks += is_block
        if name == "p":
            paragraphs.append((len(stack) - 1, blocks))
        if name in _RAW:
            found = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, i)
            i = found.end() if found else n
            close(len(stack) - 1)
    flush()
    return root, texts


# ---------------------------------------------------------------- wrappers


def _sequence(label: str) -> tuple[str, ...]:
    return tuple(label[1:].split("\x1f"))


def grouped(labels: list[str], known: set[tuple[str, ...]] = frozenset()) -> list[tuple[str, list[tuple[list[int], bool]]]]:
    """Neighbours as items (label, members): an item holds all of a run of one label, or (label +...) of a repeated sequence, by position.
    members: for each position the places and whether a run occurred. Known sequences are items even where they occur once."""
    runs: list[tuple[str, list[int]]] = []
    for i, label in enumerate(labels):
        if runs and runs[-1][0] == label:
            runs[-1][1].append(i)
        else:
            runs.append((label, [i]))
    items = [(label, [(places, len(places) > 1)]) for label, places in runs]
    for period in range(2, MOST_PERIOD + 1):
        if len(items) < period or (len(items) < 2 * period and not known):
            continue
        out, i = [], 0
        while i < len(items):
            own = tuple(x[0] for x in items[i : i + period])
            times = 1
            while len(own) == period and tuple(x[0] for x in items[i + times * period : i + (times + 1) * period]) == own:
                times += 1
            if len(own) < period or (times == 1 and own not in known) or any(x[0] == "+" for x in own):
                out.append(items[i])
                i += 1
                continue
            runs = [items[i + t * period : i + (t + 1) * period] for t in range(times)]
            out.append(("+" + "\x1f".join(own), [([k for r in runs for k in r[x][1][0][0]], any(r[x][1][0][1] for r in runs)) for x in range(period)]))
            i += times * period
        items = out
    return items


def _fold(kids: list[Node], known: set[tuple[str, ...]] = frozenset()) -> tuple[list[Node], list[tuple[Node, Node | None]]]:
    """(kids with one node an item, pairs of nodes that are to be merged for it)."""
    if not kids or (len(kids) == 1 and not known):
        return kids, []
    new, pairs = [], []

    def one(places: list[int], run: bool) -> Node:
        first = kids[places[0]]
        first.repeated |= run
        pairs.extend((first, kids[k]) for k in places[1:])
        return first

    for label, members in grouped([k.label for k in kids], known):
        own = [one(*m) for m in members]
        new.append(own[0] if label[0] != "+" or len(own) == 1 else Node(label, own, repeated=len(members[0][0]) > 1))
    return new, pairs


def _align(x: list[str], y: list[str]) -> Iterator[tuple[int, int, int, int, bool]]:
    """(start and end in x, start and end in y, equal) of parts with equal and with different labels."""
    if x == y:
        yield 0, len(x), 0, len(y), True
        return
    found = [(i, j, p, q, op == "equal") for op, i, j, p, q in difflib.SequenceMatcher(None, x, y, autojunk=False).get_opcodes()]
    if sum(q - p for _, _, p, q, equal in found if equal) < len(y):  # the long blocks leave something out: does y fit into x at all?
        places, at = [], 0
        for label in y:
            at = next((k for k in range(at, len(x)) if x[k] == label), len(x)) + 1
            places.append(at - 1)
        if at <= len(x):
            found, done = [], 0
            for p, k in enumerate(places):
                found += [(done, k, p, p, False)] if done < k else []
                found.append((k, k + 1, p, p + 1, True))
                done = k + 1
            found += [(done, len(x), len(y), len(y), False)] if done < len(x) else []
    yield from found


def merge(a: Node, b: Node | None) -> Node:
    """a, aligned with b (without b: folded). Both are changed. Pairs are worked off a stack: the deepest page needs no recursion."""
    work: list[tuple[Node, Node | None]] = [(a, b)]
    while work:
        x, y = work.pop()
        if y is None:
            x.kids, pairs = _fold(x.kids)
            work += [(k, None) for k in x.kids if k.kids]
            work += pairs  # members of a run meet before what is in them is folded
            continue
        x.seen += y.seen
        x.repeated |= y.repeated
        x.optional |= y.optional
        if x.label == TEXT:
            if x.text != y.text:
                x.text = None
            continue
        first, inner = _fold(x.kids)
        second, more = _fold(y.kids, {_sequence(k.label) for k in first if k.label[0] == "+"})
        inner += more
        new = {_sequence(k.label) for k in second if k.label[0] == "+"} - {_sequence(k.label) for k in first if k.label[0] == "+"}
        if new:
            first, more = _fold(first, new)
            inner += more
        kids, pairs = [], []
        for i, j, p, q, equal in _align([k.label for k in first], [k.label for k in second]):
            kids += first[i:j]
            if equal:
                pairs += zip(first[i:j], second[p:q], strict=True)
            else:
                for k in [*first[i:j], *second[p:q]]:
                    k.optional = True
                kids += second[p:q]
                pairs += [(k, None) for k in second[p:q] if k.kids]
        x.kids = kids
        work += pairs
        work += inner
    return a


def wrapper(page: Node) -> Node:
    """The wrapper of one page."""
    stack = [page]
    while stack:
        k = stack.pop()
        if k.text is not None:
            k.text = xxhash.xxh3_64_hexdigest(k.text)
        stack += k.kids
    return merge(page, None)


def prune(root: Node, most: int | None = MOST_NODES) -> Node:
    """root without the least seen optional nodes, where it has more nodes than most (None: as it is)."""
    seen = 1
    while _number(root) > (most or 1 << 60) and seen < 1 << 60:
        stack = [root]
        while stack:
            k = stack.pop()
            k.kids = [x for x in k.kids if not x.optional or x.seen > seen]
            stack += k.kids
        seen *= 2
    return root


def _number(root: Node) -> int:
    """Numbers the nodes in order; returns how many there are."""
    n, stack = 0, [(root, False)]
    while stack:
        k, done = stack.pop()
        if done:
            k.end = n
            continue
        k.at = n
        n += 1
        stack.append((k, True))
        stack += [(x, False) for x in reversed(k.kids)]
    return n


def encode(root: Node) -> str:
    """JSON rows in order: place of the node around it, label, text digest, seen, repeated, optional."""
    rows, stack = [], [(root, -1)]
    while stack:
        k, around = stack.pop()
        rows.append([around, k.label, k.text, k.seen, int(k.repeated), int(k.optional)])
        here = len(rows) - 1
        stack += [(x, here) for x in reversed(k.kids)]
    return json.dumps(rows, separators=(",", ":"))


def decode(text: str) -> Node:
    nodes: list[Node] = []
    for around, label, digest, seen, repeated, optional in json.loads(text):
        k = Node(label, [], digest, seen, bool(repeated), bool(optional))
        nodes.append(k)
        if around >= 0:
            nodes[around].kids.append(k)
    _number(nodes[0])
    return nodes[0]


def expression(root: Node) -> str:
    """The wrapper as a union-free regular expression over streams as stream() makes them."""
    done: dict[int, str] = {}
    stack = [(root, False)]
    while stack:
        k, ready = stack.pop()
        if not ready:
            stack.append((k, True))
            stack += [(x, False) for x in k.kids]
            continue
        inner = "".join(done.pop(id(x)) for x in k.kids)
        own = re.escape(f"<{TEXT}>") if k.label == TEXT else inner if k.label[:1] == "+" else re.escape(f"<{k.label}>") + inner + "</>"
        done[id(k)] = f"(?:{own})" + ("*" if k.repeated and k.optional else "+" if k.repeated else "?" if k.optional else "")
    return done[id(root)]


def stream(page: Node) -> str:
    """The tokens of a page that alignment looks at."""
    out, stack = [], [(page, False)]
    while stack:
        k, ready = stack.pop()
        if ready:
            out.append("</>")
            continue
        out.append(f"<{k.label}>")
        if k.label != TEXT:
            stack.append((k, True))
            stack += [(x, False) for x in reversed(k.kids)]
    return "".join(out)


def _fitted(own: list[str], items: list) -> tuple[list, list[tuple[int, int, int, int, bool]]]:
    return items, list(_align(own, [x[0] for x in items]))


def match(root: Node, page: Node, n: int) -> tuple[list[int], list[int]]:
    """For each of the page's n texts: its slot (number of a text of the wrapper, or -1) and the deepest node that it is known to be in."""
    slot, inside = [-1] * n, [0] * n
    work = [(root, page)]
    while work:
        w, p = work.pop()
        if w.label == TEXT:
            slot[p.at] = inside[p.at] = w.at
            continue
        kids = p.kids
        labels, own = [k.label for k in kids], [k.label for k in w.kids]
        known = {_sequence(label) for label in own if label[0] == "+"}
        items, parts = _fitted(own, grouped(labels, known))
        if known and any(b > a and not equal for _, _, a, b, equal in parts):  # its sequences may stand elsewhere as single elements
            items, parts = max((items, parts), _fitted(own, grouped(labels)), key=lambda f: sum(b - a for _, _, a, b, equal in f[1] if equal) / len(f[0]))
        for i, _, a, b, equal in parts:
            for k in range(a, b):
                members = items[k][1]
                if equal:
                    item = w.kids[i + k - a]
                    targets = item.kids if item.label[0] == "+" else [item]
                    for target, (places, _) in zip(targets, members, strict=True):
                        work += [(target, kids[c]) for c in places]
                else:
                    lost = [kids[c] for places, _ in members for c in places]
                    while lost:
                        x = lost.pop()
                        if x.label == TEXT:
                            inside[x.at] = w.at
                        lost += x.kids
    return slot, inside


# ---------------------------------------------------------------- what is content


def text_hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def decide(root: Node, pages: int, slots: list[tuple[int, int, int]], texts: list[tuple[int, int, int]]) -> list:
    """[first number of the content's nodes and the end, slots in it that are left out].

    slots: (slot, characters of its different texts, characters of all); texts: (slot, hash, characters of all) of those that almost
    all pages have. Both are counts over all pages of the host.
    """
    _, once, volume = max(slots, key=lambda s: (s[1], -s[0]), default=(0, 1, 1))  # the slot with most different text
    new = once / max(volume, 1)
    frame = {s for s, a, b in slots if pages >= LEAST_PAGES and a / max(b, 1) <= new * RECURRING}
    if new < DIFFERENT or pages < 2:  # pages that say much the same: nothing tells frame from content
        texts = []
    amount = Counter({s: b for s, _, b in slots if s not in frame})
    for s, _, b in texts:
        if s not in frame:
            amount[s] -= b
    if not sum(amount.values()):
        frame, texts, amount = set(), [], Counter({s: b for s, _, b in slots})
    total = sum(amount.values())
    by_place = sorted(amount.items())
    at, upto = [s for s, _ in by_place], [0, *accumulate(n for _, n in by_place)]
    inside = lambda k: upto[bisect_left(at, k.end)] - upto[bisect_left(at, k.at)]
    mark = re.compile(r"(?:^|\.)(?:content|article|post|entry|story|main|text|body)", re.I)
    region, name = root, ""
    while total > 0:  # into the element that holds most of what is left
        kids = [x for k in region.kids for x in (k.kids if k.label[0] == "+" else [k])]
        if name == "article":
            break
        if name == "main":  # an article or main is whole
            kids = [k for k in kids if k.label == "article"]
        held = [(k, inside(k)) for k in kids if k.label.split(".")[0] in _INTO]
        held = [(k, n, n * (HINT if k.label in ("article", "main") else 1.0)) for k, n in held if n > 0]
        best = max(held, key=lambda h: (h[2] >= 0.6 * (total + h[2] - h[1]), bool(mark.search(h[0].label.partition(".")[2])), h[2]), default=None)
        if best is None or best[2] < 0.6 * (total + best[2] - best[1]):
            break
        region, name = best[0], best[0].label
    out: list[int] = []
    boxes = [] if name in ("article", "main") else list(region.kids)
    known = sorted(s for s, _, _ in slots)
    while boxes:
        k = boxes.pop()
        if k.label.split(".")[0] in _BOX and inside(k) <= 0:
            out += known[bisect_left(known, k.at) : bisect_left(known, k.end)]
        else:
            boxes += k.kids
    return [region.at, region.end, sorted(out)]


def read(page: Node, texts: list[Node], root: Node, rule: list) -> str:
    """The main text: blocks joined by an empty line."""
    first, end, out = rule
    out = set(out)
    slot, inside = match(root, page, len(texts))
    return "\n\n".join(t.text for t, s, k in zip(texts, slot, inside, strict=True) if first <= k < end and s not in out)


def slot_counts(page: Node, texts: list[Node], root: Node) -> Counter[tuple[int, str]]:
    """How often each text stands in each slot."""
    slot, _ = match(root, page, len(texts))
    return Counter((s, t.text) for t, s in zip(texts, slot, strict=True) if s >= 0)


def summary(counts: list[Counter[tuple[int, str]]]) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """decide()'s slots and texts, from the slot_counts() of few pages."""
    every, on = Counter(), Counter()
    for c in counts:
        every.update(c)
        on.update(c.keys())
    once, volume = Counter(), Counter()
    for (s, t), n in every.items():
        once[s] += len(t)
        volume[s] += n * len(t)
    pages = Counter()
    for (_, t), n in on.items():
        pages[t] += n
    most = [(s, text_hash(t), every[s, t] * len(t)) for s, t in on if pages[t] >= max(2, ON_MOST * len(counts))]
    return [(s, once[s], volume[s]) for s in sorted(volume)], sorted(most)


def read_alone(html: str) -> str:
    """The main text of a page by its own wrapper."""
    page, texts = parse(html)
    root = wrapper(parse(html)[0])
    _number(root)
    return read(page, texts, root, decide(root, 1, *summary([slot_counts(page, texts, root)])))


# ---------------------------------------------------------------- Spark


def _joined(rows: DataFrame, by_host: DataFrame, size) -> DataFrame:
    """rows with the columns of by_host (one row a host, saved), which is broadcast if its counted bytes are few."""
    held = by_host.agg(F.coalesce(F.sum(size + F.lit(100)), F.lit(0))).first()[0]
    return rows.join(F.broadcast(by_host) if held <= BROADCAST_BYTES else by_host, "host", "left")


def wrappers(pages: DataFrame, most_nodes: int | None = MOST_NODES) -> DataFrame:
    """(host, part, pages, wrapper): one row for each host, saved. pages: host (not null), html."""
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    names = ["host", "part", "pages", "wrapper"]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: dict[str, list] = {}

        def rows() -> pa.RecordBatch:
            out = [(host, part, n, encode(prune(root, most_nodes))) for host, (root, n) in sorted(held.items())]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out, strict=True)) or [()] * 4, kinds, strict=True)], names=names)

        for batch in batches:
            for host, html in zip(batch.column(0).to_pylist(), strings(batch.column(1)), strict=True):
                own = parse(html.as_py())[0]
                if not own.kids:
                    continue
                own = wrapper(own)
                if host in held:
                    held[host][1] += 1
                    merge(held[host][0], own)
                    if held[host][1] % 64 == 0:
                        prune(held[host][0], most_nodes)
                else:
                    held[host] = [own, 1]
            if len(held) > 500:
                yield rows()
        yield rows()

    def one(frame: pd.DataFrame) -> pd.DataFrame:  # about FAN wrappers
        frame = frame.sort_values(["part", "wrapper"])
        roots = [decode(w) for w in frame["wrapper"]]
        for other in roots[1:]:
            merge(roots[0], other)
        return pd.DataFrame({"host": frame["host"].iloc[:1], "part": frame["salt"].iloc[:1], "pages": [frame["pages"].sum()], "wrapper": [encode(prune(roots[0], most_nodes))]})

    schema = "host string, part long, pages long, wrapper string"
    parts = save(map_arrow(pages.select("host", "html"), partial, schema), "wrappers")
    while True:
        many = parts.groupBy("host").agg(F.count("*").alias("n"))
        if (many.agg(F.max("n")).first()[0] or 0) <= 1:
            return parts
        salted = parts.join(many, "host").withColumn("salt", F.pmod(F.xxhash64("part"), F.ceil(F.col("n") / FAN)))
        parts = save(salted.drop("n").groupBy("host", "salt").applyInPandas(one, schema), "wrappers")


def rules(pages: DataFrame, most_nodes: int | None = MOST_NODES) -> DataFrame:
    """(host, wrapper, rule): one row for each host, saved. pages: host (not null), html."""
    found = wrappers(pages, most_nodes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root_of = lru_cache(1024)(decode)
        for batch in batches:
            out: list[tuple] = []
            for host, html, root in zip(batch.column(0).to_pylist(), strings(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                if root is not None:
                    page, texts = parse(html.as_py())
                    out += [(host, s, text_hash(t), n, len(t)) for (s, t), n in slot_counts(page, texts, root_of(root)).items()]
            columns = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])], names=["host", "slot", "hash", "n", "chars"])

    joined = _joined(pages.select("host", "html"), found.select("host", "wrapper"), F.length("wrapper")).select("host", "html", "wrapper")
    each = map_arrow(joined, count, "host string, slot long, hash long, n long, chars long")
    texts = save(each.groupBy("host", "slot", "hash").agg(F.count("*").alias("pages"), F.sum("n").alias("n"), F.max("chars").alias("chars")), "slot-texts")
    slots = texts.groupBy("host", "slot").agg(F.sum("chars").alias("once"), F.sum(F.col("n") * F.col("chars")).alias("volume"))
    slots = slots.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("slot", "once", "volume"))).alias("slots"))  # at most MOST_NODES
    on = texts.groupBy("host", "hash").agg(F.sum("pages").alias("on")).where("on >= 2")
    on = on.join(found.select("host", "pages"), "host").where(F.col("on") >= F.col("pages") * ON_MOST).select("host", "hash")
    most = texts.join(on, ["host", "hash"]).groupBy("host").agg(F.array_sort(F.collect_list(F.struct("slot", "hash", (F.col("n") * F.col("chars")).alias("volume")))).alias("texts"))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for root, pages_, slots_, texts_ in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3, 4)), strict=True):
                triples = [[tuple(x.values()) for x in y or []] for y in (slots_, texts_)]
                out.append(json.dumps(decide(decode(root), pages_, *triples)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], names=["host", "wrapper", "rule"])

    whole = found.join(slots, "host", "left").join(most, "host", "left").select("host", "wrapper", "pages", "slots", "texts")
    return save(map_arrow(whole, choose, "host string, wrapper string, rule string"), "rules")


HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)"


def extract(pages: DataFrame, most_nodes: int | None = MOST_NODES) -> DataFrame:
    """pages (page_id, url, html) -> page_id, url, text, n_chars."""
    host = F.nullif(F.lower(F.regexp_extract("url", HOST, 1)), F.lit(""))
    rows = pages.select("page_id", "url", host.alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    by_host = rules(rows.where("host is not null"), most_nodes)
    joined = _joined(rows, by_host, F.length("wrapper") + F.length("rule")).select("page_id", "url", "html", "wrapper", "rule")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root_of, rule_of = lru_cache(1024)(decode), lru_cache(1024)(json.loads)
        for batch in batches:
            out = []
            for html, root, rule in zip(strings(batch.column(2)), batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                html = html.as_py()
                text = read(*parse(html), root_of(root), rule_of(rule)) if root is not None and html else ""
                out.append(text or (read_alone(html) if html else ""))  # the host's wrapper does not fit this page
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return map_arrow(joined, run, pages.select("page_id", "url").schema.add("text", "string").add("n_chars", "long"))
