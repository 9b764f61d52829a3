"""Main text of web pages by wrappers: union-free regular expressions inferred per host.

A page is a stream of structure tags (with class, id and role) and texts; formatting tags fold into
their text, and end tags that HTML lets authors leave out are dropped. A host's wrapper is inferred
from all of its pages: each stream is folded, neighbouring equal groups becoming a repeated group;
then the different streams are aligned one after another, mismatches becoming optional groups (or, where a
group stands beside its equal, a repeated one) and texts becoming slots. The result is a
regular expression over tags without unions: items in order, ``?`` groups, ``+`` groups, text slots.

The slots are then judged once for the host. A slot may be main text if it stands inside the article and
no menu, header, footer, sidebar, notice, advert, form, script, style or comment section stands between the two;
what wraps the article says nothing, unless the page has another article element that is not so
wrapped. For pages without an article element the densest container of paragraphs is the article, found
over all the host's pages of that kind, or on the page itself if it has no such container. Names that settle
nothing (share, related, notice, header and the like) are a vote: such a slot, and on pages without an
article element any that is no paragraph, is template where its text sits mostly in links on the host's pages and
on the page too, or where its text is the same on at least ``SAME`` of all pages of the host and kind (``MIN_EQUAL`` of them
or more) which otherwise differ in their main text, and the page has that text. Pages of equal main text count as one. So what is left out depends on what the wrapper's slots
held on other pages; one page alone shows it for links only. Every page
is matched against its host's wrapper and each text takes the verdict of its slot, so texts with one
path but different slots are told apart. Where a page departs from the wrapper, matching goes on at the
next place that fits, else the new element is passed over; a text without a slot, or in a slot that
no counted page held it in, is judged by the same rules on the page itself.

Wrappers are learned from all pages: the different folded streams of a host are merged ``FAN`` at a time in rounds,
article places and the slots' verdicts are sums over its pages, so no task holds a host's pages.
If all wrappers together are at most ``MAX_SHARED`` bytes they are shared with the workers and pages are
only mapped; beyond that, pages are joined with their host's wrapper, salted.

Defined results: null or empty html gives the empty text; a null url is the host ''; broken markup is
read as browsers do (unclosed tags, comments or scripts run on); repeated rows give equal results;
a page of nothing but template has an empty text; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import html as html_lib
import json
import re
from collections import Counter
from difflib import SequenceMatcher

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import fresh, read, text_map
from lakestrata.session import scratch_dir

FAN = 16  # streams of a host that one task merges in a round
SPARE = 256  # tags and texts that a wrapper may have beyond twice its longest page
MIN_EQUAL, SAME = 4, 0.9  # below ten pages: all of them
MAX_SHARED = 16 * 1024 * 1024
SALTS = 64

_TOKEN = re.compile(r"<!--|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>?|[^<]++|<")
_ATTR = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
RAW = frozenset("script style textarea title noscript template xmp iframe noembed noframes plaintext".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data dfn em font i ins kbd label mark q s samp small span strike strong sub sup "
    "time tt u var wbr br img".split()
)
BLOCK_TEXT = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre blockquote caption figcaption summary".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose end tag may be left out: a new one of these closes an open one of its group.
CLOSES = {
    "p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"},
}
CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split()
)
OPTIONAL_END = frozenset("p li dt dd tr td th option thead tbody tfoot".split())
BOILERPLATE = frozenset(
    "nav header footer aside form script style noscript template iframe svg button select textarea head title menu dialog object canvas".split()
)
# Class, id and role words of what is not the article. The first say so by themselves; the second are a vote only:
# such a block is left out if its links or its sameness on pages that differ speak against it as well.
_BAD_NAME = re.compile(
    r"(?<!has-)(?<!has_)(?<!with-)(?<!with_)(?<!no-)(?<!no_)(?<![a-z0-9])(ads?|advert\w*|breadcrumbs?|comments?|consent|cookies?|disqus|footer|menu|modal|"
    r"nav|navbar|navigation|newsletter|pagination|popup|promo\w*|replies|respond|sidebar|sponsor\w*|subscribe)(?![a-z0-9])",
    re.I,
)
_WEAK_NAME = re.compile(
    r"(?<![a-z0-9])(banner|header|login|notice|related|reply|share|sharing|signup|social|toolbar|widget)(?![a-z0-9])", re.I
)
_GOOD = frozenset(("article", "main"))
# A slot's verdict: MAIN, LINKS, or the digest of its template text. Slots that their place settles have none.
MAIN, LINKS = "main", "links"


def host_of(url: str | None) -> str:
    m = re.match(r"^\s*(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", url or "", re.I)
    return m.group(1).lower() if m else ""


def signature(tag: str, attrs: str) -> str:
    """Tag with its class, id and role names (digits folded)."""
    if not attrs or "=" not in attrs:
        return tag
    names = []
    for m in _ATTR.finditer(attrs):
        value = m.group(2) or m.group(3) or m.group(4) or ""
        names.append(m.group(1).lower()[0] + ":" + re.sub(r"\d+", "0", " ".join(value.lower().split())))
    return tag + "".join("." + n for n in sorted(names))


def events(page: str):
    """('open', tag, signature) / ('close', tag, '') / ('text', raw text, '') of a page, repaired.

    End tags close the nearest open element of their name; missing ones are supplied."""
    stack: list[str] = []
    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.match(page, at)
        if m is None:
            return
        token = m.group()
        at = m.end()
        if token == "<!--":
            end = page.find("-->", at)
            at = n if end < 0 else end + 3
            continue
        tag = m.group(2)
        if tag is None:
            if token[0] != "<" or token == "<":
                yield "text", token, ""
            continue
        tag = tag.lower()
        if m.group(1):
            if tag in stack:
                while stack:
                    top = stack.pop()
                    yield "close", top, ""
                    if top == tag:
                        break
            continue
        if tag in CLOSES or tag in CLOSES_P:
            group = CLOSES.get(tag, {"p"})
            # inline elements left open inside a closed block end with it
            inner = next((i for i in range(len(stack) - 1, -1, -1) if stack[i] not in INLINE), -1)
            while inner >= 0 and stack[inner] in group:
                while len(stack) > inner:
                    yield "close", stack.pop(), ""
                inner = next((i for i in range(len(stack) - 1, -1, -1) if stack[i] not in INLINE), -1)
        sig = signature(tag, m.group(3) or "")
        yield "open", tag, sig
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            body = page[at : end.start() if end else n]
            at = end.end() if end else n
            if tag in ("title", "textarea") and body:
                yield "text", body, ""
            yield "close", tag, ""
        elif tag in VOID or token.endswith("/>"):
            yield "close", tag, ""
        else:
            stack.append(tag)
    while stack:
        yield "close", stack.pop(), ""


class Block:
    """One text block: where it stands, its raw text pieces and how much of them is inside links."""

    __slots__ = ("path", "pieces", "linked", "length")

    def __init__(self, path: tuple[str, ...]):
        self.path, self.pieces, self.linked, self.length = path, [], 0, 0

    def text(self) -> str:
        return " ".join(html_lib.unescape("".join(self.pieces)).split())

    def digest(self) -> str:
        return hashlib.blake2b(self.text().encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()

    def is_links(self) -> bool:
        return self.linked > 0.8 * max(1, self.length)


def read_page(page: str) -> tuple[list[str], list[Block]]:
    """The page's structure stream (signatures, ``/tag`` ends and ``#``) and its text blocks in order."""
    stream: list[str] = []
    blocks: list[Block] = []
    path: list[str] = []
    links = 0
    block: Block | None = None
    for kind, what, sig in events(page):
        if kind == "text":
            if block is None:
                if what.isspace():
                    continue
                block = Block(tuple(path))
                blocks.append(block)
                stream.append("#")
            block.pieces.append(what)
            block.length += len(what)
            block.linked += len(what) if links else 0
        elif what in INLINE:
            if what == "a":
                links += 1 if kind == "open" else -1
            if what in ("br", "img") and block is not None:
                block.pieces.append(" ")
        else:
            block = None
            if kind == "open":
                path.append(sig)
                stream.append(sig)
            else:
                path.pop()
                if what not in OPTIONAL_END and what not in VOID:
                    stream.append("/" + what)
    return stream, blocks


# --- wrapper inference: items are strings (a tag, an end or '#') or tuples ('+' | '?', items...) ---


def fold(items: list) -> list:
    """Neighbouring equal groups (of up to 12 items) become one repeated group."""
    size = 1
    items = list(items)
    while size <= 12 and size * 2 <= len(items):
        out, i, changed = [], 0, False
        while i < len(items):
            group = items[i : i + size]
            j = i + size
            while len(group) == size and items[j : j + size] == group:
                j += size
            if j > i + size and group != ["#"]:
                body = group[0] if size == 1 and isinstance(group[0], tuple) and group[0][0] == "+" else ("+", *group)
                out.append(body)
                i, changed = j, True
            else:
                out.append(items[i])
                i += 1
        items = out
        size = 1 if changed else size + 1
    return items


def generalise(wrapper: list, stream: list) -> list:
    """Align a folded stream with the wrapper; what only one side has becomes optional, and a group
    that the other side repeats becomes repeated."""
    plain = [_core(x) for x in wrapper]
    other = [_core(x) for x in stream]
    out: list = []
    for op, a0, a1, b0, b1 in SequenceMatcher(None, plain, other, autojunk=False).get_opcodes():
        if op == "equal":
            for x, y in zip(wrapper[a0:a1], stream[b0:b1], strict=True):
                out.append(x if _rank(x) >= _rank(y) else y)
            continue
        for part in (wrapper[a0:a1], stream[b0:b1]):
            if not part:
                continue
            if out and len(out) >= len(part) and [_core(x) for x in out[-len(part) :]] == [_core(x) for x in part]:
                out[-len(part) :] = [("+", *[y for x in part for y in _core(x)])]  # beside its equal: a repeated group
                continue
            whole = part[0] if len(part) == 1 and isinstance(part[0], tuple) and part[0][0] == "?" else ("?", *part)
            out.append(whole)
    return fold(out)


def size(item) -> int:
    """Tags and texts of an item."""
    return 1 if isinstance(item, str) else sum(map(size, item[1:]))


def _tokens(item):
    if isinstance(item, str):
        yield item
    else:
        for x in item[1:]:
            yield from _tokens(x)


def loose(wrapper: list) -> bool:
    return len(wrapper) == 1 and not isinstance(wrapper[0], str) and wrapper[0][0] == "+" and all(x[0] == "?" for x in wrapper[0][1:])


def merge(streams: list[tuple[list, int]]) -> tuple[list, int]:
    """The wrapper of folded streams, or of wrappers of some of them, each with the size of its longest stream. A wrapper
    that outgrows that size twice over (and by ``SPARE``) becomes a loose one, a repeated group of its optional tags: pages without
    a common order have one slot, in which texts are told apart by their paths."""
    wrapper, longest = streams[0]
    for stream, length in streams[1:]:
        longest = max(longest, length)
        if not loose(wrapper) and not loose(stream):
            wrapper = generalise(wrapper, stream)
            if sum(map(size, wrapper)) <= 2 * longest + SPARE:
                continue
            stream = []
        wrapper = [("+", *[("?", t) for t in sorted({t for x in (*wrapper, *stream) for t in _tokens(x)})])]
    return wrapper, longest


def as_items(read: list) -> list:
    """Items as they were before JSON made lists of their groups."""
    return [x if isinstance(x, str) else (x[0], *as_items(x[1:])) for x in read]


def _core(item) -> tuple:
    """What an item matches, whether optional or repeated or not."""
    while isinstance(item, tuple) and item[0] in "+?" and len(item) == 2 and isinstance(item[1], tuple):
        item = item[1]
    return item[1:] if isinstance(item, tuple) else (item,)


def _rank(item) -> int:
    return {"+": 2, "?": 1}.get(item[0], 0) if isinstance(item, tuple) else 0


def printed(items) -> str:
    """The wrapper as text: tags, ``#`` slots, ``( )?`` and ``( )+`` groups."""
    return " ".join(x if isinstance(x, str) else f"( {printed(x[1:])} ){x[0]}" for x in items)


class Matcher:
    """A wrapper as an automaton; a slot's number is its place in the expression."""

    def __init__(self, items: list):
        self.labels: list[str | None] = [None]
        self.steps: list[list[int]] = [[]]
        self._reach: dict[int, dict[str, list[int]]] = {}
        self._build(items, 0)
        self.places: dict[str, list[int]] = {}
        for i, label in enumerate(self.labels):
            if label is not None:
                self.places.setdefault(label, []).append(i)

    def _new(self) -> int:
        self.labels.append(None)
        self.steps.append([])
        return len(self.labels) - 1

    def _build(self, items, at: int) -> int:
        for x in items:
            if isinstance(x, str):
                self.labels[at], end = x, self._new()
                self.steps[at].append(end)
                at = end
                continue
            first = self._new()
            self.steps[at].append(first)
            last = self._build(x[1:], first)
            end = self._new()
            self.steps[last] += [first, end] if x[0] == "+" else [end]
            if x[0] == "?":
                self.steps[at].append(end)
            at = end
        return at

    def _next(self, state: int) -> dict[str, list[int]]:
        """The items that can follow, by label, the preferred first: repeat, take, leave out."""
        found = self._reach.get(state)
        if found is None:
            found, todo, done = {}, [state], set()
            while todo:
                at = todo.pop()
                if at in done:
                    continue
                done.add(at)
                if self.labels[at] is not None:
                    found.setdefault(self.labels[at], []).append(at)
                else:
                    todo.extend(reversed(self.steps[at]))
            self._reach[state] = found
        return found

    def slots(self, stream: list[str]) -> list[int | None]:
        """The slot of every text of the stream, None for texts that the wrapper has no place for."""
        active: dict[int, tuple | None] = {0: None}  # state: slots so far, the last first
        i, n = 0, len(stream)
        while i < n:
            token = stream[i]
            i += 1
            after: dict[int, tuple | None] = {}
            for state, trace in active.items():
                for item in self._next(state).get(token, ()):
                    after.setdefault(self.steps[item][0], (item, trace) if token == "#" else trace)
            if after:
                active = after
                continue
            if token == "#":
                active = {state: (None, trace) for state, trace in active.items()}
                continue
            here, trace = next(iter(active.items()))
            fits = (self.steps[x][0] for x in self.places.get(token, ()) if x > here)
            later = next((x for x in fits if i == n or stream[i] in self._next(x)), None)
            if later is not None:
                active = {later: trace}
                continue
            tag = token.split(".", 1)[0]
            if token[0] == "/" or tag in OPTIONAL_END or tag in VOID:
                continue
            depth = 1  # an element that the wrapper does not have is passed over as a whole
            while i < n and depth:
                inner = stream[i]
                i += 1
                depth += (inner.split(".", 1)[0] == tag) - (inner == "/" + tag)
                if inner == "#":
                    active = {state: (None, t) for state, t in active.items()}
        out: list[int | None] = []
        trace = next(iter(active.values()))
        while trace is not None:
            out.append(trace[0])
            trace = trace[1]
        return out[::-1]


def slot_key(kind: str, slot: int, path: tuple[str, ...]) -> str:
    """``kind``: as ``kind_of`` gives it."""
    return f"{kind}{slot}\t" + "\t".join(path)


def _named(sig: str, pattern: re.Pattern) -> bool:
    tag, *names = sig.split(".", 1)
    return bool(names) and tag not in ("body", "html", "article", "main") and pattern.search(names[0]) is not None


def bad_container(sig: str) -> bool:
    return sig.split(".", 1)[0] in BOILERPLATE or _named(sig, _BAD_NAME)


def weak_container(sig: str) -> bool:
    return _named(sig, _WEAK_NAME)


def good_container(sig: str) -> bool:
    return sig.split(".", 1)[0] in _GOOD or ".r:main" in sig or ".r:article" in sig


def article_start(path: tuple[str, ...]) -> int:
    """Where the block's outermost article element stands in its path, -1 without one."""
    return next((i for i, s in enumerate(path) if good_container(s)), -1)


def kind_of(blocks: list[Block]) -> str:
    """'a': some article element stands under no menu, form, sidebar and the like; 'b': all that there are stand under
    one (which then says nothing: it wraps the page); 'p': there is no article element."""
    found = "p"
    for b in blocks:
        start = article_start(b.path)
        if start >= 0:
            if not any(bad_container(s) for s in b.path[:start]):
                return "a"
            found = "b"
    return found


def judge(path: tuple[str, ...], kind: str, anchor: tuple[str, ...] | None) -> bool:
    """Whether a block at this place may be main text; ``anchor``: the article's place on pages of kind 'p'."""
    start = article_start(path)
    if kind == "p":
        return anchor is not None and path[: len(anchor)] == anchor and not any(bad_container(s) for s in path[len(anchor) :])
    inside = path[0 if kind == "a" else start :]
    return start >= 0 and not any(bad_container(s) for s in inside)


def weak(path: tuple[str, ...], kind: str, anchor: tuple[str, ...] | None) -> bool:
    """Whether a name inside the article speaks against the block without settling it."""
    inside = path[len(anchor) :] if kind == "p" and anchor else path[article_start(path) :] if kind != "p" else ()
    return any(weak_container(s) for s in inside)


def holds(anchor: tuple[str, ...] | None, blocks: list[Block]) -> bool:
    return anchor is not None and any(b.path[: len(anchor)] == anchor for b in blocks)


def page_wrappers(blocks: list[Block]) -> set[tuple[str, ...]]:
    """Paths of forms and badly named containers that hold most of a page's unlinked text: they wrap the page."""
    mass: dict[tuple[str, ...], int] = {}
    total = 0
    for b in blocks:
        free = max(0, b.length - 2 * b.linked)
        total += free
        for i, s in enumerate(b.path):
            if s.split(".", 1)[0] == "form" or (s.split(".", 1)[0] not in BOILERPLATE and bad_container(s)):
                mass[b.path[: i + 1]] = mass.get(b.path[: i + 1], 0) + free
    return {p for p, m in mass.items() if m > 0.6 * total}


def page_mass(blocks: list[Block]) -> dict[tuple[str, ...], int]:
    """Unlinked paragraph text by container, on a page without an article element."""
    mass: dict[tuple[str, ...], int] = {}
    if kind_of(blocks) != "p":
        return mass
    around = page_wrappers(blocks)
    for b in blocks:
        if not any(bad_container(s) and b.path[: i + 1] not in around for i, s in enumerate(b.path)):
            cut = next((i for i, s in enumerate(b.path) if s.split(".", 1)[0] in BLOCK_TEXT), len(b.path))
            mass[b.path[:cut]] = mass.get(b.path[:cut], 0) + b.length - 2 * b.linked
    return mass


def article_place(pages: list[list[Block]]) -> tuple[str, ...] | None:
    """The container with most unlinked paragraph text, over the pages without an article element."""
    mass: dict[tuple[str, ...], int] = {}
    for blocks in pages:
        for path, m in page_mass(blocks).items():
            mass[path] = mass.get(path, 0) + m
    if not mass:
        return None
    top = max(mass.values())
    # the smallest container that holds most of the text: paragraphs may sit one level below it
    best = max(mass, key=lambda p: (mass[p], -len(p), p))
    for i in range(len(best), 0, -1):
        held = sum(v for p, v in mass.items() if p[:i] == best[:i] and v > 0)
        if held <= 1.2 * top:
            best = best[:i]
    return best or None if top > 0 else None


def doubted(path: tuple[str, ...], kind: str, anchor: tuple[str, ...] | None) -> bool:
    """Whether a block that may be main text is left for the host's pages to settle."""
    if not judge(path, kind, anchor):
        return False
    return weak(path, kind, anchor) or (kind == "p" and not (path and path[-1].split(".", 1)[0] in BLOCK_TEXT))


class Doubts:
    """What a page says about the doubted slots of its host's wrapper."""

    def __init__(self, wrapper: dict):
        self.matcher = Matcher(wrapper["items"])
        self.anchor = tuple(wrapper["anchor"]) if wrapper["anchor"] else None

    def of(self, page: str | None) -> dict | None:
        """``kind``, the digest ``main`` of its main text, and (slot, path, linked, length, digest of its only text) of
        every doubted slot; None for pages that are judged by themselves."""
        if not page:
            return None
        stream, blocks = read_page(page)
        kind = kind_of(blocks)
        if kind == "p" and not holds(self.anchor, blocks):
            return None
        main = "".join(b.digest() for b in blocks if judge(b.path, kind, self.anchor))
        found: dict[tuple, list] = {}
        for slot, b in zip(self.matcher.slots(stream), blocks, strict=True):
            if slot is not None and doubted(b.path, kind, self.anchor):
                at = found.setdefault((slot, b.path), [0, 0, set()])
                at[0] += b.linked
                at[1] += b.length
                at[2].add(b.digest())
        slots = [
            {"slot": s, "path": list(p), "linked": n, "length": m, "text": texts.pop() if len(texts) == 1 else None}
            for (s, p), (n, m, texts) in sorted(found.items())
        ]
        return {"kind": kind, "main": hashlib.blake2b(main.encode(), digest_size=16).hexdigest(), "slots": slots}


def infer_wrapper(pages: list[str]) -> dict:
    """Wrapper of a few pages of a host: ``items``, printed as ``expression``, the article's place on pages without an
    article element, and the verdicts on doubted slots. ``learn_wrappers`` is the same for any number of pages."""
    reads = [read_page(p) for p in pages if p]
    if not reads:
        return {"expression": "", "items": [], "slots": {}, "anchor": None}
    items, _ = merge([(x, sum(map(size, x))) for x in (fold(stream) for stream, _ in reads)])
    anchor = article_place([b for _, b in reads])
    wrapper = {"expression": printed(items), "items": items, "slots": {}, "anchor": list(anchor) if anchor else None}
    doubts = Doubts(wrapper)
    counted: dict[str, dict[str, list]] = {}  # a page of every main text, by kind
    for got in (doubts.of(p) for p in pages):
        if got is not None:
            counted.setdefault(got["kind"], {}).setdefault(got["main"], got["slots"])
    for kind, by_text in counted.items():
        seen: dict[tuple, list] = {}
        for x in (x for slots in by_text.values() for x in slots):
            seen.setdefault((x["slot"], tuple(x["path"])), []).append(x)
        for (slot, path), found in seen.items():
            verdict = MAIN
            texts = Counter(x["text"] for x in found if x["text"] is not None)
            same, text = max(((n, t) for t, n in texts.items()), default=(0, ""))
            if sum(x["linked"] for x in found) > 0.8 * max(1, sum(x["length"] for x in found)):
                verdict = LINKS
            elif len(by_text) >= MIN_EQUAL and same >= SAME * len(by_text):
                verdict = text
            wrapper["slots"][slot_key(kind, slot, path)] = verdict
    return wrapper


class Extractor:
    def __init__(self, wrapper: dict | None):
        self.slots = wrapper["slots"] if wrapper else {}
        self.matcher = Matcher(wrapper["items"] if wrapper else [])
        anchor = wrapper.get("anchor") if wrapper else None
        self.anchor = tuple(anchor) if anchor else None

    def text(self, page: str | None) -> str:
        if not page:
            return ""
        stream, blocks = read_page(page)
        kind = kind_of(blocks)
        anchor, slots = None, self.slots
        if kind == "p":
            anchor = self.anchor
            if not holds(anchor, blocks):
                anchor, slots = article_place([blocks]), {}
        out = []
        for slot, b in zip(self.matcher.slots(stream), blocks, strict=True):
            main = None if slot is None else slots.get(slot_key(kind, slot, b.path))
            if main is None:
                main = judge(b.path, kind, anchor) and not (weak(b.path, kind, anchor) and b.is_links())
            elif main == LINKS:
                main = not b.is_links()
            else:
                main = main == MAIN or main != b.digest()
            if main:
                text = b.text()
                if text:
                    out.append(text)
        return "\n".join(out)


def host_column(url):
    return F.coalesce(F.lower(F.regexp_extract(url.cast("string"), r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


_SHAPE = pa.struct([
    ("shape", pa.string()), ("longest", pa.int64()), ("open", pa.bool_()),
    ("mass", pa.list_(pa.struct([("path", pa.list_(pa.string())), ("m", pa.int64())]))),
])
_SHAPE_DDL = "struct<shape:string,longest:bigint,open:boolean,mass:array<struct<path:array<string>,m:bigint>>>"
_DOUBTS = pa.struct([
    ("kind", pa.string()), ("main", pa.string()),
    ("slots", pa.list_(pa.struct([
        ("slot", pa.int64()), ("path", pa.list_(pa.string())), ("linked", pa.int64()), ("length", pa.int64()),
        ("text", pa.string()),
    ]))),
])
_DOUBTS_DDL = (
    "struct<kind:string,main:string,slots:array<struct<slot:bigint,path:array<string>,linked:bigint,length:bigint,text:string>>>"
)


def _shape(page: str) -> dict:
    """A page's folded stream and its size, whether its host's pages may have slots to settle, and its paragraph text by container."""
    stream, blocks = read_page(page)
    kind = kind_of(blocks)
    mass = [{"path": list(p), "m": m} for p, m in page_mass(blocks).items()]
    items = fold(stream)
    is_open = kind == "p" or any(doubted(b.path, kind, None) for b in blocks)
    return {"shape": json.dumps(items, ensure_ascii=False), "longest": sum(map(size, items)), "open": is_open, "mass": mass}


def _merged(shapes: DataFrame) -> DataFrame:
    """(host, shape, longest, open): one wrapper a host, its streams merged in rounds of about ``FAN`` a task."""
    spark = shapes.sparkSession
    ddl = "host string, shape string, longest bigint, open boolean"

    def one(group: pd.DataFrame) -> pd.DataFrame:
        group = group.assign(n=group["shape"].str.len()).sort_values(["n", "shape"])
        shape, longest = group["shape"].iloc[0], int(group["longest"].max())
        if len(group) > 1:
            items, longest = merge([(as_items(json.loads(x)), int(n)) for x, n in zip(group["shape"], group["longest"], strict=True)])
            shape = json.dumps(items, ensure_ascii=False)
        return pd.DataFrame({"host": [group["host"].iloc[0]], "shape": [shape], "longest": [longest], "open": [bool(group["open"].any())]})

    while True:
        path = scratch_dir(spark, "wrapper-shapes")
        shapes.write.parquet(path)
        shapes = spark.read.parquet(path)
        most = shapes.groupBy("host").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return shapes
        part = F.pmod(F.xxhash64("shape"), F.lit(-(-most // FAN)))
        shapes = shapes.groupBy("host", part.alias("part")).applyInPandas(one, ddl)


def _article_places(mass: DataFrame) -> DataFrame:
    """(host, anchor) as ``article_place`` finds it, from (host, path, m) of all pages."""
    mass = mass.groupBy("host", "path").agg(F.sum("m").alias("m"))
    best = mass.groupBy("host").agg(F.max(F.struct("m", (-F.size("path")).alias("n"), "path")).alias("x"))
    best = best.where("x.m > 0 and size(x.path) > 0").select("host", F.col("x.path").alias("best"), F.col("x.m").alias("top"))
    lengths = F.sequence(F.lit(1), F.size("best"))
    shared = F.size(F.filter(lengths, lambda i: F.slice("path", 1, i) == F.slice("best", 1, i)))
    held = mass.where("m > 0").join(best, "host").groupBy("host", "best", "top", shared.alias("upto")).agg(F.sum("m").alias("m"))
    lists = held.groupBy("host", "best", "top").agg(F.collect_list(F.struct("upto", "m")).alias("held"))
    within = lambda i: F.aggregate(F.filter("held", lambda c: c["upto"] >= i), F.lit(0).cast("bigint"), lambda a, c: a + c["m"]) <= F.col("top") * 1.2
    cut = F.coalesce(F.get(F.filter(lengths, within), F.lit(0)), F.size("best"))
    return lists.select("host", F.slice("best", 1, cut).alias("anchor"))


def _verdicts(got: DataFrame) -> DataFrame:
    """(host, slots): the verdicts on doubted slots, from (host, d) of all pages (``d`` as ``Doubts.of`` gives it)."""
    spark = got.sparkSession
    path = scratch_dir(spark, "wrapper-texts")  # read twice
    got.where("d is not null").groupBy("host", "d.kind", "d.main").agg(F.min("d.slots").alias("slots")).write.parquet(path)
    texts = spark.read.parquet(path)
    pages = texts.groupBy("host", "kind").agg(F.count("*").alias("of"))
    slot = ["host", "kind", "slot", "path"]
    sums = texts.select("host", "kind", F.explode("slots").alias("x")).select("host", "kind", "x.*").groupBy(*slot, "text").agg(
        F.sum("linked").alias("linked"), F.sum("length").alias("length"), F.count("*").alias("n")
    )
    most = F.max(F.when(F.col("text").isNotNull(), F.struct("n", "text")))
    sums = sums.groupBy(*slot).agg(F.sum("linked").alias("linked"), F.sum("length").alias("length"), most.alias("most"))
    equal = (F.col("of") >= MIN_EQUAL) & (F.col("most.n") >= F.col("of") * SAME)
    verdict = F.when(F.col("linked") > F.greatest(F.lit(1), "length") * 0.8, LINKS).when(equal, F.col("most.text")).otherwise(MAIN)
    key = F.concat("kind", F.col("slot").cast("string"), F.lit("\t"), F.array_join("path", "\t"))  # as slot_key
    named = sums.join(pages, ["host", "kind"]).select("host", F.struct(key.alias("key"), verdict.alias("verdict")).alias("x"))
    return named.groupBy("host").agg(F.map_from_entries(F.array_sort(F.collect_list("x"))).alias("slots"))


def learn_wrappers(pages: DataFrame, *, url_col: str = "url", html_col: str = "html", max_shared: int = MAX_SHARED) -> DataFrame:
    """(host, wrapper): JSON wrappers from all pages of each host."""
    spark = pages.sparkSession
    slim = pages.select(F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").cast("string").alias("html")).where("html != ''")

    def factory():
        return lambda texts: pa.array([_shape(t) for t in texts], _SHAPE)

    path = scratch_dir(spark, "page-shapes")
    slim.select(host_column(F.col("url")).alias("host"), text_map(_SHAPE_DDL, factory)(F.col("html")).alias("p")).select("host", "p.*").write.parquet(path)
    shapes = spark.read.parquet(path)
    merged = _merged(shapes.groupBy("host", "shape").agg(F.max("longest").alias("longest"), F.max("open").alias("open")))
    places = _article_places(shapes.select("host", F.explode("mass").alias("x")).select("host", "x.*"))
    head = F.concat(F.lit('{"items":'), "shape", F.lit(',"anchor":'), F.coalesce(F.to_json("anchor"), F.lit("null")))
    path = scratch_dir(spark, "wrapper-heads")
    merged.join(places, "host", "left").select("host", "open", head.alias("head")).write.parquet(path)
    heads = spark.read.parquet(path)

    # only hosts that have something to settle are read again
    unsettled = heads.where("open").select("host", F.concat("head", F.lit("}")).alias("wrapper"))
    if unsettled.isEmpty():
        return heads.select("host", F.concat("head", F.lit(',"slots":{}}')).alias("wrapper"))
    got = _map_pages(slim, unsettled, _DOUBTS_DDL, _DOUBTS, lambda w: Doubts(w).of if w else lambda _: None,
                     url_col="url", html_col="html", out="d", max_shared=max_shared)
    slots = _verdicts(got.select(host_column(F.col("url")).alias("host"), "d"))
    tail = F.concat(F.lit(',"slots":'), F.coalesce(F.to_json("slots"), F.lit("{}")), F.lit("}"))
    return heads.join(slots, "host", "left").select("host", F.concat("head", tail).alias("wrapper"))


def _map_pages(pages: DataFrame, wrappers: DataFrame, ddl: str, arrow: pa.DataType, make, *, url_col: str, html_col: str,
               out: str, max_shared: int) -> DataFrame:
    """``pages`` plus ``out``: ``make`` gives the function from a page to its value for a host's wrapper (None without)."""
    spark = pages.sparkSession
    host, body = fresh(pages, "_host"), F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit(""))
    pages = pages.withColumn(host, host_column(F.col(f"`{url_col}`")))
    total = wrappers.agg(F.sum(F.octet_length("wrapper") + F.octet_length("host"))).first()[0] or 0
    if total <= max_shared:
        shared = spark.sparkContext.broadcast({r["host"]: r["wrapper"] for r in wrappers.toLocalIterator()})
        joined, wrapper = pages, F.lit(None).cast("string")
    else:
        shared = None
        salt, spread = fresh(pages, "_salt"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        many = wrappers.select(F.col("host").alias(host), F.col("wrapper").alias(fresh(pages, "_wrapper")), spread.alias(salt))
        salted = pages.withColumn(salt, F.pmod(F.xxhash64(body), F.lit(SALTS)).cast("int"))
        joined = salted.join(many, [host, salt], "left").drop(salt)
        wrapper = F.col(fresh(pages, "_wrapper"))

    def factory():
        made: dict = {}

        def run(rows):
            out = []
            for r in rows:
                known = shared.value.get(r["host"]) if shared is not None else r["wrapper"]
                name = r["host"]
                if name not in made:
                    if len(made) >= 500:
                        made.clear()
                    made[name] = make(json.loads(known) if known else None)
                out.append(made[name](r["html"]))
            return pa.array(out, arrow)

        return run

    got = joined.withColumn(out, text_map(ddl, factory)(F.struct(F.col(host).alias("host"), body.alias("html"), wrapper.alias("wrapper"))))
    return got.select(*[F.col(f"`{c}`") for c in pages.columns if c not in (host, out)], out)


def extract_main_text(pages: DataFrame, wrappers: DataFrame, *, url_col: str = "url", html_col: str = "html",
                      out: str = "main_text", max_shared: int = MAX_SHARED) -> DataFrame:
    """``pages`` plus string ``out``; ``wrappers`` (host, wrapper) is read twice, so pass a written table."""
    return _map_pages(pages, wrappers, "string", pa.string(), lambda w: Extractor(w).text,
                      url_col=url_col, html_col=html_col, out=out, max_shared=max_shared)


def op7_html(spark, sf_dir) -> DataFrame:
    """Main text of every page."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    path = scratch_dir(spark, "wrappers")
    learn_wrappers(pages).write.parquet(path)
    got = extract_main_text(pages, spark.read.parquet(path), out="text")
    return got.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
