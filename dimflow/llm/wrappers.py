"""Main-text extraction from web pages by inferred wrappers.

Pages of one host come from a few templates. Their token streams are aligned
into one union-free regular expression per host, the wrapper: elements that all
pages share, optional elements (``?``) where a mismatch could only be resolved by
leaving one out, repeated elements or groups (``+``) where a mismatch was one
more round of what stands before it, and text slots (``#``).

1. Each page becomes an outline (elements, words and hashes of texts) and a
   skeleton: its element tree with repeated siblings folded. Equal skeletons of a
   host collapse before anything moves.
2. Skeletons of a host are aligned one after the other, first within blocks,
   then the blocks' wrappers with each other, so no host is one task's work.
3. Each page is mapped onto its host's wrapper. Words, links and distinct texts in
   each slot of the wrapper, over all pages of the host, decide which slots are
   template text (the same on all pages) and which hold more than links.
4. Every page is read again, whole, with its host's decision. Its own main-text
   slots give the element that holds its text, so pages of a rarer template of the
   host are not cut to the place where the others have theirs.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import blake2b
from urllib.parse import urlsplit

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import ship_package, staged, text_of

DEEPEST = 150  # levels of elements; what is nested deeper is part of the one at this level, its blocks stay blocks
BLOCKS = 64  # blocks of a host in the first alignment
LONGEST_GROUP = 4  # siblings in one repeated group
LONGEST_NAMES = 60  # characters of names in a label
LEAST_PAGES = 3  # distinct pages before a text counts as the same on all of them
MANY_PAGES = 10  # ... where such texts hold most of the words
FEW = 10  # pages for each distinct text of a slot that counts as template text
RARE = 20  # a slot is judged if one page in so many of the host has it

# Kinds of HTML elements, and names of what is not main text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe object svg math textarea select button canvas".split())
INLINE = set("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span "
             "strike strong sub sup time tt u var wbr".split())
CLOSED_BY = {"p": set("p h1 h2 h3 h4 h5 h6 ul ol dl table div section article aside nav header footer form figure "
                      "blockquote pre main hr address fieldset".split()),
             "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
             "th": {"td", "th", "tr"}, "option": {"option"}}
BOILERPLATE = set("nav header footer aside form head title menu dialog".split())
# A class, id or role name counts as a whole: each of its parts is one of these words, or one of PLACE beside one of them.
BOILERPLATE_NAME = set(
    "ad ads advert adverts advertisement advertisements advertising banner banners sponsor sponsors sponsored promo "
    "promos promotion promotions cookie cookies consent notice notices alert alerts comment comments replies respond "
    "sidebar menu menus nav navs navbar navigation breadcrumb breadcrumbs footer header share sharing social related "
    "newsletter subscribe popup modal widget widgets masthead toolbar login signup".split())
PLACE = set("top bottom left right main site global primary secondary mobile desktop bar box block list area wrapper "
            "container inner outer item items link links button buttons icon icons form panel slot unit overlay "
            "message policy posts articles stories media tools tabs".split())
CONTENT = set("article main".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>",
                   re.S)
NAME = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def host_of(url: str | None) -> str:
    """Lower-case host of a page's address; empty for none or an unreadable one."""
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def _named_boilerplate(names: str) -> bool:
    for name in names.split():
        parts = set(re.split("[_-]+", name)) - {""}
        if parts & BOILERPLATE_NAME and parts <= BOILERPLATE_NAME | PLACE:
            return True
    return False


def _label(tag: str, attributes: str) -> str:
    """Tag and names of an element; ``!`` ends the label of one whose names say that it is no main text.

    All names are judged; of long ones the label keeps the start and a hash of the whole.
    """
    if "=" not in attributes:
        return tag
    names = " ".join(x for found in NAME.findall(attributes) for x in found if x).lower()
    judged = re.sub(r"[^a-z _-]+", "", names)
    # Numbers of their own and long ones are a page's (post-123); others belong to the name (c7).
    short = "_".join(re.sub(r"(?<![a-z0-9])[0-9]+|[0-9]{4,}|[^a-z0-9 _-]+", "", names).split())
    if len(short) > LONGEST_NAMES:
        short = f"{short[:LONGEST_NAMES]}~{zlib.crc32(short.encode()):08x}"
    return f"{tag}.{short}{'!' * _named_boilerplate(judged)}" if short else tag


def tokens(page: str) -> Iterator[tuple[str, str]]:
    """``("open", label)``, ``("close", tag)`` of block elements, ``("text", raw)``, ``("link", "+" or "-")``.

    Scripts, styles, comments and their like vanish here; end tags that HTML lets
    a page omit are supplied. Elements below ``DEEPEST`` levels come as ``("break", "")``
    where they open and close.
    """
    stack: list[str] = []

    def closing_of(tag: str) -> tuple[str, str]:
        return ("close", tag) if len(stack) < DEEPEST else ("break", "")

    at = 0
    found = TOKEN.search(page)
    while found:
        if found.start() > at:
            yield "text", page[at:found.start()]
        at = found.end()
        closing, tag = found.group(1), (found.group(2) or "").lower()
        if tag in RAW:
            if not closing and not (found.group(3) or "").endswith("/"):
                end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
        elif tag == "a":
            yield "link", "-" if closing else "+"
        elif tag and tag not in INLINE and tag not in VOID:
            if closing:
                if tag in stack:
                    while stack:
                        top = stack.pop()
                        yield closing_of(top)
                        if top == tag:
                            break
            else:
                while stack and tag in CLOSED_BY.get(stack[-1], ()):
                    yield closing_of(stack.pop())
                stack.append(tag)
                yield ("open", _label(tag, found.group(3) or "")) if len(stack) <= DEEPEST else ("break", "")
        elif tag in ("br", "hr"):
            yield "text", " "
        found = TOKEN.search(page, at)
    if at < len(page):
        yield "text", page[at:]
    while stack:
        yield closing_of(stack.pop())


# A node of a skeleton or wrapper: [label, children, optional, repeated]; a text slot is the label "#".

def _same(a: list, b: list) -> bool:
    return a[0] == b[0]


def align(one: list, two: list) -> list:
    """Two sibling lists as one: equal labels in order meet (longest common sequence), the others become optional."""
    n, m = len(one), len(two)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if _same(one[i], two[j]) else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and _same(one[i], two[j]) and best[i][j] == best[i + 1][j + 1] + 1:
            out.append(merge(one[i], two[j]))
            i, j = i + 1, j + 1
        elif j == m or i < n and best[i + 1][j] >= best[i][j + 1]:
            out.append([one[i][0], one[i][1], True, one[i][3]])
            i += 1
        else:
            out.append([two[j][0], two[j][1], True, two[j][3]])
            j += 1
    return fold(out)


def merge(a: list, b: list) -> list:
    return [a[0], a[1] if a[1] == b[1] else align(a[1], b[1]), a[2] or b[2], a[3] or b[3]]


def fold(siblings: list) -> list:
    """Neighbouring rounds of the same one to ``LONGEST_GROUP`` labels become one repeated element or group."""
    for width in range(1, LONGEST_GROUP + 1):
        out, i = [], 0
        while i < len(siblings):
            group = siblings[i:i + width]
            labels = [x[0] for x in group]
            rounds = 1
            while len(group) == width and [x[0] for x in siblings[i + rounds * width:i + (rounds + 1) * width]] == labels:
                group = [merge(a, b) for a, b in zip(group, siblings[i + rounds * width:i + (rounds + 1) * width])]
                rounds += 1
            if rounds == 1:
                out.append(siblings[i])
                i += 1
            elif width == 1:
                out.append([group[0][0], group[0][1], group[0][2], True])
                i += rounds
            else:
                out.append(["(" + " ".join(labels) + ")", group, False, True])
                i += rounds * width
        siblings = out
    return siblings


def outline(page: str) -> str:
    """A page without its text: lines ``+label``, ``-``, and for the text between them ``words linked hash``."""
    lines: list[str] = []
    run: list[str] = []
    links = n = linked = 0

    def flush() -> None:
        if n:
            lines.append(f"{n} {linked} {_hash(' '.join(''.join(run).split())):x}")

    for kind, value in tokens(page):
        if kind == "text":
            count = len(value.split())
            n, linked = n + count, linked + count * bool(links)
            run.append(value)
        elif kind == "link":
            links = max(0, links + (1 if value == "+" else -1))
        else:
            flush()
            run, n, linked = [], 0, 0
            if kind != "break":
                lines.append("+" + value if kind == "open" else "-")
    flush()
    return "\n".join(lines)


def _hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=False) >> 1


def tree_of(lines: str) -> list:
    """The folded element tree of a page from its outline."""
    root: list = ["", [], False, False]
    stack = [root]
    for line in lines.split("\n") if lines else ():
        if line[0] == "+":
            node = [line[1:], [], False, False]
            stack[-1][1].append(node)
            stack.append(node)
        elif line == "-":
            done = stack.pop()
            done[1] = fold(done[1])
        elif not stack[-1][1] or stack[-1][1][-1][0] != "#":
            stack[-1][1].append(["#", [], False, False])
    return fold(root[1])


class Slots:
    """Places of a page's elements in a wrapper, read along its sibling lists.

    A slot is a path of labels; of equal labels that a sibling list holds at
    several places, the later ones get ``@2``, ``@3``. An element takes the next
    place of its label, in a repeated element or group also the same or an
    earlier one; what the wrapper does not hold keeps its own path.
    """

    def __init__(self, wrapper: list | None = None):
        self.children: dict[str, tuple] = {}
        if wrapper:
            self._add("", wrapper)

    def _add(self, path: str, nodes: list) -> None:
        labels, inner, first, last = [], [], [], []

        def flatten(nodes: list, outer: int | None) -> None:
            for label, children, _, repeated in nodes:
                at = len(labels)
                if label.startswith("("):
                    flatten(children, at if outer is None else outer)
                    if outer is None:
                        last[at:] = [len(labels) - 1] * (len(labels) - at)
                elif label != "#":
                    labels.append(label)
                    inner.append(children)
                    first.append(outer if outer is not None else at if repeated else at + 1)
                    last.append(at)

        flatten(nodes, None)
        seen: dict[str, int] = {}
        names = []
        for label, children in zip(labels, inner):
            seen[label] = seen.get(label, 0) + 1
            names.append(f"{path}/{label}" + (f"@{seen[label]}" if seen[label] > 1 else ""))
            self._add(names[-1], children)
        if labels:
            self.children[path] = labels, names, first, last

    def step(self, path: str, at: int, label: str) -> tuple[str, int]:
        """Slot path of the next child ``label`` and its place, after the one at place ``at`` (-1: none yet)."""
        if path not in self.children:
            return f"{path}/{label}", at
        labels, names, first, last = self.children[path]
        if at >= 0 and first[at] <= at:
            order = (*((at,) if first[at] == at == last[at] else ()), *range(at + 1, last[at] + 1),
                     *range(first[at], at + 1), *range(last[at] + 1, len(labels)), *range(at))
        else:
            order = (*range(at + 1, len(labels)), *range(at + 1))
        for i in order:
            if labels[i] == label:
                return names[i], i
        return f"{path}/{label}", at


def read_slots(lines: str, slots: Slots) -> dict[str, list]:
    """Words, words in links and the hashes of the texts of each slot, from a page's outline."""
    path, place = [""], [-1]
    out: dict[str, list] = {}
    for line in lines.split("\n") if lines else ():
        if line[0] == "+":
            slot, place[-1] = slots.step(path[-1], place[-1], line[1:])
            path.append(slot)
            place.append(-1)
        elif line == "-":
            path.pop()
            place.pop()
        else:
            n, linked, value = line.split(" ")
            found = out.setdefault(path[-1], [0, 0, []])
            found[0] += int(n)
            found[1] += int(linked)
            found[2].append(value)
    return out


def skeleton(page: str) -> tuple[list, dict[str, list[int]]]:
    """The folded element tree of a page, and words and words in links by slot path."""
    lines = outline(page)
    return tree_of(lines), {p: x[:2] for p, x in read_slots(lines, Slots()).items()}


def to_text(nodes: list) -> str:
    """A wrapper as a regular expression over elements."""
    return " ".join(label + (f"[{to_text(children)}]" if children else "") + "?" * optional + "+" * repeated
                    for label, children, optional, repeated in nodes)


def pack(nodes: list) -> str:
    """Nodes as a string, for grouping and moving."""
    return json.dumps(nodes, separators=(",", ":"))


def unpack(packed: str) -> list:
    return json.loads(packed)


@lru_cache(256)
def slots_of(packed: str) -> Slots:
    return Slots(unpack(packed))


def _prefixes(path: str) -> list[str]:
    labels = path.split("/")
    return ["/".join(labels[:i + 1]) for i in range(1, len(labels))]


def _tag(path: str) -> str:
    return re.split("[.!@]", path.rsplit("/", 1)[1], maxsplit=1)[0]


def boilerplate(words: dict[str, tuple[int, int]]) -> set[str]:
    """The slots, of these with their words and words in links, that lie in an element that is not main text.

    Names do not exclude html, body, article or main elements, nor an element
    (a form neither) with most of the words, unless a tenth of them are in an
    article or main element beside it: an article with many comments.
    """
    steps = {p: _prefixes(p) for p in words}
    mass: dict[str, int] = {}
    total = 0
    for path, (n, _) in words.items():
        if not any(_tag(x) in BOILERPLATE - {"form"} for x in steps[path]):
            total += n
            for x in steps[path]:
                mass[x] = mass.get(x, 0) + n
    content = [x for x, n in mass.items() if _tag(x) in CONTENT and 10 * n >= total]

    def beside(x: str) -> bool:
        return any(not (c + "/").startswith(x + "/") and not (x + "/").startswith(c + "/") for c in content)

    def excluded(x: str) -> bool:
        tag = _tag(x)
        if tag in BOILERPLATE - {"form"}:
            return True
        if tag != "form" and "!" not in x.rsplit("/", 1)[1] or tag in CONTENT or tag in ("html", "body"):
            return False
        return 2 * mass.get(x, 0) <= total or beside(x)

    known = {x: excluded(x) for x in {x for xs in steps.values() for x in xs}}
    return {p for p, xs in steps.items() if any(known[x] for x in xs)}


def same_everywhere(slots: pd.DataFrame) -> list[str]:
    """Slots of a host whose text is template text: the same on all its pages, or one of few.

    ``slots`` has a row per slot: ``slot, words, linked, n_values, n_pages``, the
    numbers of distinct texts and distinct pages, and a row of slot "" for the
    host. Copies of a page count once. Where such slots hold most of the words the
    pages may be near copies: then many pages must agree, and never on nearly all.
    """
    if slots.empty:
        return []
    pages = slots["n_pages"].max()
    slots = slots[slots["slot"] != ""]
    agreed = slots[(slots["n_pages"] >= LEAST_PAGES) & (slots["n_pages"] * RARE >= pages)
                   & ((slots["n_values"] == 1) | (slots["n_values"] * FEW <= slots["n_pages"]))]
    out = boilerplate({s: (n, l) for s, n, l in zip(slots["slot"], slots["words"], slots["linked"])})

    def plain(rows: pd.DataFrame) -> int:
        return int((rows["words"] - rows["linked"])[~rows["slot"].isin(out)].sum())

    same, total = plain(agreed), plain(slots)
    if 2 * same > total and (pages < MANY_PAGES or 10 * same > 9 * total):
        agreed = agreed[agreed["words"] == agreed["linked"]]
    return sorted(agreed["slot"])


def choose(words: dict[str, tuple[int, int]], template: Iterable[str] = (), prose: Iterable[str] = ()) -> str:
    """Path of the element that holds the main text, from words and words in links by slot path.

    ``template`` are slots of template text, ``prose`` those that hold more than
    links on the host's pages.

    An article or main element if one holds half the words that are not
    boilerplate; else the smallest element that holds all of them. Words in links
    count only where there are no others.
    """
    out = boilerplate(words).union(template)
    left = {p: n if p in prose else n - linked for p, (n, linked) in words.items()
            if p not in out and (n > linked or p in prose)}
    left = left or {p: n for p, (n, _) in words.items() if p not in out}
    mass: dict[str, int] = {}
    for path, n in left.items():
        for prefix in _prefixes(path):
            mass[prefix] = mass.get(prefix, 0) + n
    total = sum(left.values())
    named = [p for p, n in mass.items() if _tag(p) in CONTENT and 2 * n >= total]
    if named:
        return min(named, key=lambda p: (p.count("/"), p))
    # A paragraph that happens to hold it all is no container.
    holders = [p for p, n in mass.items() if n == total and (len(left) > 1 or p not in left)]
    return max(holders, key=lambda p: p.count("/"), default="")


def main_text(page: str, container: str | None = None, wrapper: Slots | None = None, template: Iterable[str] = (),
              prose: Iterable[str] = ()) -> str:
    """Blocks inside the container that are no boilerplate, one per line.

    The page's own words choose the container, also in place of one that is given
    but does not hold most of the page's main words.
    """
    # Template text inside an article or main element is the page's own: shared headings, a byline.
    template = [t for t in template if not any(_tag(x) in CONTENT for x in _prefixes(t))]
    slots = wrapper or Slots()
    path, place, links, block = [""], [-1], 0, 0
    texts: list[tuple[str, str, int]] = []
    words: dict[str, tuple[int, int]] = {}
    for kind, value in tokens(page):
        if kind == "open":
            slot, place[-1] = slots.step(path[-1], place[-1], value)
            path.append(slot)
            place.append(-1)
            block += 1
        elif kind == "close":
            path.pop()
            place.pop()
            block += 1
        elif kind == "break":
            block += 1
        elif kind == "link":
            links = max(0, links + (1 if value == "+" else -1))
        else:
            texts.append((path[-1], value, block))
            n = len(value.split())
            if n:
                all_words, linked = words.get(path[-1], (0, 0))
                words[path[-1]] = all_words + n, linked + n * bool(links)
    out = boilerplate(words).union(template)
    main = {p: n for p, (n, _) in words.items() if p not in out}
    held = sum(n for p, n in main.items() if container is not None and (p + "/").startswith(container + "/"))
    if container is None or 2 * held <= sum(main.values()):
        container = choose(words, template, prose)
    if container and _tag(container) not in ("html", "body"):  # nor is it taken out of the chosen element
        out = boilerplate(words) | {t for t in template if not (t + "/").startswith(container + "/")}
    blocks: list[list[str]] = []
    known, open_block = {}, None
    for where, value, number in texts:
        if where not in known:
            known[where] = (where + "/").startswith(container + "/") and where not in out
        if known[where]:
            if number != open_block:
                blocks.append([])
                open_block = number
            blocks[-1].append(value)
    lines = (" ".join(html.unescape("".join(b)).split()) for b in blocks)
    return "\n".join(line for line in lines if line)


def infer_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per host, from all its pages: ``host, wrapper`` (the expression), ``tree`` (packed), ``template`` and
    ``prose`` (slots of template text, and those that hold more than links)."""
    ship_package(pages.sparkSession)
    rows = pages.select(F.col(url_col).alias("url"), text_of(html_col).alias("html"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [outline(page.as_py()) for page in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([host_of(url.as_py()) for url in batch.column(0)], pa.string()), pa.array(lines, pa.string())],
                names=["host", "outline"])

    outlines = staged(rows.mapInArrow(read, "host string, outline string"), "page_outlines")

    @F.arrow_udf("string")
    def tree(outlines: pa.Array) -> pa.Array:
        return pa.array([pack(tree_of(x)) for x in outlines.to_pylist()], pa.string())

    found = outlines.select("host", tree("outline").alias("tree")).distinct()

    def together(group: pd.DataFrame) -> pd.DataFrame:
        wrapper = None
        for packed in sorted(group["tree"]):
            tree = unpack(packed)
            wrapper = tree if wrapper is None else align(wrapper, tree)
        return pd.DataFrame({"host": group["host"].iloc[:1], "tree": [pack(wrapper)]})

    schema = "host string, tree string"
    trees = staged(found.select("host", "tree", F.pmod(F.xxhash64("tree"), F.lit(BLOCKS)).alias("b"))
                   .groupBy("host", "b").applyInPandas(together, schema)
                   .groupBy("host").applyInPandas(together, schema), "page_trees")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for host, lines, packed in zip(*(c.to_pylist() for c in batch.columns)):
                page = _hash(lines)
                out.append((host, "", 0, 0, 0, page))
                out += [(host, slot, n, linked, _hash(" ".join(values)), page)
                        for slot, (n, linked, values) in read_slots(lines, slots_of(packed)).items() if slot]
            columns = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[i], pa.string()) for i in range(2)]
                + [pa.array(columns[i], pa.int64()) for i in range(2, 6)],
                names=["host", "slot", "words", "linked", "value", "page"])

    slots = (outlines.join(trees, "host").select("host", "outline", "tree")
             .mapInArrow(gather, "host string, slot string, words long, linked long, value long, page long")
             .groupBy("host", "slot").agg(
                 F.sum("words").alias("words"), F.sum("linked").alias("linked"),
                 F.approx_count_distinct("value").alias("n_values"), F.approx_count_distinct("page").alias("n_pages")))

    def decide(wrapper: pd.DataFrame, slots: pd.DataFrame) -> pd.DataFrame:
        words = {p: (int(n), int(l)) for p, n, l in zip(slots["slot"], slots["words"], slots["linked"]) if p}
        template = same_everywhere(slots)
        prose = [p for p, (n, linked) in words.items() if 2 * linked <= n]
        return pd.DataFrame({"host": wrapper["host"], "wrapper": [to_text(unpack(t)) for t in wrapper["tree"]],
                             "tree": wrapper["tree"], "template": [template], "prose": [prose]})

    return staged(trees.groupBy("host").cogroup(slots.groupBy("host")).applyInPandas(
        decide, "host string, wrapper string, tree string, template array<string>, prose array<string>"),
        "page_wrappers")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: ``id, url, text, n_chars``.

    ``text`` is empty where nothing is left, also for a null or empty page. Pages
    without a host share one wrapper; repeated rows and null ids keep their rows.
    """
    wrappers = infer_wrappers(pages, url_col, html_col).drop("wrapper")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), text_of(html_col).alias("html"))

    @F.arrow_udf("string")
    def host(urls: pa.Array) -> pa.Array:
        return pa.array([host_of(u) for u in urls.to_pylist()], pa.string())

    @F.arrow_udf("string")
    def text(pages: pa.Array, trees: pa.Array, templates: pa.Array, prose: pa.Array) -> pa.Array:
        return pa.array([main_text(page.as_py(), None, slots_of(tree), set(template), set(slots))
                         for page, tree, template, slots in zip(pages, *(
                             c.to_pylist() for c in (trees, templates, prose)))], pa.string())

    # Every page has a host, be it the empty one, so the join loses none.
    decided = rows.withColumn("host", host("url")).join(wrappers, "host")
    return (decided.select("id", "url", text("html", "tree", "template", "prose").alias("text"))
            .select("id", "url", "text", F.char_length("text").cast("long").alias("n_chars")))
