"""Operator 11: main text of web pages, by removal of the templates of their sites.

Subtrees.  A task reads a page into a tree of elements (end tags may be missing or
wrong, as browsers allow) and hashes every subtree: its tag, its texts with white
space folded, its children's hashes.  Spark counts them per host: distinct (host
and hash, page) pairs first, then a partial count a task, so neither a host nor a
subtree with a third of all pages is one group.  A page is its main text there, so
copies of one page under many addresses count once and are no template.  What
``min_pages`` pages or more of a host share is that site's template.

The keys of the templates, 8 bytes each, lie sorted in files of some four million
in the shared folder, cut by ranges of the key; tasks map a few of them at a time.
A second pass over the pages deletes the subtrees found there.

Prose.  Inside an ``article`` or ``main`` element, paragraphs, headings, lists,
tables and what stands in a line are never deleted as templates, however often a
site repeats them (a licence line, a quotation); other elements there, and every
element elsewhere, are.

Besides, elements whose tag, role, class or id says that they are menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles or reader comments
go, since those that change from page to page are in no template.  Of what is left, the
text of the outermost ``article`` elements is the page's; without any, that of the ``main``
elements; else all of it.

Text.  Character references are decoded, white space (also U+00A0) in a block is
one space, blocks are joined in page order by one space; ``br`` ends a line like a
block.  A header inside an article keeps its headings.

Cases: null html is empty; a null url or one without ``://`` belongs to the host
''; rows with equal ids are pages like any other; comments, scripts and tags that
never end reach to the end of the page; an empty table gives an empty one.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter, OrderedDict
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import shared_files as files
from tidewatch.llm.common import materialise, prepare
from tidewatch.llm.urls import host_of
from tidewatch.session import scratch_path

#: Template keys of one file, files that a worker keeps mapped.
FILE_KEYS, MAPPED = 1 << 22, 16

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup; they have no text of the page either.
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript".split())
HEAD = frozenset("html head base link meta title script style noscript template".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table caption tbody td "
    "tfoot th thead tr ul".split())
#: Start tags that end an open paragraph.
ENDS_P = BLOCK - frozenset("body html option optgroup caption tbody td tfoot th thead tr legend".split())
CELLS = frozenset("table caption td th html button object template".split())
#: Elements that end when one of the second set starts, up to an element of the third.
SIBLINGS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir", *CELLS])),
    "dd": (frozenset(["dd", "dt"]), frozenset(["dl", *CELLS])), "dt": (frozenset(["dd", "dt"]), frozenset(["dl", *CELLS])),
    "option": (frozenset(["option"]), frozenset(["select", *CELLS])), "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select", *CELLS])),
    "td": (frozenset(["td", "th"]), frozenset(["table", "html"])), "th": (frozenset(["td", "th"]), frozenset(["table", "html"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table", "html"])),
    **{t: (frozenset(["tbody", "thead", "tfoot", "tr", "td", "th", "caption"]), frozenset(["table", "html"])) for t in ("tbody", "thead", "tfoot")},
}
#: What is not deleted as a template inside the main text.
CONTAINERS = frozenset("address article aside body center details dialog div fieldset footer form header hgroup html main menu nav search section".split())
#: Menus, headers, footers, sidebars, notices, adverts, forms, scripts and styles by their tags.
DROPPED = RAW | frozenset(
    "nav header footer aside form menu dialog button select input datalist search template svg math object canvas audio video applet "
    "frameset head".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar status".split())
#: A name says what an element is by a whole word, unless it says that there is one or none.
_WORD = r"(?<![a-z0-9])(?<!no[-_])(?<!has[-_])(?<!with[-_])(?<!without[-_])"
_HINT = re.compile(
    _WORD + r"(?:ads?|adbox|adsense|advert\w*|sponsor\w*|promo|promotion|promoted|banner|cookies?|consent|gdpr|notice|popup|modal|overlay|newsletter|"
    r"subscribe|subscription|signup|menu|nav|navbar|navigation|breadcrumbs?|pager|pagination|sidebar|widget|related|share|sharing|"
    r"social|footer|toolbar|login|search)(?![a-z0-9])")
_OUTSIDE = re.compile(_WORD + r"(?:header|masthead)(?![a-z0-9])")
_COMMENTS = re.compile(_WORD + r"(?:comments?|commentlist|disqus|respond|replies)(?![a-z0-9])")
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_ATTRS = r"""(?:=\s*(?:"[^"]*"|'[^']*')|[^>=]++|=)*+"""
_TAG = re.compile(
    rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*){_ATTRS}(?:>|\Z)|</[^>]*(?:>|\Z)|<([a-zA-Z][^\s/>]*)({_ATTRS})(?:>|\Z)", re.S)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.I) for t in RAW}
_SAYING = re.compile(r"class|id|role|style", re.I)
_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")


@lru_cache(maxsize=4096)
def hints(attributes: str) -> tuple[bool, bool, bool, bool]:
    """What the attributes say: dropped anywhere, dropped outside the main text, reader comments, main text."""
    found = {}
    for name, value in _ATTR.findall(attributes):
        found.setdefault(name.lower(), _html.unescape(value.strip("\"'")).lower())
    names, role = f"{found.get('class', '')} {found.get('id', '')}", found.get("role", "").strip()
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "")
    return bool(hidden or role in ROLES or _HINT.search(names)), bool(_OUTSIDE.search(names)), bool(_COMMENTS.search(names)), role == "main"


class Page:
    """Elements in page order: tags, parents, attributes, and their texts and children in order."""

    def __init__(self, source: str):
        self.tags, self.parents, self.attributes, self.inner = ["#page"], [0], [""], [[]]
        self._open, self._stack = Counter(), [0]
        self._read(source)

    def _pop_to(self, depth: int) -> None:
        for e in self._stack[depth:]:
            self._open[self.tags[e]] -= 1
        del self._stack[depth:]

    def _end(self, names, stops) -> None:
        """End the innermost open element of these names, unless one of ``stops`` is further in."""
        if not any(self._open[n] for n in names):
            return
        for depth in range(len(self._stack) - 1, 0, -1):
            tag = self.tags[self._stack[depth]]
            if tag in names:
                return self._pop_to(depth)
            if tag in stops:
                return

    def _start(self, tag: str, attributes: str) -> None:
        if tag in ("html", "body", "head") and (self._open[tag] or tag == "head" and self._open["body"]):
            return
        if tag not in HEAD and self._open["head"]:
            self._end(("head",), ())
        if tag in ENDS_P:
            self._end(("p",), CELLS)
        if tag in _HEADINGS and self.tags[self._stack[-1]] in _HEADINGS:
            self._pop_to(len(self._stack) - 1)
        if tag in SIBLINGS:
            names, stops = SIBLINGS[tag]
            for _ in names:   # a row ends its cell, and then the row before
                self._end(names, stops)
        e = len(self.tags)
        self.tags.append(tag)
        self.parents.append(self._stack[-1])
        self.attributes.append(attributes)
        self.inner[self._stack[-1]].append(e)
        self.inner.append([])
        if tag not in VOID:
            self._stack.append(e)
            self._open[tag] += 1

    def _close(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        if tag == "br":
            self._start("br", "")
        elif tag in ("table", "tr", "tbody", "thead", "tfoot", "td", "th", "caption"):
            self._end((tag,), ("table",) if tag != "table" else ())
        elif tag in BLOCK or tag in DROPPED:
            self._end(tuple(_HEADINGS) if tag in _HEADINGS else (tag,), CELLS)
        else:
            self._end((tag,), BLOCK)

    def _read(self, source: str) -> None:
        at, find = 0, _TAG.search
        while m := find(source, at):
            if m.start() > at:
                self.inner[self._stack[-1]].append(_html.unescape(source[at:m.start()]))
            at = m.end()
            if source[at - 1] != ">":   # the page ends in a tag or comment
                break
            if m[1]:
                self._close(m[1].lower())
            elif m[2]:
                self._start(tag := m[2].lower(), m[3])
                if tag in RAW:
                    end = _RAW_END[tag].search(source, at)
                    at = end.start() if end else len(source)
            # a text of "<" that starts no tag is found by no pattern and stays text
        if at < len(source):
            self.inner[self._stack[-1]].append(_html.unescape(source[at:]))

    def prepared(self) -> Page:
        """Adds which elements go by tag, role, class or id, and where the main text is."""
        n = len(self.tags)
        said = [hints(a) if a and _SAYING.search(a) else (False,) * 4 for a in self.attributes]
        comments = [s[2] and t in BLOCK for s, t in zip(said, self.tags)]
        for e in range(1, n):
            comments[e] = comments[e] or comments[self.parents[e]]
        articles = [e for e in range(n) if self.tags[e] == "article"]
        spared = bool(articles) and all(comments[e] for e in articles)   # the word is about something else then
        gone, within = [False] * n, [False] * n
        for e in range(1, n):
            gone[e] = gone[self.parents[e]] or self.tags[e] in DROPPED or (comments[e] and not spared)
            hinted = (said[e][0] or said[e][1]) and self.tags[e] not in ("html", "body", "article", "main")
            within[e] = within[self.parents[e]] or hinted
        left = [e for e in range(n) if not gone[e]]
        mains = [e for e in left if self.tags[e] == "article"] or [e for e in left if self.tags[e] == "main" or said[e][3]]
        mains = [e for e in mains if not within[e]] or mains   # rather one that is not, say, in a sidebar
        over, inside = [False] * n, [False] * n
        for e in mains:
            inside[e] = True
            while e and not over[e]:
                over[e], e = True, self.parents[e]
        for e in range(1, n):
            inside[e] = inside[e] or inside[self.parents[e]]
            hinted = said[e][0] or (said[e][1] and not inside[e])
            gone[e] = gone[self.parents[e]] or self.tags[e] in DROPPED or (comments[e] and not spared) or (
                hinted and not over[e] and self.tags[e] not in ("html", "body"))
            if gone[e] and inside[e] and not hinted and self.tags[e] in _HEADINGS and self._only_under("header", e, gone, said):
                gone[e] = False
        self.gone, self.inside, self.mains = gone, inside, [e for e in mains if not inside[self.parents[e]]]
        return self

    def _only_under(self, tag: str, e: int, gone: list[bool], said) -> bool:
        """Whether an element goes for no other reason than standing in an element of this tag."""
        while gone[e := self.parents[e]]:
            if self.tags[e] in DROPPED and self.tags[e] != tag or said[e][0] or said[e][2]:
                return False
        return True

    def text(self, deleted=frozenset()) -> str:
        """The main text without the deleted subtrees."""
        blocks, line = [], []

        def flush():
            if words := "".join(line).split():
                blocks.append(" ".join(words))
            line.clear()

        for root in self.mains or [0]:
            todo = [root]
            while todo:
                x = todo.pop()
                if x is None:
                    flush()
                elif isinstance(x, str):
                    line.append(x)
                elif x < 0:   # an element that goes; headings may stay in it
                    if self.tags[-x] in BLOCK:
                        flush()
                    todo += [i if not self.gone[i] else -i for i in reversed(self.inner[-x]) if not isinstance(i, str)]
                elif x in deleted:
                    if self.tags[x] in BLOCK:
                        flush()
                else:
                    if self.tags[x] in BLOCK or self.tags[x] == "br":
                        flush()
                        todo.append(None)
                    todo += [i if isinstance(i, str) or not self.gone[i] else -i for i in reversed(self.inner[x])]
            flush()
        return " ".join(blocks)

    def subtrees(self) -> dict[int, bytes]:
        """The hashes of the elements with text that may be deleted as templates."""
        n = len(self.tags)
        digests, texts = [b""] * n, [False] * n
        for e in range(n - 1, 0, -1):   # children stand behind their parents
            h = xxhash.xxh64(self.tags[e].encode())
            for x in self.inner[e]:
                if isinstance(x, str):
                    if words := " ".join(x.split()):
                        h.update(b"\x01" + words.encode() + b"\x02")
                        texts[e] = True
                else:
                    h.update(b"\x03" + digests[x])
                    texts[e] = texts[e] or texts[x]
            digests[e] = h.digest()
        return {e: digests[e] for e in range(1, n) if texts[e] and self.tags[e] not in ("html", "body")
                and (not self.inside[e] or self.tags[e] in CONTAINERS)}


def _keys(host: str, page: Page) -> dict[int, int]:
    own = host.encode() + b"\0"
    return {e: xxhash.xxh64_intdigest(own + d) for e, d in page.subtrees().items()}


def _pages(batch: pa.RecordBatch):
    """Host and tree of each row; columns ``host`` and ``html``."""
    for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
        yield host, Page(source or "").prepared()


def _marks(batches):
    """``key, page``: the subtrees of each page, and what it counts as."""
    for b in batches:
        keys, pages = [], []
        for (host, page), source in zip(_pages(b), b.column("html").to_pylist()):
            found = set(_keys(host, page).values())
            counted = xxhash.xxh64_intdigest((page.text() or source or "").encode())
            keys += found
            pages += [counted] * len(found)
        yield pa.RecordBatch.from_arrays([pa.array(np.array(keys, np.uint64).view(np.int64)),
                                          pa.array(np.array(pages, np.uint64).view(np.int64))], names=["key", "page"])


def _file_of(keys: np.ndarray, n: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _store(folder: str, n: int):
    def run(key, table):
        keys = np.sort(table.column("key").to_numpy().view(np.uint64))
        files.put(folder, f"templates-{key[0].as_py()}", keys)
        return pa.table({"file": [key[0].as_py()], "keys": [len(keys)]})
    return run


class Templates:
    """The stored template keys; a few files are mapped at a time."""

    def __init__(self, folder: str, n: int):
        self.folder, self.n, self.mapped = folder, n, OrderedDict()

    def _file(self, i: int) -> np.ndarray:
        if i in self.mapped:
            self.mapped.move_to_end(i)
        else:
            self.mapped[i] = files.mapped(self.folder, f"templates-{i}", np.uint64)
            if len(self.mapped) > MAPPED:
                self.mapped.popitem(last=False)
        return self.mapped[i]

    def among(self, keys: set[int]) -> set[int]:
        """Those of the keys that are templates."""
        if not self.n or not keys:
            return set()
        k = np.sort(np.fromiter(keys, np.uint64, len(keys)))
        of, out = _file_of(k, self.n), []
        starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        for a, b in zip(starts, [*starts[1:], len(k)]):   # the files that these keys fall into
            stored = self._file(int(of[a]))
            at = np.minimum(np.searchsorted(stored, k[a:b]), len(stored) - 1)
            out += k[a:b][stored[at] == k[a:b]].tolist()
        return set(out)


def templates(pages: DataFrame, min_pages: int) -> tuple[str, int]:
    """Count the subtrees of ``host, html`` rows and store the templates: folder, number of files."""
    spark = pages.sparkSession
    marks = pages.mapInArrow(_marks, "key bigint, page bigint").distinct()
    common = materialise(marks.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages).select("key"), "templates")
    folder, total = scratch_path(spark, "template-files"), common.count()
    n = -(-total // FILE_KEYS)
    if n:
        high = F.shiftrightunsigned("key", 32)
        common.groupBy(F.shiftright(high * F.lit(n).cast("bigint"), 32).alias("file")).applyInArrow(
            _store(folder, n), "file bigint, keys bigint").agg(F.sum("keys")).first()
    return folder, n


def _texts(folder: str, n: int):
    def run(batches):
        known = Templates(folder, n)
        for b in batches:
            trees = [(page, _keys(host, page)) for host, page in _pages(b)]
            common = known.among({k for _, keys in trees for k in keys.values()})
            out = [page.text({e for e, k in keys.items() if k in common}) for page, keys in trees]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(out, pa.string())], names=["page_id", "url", "text"])
    return run


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_pages: int = 3) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row."""
    prepare(pages.sparkSession)
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).alias("page_id"), url.alias("url"), host_of(url).alias("host"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    folder, n = templates(rows.select("host", "html"), min_pages)
    kind = dict(rows.dtypes)["page_id"]
    found = rows.mapInArrow(_texts(folder, n), f"page_id {kind}, url string, text string")
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
