"""Main text of HTML pages by nearest-URL page differencing.

A page is cut into text lines, one a block.  Pages stand in order of host and
URL path; each page is compared with its nearest neighbour of the same host
(the longer common path; the following page on ties; the other one if the
nearest is a copy or shares nothing), their lines are aligned by longest
common subsequence, and shared lines are deleted.

Element roles guard it: lines of a page's own ``article`` or ``main`` element go
only if at least half the pages of their host have them in theirs (three at
least), and where no neighbour proves anything that element is the whole main
text; text in menus, headers, footers,
sidebars, notices, adverts, forms, scripts and comments goes even if no
neighbour has it.

Null and empty pages have an empty text; an empty table has an empty result.
Null URLs are one host.  Pages of any length are read whole.  Pages that tie in
host, path and URL stand by id; repeated rows are pages of their own and, as
copies of each other, prove nothing about each other's lines.  Columns beside
id, URL and html are left out, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialize, ranked, small_batches

# Names of HTML elements by their role.
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li "
    "main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("aside audio button canvas dialog fieldset footer form head header menu nav object select video".split())
RAW = "script|style|template|noscript|noembed|noframes|textarea|select|iframe|title|svg|math|xmp"
MAIN = frozenset(("article", "main"))
UNNAMED = frozenset("html body main h1 h2 h3 h4 h5 h6".split())
#: Words of class and id attributes that mark what is no main text.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promoted promotion nav navbar navigation menu menus breadcrumb breadcrumbs header masthead "
    "footer sidebar sidebars aside widget widgets notice notices cookie cookies consent gdpr banner popup modal overlay newsletter subscribe subscription comment comments disqus respond reply replies "
    "share sharing social related recommended form login signup search pagination pager toolbar".split()
)
#: Words that may stand beside them in one class ("comment-list"); any other word makes it another class ("has-sidebar").
PLAIN = frozenset("area bar block box button buttons container inner item items link links list main section site slot unit wrap wrapper".split())
COMMENTS = frozenset(("comment", "comments", "reply", "replies"))
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())

_ATTRS = r"""(?:[^>"'=]++|=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z))?+|["'])*+"""
_TOKEN = re.compile(
    rf"<!--(?:>|->|.*?(?:--!?>|\Z))|<(?P<raw>{RAW})(?=[\s/>]){_ATTRS}(?:>.*?(?:</(?P=raw)(?=[\s/>])[^>]*(?:>|\Z)|\Z)|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*){_ATTRS}(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
_MARKED = re.compile(r"""(?:class|id|role|hidden|aria-hidden)\b""", re.I)
_ATTR = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""")

#: Roles of a line.
GONE, KEPT, OPEN = 0, 1, 2


#: What a start tag says of its element: nothing, a class word that marks it, or that it is no main text in any case.
FREE, NAMED, OUT = 0, 1, 2


def _marked(name: str, tag: str) -> int:
    """Does the start tag say that its element is no main text?"""
    if name in DROPPED:
        return OUT
    if not _MARKED.search(tag):
        return FREE
    says = FREE
    for key, value in _ATTR.findall(tag[1 + len(name) :]):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "role" and value in ROLES:
            return OUT
        if key in ("class", "id") and name not in UNNAMED:
            marks = COMMENTS if name == "article" else MARKS
            for token in value.split():
                found = {w for w in re.split(r"[^a-z]+", token) if w}
                if found & marks and found <= marks | PLAIN:
                    says = NAMED
    return says


def _lifted(parents: list[int], sizes: list[int], around: list[bool], free: int) -> list[bool]:
    """Which class marks don't hold, on a page whose every article is inside one: those around an article that has more text than what is ``free`` of marks, and those around most of the page's text."""
    total = free + sum(sizes)
    whole, holds = list(sizes), list(around)
    for k in range(len(parents) - 1, -1, -1):
        if parents[k] >= 0:
            whole[parents[k]] += whole[k]
            holds[parents[k]] |= holds[k]
    return [2 * n > total or has and n > free for n, has in zip(whole, holds, strict=True)]


def lines(html: str | None) -> list[tuple[str, int]]:
    """The text lines of a page in order, each with its role."""
    out: list[tuple[list, bool, bool, int]] = []  # texts with their inline marks, out in any case, main, mark
    if not html:
        return []
    stack: list[tuple[str, bool | None, bool, int, int]] = []  # name, out, main, mark, inline mark: of the open elements
    count: dict[str, int] = {}
    held: list[tuple[str, int]] = []
    # Class marks: the mark around each, the text in it alone, whether an article is.
    parents: list[int] = []
    sizes: list[int] = []
    around: list[bool] = []
    free, bare = 0, False

    def hold(text: str) -> None:
        nonlocal free
        _, gone, _, mark, inline = stack[-1] if stack else ("", False, False, -1, -1)
        if gone is None:
            return
        held.append((unescape(text), inline))
        if gone is False:
            n, k = len(text.strip()), max(mark, inline)
            if k >= 0:
                sizes[k] += n
            else:
                free += n

    def flush() -> None:
        if held:
            gone, main, mark = stack[-1][1:4] if stack else (False, False, -1)
            out.append((list(held), gone is not False, main, mark))
        held.clear()

    def pop_to(name: str) -> None:
        while stack:
            top = stack.pop()[0]
            count[top] -= 1
            if top == name:
                break

    at = 0
    for m in _TOKEN.finditer(html):
        if m.start() > at:
            hold(html[at : m.start()])
        at = m.end()
        if not m["name"]:
            continue
        name = m["name"].lower()
        block = name in BLOCKS
        if m["close"]:
            if count.get(name):
                if block:
                    flush()
                pop_to(name)
            elif block:
                flush()
            continue
        if block:
            flush()
            if name != "br" and count.get("p"):
                pop_to("p")
        if name in VOID:
            continue
        gone, main, mark, inline = stack[-1][1:] if stack else (False, False, -1, -1)
        hit = _marked(name, m[0])
        if hit == NAMED and gone is False:
            parents.append(max(mark, inline))
            sizes.append(0)
            around.append(False)
            if block and inline < 0:
                mark = len(parents) - 1
            else:
                inline = len(parents) - 1
        elif hit == OUT and not block and gone is False:
            gone = None  # inside a block: its text is skipped, and the block goes on
        elif hit == OUT and gone is False:
            gone = True
        if name in MAIN and gone is False:
            main = True
            if max(mark, inline) >= 0:
                around[max(mark, inline)] |= hit == FREE
            else:
                bare = True
        stack.append((name, gone, main, mark, inline))
        count[name] = count.get(name, 0) + 1
    if at < len(html):
        hold(html[at:])
    flush()
    lifted = [False] * len(parents) if bare else _lifted(parents, sizes, around, free)
    holds: list[bool] = []
    for k, p in enumerate(parents):
        holds.append(not lifted[k] or p >= 0 and holds[p])
    found: list[tuple[str, int]] = []
    for texts, gone, main, mark in out:
        gone = gone or mark >= 0 and holds[mark]
        if text := " ".join("".join(t for t, k in texts if gone or k < 0 or not holds[k]).split()):
            found.append((text, GONE if gone else KEPT if main else OPEN))
    return found


def _rows(a: list, b: list, keep: bool) -> list[int]:
    """Bit-parallel longest common subsequence: a row of bits for each element of a (or the last only); a zero bit is a step in b."""
    where: dict = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    v, out = full, []
    for x in a:
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
        if keep:
            out.append(v)
    return out if keep else [v]


def _steps(bits: int, n: int) -> np.ndarray:
    """Common length with each prefix of b."""
    raw = np.frombuffer(bits.to_bytes((n + 7) // 8, "little"), dtype=np.uint8)
    return np.concatenate([[0], np.cumsum(1 - np.unpackbits(raw, count=n, bitorder="little").astype(np.int64))])


def shared(a: list, b: list, most: int = 1 << 28) -> list[int]:
    """Positions of ``a`` in a longest common subsequence with ``b``; long pairs are halved so that memory stays bounded."""
    first, last = 0, 0
    while first < min(len(a), len(b)) and a[first] == b[first]:
        first += 1
    while last < min(len(a), len(b)) - first and a[-1 - last] == b[-1 - last]:
        last += 1
    x, y = a[first : len(a) - last], b[first : len(b) - last]
    inner: list[int] = []
    if x and y and len(x) > 1 and len(x) * len(y) > most:
        half = len(x) // 2
        up, down = _steps(_rows(x[:half], y, False)[0], len(y)), _steps(_rows(x[half:][::-1], y[::-1], False)[0], len(y))
        cut = int(np.argmax(up + down[::-1]))
        inner = shared(x[:half], y[:cut], most) + [half + i for i in shared(x[half:], y[cut:], most)]
    elif x and y:
        rows, i, j = _rows(x, y, True), len(x), len(y)
        while i and j:
            if rows[i - 1] >> (j - 1) & 1:
                j -= 1
            else:
                i -= 1
                if not (i and not rows[i - 1] >> (j - 1) & 1):
                    inner.append(i)
                    j -= 1
        inner.reverse()
    return [*range(first), *(first + i for i in inner), *range(len(a) - last, len(a))]


def _hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


PARSED = "page_id long, url string, host string, path string, lines array<string>, own array<boolean>, around array<long>, at array<int>"
_URL = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)([^?#]*)")


def parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pages to ``PARSED``: the lines that may be main text, whether each is of an article, the hashes of all lines, and where among them those lines are."""
    for batch in batches:
        rows, held = [], 0
        for page, url, html in zip(batch["page_id"], batch["url"], batch["html"], strict=True):
            found = lines(html)
            m = _URL.match(url or "")
            host, path = (m[1].lower().rpartition("@")[2], m[2] or "/") if m else ("", url or "")
            at = [i for i, (_, role) in enumerate(found) if role != GONE]
            rows.append((page, url, host, path, [found[i][0] for i in at], [found[i][1] == KEPT for i in at], [_hash(t) for t, _ in found], at))
            held += len(html or "")
            if held > 8_000_000:
                yield _frame(rows)
                rows, held = [], 0
        yield _frame(rows)


def _frame(rows: list) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["page_id", "url", "host", "path", "lines", "own", "around", "at"])
    out["page_id"] = out["page_id"].astype("Int64")
    return out


def _common(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def kept(path: pd.Series, around: pd.Series, at: pd.Series, own: pd.Series, common: pd.Series, before: pd.Series, before_path: pd.Series, after: pd.Series, after_path: pd.Series) -> pd.DataFrame:
    """``DECIDED``: which lines of ``at`` stay, where not those that roles alone give; how many lines of the page its neighbour shares, as far as that proves anything, and how many stay.  A neighbour that shares nine tenths of a page's lines or more is a copy and proves as little as one that shares none; then the other neighbour decides."""
    out = []
    for p, mine, places, article, often, b, bp, a, ap in zip(path, around, at, own, common, before, before_path, after, after_path, strict=True):
        mine, often = list(mine), set() if often is None else set(often)
        near = sorted(((-_common(p, q), k, list(x)) for k, (x, q) in enumerate(((a, ap), (b, bp))) if x is not None), key=lambda t: t[:2])
        gone: list[int] = []
        proof = False
        for _, _, other in near:
            gone = shared(mine, other)
            proof = 0 < len(gone) < 0.9 * len(mine)
            if proof:
                break
        same = set(gone if len(gone) < len(mine) else [])
        if any(article):
            roles = [i for i, x in zip(places, article, strict=True) if x]
            stay = [i for i, x in zip(places, article, strict=True) if i not in same or x and mine[i] not in often] if proof else roles
            stay = stay if any(x and i in stay for i, x in zip(places, article, strict=True)) else roles
        else:
            roles = list(places)
            stay = [i for i in places if i not in same]
        out.append((None if stay == roles else stay, len(mine), len(same) if proof else 0, len(stay), len(set(range(len(mine))) - set(stay) - (same if proof else set()))))
    return pd.DataFrame(out, columns=["stay", "n_lines", "n_shared", "n_kept", "n_by_role"])


DECIDED = "stay array<int>, n_lines int, n_shared int, n_kept int, n_by_role int"


def decided(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """What the comparison did to every page: ``page_id`` and the numbers of its lines, of those its neighbour shares, of those kept, and of those that only their role deletes."""
    held, by_page = _compared(pages, page, url, html)
    return held.select("_id", "page_id").join(by_page.drop("stay"), "_id").drop("_id")


def main_text(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, text`` of every row of ``pages``.

    Pages are parsed once, and each takes part in the join with its neighbours,
    which moves hashes of lines, never pages.  Texts move only if the list of
    pages that differencing changes is too long to broadcast.  A host of any
    size is cut into ranges of its paths.
    """
    held, by_page = _compared(pages, page, url, html)
    roles = F.when(F.exists("own", lambda x: x), F.col("own")).otherwise(F.transform("own", lambda _: F.lit(True)))
    left = F.filter(F.arrays_zip("lines", "at", roles.alias("role")), lambda x: F.coalesce(F.array_contains(F.col("stay"), x["at"]), x["role"]))
    # Written, so that its own size decides whether it is broadcast.
    changed = materialize(by_page.where("stay IS NOT NULL").select("_id", "stay"), "changed")
    return held.join(changed, "_id", "left").select("page_id", "url", F.array_join(F.transform(left, lambda x: x["lines"]), "\n").alias("text"))


def _compared(pages: DataFrame, page: str, url: str, html: str) -> tuple[DataFrame, DataFrame]:
    """The parsed pages, and ``_id`` with ``DECIDED`` of each, both written."""
    small_batches(pages.sparkSession)
    raw = pages.select(pages[page].cast("long").alias("page_id"), pages[url].alias("url"), pages[html].alias("html")).mapInPandas(parsed, PARSED)
    held = materialize(raw.withColumn("_id", F.monotonically_increasing_id()), "pages")
    order, _ = ranked(held.select("_id", "host", "path", "url", "page_id", "around", "at", "own"), ["host", "path", "url", "page_id"], "_rank")
    mine = F.array_distinct(F.transform(F.filter(F.arrays_zip("at", "own"), lambda x: x["own"]), lambda x: F.get("around", x["at"])))
    often = order.select("host", F.explode(mine).alias("h")).groupBy("host", "h").agg(F.count("*").alias("n")).where("n >= 3")
    sizes = order.groupBy("host").agg(F.count("*").alias("pages"))
    common = materialize(often.join(sizes, "host").where("2 * n >= pages").groupBy("host").agg(F.collect_list("h").alias("common")), "common")
    step = lambda by: order.select((F.col("_rank") + by).alias("_rank"), F.col("host").alias(f"h{by + 1}"), F.col("path").alias(f"p{by + 1}"), F.col("around").alias(f"x{by + 1}"))
    side = lambda k, c: F.when(F.col(f"h{k}") == F.col("host"), F.col(f"{c}{k}"))
    near = order.join(step(1), "_rank", "left").join(step(-1), "_rank", "left").join(common, "host", "left")
    verdict = F.pandas_udf(kept, DECIDED).asNondeterministic()("path", "around", "at", "own", "common", side(2, "x"), F.coalesce(side(2, "p"), F.lit("")), side(0, "x"), F.coalesce(side(0, "p"), F.lit("")))
    # Not deterministic: a selection pushed below would run it twice.
    return held, materialize(near.select("_id", verdict.alias("v")).select("_id", "v.*"), "decided")
