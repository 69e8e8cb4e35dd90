"""Main text of web pages: the article by structure, and what a host repeats by a suffix array of its pages.

Pages become blocks of text. Blocks of an explicit article are its text. Of the other blocks, those of menus,
notices and the like go by their markup; from the rest goes every run of words that a share of the host's pages have. To find these
runs the token streams of a host's pages are laid end to end and their suffixes sorted; suffixes that agree in
``RUN`` tokens are neighbours. Hosts of many pages are dealt over several arrays, whose classes meet by key.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathweave.llm.scratch import written

#: Tokens that a repeated run has at least.
RUN = 8
#: A run is boilerplate on so many pages of different content, and on this share of the host's pages: a text that a host serves at
#: two addresses is none.
LEAST_PAGES = 3
SHARE = 0.25
#: Pages in one suffix array, about.
PAGES = 2000

# HTML elements by what they do to text.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template iframe svg math object canvas audio video title textarea select".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody tfoot thead tr ul".split()
)
_SPACE = frozenset("br td th option img".split())
_OUT = frozenset("nav footer aside form menu dialog button head search".split())
# Words in class, id or role that mark what isn't the article.
_MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup "
    "modal overlay newsletter subscribe subscription paywall sidebar side aside nav navbar navigation menu menubar breadcrumb breadcrumbs footer header masthead "
    "comment comments commentlist respond replies disqus share sharing social related recommended widget pagination pager skip search "
    "login signup signin contentinfo complementary dialog hidden".split()
)
# Words that may stand beside a mark in a hyphenated token without changing what it says.
_BESIDE = frozenset("main site primary secondary top bottom left right global bar box buttons links".split())
# Kinds of drop under which an explicit article still stands.
_RESCUED = ("lent", "teaser")
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())

_PIECE = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*+(?:>|$)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(?=/?[a-zA-Z]).*", re.DOTALL
)
_NAMES = re.compile(r"\b(class|id|role|itemprop|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)"

Block = tuple[str, str]  # "article", "out" or "plain", and the text


def _is_mark(token: str) -> bool:
    """Whether a token is a mark, or made of marks and words beside them; "article-header" and "no-sidebar" are not."""
    parts = set(re.split(r"[^a-z0-9]+", token)) - {""}
    return not parts.isdisjoint(_MARKS) and parts <= _MARKS | _BESIDE


def _marks(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether an element's attributes mark it as no article text, and whether they mark it as the article."""
    out = main = False
    for name, a, b, c in _NAMES.findall(attributes) if attributes.strip() else ():
        value = (a or b or c).lower()
        if name.lower() in ("hidden", "aria-hidden"):
            out |= name.lower() == "hidden" or value == "true"
        else:
            words = set(value.split())
            main |= (name.lower() == "role" and "main" in words) or value in ("articlebody", "article", "article-body", "post-content", "entry-content")
            out |= any(_is_mark(w) for w in words) and tag not in ("html", "body", "article", "main")
    return out and not main, main


def blocks(page: str) -> list[Block]:
    """Blocks of a page in order; tags that are never closed, and a page cut off anywhere, do no harm.

    An article inside a dropped element counts if the page has no other. A page without an article gives what no
    element drops; what a form wraps if that has more words; and if nothing is left, what marked elements hold.
    """
    out: list[Block] = []
    text: list[str] = []
    stack: list[tuple[str, str, bool, bool]] = []  # tag, kind of what drops it, article, in an article's header
    state = ("", False, False)

    def flush() -> None:
        words = " ".join("".join(text).split())
        text.clear()
        if words:
            drop, article, head = state
            aside = head and stack[-1][0] not in _HEADINGS and not any(s[0] in _HEADINGS for s in stack)
            out.append(("out" if aside or drop and article and drop not in _RESCUED else drop or ("article" if article else "plain"), words))

    at, raw = 0, ""
    while at < len(page):
        if raw:  # inside an element whose content is no markup
            close = re.compile(rf"</{raw}(?=[\s/>])", re.IGNORECASE).search(page, at)
            at, raw = (close.start() if close else len(page)), ""
            continue
        piece = _PIECE.search(page, at)
        if not piece:
            text.append(html.unescape(page[at:]))
            break
        if piece.start() > at:
            text.append(html.unescape(page[at:piece.start()]))
        at = piece.end()
        if not piece[2]:
            continue
        tag = piece[2].lower()
        if tag in _SPACE:
            text.append(" ")
        if tag in _BLOCK:
            flush()
        if piece[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
        elif tag not in _VOID and not (piece[3].endswith("/") and tag in ("svg", "math")):
            if tag in _BLOCK:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in ("p", *(("li",) if tag == "li" else ())):
                        del stack[i:]
                        break
                    if stack[i][0] in _BLOCK:
                        break
            drop, article, head = stack[-1][1:] if stack else ("", False, False)
            marked, main = _marks(tag, piece[3])
            own_head = tag == "header" and article
            explicit = tag in ("article", "main") or main
            if drop and explicit and not article:
                drop = "lent" if drop in ("form", "marked") else "teaser"
            elif tag != "form" and tag in _OUT or tag == "header" and not article or "hidden" in piece[3].lower() and marked:
                drop = "out"
            elif drop in ("", "form", *_RESCUED) and marked and not own_head:
                drop = "out" if article else "marked"
            elif tag == "form" and drop != "marked":
                drop = "out" if article else drop or "form"
            stack.append((tag, drop, article or explicit, head or own_head))
            if tag in _RAW:
                raw = tag
        state = stack[-1][1:] if stack else ("", False, False)
    flush()
    return _decided(out)


def _decided(out: list[Block]) -> list[Block]:
    """Blocks as article, plain or out, once all of the page is known."""
    sizes = {kind: sum(len(words.split(" ")) for k, words in out if k == kind) for kind in ("article", "lent", "plain", "form", "teaser", "marked")}
    chosen = next((k for k in ("article", "lent") if sizes[k]), None)
    if chosen is None:
        chosen = "form" if sizes["form"] > sizes["plain"] else next((k for k in ("plain", "teaser", "marked") if sizes[k]), "")
    as_kind = "article" if chosen in ("article", "lent", "teaser") else "plain"
    return [(as_kind if kind == chosen else "out", words) for kind, words in out]


def stream(found: list[Block]) -> list[str]:
    """Tokens of a page outside its article."""
    return [w for kind, words in found if kind != "article" for w in words.split(" ")]


def suffix_classes(streams: list[list[str]], run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of the streams laid end to end, and the class of each suffix: equal classes agree in ``run`` tokens.

    Suffixes are sorted by doubling until ``run`` tokens count; those that a stream's end cuts short are left out.
    """
    codes: dict[str, int] = {}
    flat = [codes.setdefault(w, len(codes)) for s in streams for w in s]
    sizes = np.array([len(s) for s in streams], dtype=np.int64)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(flat))  # tokens up to the end of the stream
    rank, span = np.array(flat, dtype=np.int64), 1
    while span < run:
        step = min(span, run - span)
        after = np.full(len(rank), -1)
        after[:len(rank) - step] = rank[step:]
        after[left <= step] = -1
        rank = np.unique(np.stack([rank, after]), axis=1, return_inverse=True)[1].reshape(-1)
        span += step
    order = np.argsort(rank, kind="stable")
    order = order[left[order] >= run]
    return order, rank[order]


def _classes(run: int):
    """For the pages of one array: ``host, key, page, content, starts``, a row for each class and page."""

    def of(table: pa.Table) -> pa.Table:
        hosts, pages = table.column("host").to_pylist(), table.column("page").to_pylist()
        streams = [x or [] for x in table.column("tokens").to_pylist()]
        contents = [xxhash.xxh3_64_intdigest("\x1f".join(x).encode("utf-8", "surrogatepass")) - 2**63 for x in streams]
        order, classes = suffix_classes(streams, run)
        bounds = np.cumsum([len(s) for s in streams])
        page = np.searchsorted(bounds, order, side="right")
        starts = order - (bounds - [len(s) for s in streams])[page] if len(order) else order
        rows: dict[tuple[int, int], list[int]] = {}
        for c, p, s in zip(classes.tolist(), page.tolist(), starts.tolist(), strict=True):
            rows.setdefault((c, p), []).append(s)
        keys = {}
        for (c, p), at in rows.items():
            if c not in keys:
                keys[c] = xxhash.xxh3_128_digest("\x1f".join(streams[p][at[0]:at[0] + run]).encode("utf-8", "surrogatepass"))
        return pa.table([
            pa.array([hosts[p] for _, p in rows], pa.string()), pa.array([keys[c] for c, _ in rows], pa.binary()),
            pa.array([pages[p] for _, p in rows], pa.int64()), pa.array([contents[p] for _, p in rows], pa.int64()),
            pa.array(list(rows.values()), pa.list_(pa.int32())),
        ], ["host", "key", "page", "content", "starts"])

    return of


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [stream(blocks(x)) for x in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("page"), pa.array(found, pa.list_(pa.string()))], ["host", "page", "tokens"])


def main_text(page: str, repeated: list[int], run: int = RUN) -> str:
    """The article's blocks, and of plain blocks the runs that no repeated run covers."""
    found, at, out = blocks(page), 0, []
    total = sum(len(words.split(" ")) for kind, words in found if kind != "article")
    covered = np.zeros(total, dtype=bool)
    for start in repeated:
        covered[start:start + run] = True
    for kind, words in found:
        if kind == "article":
            out.append(words)
            continue
        tokens = words.split(" ")
        if kind == "plain":
            kept = [w for w, c in zip(tokens, covered[at:at + len(tokens)].tolist(), strict=True) if not c]
            if kept:
                out.append(" ".join(kept))
        at += len(tokens)
    return "\n".join(out)


def _is_open(page: str) -> bool:
    """Whether markup alone doesn't settle the page's text."""
    return any(kind == "plain" for kind, _ in blocks(page))


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of the pages that markup settles."""
    for batch in batches:
        found = [blocks(x) for x in batch.column("html").to_pylist()]
        at = pa.array([i for i, f in enumerate(found) if all(kind != "plain" for kind, _ in f)], pa.int64())
        made = ["\n".join(words for kind, words in found[i] if kind == "article") for i in at.to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id").take(at), batch.column("url").take(at), pa.array(made, pa.string()), pa.array([len(t) for t in made], pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def _open_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pa.array([_is_open(x) for x in batch.column("html").to_pylist()], pa.bool_()))


def _texts(run: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("html").to_pylist(), batch.column("starts").to_pylist(), strict=True)
            made = [main_text(page, [s for part in starts or () for s in part], run) for page, starts in pairs]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(made, pa.string()), pa.array([len(t) for t in made], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return of


def extract(
    pages: DataFrame, run: int = RUN, pages_each: int = PAGES, least_pages: int = LEAST_PAGES, share: float = SHARE
) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``.

    Character references are decoded; white space in a block, line breaks included, is one space; blocks are joined by a line feed. A page with
    an explicit article (``article``, ``main`` or marked as such) gives all of the article's text without what its
    markup sets apart; other pages give their plain blocks without the runs of ``run`` words that stand on ``least_pages`` pages of the host
    or more, and on ``share`` of them. Pages of equal content count as one, so that copies don't take each other's text.

    A null or empty html gives an empty text; a null address is a host of its own; a null id stays null. Other columns are
    ignored; an empty table gives no rows.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("page", F.xxhash64("page_id", "url", "html"))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), _HOST, 1)).alias("host")
    tokens = rows.select(host, "page", "html").mapInArrow(_tokens, "host string, page long, tokens array<string>").filter(F.size("tokens") >= run)
    many = rows.select(host).groupBy("host").agg(F.ceil(F.count("*") / F.lit(pages_each)).cast("int").alias("arrays"))
    dealt = tokens.join(many, "host").withColumn("array", F.pmod("page", "arrays")).drop("arrays")
    dealt = dealt.repartition("host", "array")  # or the join would leave all arrays of a host in one task
    schema = "host string, key binary, page long, content long, starts array<int>"
    classes = written(dealt.groupBy("host", "array").applyInArrow(_classes(run), schema), "runs")
    contents = classes.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("of"))
    held = classes.select("host", "key", "content").distinct().groupBy("host", "key").agg(F.count("*").alias("n")).filter(F.col("n") >= least_pages)
    several = held.join(contents, "host").filter(F.col("n") >= share * F.col("of")).select("host", "key")
    starts = classes.join(several, ["host", "key"]).groupBy("page").agg(F.collect_list("starts").alias("starts"))
    kind = dict(pages.dtypes)["page_id"]
    result = f"page_id {kind}, url string, text string, n_chars long"
    settled = rows.select("page_id", "url", "html").mapInArrow(_settled, result)
    left = rows.mapInArrow(_open_pages, f"page_id {kind}, url string, html string, page long")  # only these pages are shuffled
    joined = left.join(starts.hint("shuffle_hash"), "page", "left").select("page_id", "url", "html", "starts")
    return settled.unionByName(joined.mapInArrow(_texts(run), result))
