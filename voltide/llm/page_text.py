"""Main text of HTML pages, with a suffix array over each host's pages.

Markup decides first: blocks of an ``article`` (else of ``main``, else of the page) may be
the text, and elements that are menus, footers, adverts, forms and the like never are. Then
repetition decides, on all pages: the words of the host's pages are concatenated, their
suffix array is sorted far enough to tell runs of ``RUN`` words apart, and blocks that are
mostly covered by runs found on several different pages go; unique runs stay. A marked
article is sooner believed: its blocks go by runs of ``MARKED_PAGES`` pages or more. Copies of an
article are still articles: pages that mark the same article count as one page, and an
article that would lose ``COPY`` of its words is a copy of others and stays whole.

A host's different pages are spread over tasks by their words. A task makes suffix arrays of
at most ``SHARD`` pages and sends each run with its number of pages; the sums over the host
tell which runs are frequent, so neither shards nor partitions nor batches show in the result.
Most runs stand on one page only. An array of ``LARGE`` pages or more does not send these: what
it leaves out is one page at most, so only runs that are short of the bar by fewer pages than
there are such arrays may still reach it, and they are counted again with nothing left out.
A frequent run stands on a tenth of the host's pages, so a host has at most ten times as many
of them as a page has words; groups of a host's pages meet that list.

Cases: null HTML counts as empty and gives an empty text. A null URL has an empty
host. Repeated rows get equal results and count as one page when repetition is
sought. Null ids are kept. Other columns are ignored. An empty table gives an empty
table.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltide.llm.common import as_text, freed_shuffles, materialize, shuffle_parts, with_type
from voltide.llm.url_filter import host

#: Pages of a host that share a suffix array; runs are counted over all arrays of the host.
SHARD = 256
#: Words of the shortest run that counts as repeated.
RUN = 8
#: A run is boilerplate on at least so many pages and this share of the host's.
PAGES, PAGE_SHARE = 2, 0.1
#: Inside a marked article, on at least so many.
MARKED_PAGES = 3
#: Share of a block's words that must be covered for it to go.
COVERED = 0.5
#: An article that would lose this share of its words is a copy.
COPY = 0.9
#: Pages of an array that leaves out runs of one page; over 1 / PAGE_SHARE, so runs of which
#: nothing is sent are below the bar.
LARGE = 20
#: Stands between a marked article and the rest; no run reaches over it.
EDGE = "\0"

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)>"
    r"|<[!?/][^>]*>|<[a-zA-Z!?/][^>]*\Z",
    re.S,
)
_NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z0-9]+")

#: Elements whose content is text without markup.
RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
#: Elements without an end.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that start a new block.
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu"
    " nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that are never main text.
NEVER = set(
    "aside audio button canvas dialog footer form head iframe input map menu nav noembed noframes"
    " noscript object option script select style svg template textarea title video xmp".split()
)
#: Words in a class, id or role of what is never main text.
NEVER_NAMED = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments"
    " consent cookie cookies disqus footer menu modal nav navbar navigation newsletter notice notices"
    " pagination popup promo promotion related share sharing sidebar social sponsor sponsored"
    " subscribe".split()
)
#: Those that count outside articles only.
OUTSIDE_NAMED = {"header", "masthead"}
#: Elements whose class says nothing of their content.
WHOLE = {"html", "body", "article", "main", "h1", "h2", "h3", "h4", "h5", "h6"}


@dataclass
class Block:
    text: str
    place: str  # "article", "main", "body" or "never"


def _names(rest: str) -> set[str]:
    found: set[str] = set()
    if "=" in rest:
        for m in _NAMED.finditer(rest):
            found.update(_WORD.findall((m[1] or m[2] or m[3] or "").lower()))
    return found


def blocks_of(page: str) -> list[Block]:
    """Blocks of a page in their order; white space within them is one space."""
    out: list[Block] = []
    held: list[str] = []
    open_tags: list[tuple[str, str]] = []  # name, what it makes of its content
    at, never, article, main = 0, 0, 0, 0

    def flush() -> None:
        if held:
            text = " ".join("".join(held).split())
            held.clear()
            if text:
                place = "never" if never else "article" if article else "main" if main else "body"
                out.append(Block(text, place))

    def count(kind: str, step: int) -> None:
        nonlocal never, article, main
        never += step * (kind == "never")
        article += step * (kind == "article")
        main += step * (kind == "main")

    end = len(page)
    while at < end:
        m = _TAG.search(page, at)
        text = page[at : m.start() if m else end]
        if text:
            held.append(entities.unescape(text) if "&" in text else text)
        if not m:
            break
        at = m.end()
        name = m["name"] or m["name2"]
        if not name:
            continue
        name = name.lower()
        if name in BLOCK:
            flush()
        elif name == "br":
            held.append(" ")
        if m["end"] or m["end2"]:
            for i in range(len(open_tags) - 1, -1, -1):
                if open_tags[i][0] == name:
                    for _, kind in open_tags[i:]:
                        count(kind, -1)
                    del open_tags[i:]
                    break
            continue
        rest = m["rest"] if m["name"] else m["rest2"]
        if name in RAW:
            close = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*>?", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if name in VOID or rest.endswith("/") and name in ("svg",):
            continue
        if name == "p" or name in ("li", "dt", "dd", "option"):
            # an open one of the same kind ends here
            if open_tags and open_tags[-1][0] == name:
                count(open_tags.pop()[1], -1)
        kind = ""
        if name in NEVER or name == "header" and not article:
            kind = "never"
        elif name not in WHOLE or name == "article":
            named = _names(rest)
            if named & NEVER_NAMED or (named & OUTSIDE_NAMED and not article):
                kind = "never"
        if not kind and name in ("article", "main"):
            kind = name
        open_tags.append((name, kind))
        count(kind, 1)
    flush()
    return out


def suffix_ranks(tokens: np.ndarray, run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of ``tokens``, sorted by the first ``run`` tokens or more, and the
    rank of each suffix; suffixes that agree that far share a rank."""
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    order, seen = np.argsort(rank, kind="stable"), 1
    while seen < run:
        step = min(seen, run - seen)
        after = np.full(len(rank), -1, np.int64)
        after[: len(rank) - step] = rank[step:]
        key = rank * (len(rank) + 1) + after + 1
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank[order] = np.cumsum(np.r_[0, ordered[1:] != ordered[:-1]])
        seen += step
    return order, rank


@dataclass
class Page:
    marked: bool  # whether markup names an article or main part
    stream: list[str]  # all blocks, with an edge between marked and other ones
    own: list[int]  # blocks of the stream that may be main text


def page_of(html: str) -> Page:
    found = blocks_of(html)
    kind = next((kind for kind in ("article", "main") if any(b.place == kind for b in found)), "body")
    if kind == "body":
        return Page(False, [b.text for b in found], [i for i, b in enumerate(found) if b.place == "body"])
    stream: list[str] = []
    own: list[int] = []
    inside = None
    for b in found:
        mine = b.place == kind or kind == "main" and b.place == "article"
        if inside is not None and mine != inside:
            stream.append(EDGE)
        if mine:
            own.append(len(stream))
        stream.append(b.text)
        inside = mine
    return Page(True, stream, own)


def _code(texts: Sequence[str]) -> int:
    data = "\x1e".join(texts).encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def codes_of(page: Page) -> tuple[int, int]:
    """What tells different pages of a host apart (the article, if one is marked), and the whole page."""
    whole = _code(page.stream)
    return (_code([EDGE, *(page.stream[i] for i in page.own)]) if page.marked else whole), whole


def _run_hashes(words: list[str], run: int) -> np.ndarray:
    """A hash of the run that starts at each word, the same on all machines."""
    if len(words) < run:
        return np.zeros(0, np.int64)
    codes, different = pd.factorize(np.array(words, object))
    hashes = pd.util.hash_array(np.array(different, object), categorize=False)[codes]
    total = np.zeros(len(words) - run + 1, np.uint64)
    for i in range(run):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + len(total)]
    return total.view(np.int64)


def _words(stream: Sequence[str]) -> list[str]:
    return [w for text in stream for w in text.split(" ")]


def run_counts(streams: Sequence[Sequence[str]], run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the different runs of some pages, and on how many of the pages each stands."""
    words: list[str] = []
    page: list[int] = []
    for no, stream in enumerate(streams):
        own = _words(stream)
        words += [*own, f"\0{no}"]  # no run reaches over the end of a page
        page += [no] * (len(own) + 1)
    hashes = _run_hashes(words, run)
    if not len(hashes):
        return hashes, np.zeros(0, np.int64)
    order, rank = suffix_ranks(pd.factorize(np.array(words, object))[0], run)
    ends = np.r_[0, np.cumsum([w[:1] == "\0" for w in words])]
    order = order[order < len(hashes)]
    order = order[ends[order + run] == ends[order]]
    numbers = rank[order]
    first = np.flatnonzero(np.r_[True, numbers[1:] != numbers[:-1]]) if len(order) else order
    pairs = np.unique(numbers * len(streams) + np.array(page)[order]) // len(streams)
    return hashes[order[first]], np.bincount(pairs, minlength=len(rank))[numbers[first]]


def unrepeated(page: Page, frequent: np.ndarray, run: int = RUN) -> str:
    """The main text of a page without blocks that frequent runs mostly cover."""
    stream, words = page.stream, _words(page.stream)
    starts = np.isin(_run_hashes(words, run), frequent)
    edge = np.zeros(len(words) + run + 1, np.int64)
    edge[: len(starts)] += starts
    edge[run : run + len(starts)] -= starts
    total = np.r_[0, np.cumsum(np.cumsum(edge)[: len(words)] > 0)]
    bounds = np.r_[0, np.cumsum([text.count(" ") + 1 for text in stream])].astype(int)
    size = bounds[1:] - bounds[:-1]
    kept = [i for i in page.own if total[bounds[i + 1]] - total[bounds[i]] < COVERED * size[i]]
    if page.marked and size[kept].sum() <= (1 - COPY) * size[page.own].sum():
        kept = page.own
    return "\n\n".join(stream[i] for i in kept)


def texts_of(pages: list[str]) -> list[str]:
    """Main texts of the pages of one host."""
    parsed = [page_of(p) for p in pages]
    different: dict[int, tuple[int, list[str]]] = {}
    for p in parsed:
        key, whole = codes_of(p)
        different[key] = min(different.get(key, (whole, p.stream)), (whole, p.stream))
    hashes, n = run_counts([stream for _, stream in different.values()])
    hashes, n = hashes[some := n >= least_pages(len(different))], n[some]
    return [unrepeated(p, hashes[n >= MARKED_PAGES] if p.marked else hashes) for p in parsed]


def least_pages(pages: int) -> int:
    return max(PAGES, int(np.ceil(PAGE_SHARE * pages)))


def _rows_of_runs(name: str, streams: list, size: int, alone: bool, large: int) -> pd.DataFrame:
    """A row for each run of a suffix array that may matter, and one without a run.

    ``alone``: the array has all pages of the host, so what is not frequent in it never is.
    """
    hashes, n = run_counts(streams)
    some = n >= (least_pages(size) if alone else 2 if size >= large else 1)
    hashes, n = hashes[some], n[some]
    return pd.DataFrame({
        "host": np.full(len(n) + 1, name, object), "run": pd.array([*hashes.tolist(), None], "Int64"),
        "n": [*n.tolist(), size], "arrays": np.full(len(n) + 1, int(size >= large and not alone)),
    })


def _counts(rows: DataFrame, large_hosts: DataFrame, shard: int, large: int) -> DataFrame:
    """``host, run, n, arrays``: how many pages runs stand on, and how many large arrays say so."""

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            pages = [page_of(p) for p in frame["html"]]
            codes = [codes_of(p) for p in pages]
            yield pd.DataFrame({
                "host": frame["host"].to_numpy(object), "key": [c[0] for c in codes], "whole": [c[1] for c in codes],
                "stream": [p.stream for p in pages],
            }).drop_duplicates(["host", "key", "whole"])

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, key, held, arrays = None, None, [], 0

        def ended(last: bool) -> pd.DataFrame:
            alone = last and not arrays and at[1] == 1
            return _rows_of_runs(at[0], held, len(held), alone, large)

        for frame in frames:
            columns = (frame[c] for c in ("host", "groups", "group", "key", "stream"))
            for name, groups, group, code, stream in zip(*columns):
                if at != (name, groups, group):
                    if held:
                        yield ended(True)
                    at, key, held, arrays = (name, groups, group), None, [], 0
                if code == key:
                    continue  # the same article on another page
                if len(held) == shard:
                    yield ended(False)
                    held, arrays = [], arrays + 1
                key = code
                held.append(stream)
        if held:
            yield ended(True)

    pages = rows.select("host", "html").mapInPandas(parse, "host string, key long, whole long, stream array<string>")
    dealt = (
        pages.join(large_hosts, "host", "left").withColumn("groups", F.coalesce("groups", F.lit(1)))
        .withColumn("group", F.pmod("key", "groups"))
        .repartition(shuffle_parts(rows.sparkSession), "host", "group")
        .sortWithinPartitions("host", "group", "key", "whole")
    )
    found = dealt.mapInPandas(count, "host string, run long, n long, arrays long")
    with freed_shuffles(rows.sparkSession):
        return materialize(found, "runs").groupBy("host", "run").agg(F.sum("n").alias("n"), F.sum("arrays").alias("arrays"))


def _frequent_runs(rows: DataFrame, large_hosts: DataFrame, shard: int) -> DataFrame:
    """``host, run, n`` of the runs on enough of the host's different pages; ``n`` is those known of,
    all of them on hosts where the bar is below ``MARKED_PAGES``."""
    counts = _counts(rows, large_hosts, shard, LARGE)
    pages = counts.where("run IS NULL").select("host", F.col("n").alias("pages"), F.col("arrays").alias("all_arrays"))
    least = F.greatest(F.lit(PAGES), F.ceil(F.lit(PAGE_SHARE) * F.col("pages")))
    likely = materialize(
        counts.where("run IS NOT NULL").join(pages, "host").withColumn("least", least)
        .where("n + all_arrays - arrays >= least").select("host", "run", "n", "least", F.expr("n >= least").alias("sure")),
        "likely-runs",
    )
    sure, open_runs = likely.where("sure").select("host", "run", "n"), likely.where("NOT sure").select("host", "run", "least")
    if open_runs.isEmpty():
        return sure
    again = rows.join(open_runs.select("host").distinct(), "host", "left_semi")
    exact = _counts(again, large_hosts, shard, sys.maxsize).select("host", "run", "n")
    return sure.unionByName(exact.join(open_runs, ["host", "run"]).where("n >= least").select("host", "run", "n"))


def extract_text(pages: DataFrame, shard: int = SHARD) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    spark = pages.sparkSession
    id_type = pages.schema["page_id"].dataType.simpleString()
    rows = pages.select(
        as_text("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"), host().alias("host")
    )
    large_hosts = materialize(
        rows.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / shard).alias("groups")).where("groups > 1"), "large-hosts"
    )
    frequent = materialize(_frequent_runs(rows, large_hosts, shard), "frequent-runs")
    spread = rows.join(large_hosts, "host", "left").withColumn(
        "group", F.coalesce(F.pmod(F.monotonically_increasing_id(), F.col("groups")), F.lit(0))
    ).drop("groups")
    # each group gets the list
    lists = (
        frequent.groupBy("host").agg(
            F.collect_list("run").alias("runs"), F.collect_list(F.expr(f"if(n >= {MARKED_PAGES}, run, null)")).alias("marked")
        )
        .join(large_hosts, "host", "left")
        .select("host", "runs", "marked", F.explode(F.expr("sequence(0, coalesce(groups, 1) - 1)")).alias("group"))
    )

    def decide(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        none = np.zeros(0, np.int64)
        at, runs = None, (none, none)  # for pages without and with a marked article
        for frame in frames:
            out: list[tuple] = []
            columns = (frame[c] for c in ("host", "group", "runs", "marked", "page_id", "url", "html"))
            for name, group, listed, marked, page_id, url, html in zip(*columns):
                if listed is not None:
                    at, runs = (name, group), (np.asarray(listed, np.int64), np.asarray(marked, np.int64))
                    continue
                if at != (name, group):
                    at, runs = (name, group), (none, none)
                page = page_of(html)
                text = unrepeated(page, runs[page.marked])
                out.append((page_id, url, text, len(text)))
            yield pd.DataFrame(out, columns=["page_id", "url", "text", "n_chars"])

    decided = (
        spread.unionByName(lists, allowMissingColumns=True)
        .repartition(shuffle_parts(spark), "host", "group")
        .sortWithinPartitions("host", "group", F.col("runs").isNull())
        .mapInPandas(decide, "page_id string, url string, text string, n_chars long")
    )
    return with_type(decided, "page_id", id_type)
