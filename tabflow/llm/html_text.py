"""Main text of web pages as a maximum-scoring subsequence of tokens.

A page is a sequence of tags and words. Words score positive and tags negative, by weights that are learned from labelled
pages: pages whose markup names the content (an article or main element, or a body marked as such). The weight of a kind of
token is the log-odds of its lying inside the content; the kind of a word is the block it stands in and whether it is part
of a link, so that menus of plain lists do not tell on lists of text. One scan finds the contiguous region of the highest
score, and the text is that of all the region's blocks but asides: elements that never hold content (forms, navigation and
the like), elements that a class, id or role names so, and what is in them. An aside counts against a region once for each
of its blocks, however long, so that a long one does not cut an article in two. A name counts by whole words of a class
that does not say that something is absent or switched on (no-sidebar, has-header, comments-open), and never on html, body,
main or article.

Edge cases: null html counts as empty; a page without words, or whose best region holds none, has an empty text; unclosed
and unknown tags, cut-off markup and a lone < are read as far as they go; without labelled pages the prior weights below
decide; every row of a repeated page_id is extracted by itself; an empty table gives an empty result; only the columns that
are asked for are kept.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.llm.common import slices

#: Labelled pages that the weights are learned from, at most; they are picked by a hash of url and page_id.
SAMPLE = 2000
#: Weights before learning: a word in a block that is, or is not, of a kind that never holds the content, and a tag.
PRIOR_WORD, PRIOR_ASIDE, PRIOR_TAG = 1.0, -3.0, -0.5
#: Counts of the prior's strength, in tokens, and the bound of a weight.
STRENGTH, BOUND = 5.0, 6.0

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(script|style|noscript|template|textarea|svg|iframe|title)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*)(?:>|\Z)",
    re.S | re.I)
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_BLOCKS = frozenset("address article aside blockquote body br button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose words are never content.
_NEVER = frozenset("nav aside form button select option menu dialog head header footer fieldset legend".split())
#: Words in a class, id or role that name what is not content.
_ASIDE = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header hidden login menu modal nav navbar navigation newsletter notice popup promo promoted related reply replies share sharing sidebar signup social sponsor sponsored subscribe teaser toolbar widget".split())
#: Parts of a class name that make it speak of the layout around the element.
_MODIFIERS = frozenset("no not has have with without is hide hides hidden show shows open closed enabled disabled active inactive on off".split())
_LAYOUT = frozenset("html body main article".split())
_CONTENT = frozenset("articlebody main".split())


def _names(attributes: str) -> set[str]:
    return {w for _, v in _ATTRIBUTE.findall(attributes) for w in re.findall(r"[a-z]+", v.lower())} if "=" in attributes else set()


def _names_aside(attributes: str) -> bool:
    """Whether a class, id or role names what is not content."""
    if "=" not in attributes:
        return False
    for _, value in _ATTRIBUTE.findall(attributes):
        for name in value.lower().strip("\"'").split():
            parts = re.findall(r"[a-z]+", name)
            if _ASIDE.intersection(parts) and (len(parts) == 1 or not _MODIFIERS.intersection(parts[:1] + parts[-1:])):
                return True
    return False


def tokens(page: str) -> list[tuple[str, int, str, bool, bool]]:
    """The tokens of a page: (kind, words, text, begins a block, lies in the named content). Tags have no words."""
    out = []
    stack: list[tuple[str, str, bool]] = []  # element, the kind of words in it, whether it is in the named content
    at = 0
    fresh = True  # a block has begun since the last text
    links = 0  # open links of the block

    def say(text: str) -> None:
        nonlocal fresh
        text = html.unescape(text)
        words = len(text.split())
        if words or text:
            kind, inside = (stack[-1][1], stack[-1][2]) if stack else ("word:", False)
            kind += ":link" if links else ""
            out.append((kind, words, text, fresh, inside))
            fresh = fresh and not words

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            say(page[at : m.start()])
        at = m.end()
        name = m[3] or m[6]
        if not name:
            if m[1] and m[1].lower() != "svg":
                fresh = True
                out.append((f"tag:{m[1].lower()}", 0, "", True, bool(stack and stack[-1][2])))
            continue
        name, closes = name.lower(), bool(m[2] or m[5])
        if name == "a":
            links = 0 if closes else 1
        if name in _BLOCKS:
            fresh = True
            inside = bool(stack and stack[-1][2])
            if closes:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == name:
                        inside = stack[k - 1][2] if k else False
                        del stack[k:]
                        break
                out.append((f"tag:/{name}", 0, "", True, inside))
                continue
            out.append((f"tag:{name}", 0, "", True, inside))
            if name in _VOID:
                continue
            if name in ("p", "li", "option", "dt", "dd", "tr", "td", "th") and stack and stack[-1][0] == name:
                stack.pop()  # its end tag may be left out
            names = _names(m[4] or m[7] or "")
            named = name not in _LAYOUT and _names_aside(m[4] or m[7] or "")
            aside = name in _NEVER or named or name != "main" and bool(stack) and stack[-1][1].startswith("aside:")
            content = name in ("article", "main") or bool(names & _CONTENT)
            stack.append((name, f"{'aside' if aside else 'word'}:{name}", inside or content))
    if at < len(page):
        say(page[at:])
    return out


class Weights:
    """Log-odds by kind of token."""

    def __init__(self, counts: dict[str, tuple[float, float]]):
        inside, outside = sum(a for a, _ in counts.values()), sum(b for _, b in counts.values())
        base = math.log((inside + 1) / (outside + 1))
        self.of = {}
        for kind, (a, b) in counts.items():
            prior = self.prior(kind)
            got = math.log((a + 0.5) / (b + 0.5)) - (base if kind.startswith("tag:") else 0)
            w = (prior * STRENGTH + got * (a + b)) / (STRENGTH + a + b)
            # words score positive unless they are found outside, tags negative
            self.of[kind] = max(-BOUND, min(BOUND, w)) if not kind.startswith("tag:") else max(-BOUND, min(-0.01, w))

    @staticmethod
    def prior(kind: str) -> float:
        return PRIOR_TAG if kind.startswith("tag:") else PRIOR_ASIDE if kind.startswith("aside:") else PRIOR_WORD

    def __getitem__(self, kind: str) -> float:
        w = self.of.get(kind)
        return self.prior(kind) if w is None else w


def extract(page: str, weights: Weights) -> str:
    """The page's main text: blocks joined by one blank."""
    seen = tokens(page)
    best, run, start, region = 0.0, 0.0, 0, (0, 0)
    for i, (kind, words, _, _, _) in enumerate(seen):
        run += weights[kind] * (words if kind.startswith("word:") else min(words, 1) if kind.startswith("aside:") else 1)
        if run <= 0:
            run, start = 0.0, i + 1
        elif run > best:
            best, region = run, (start, i + 1)
    parts = []
    for kind, _, text, fresh, _ in seen[region[0] : region[1]]:
        if kind.startswith("tag:"):
            parts.append(" ")
        elif kind.startswith("word:"):
            parts.append(" " + text if fresh else text)
    return " ".join("".join(parts).split())


def learn(pages: DataFrame, sample: int = SAMPLE) -> Weights:
    """Weights from a sample of labelled pages, counted on executors; the driver receives a row for each kind."""
    named = F.lower("html").rlike(r"<(article|main)\b|articlebody|role\s*=\s*[\"']?main")
    order = F.xxhash64(F.col("url").cast("string"), F.col("page_id").cast("string"))
    marked = pages.where(named).select("html", order.alias("_o"))
    # hashes alone are sorted; the pages are then picked by them
    chosen = marked.select("_o").orderBy("_o").limit(sample).distinct()
    labelled = marked.join(F.broadcast(chosen), "_o").select("html")

    def count(batches):
        total: dict[str, list[float]] = {}
        for batch in slices(batches, "html"):
            for page in batch.column("html").to_pylist():
                for kind, words, _, _, inside in tokens(page):
                    total.setdefault(kind, [0, 0])[not inside] += words if not kind.startswith("tag:") else 1
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array([float(a) for a, _ in total.values()]), pa.array([float(b) for _, b in total.values()])], names=["kind", "inside", "outside"])

    rows = labelled.mapInArrow(count, "kind string, inside double, outside double").groupBy("kind").agg(F.sum("inside"), F.sum("outside")).collect()
    return Weights({k: (a, b) for k, a, b in rows})


def main_text(spark: SparkSession, pages: DataFrame, keep: list[str] = ["page_id", "url"], sample: int = SAMPLE) -> DataFrame:  # noqa: B006
    """The kept columns of pages (page_id, url, html) with text and n_chars."""
    weights = learn(pages, sample)
    names = [f"_k{i}" for i in range(len(keep))]
    rows = pages.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.coalesce("html", F.lit("")).alias("_html"))
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*names).schema)

    def run(batches):
        for batch in slices(batches, "_html"):
            texts = [extract(p, weights) for p in batch.column("_html").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*names, "text", "n_chars"])

    out = rows.mapInArrow(run, f"{types}, text string, n_chars long")
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], "text", "n_chars")
