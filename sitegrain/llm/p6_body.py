"""Problem 6: the main body of a web page without what surrounds it.

The standard library's parser streams events of a page into lines, one for each block element's text, with the line's
text-to-tag ratio and its chain of containers. The ratios are smoothed by a Gaussian, a threshold between their two
clusters marks content lines, and the containers of these lines are the candidate regions. The region is taken whole,
so that short lines of the body stay.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrain.functions.text import is_blank
from sitegrain.sources.tables import table

# Elements of HTML by their role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT = set("script style template noscript head title iframe svg select textarea button".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINER = set("article aside blockquote body center details dialog div fieldset footer form header main nav section td th".split())
AROUND = set("aside dialog footer header nav form".split())
ENDS_P = BLOCK - {"html", "body"}
#: An open element of the key is ended by the start of one of the values.
ENDED_BY = {"p": ENDS_P, "li": {"li"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
SIGMA = 1.5


class Lines(HTMLParser):
    """``lines``: [text, tags, letters in links, container ids from the outside in, heading level]."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int]] = []
        self.silent = self.link = self.level = self.tags = self.linked = 0
        self.kinds: list[str] = ["body"]
        self.path: tuple[int, ...] = (0,)
        self.lines: list[tuple[str, int, int, tuple[int, ...], int]] = []
        self.words: list[str] = []

    def _flush(self) -> None:
        text = " ".join("".join(self.words).split())
        if text:
            self.lines.append((text, self.tags, self.linked, self.path, self.level))
            self.tags = 0
        self.words, self.linked = [], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        while self.open and tag in ENDED_BY.get(self.open[-1][0], ()):
            self._close()
        self.tags += 1
        if tag in BLOCK or tag == "br":
            self._flush()
        if tag in VOID:
            return
        made = -1
        if tag in CONTAINER and tag != "body":
            role = dict(attrs).get("role") or ""
            self.kinds.append("dialog" if role in ("dialog", "alertdialog", "banner", "navigation", "contentinfo", "complementary", "search") else tag)
            made = len(self.kinds) - 1
            self.path += (made,)
        self.open.append((tag, made))
        self.silent += tag in SILENT
        self.link += tag == "a"
        if tag[0] == "h" and tag[1:] in "123456" and len(tag) == 2:
            self.level = int(tag[1])

    def _close(self) -> None:
        tag, made = self.open.pop()
        if tag in BLOCK:
            self._flush()
        if made >= 0:
            self.path = self.path[:-1]
        self.silent -= tag in SILENT
        self.link -= tag == "a"
        if tag[0] == "h" and tag[1:] in "123456" and len(tag) == 2:
            self.level = 0

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag not in (t for t, _ in self.open):
            return
        while self.open[-1][0] != tag:
            self._close()
        self._close()

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.words.append(data)
            if self.link:
                self.linked += len(data.strip())

    def close(self) -> None:
        super().close()
        self._flush()


def smooth(values: list[float], sigma: float = SIGMA) -> list[float]:
    """The values under a Gaussian window, renormalised at the ends."""
    reach = math.ceil(3 * sigma)
    kernel = [math.exp(-(d * d) / (2 * sigma * sigma)) for d in range(reach + 1)]
    out = []
    for i in range(len(values)):
        lo, hi = max(0, i - reach), min(len(values), i + reach + 1)
        weights = [kernel[abs(i - j)] for j in range(lo, hi)]
        out.append(sum(w * v for w, v in zip(weights, values[lo:hi])) / sum(weights))
    return out


def threshold(values: list[float]) -> float:
    """The border between the two clusters of the values (means in turn, from the extremes)."""
    lo, hi = min(values), max(values)
    for _ in range(50):
        cut = (lo + hi) / 2
        low, high = [v for v in values if v < cut], [v for v in values if v >= cut]
        new = (sum(low) / len(low) if low else lo, sum(high) / len(high) if high else hi)
        if new == (lo, hi):
            break
        lo, hi = new
    return (lo + hi) / 2


def body_lines(html: str | None) -> list[str]:
    """The lines of the main body, in order; none for null, blank or textless html.

    Content lines are those whose smoothed ratio of text to tags is in the upper cluster. Of the containers around the
    page's top heading or around content lines (navigation, asides, footers and dialogs last), the one is taken that
    bears the top heading, else the one with the most content; it is taken with all its lines but those of containers
    within it that are no content: asides, navigation, link lists.
    """
    if not html or not html.strip():
        return []
    page = Lines()
    page.feed(html)
    page.close()
    lines = page.lines
    if not lines:
        return []
    ratio = smooth([max(0, len(text) - linked) / (tags + 1) for text, tags, linked, _, _ in lines])
    cut = threshold(ratio)
    around = [any(page.kinds[c] in AROUND for c in path) for _, _, _, path, _ in lines]
    mass: dict[int, float] = {}
    heads: dict[int, int] = {}
    for (text, _, linked, path, level), r, out in zip(lines, ratio, around):
        at = path[-1]
        heads[at] = min(heads.get(at, 9), (level or 9) + 7 * out)
        if r >= cut and linked < 0.5 * len(text):
            mass[at] = mass.get(at, 0.0) + len(text) * (0.1 if out else 1.0)
    main = min(heads, key=lambda c: (heads[c] if heads[c] == 1 else 9, -mass.get(c, 0.0), c))
    own = [i for i, (_, _, _, path, _) in enumerate(lines) if main in path]
    inner = {c for i in own for c in lines[i][3][lines[i][3].index(main) + 1 :]}
    drop = {c for c in inner if page.kinds[c] in AROUND - {"form"}}
    return [lines[i][0] for i in own if not drop & set(lines[i][3])]


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(["\n".join(body_lines(h)) for h in batch.column(1).to_pylist()], pa.string())], ["ord", "body"])


def main_bodies(pages: DataFrame) -> DataFrame:
    """(ord, body) for each page (``ord, html``; other columns are ignored): the main body, one line a block.

    Null, blank and textless html gives ''. Every row is parsed whole; repeated rows give repeated rows; an empty table
    gives no row.
    """
    return pages.select(F.col("ord").cast("long"), "html").mapInArrow(_bodies, "ord long, body string")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases that belong to the main body of their page."""
    phrases = table(spark, sf_dir, "page_phrases").select("phrase_id", F.col("page_ord").alias("ord"), "phrase").where(~is_blank("phrase"))
    text = F.replace("body", F.lit("\n"), F.lit(" "))
    hit = phrases.join(main_bodies(table(spark, sf_dir, "page_fetch")), "ord").where(F.contains(text, F.trim("phrase")))
    return hit.select(F.col("phrase_id").cast("long").alias("phrase_id")).distinct()


def p6_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main body of every fetched page."""
    return main_bodies(table(spark, sf_dir, "page_fetch"))
