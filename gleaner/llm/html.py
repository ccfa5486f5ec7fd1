"""Main text of HTML pages by text-to-tag ratios.

Events of the standard library's streaming parser build lines: block tags, line
breaks and new lines end a line, and each line counts its text characters and
its tags.  The ratio of the two is smoothed over neighbouring lines by a
Gaussian kernel, and lines are content where the smoothed ratio exceeds
``factor`` standard deviations of the page's smoothed ratios.  For the deviation
ratios count up to their ``BOUND`` quantile only, so that one very long line doesn't
set the threshold for the others.  The text of scripts, styles, templates and of the
head is no text.  A head that is never closed ends at the first block of
the body; the text of a ``noscript`` or ``template`` that is never closed is text.

A null page gives a null text; an empty one, or one without text, an empty text.
A page whose lines all have the same ratio is content as a whole.  Pages are read
whole, in pieces of ``FEED`` characters.  Repeated rows give equal rows.  Other
columns, whatever their names, are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf

SIGMA = 1.0
FACTOR = 0.8
BOUND = 0.9
FEED = 1 << 16
BLOCKS = frozenset(
    "address article aside blockquote body br caption dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
SILENT = frozenset("script style template noscript title head".split())
#: What a head or a hidden element that has been left open may still hold: any other block ends it.
INSIDE = frozenset("head title meta link base script style template noscript html".split())


class Lines(HTMLParser):
    """Collects (text, number of tags) of each line."""

    CDATA_CONTENT_ELEMENTS = ("script", "style")

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int]] = []
        self.parts: list[str] = []
        self.tags = 0
        self.silent: list[str] = []
        self.hidden: list[str] = []

    def end_line(self) -> None:
        if self.parts or self.tags:
            text = " ".join("".join(self.parts).split())
            self.lines.append((text, self.tags))
            self.parts, self.tags = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.end_line()
            if self.hidden:
                self.hidden.append("\n")
            if self.silent and (tag == "body" or self.silent[-1] in ("head", "title") and tag not in INSIDE):
                self.silent.clear()
        if tag in SILENT:
            self.silent.append(tag)
        self.tags += 1

    def handle_startendtag(self, tag, attrs):
        if tag in BLOCKS:
            self.end_line()
        self.tags += 1

    def handle_endtag(self, tag):
        if tag in self.silent:
            while self.silent.pop() != tag:
                pass
            self.hidden.clear()
        self.tags += 1
        if tag in BLOCKS:
            self.end_line()

    def show_hidden(self) -> None:
        """At the end: the text of a hidden element that was never closed is text after all."""
        held, self.hidden = self.hidden, []
        if self.silent and self.silent[-1] in ("noscript", "template"):
            self.silent.clear()
            for data in held:
                self.handle_data(data)

    def handle_data(self, data):
        if self.silent:
            if self.silent[-1] in ("noscript", "template"):
                self.hidden.append(data)
            return
        pieces = data.split("\n")
        for piece in pieces[:-1]:
            self.parts.append(piece)
            self.end_line()
        if pieces[-1]:
            self.parts.append(pieces[-1])


def lines_of(html: str) -> list[tuple[str, int]]:
    parser = Lines()
    for k in range(0, len(html), FEED):
        parser.feed(html[k : k + FEED])
    parser.close()
    parser.show_hidden()
    parser.end_line()
    return [x for x in parser.lines if x[0] or x[1]]


def smoothed(ratio: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian smoothing, the kernel cut off at three sigmas and renormalised at the ends."""
    reach = max(1, int(np.ceil(3 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    around = np.convolve(ratio, kernel)[reach : reach + len(ratio)]
    return around / np.convolve(np.ones(len(ratio)), kernel)[reach : reach + len(ratio)]


def content(html: str, sigma: float = SIGMA, factor: float = FACTOR) -> tuple[str, int, int]:
    """(text, lines, content lines) of a page."""
    lines = [x for x in lines_of(html)]
    if not lines:
        return "", 0, 0
    ratio = np.array([len(t) / max(1, n) for t, n in lines])
    smooth = smoothed(ratio, sigma)
    spread = np.minimum(smooth, np.quantile(smooth, BOUND)).std()
    chosen = smooth > factor * spread if spread > 1e-9 * max(1.0, smooth.max()) else np.ones(len(lines), bool)
    kept = [t for (t, _), c in zip(lines, chosen) if c and t]
    return "\n".join(kept), len(lines), len(kept)


def extracted(pages: DataFrame, sigma: float = SIGMA, factor: float = FACTOR) -> DataFrame:
    """(page_id, url, text, n_lines, n_content_lines) for every page."""

    @arrow_udf("text string, n_lines int, n_content_lines int")
    def extract(column: pa.Array) -> pa.Array:
        found = [(None, 0, 0) if h is None else content(h, sigma, factor) for h in column.to_pylist()]
        text, lines, kept = zip(*found) if found else ((), (), ())
        return pa.StructArray.from_arrays([pa.array(text, pa.string()), pa.array(lines, pa.int32()), pa.array(kept, pa.int32())], names=["text", "n_lines", "n_content_lines"])

    out = pages.select("page_id", "url", extract(F.col("html")).alias("c"))
    return out.select("page_id", "url", "c.text", "c.n_lines", "c.n_content_lines")
