"""Main text of web pages (operator 5): streaming parser events, text-to-tag ratios, smoothing and clustering.

The standard library's parser turns a page into lines, one per block, each
with its text, the tags in it and the containers it is in. The ratio of text
to tags of each line is smoothed by a Gaussian; lines above the page's
threshold are the content cluster. The containers that hold most of their
text in that cluster are the content regions, and all their lines are kept, so
short paragraphs between long ones stay. Menus, notices and the like are left
out by what their containers are. Names of class and id that mean comments,
notices or adverts leave their elements out whatever these hold. Other names
are overruled if their element holds most of the clustered text and the page's
main heading, or nothing is left without it; pages with such names are parsed
up to three times.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Width of the Gaussian in lines, and the share of the ratios' deviation that makes the threshold.
SIGMA, THRESHOLD = 1.5, 0.5

#: Tags that begin a line, tags that hold regions, and tags without content.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
REGIONS = frozenset("article aside blockquote body dd details dialog div dl dt fieldset figure footer form header html li main menu nav ol section table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Containers that are never content, and words of class, id and role names that say so.
NEVER = frozenset("aside button datalist dialog footer form head iframe math menu nav noscript object script select style svg template textarea title video audio canvas".split())
NEVER_NAMED = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices pagination pager popup promo promoted promotion recommended related replies reply respond share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget widgets".split()
)
#: Those of them that say so whatever the element holds: reader comments, notices and adverts.
NEVER_OVERRULED = frozenset("ad ads adv advert adverts advertisement advertising banner comment comments commentlist consent cookie cookies disqus gdpr notice notices promo promoted promotion replies reply respond sponsor sponsored".split())
#: Tags that head a page's main text: a named element without them isn't the page's content while other text is left.
HEADS = frozenset(["h1", "article", "main"])
NEVER_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Words by which a name says what an element has or lacks, not what it is; and what an article's own parts may be called.
NOT_ITSELF = frozenset("has have no non not with without free hide hides hidden show shows enable enabled disable disabled".split())
OWN_PARTS = frozenset(["header"])
_NAME = re.compile(r"[a-z]+")


class _Lines(HTMLParser):
    """Collects the lines of a page as parser events come in.

    Elements whose names say that they are no content are left out, except
    those at the places `exempt`; where that is None none is, and `named` has
    the characters in each of them for every line.
    """

    def __init__(self, exempt: frozenset[tuple[int, int]] | None = frozenset()) -> None:
        super().__init__(convert_charrefs=True)
        self.exempt = exempt
        self.open: list[tuple[str, bool, int]] = []  # tag, whether it is left out, number of the region
        self.inside: list[tuple[tuple[int, int], ...]] = []  # places of the named elements that each is in
        self.held: dict[tuple[int, int], int] = {}
        self.named: list[dict[tuple[int, int], int]] = []
        self.saw_name = False
        self.headed: set[tuple[int, int]] = set()  # places of named elements with a main heading
        self.regions = 1
        self.parents = [0]
        self.article = [False]
        self.parts: list[str] = []
        self.tags = 0
        self.texts: list[str] = []
        self.counts: list[int] = []
        self.homes: list[int] = []

    @property
    def _out(self) -> bool:
        return bool(self.open) and self.open[-1][1]

    @property
    def _region(self) -> int:
        return self.open[-1][2] if self.open else 0

    def _end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.texts.append(text)
            self.counts.append(self.tags)
            self.homes.append(self._region)
            self.named.append(self.held)
        self.parts, self.tags, self.held = [], 0, {}

    def _left_out(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if tag in NEVER:
            return True
        in_article = self.article[self._region]
        if tag == "header":
            return not in_article
        if tag in ("html", "body", "main", "article"):
            return False
        for name, value in attrs:
            if name == "role" and value and value.strip().lower() in NEVER_ROLES:
                return True
            if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and value and "display:none" in value.replace(" ", "").lower():
                return True
        return False

    def _never_named(self, tag: str, attrs: list[tuple[str, str | None]]) -> frozenset[str]:
        """The words in the element's names that say that it is no content."""
        found: set[str] = set()
        if tag in ("html", "body", "main", "article", "header"):
            return frozenset()
        for name, value in attrs:
            for token in value.lower().split() if name in ("class", "id") and value else ():
                words = set(_NAME.findall(token))
                if self.article[self._region]:
                    words -= OWN_PARTS
                if not words & NOT_ITSELF:
                    found |= words & NEVER_NAMED
        return frozenset(found)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self._end_line()
        self.tags += 1
        if tag in HEADS and not self._out and self.inside:
            self.headed.update(self.inside[-1])
        if tag == "br":
            self.parts.append("\n")
        if tag in VOID:
            return
        out, place, named = self._out or self._left_out(tag, attrs), self.getpos(), False
        if words := self._never_named(tag, attrs):
            if words & NEVER_OVERRULED:
                out = True
            else:
                self.saw_name = True
                named = self.exempt is None and not out
                out = out or not named and place not in self.exempt
        if tag in REGIONS or out or named:
            region = self._region
            if tag in REGIONS:
                self.parents.append(region)
                self.article.append(self.article[region] or tag in ("article", "main"))
                region, self.regions = self.regions, self.regions + 1
            self.open.append((tag, out, region))
            self.inside.append((*(self.inside[-1] if self.inside else ()), *([place] if named else [])))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID:
            self.handle_starttag(tag, attrs)
        else:
            self.handle_starttag(tag, attrs)
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self._end_line()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self._end_line()
                del self.open[i:], self.inside[i:]
                break
        self.tags += 1

    def handle_data(self, data: str) -> None:
        if not self._out:
            self.parts.append(data)
            for place in self.inside[-1] if self.inside else ():
                self.held[place] = self.held.get(place, 0) + len("".join(data.split()))


def _parsed(html: str, exempt: frozenset[tuple[int, int]] | None) -> _Lines:
    page = _Lines(exempt)
    page.feed(html)
    page.close()
    page._end_line()
    return page


def lines(html: str) -> _Lines:
    page = _parsed(html, frozenset())
    if not page.saw_name:
        return page
    exempt = _holding_most(html, bool(content(page).any()))
    return _parsed(html, exempt) if exempt else page


def _holding_most(html: str, other: bool) -> frozenset[tuple[int, int]]:
    """The elements that are named as no content but hold most of the clustered text of the whole page; and, if there is `other` text, its main heading."""
    page = _parsed(html, None)
    if not page.texts:
        return frozenset()
    cluster = np.flatnonzero(_clustered(page)[1])
    total, held = 0, {}
    for i in cluster.tolist():
        total += len("".join(page.texts[i].split()))
        for place, n in page.named[i].items():
            held[place] = held.get(place, 0) + n
    return frozenset(place for place, n in held.items() if 2 * n > total and (not other or place in page.headed))


def _clustered(page: _Lines) -> tuple[np.ndarray, np.ndarray]:
    """The length of each line, and whether it is in the content cluster."""
    length = np.array([len(t) for t in page.texts], float)
    ratio = length / np.maximum(np.array(page.counts), 1)
    reach = int(3 * SIGMA)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / SIGMA) ** 2)
    smooth = np.convolve(np.pad(ratio, reach, mode="edge"), kernel / kernel.sum(), mode="valid")
    return length, smooth >= THRESHOLD * smooth.std()


def content(page: _Lines) -> np.ndarray:
    """Which lines of a page are content."""
    if not page.texts:
        return np.zeros(0, bool)
    length, cluster = _clustered(page)
    homes = np.array(page.homes)
    # text of each region with all regions in it, and how much of it is in the cluster
    total, chosen = np.zeros(page.regions), np.zeros(page.regions)
    np.add.at(total, homes, length)
    np.add.at(chosen, homes, length * cluster)
    for region in range(page.regions - 1, 0, -1):
        total[page.parents[region]] += total[region]
        chosen[page.parents[region]] += chosen[region]
    is_content = (total > 0) & (2 * chosen >= total)
    article = np.array(page.article)
    if (is_content & article).any():
        is_content &= article
    kept = np.zeros(page.regions, bool)
    for region in range(page.regions):
        kept[region] = is_content[region] or (region > 0 and kept[page.parents[region]])
    return kept[homes]


def main_text(html: str | None) -> str:
    """The content lines of a page, one below the other; empty for none."""
    page = lines(html or "")
    return "\n".join(text for text, kept in zip(page.texts, content(page), strict=True) if kept)


def extract(pages: DataFrame, html: str = "html", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """`pages` with its main text and the number of its code points; a null or empty page has an empty one.

    Columns of the two names are replaced. A page is parsed by itself, as it
    streams through its task; broken markup is taken as far as it goes.
    """
    rest = [c for c in pages.columns if c not in (text, n_chars)]
    spare = next(name for name in ("_html", *(f"_html_{i}" for i in range(len(pages.columns) + 1))) if name not in pages.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [main_text(x) for x in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())], names=[*rest, text, n_chars])

    shape = T.StructType([*(pages.schema[c] for c in rest), T.StructField(text, T.StringType()), T.StructField(n_chars, T.LongType())])
    return pages.select(*(F.col(f"`{c}`") for c in rest), F.col(html).alias(spare)).mapInArrow(run, shape)
