"""Main text of a web page by its line-block distribution.

Markup is stripped into lines, one a block; containers that the page itself names as furniture
(navigation, footers, forms, adverts, comments and so on) leave only empty lines. The lengths of the
text outside links are summed over a sliding window of lines. Text surges where the sum rises from
nothing to a window whose density looks like prose, and dives where it falls to nothing again; the
lines between are kept. A name whose words are all furniture's (or layout's) decides by itself; where only some
are ("search-engines"), the container is furniture only if its own lines surge nowhere. What readers wrote is
furniture whatever it is made of. Where the page marks main text, the marked container with the most text outside
links is taken, with its like beside it, and any text outside links surges there; lines of links alone
need such text within a window. Marks that hold no text count for nothing, and marks inside furniture
only if they hold more text than what surges outside.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lines a window sums; letters outside links that a window must have to surge, and in marked main text.
WINDOW = 3
SURGE = 80
SURGE_MARKED = 1

# Fixed values of HTML.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noframes
    ol optgroup option p pre section select summary table tbody td tfoot th thead title tr ul""".split())
RAW = frozenset("iframe noembed noframes noscript script style svg math template textarea title xmp".split())
LISTS = frozenset("dir menu ol ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE = frozenset("""aside button datalist dialog fieldset footer form head header label legend menu nav optgroup
    option search select""".split())
# Parts of a class, id or role that name furniture.
NAMES = frozenset("""ad ads adv advert advertisement advertising adverts alert aside banner breadcrumb breadcrumbs comment
    comments commentlist complementary contentinfo consent cookie cookies copyright dialog disclaimer disqus discussion
    dropdown feedback footer form gdpr header masthead menu menubar modal nav navbar navigation newsletter notice notices
    pager pagination popup promo promoted promotion recommended related replies reply responses search share sharing
    sidebar sidebars signup social sponsor sponsored subscribe subscription tagcloud toolbar toc topbar widget
    widgets""".split())
MAIN = frozenset("main article".split())
# Names that make even an article or main element furniture (a reader's comment is often an article).
NOT_MAIN = frozenset("""ad ads advert advertisement comment comments promo promoted recommended related replies reply
    sponsored""".split())
# Words of layout, which say nothing about what a container holds.
LAYOUT = frozenset("""area article bar block body bottom box card col column container content entry fixed footer global group
    header holder inline inner item items large layout left link links list main mini module outer page panel post posts
    primary right row secondary section site small sticky story tab tabs text thread top widget wrap wrapper""".split())
# Names that an article's own title block may have.
TITLE_BLOCK = frozenset("header masthead".split())

# A quote opens a string only where a value begins.
_TAG = re.compile(r"""<!--.*?(?:-->|\Z) |
    <(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*)|[^>=]|=)*)>? | <[!?][^>]*>? """, re.X | re.S)
_NAMED = re.compile(r"""\b(class|id|role|hidden|aria-hidden|itemprop)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_PARTS = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")


def _names(attributes: str) -> tuple[set[str], bool, bool]:
    """What of an element's names says furniture, whether they say main text, and whether furniture is in doubt:
    some words of a name say it, and others say something else."""
    furniture: set[str] = set()
    main = sure = False
    for key, value in _NAMED.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            furniture.add("hidden")
            sure = True
        elif key == "itemprop":
            main |= value.lower() == "articlebody"
        elif key in ("class", "id", "role"):
            for name in value.split():
                words = set(_PARTS.split(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", name).lower())) - {""}
                furniture |= words & NAMES
                sure |= bool(words & NAMES) and all(w in NAMES or w in LAYOUT or any(map(str.isdigit, w)) for w in words)
            main |= key == "role" and value.lower() in MAIN
    return furniture, main, bool(furniture) and not sure


def lines_of(page: str) -> tuple[list[str], list[int], list[int], list[tuple]]:
    """Lines (empty ones where text must dive), letters outside links, which container a line is in (0: none),
    and of each container whether it is in furniture, the container around it and its level: 2 for an
    article, 1 for other marked main text. An article's inner containers are part of it."""
    lines: list[str] = []
    plain: list[int] = []
    inside: list[int] = []
    text: list[str] = []
    out_of_link = 0
    link = 0
    skip: list[str] = []  # open elements from the outermost furniture on
    closed = False  # that furniture holds no main text whatever is in it
    # Open containers of which it is in doubt whether they are furniture: name, open ones of that name inside, first line.
    doubted: list[list] = []
    doubts: list[tuple[int, int]] = []
    # Open elements that mark main text: name, container, open ones of that name inside, furniture around.
    opened: list[list] = []
    containers: list[tuple] = [(False, 0, 0)]
    at = 0

    def container() -> int:
        return opened[-1][1] if opened else 0

    def open_main(name: str) -> None:
        gap()
        around, level = container(), 1 if name == "main" else 2
        if containers[around][2] < level:
            containers.append((bool(skip) or containers[around][0], around, level))
            around = len(containers) - 1
        opened.append([name, around, 0, skip[:]])
        skip.clear()

    def close_main() -> None:
        gap()
        skip[:] = opened.pop()[3]

    def close_line() -> None:
        nonlocal text, out_of_link
        if text:
            line = " ".join(html.unescape("".join(text)).split())
            if line:
                lines.append(line)
                plain.append(out_of_link)
                inside.append(container())
        text, out_of_link = [], 0

    def gap() -> None:
        close_line()
        lines.extend([""] * WINDOW)
        plain.extend([0] * WINDOW)
        inside.extend([container()] * WINDOW)

    def say(piece: str) -> None:
        nonlocal out_of_link
        if piece and not skip:
            text.append(piece)
            if not link:
                out_of_link += len(piece.strip())

    size = len(page)
    while at < size:
        m = _TAG.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at:m.start()])
        at = m.end()
        name = m[2] and m[2].lower()
        if not name:
            continue
        # A p ends where a block begins or the one around it ends, an li at the next one or the list's end.
        if skip and skip[-1] == "p" and name in BLOCKS and not (m[1] and name in skip):
            skip.pop()
        elif skip and skip[-1] == "li" and (name in LISTS and name not in skip if m[1] else name == "li"):
            skip.pop()
        elif opened and not skip and opened[-1][0] == "p" and name in BLOCKS and (not m[1] or name != "p"):
            close_main()
        if skip:
            if m[1]:
                if name in skip:  # also closes what was left open inside
                    del skip[len(skip) - 1 - skip[::-1].index(name):]
                elif name == "body":
                    skip.clear()
            elif name in RAW:
                at = _after_raw(page, name, at)
            elif name in MAIN and not closed and not _names(m[3])[0] & NOT_MAIN:
                open_main(name)  # perhaps the furniture was left open before the article
            elif name not in VOID and not m[3].endswith("/") and (
                    name == skip[0] or name in FURNITURE or skip[-1] == "li" and name in LISTS):
                skip.append(name)
            continue
        if m[1]:
            if name == "a":
                link = max(0, link - 1)
            elif name in BLOCKS:
                close_line()
                if doubted and name == doubted[-1][0]:
                    doubted[-1][1] -= 1
                    if doubted[-1][1] < 0:
                        doubts.append((doubted.pop()[2], len(lines)))
                        continue
                if opened and name == opened[-1][0]:
                    opened[-1][2] -= 1
                    if opened[-1][2] < 0:
                        close_main()
                elif opened and name in opened[-1][3]:  # the furniture around ends
                    close_main()
                    del skip[len(skip) - 1 - skip[::-1].index(name):]
            continue
        if name in RAW:
            at = _after_raw(page, name, at)
            continue
        furniture, main, doubt = _names(m[3]) if m[3] else (set(), False, False)
        if (main or name in MAIN) and not furniture & NOT_MAIN:
            open_main(name)
        elif doubt and name in BLOCKS and name not in FURNITURE and name not in VOID and name not in ("html", "body"):
            close_line()
            doubted.append([name, 0, len(lines)])
        elif (furniture or name in FURNITURE) and name not in ("html", "body"):
            if opened and (name == "header" or furniture and furniture <= TITLE_BLOCK):
                close_line()  # an article's own header has its title
            elif name not in VOID:
                if opened:
                    close_line()
                else:
                    gap()
                skip.append(name)
                closed = bool(furniture & NOT_MAIN)
        elif name == "a":
            link += 1
        elif name == "br":
            say(" ")
        elif name in BLOCKS:
            link = 0
            close_line()
            if doubted and name == doubted[-1][0]:
                doubted[-1][1] += 1
            elif opened and name == opened[-1][0]:
                opened[-1][2] += 1
    close_line()
    for begin, end in [*doubts, *((d[2], len(lines)) for d in doubted)]:
        if not _surged(np.array(plain[begin:end], int), SURGE).any():
            lines[begin:end], plain[begin:end] = [""] * (end - begin), [0] * (end - begin)
    return lines, plain, inside, containers


def _after_raw(page: str, name: str, at: int) -> int:
    end = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, at)
    return end.end() if end else len(page)


def main_text(page: str | None) -> str:
    """The article's blocks, joined by two line breaks; empty if the page is null, empty or has none."""
    if not page:
        return ""
    lines, plain, inside, containers = lines_of(page)
    if not lines:
        return ""
    length, where = np.array(plain), np.array(inside)
    furniture = np.array([c[0] for c in containers])
    held = np.bincount(where, length, len(containers))
    held[0] = 0

    def alike(c: int) -> np.ndarray:
        return np.array([x == containers[c] for x in containers])[where]
    best = int(np.argmax(np.where(furniture, 0, held)))
    if held[best]:
        keep = _near(_surged(np.where(alike(best), length, 0), SURGE_MARKED)) & alike(best)
    else:
        keep = _surged(np.where(furniture[where], 0, length), SURGE) & ~furniture[where]
        best = int(np.argmax(held))
        if held[best] > length[keep].sum():
            keep = _near(_surged(np.where(alike(best), length, 0), SURGE_MARKED)) & alike(best)
        elif not keep.any():  # marked main text of links alone
            keep = where > 0
    return "\n\n".join(x for x, k in zip(lines, keep) if k and x)


def _surged(length: np.ndarray, surge: int) -> np.ndarray:
    """The lines from where text begins to where it dives, if a window between them surges."""
    if not len(length):
        return np.zeros(0, bool)
    # Windows start at each line; the sums of the WINDOW lines from there.
    sums = np.convolve(length, np.ones(WINDOW, int))[WINDOW - 1:]
    keep = np.zeros(len(length), bool)
    at = 0
    while at < len(length):
        if not length[at]:
            at += 1
            continue
        dive = at
        while dive < len(length) and sums[dive]:  # nothing for a whole window: the text dives
            dive += 1
        if sums[at:dive].max() >= surge:
            keep[at:dive] = True
        at = dive + 1
    return keep


def _near(keep: np.ndarray) -> np.ndarray:
    """Lines that share a window with a kept one: in marked text, a headline may be a link."""
    return np.convolve(keep, np.ones(2 * WINDOW - 1, int))[WINDOW - 1:][:len(keep)] > 0


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [main_text(x.as_py()) for x in b.column(2)]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page.

    A null, empty or text-free page has an empty text; repeated rows keep a row each; ids and URLs
    may be null; a page without tags is text as it is, if it is long enough to surge. Other columns
    are not read.
    """
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(_extracted, "page_id BIGINT, url STRING, text STRING, n_chars BIGINT")
