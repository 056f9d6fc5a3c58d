"""Main text of web pages by wrappers inferred for each host.

A page is read as a stream of tokens: text slots, each under the tags that
enclose it. Pages of a host are aligned one after the other. Where a stream
repeats itself, the repetition becomes a repeated group; where one of two
aligned streams has more, the surplus becomes an optional group; where texts at
the same place differ, the place is a text slot, and otherwise fixed text. The
result is a regular expression without unions, the wrapper of the host, and the
part of it that holds the article says which slots of a page are its main text.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from slotmill.llm.common import batches_of, fresh_name, materialise, table

#: parts that the pages of a host are dealt into before their wrappers are merged
SPREAD = 64
#: text that so many pages have at the same place, and no page otherwise, may belong to the template,
FIXED_PAGES = 3
#: and does if they are this share of the host's pages: within the article, and where no tags tell an article
FIXED_SHARE, FIXED_SHARE_OUTSIDE = 0.9, 0.5
#: a slot with this share of its text in links is a menu, outside an article
LINKED = 0.8
#: longest run of slots that is looked for as a repeated group
GROUP = 4

# fixed values: what HTML elements are
RAW = "script|style|textarea|title"
#: elements whose text is not read; one without an end tag ends with the block around it
SKIPPED = frozenset("noscript template svg iframe select button option optgroup datalist object math".split())
OPTIONS = {"option": {"option", "optgroup"}, "optgroup": {"optgroup"}}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
#: an element of the first kind is closed where one of its list begins
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr"},
    "th": {"td", "th", "tr"}, "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"}, "head": {"body"},
}
#: elements that an open li, td and so on is not closed through
SCOPE = {"ul", "ol", "dl", "table", "menu", "dir"}
BESIDE_TAGS = frozenset("nav header footer aside form menu dialog head".split())
BESIDE_WORDS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments cookie cookies disqus footer header menu "
    "modal nav navbar navigation newsletter notice notices popup promo promotion related respond share sharing sidebar social "
    "sponsor sponsored subscribe toolbar widget masthead alert".split()
)
MAIN_WORDS = frozenset(("articlebody",))
#: of these words no slot is an article's, however its text varies from page to page
NEVER_WORDS = frozenset("ad ads advert advertisement adverts comment comments disqus respond sponsor sponsored".split())
#: beside the article by a class or id only, which the pages of the host may contradict
HINTED, BESIDE = 1, 2

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})(?=[\s/>])[^>]*>(?:.*?</\1\s*>|(?<!/>).*\Z)"
    r"|<(/?)([a-zA-Z][\w:-]*)((?:[^<>\"']|\"[^\"<]*\"|'[^'<]*'|[\"'])*?)>|<[!?][^>]*>",
    re.S | re.I,
)
_NAME = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PART = re.compile(r"[a-z]+|[A-Z][a-z]*")


@dataclass(frozen=True)
class Block:
    """A run of text between two block tags: its path, whether it is beside the article, its text, characters in links.

    ``beside`` is 0, HINTED by a name within an article, or BESIDE.
    """

    path: str
    beside: int
    text: str
    linked: int


def _names(attributes: str) -> list[str]:
    return [w for groups in _NAME.findall(attributes) for value in groups for w in value.split()] if "=" in attributes else []


def _is_beside(tag: str, names: list[str], in_article: bool) -> int:
    if tag in ("html", "body"):
        return 0
    if tag in BESIDE_TAGS and not (tag == "header" and in_article):
        return BESIDE
    words = {part.lower() for name in names for part in _PART.findall(name)}
    if tag in ("article", "main") or tag[0] == "h" and tag[1:].isdigit():
        words &= {"comment", "comments", "respond", "related", "sponsored", "ad", "advert", "advertisement"}
    if words.isdisjoint(BESIDE_WORDS):
        return 0
    return HINTED if in_article and words.isdisjoint(NEVER_WORDS) else BESIDE


def blocks(page: str | None) -> list[Block]:
    """The text blocks of a page in order, white space collapsed and references decoded; empty ones left out."""
    out: list[Block] = []
    #: open block elements: (tag, key, beside, in an article)
    stack: list[tuple[str, str, int, bool]] = []
    #: open skipped elements, and the blocks open in them
    skipped: list[str] = []
    inner: list[str] = []
    parts: list[str] = []
    linked, in_link = 0, False

    def in_skipped(tag: str, end: bool) -> bool:
        """The tag belongs to the skipped elements that are open; if not, they end before it."""
        if end:
            for open_tags in (inner, skipped):
                if tag in open_tags:
                    while open_tags.pop() != tag:
                        pass
                    if not skipped:
                        inner.clear()
                    return True
            if not any(tag == open_tag for open_tag, *_ in stack):
                return True
        else:
            while skipped and tag in OPTIONS.get(skipped[-1], ()):
                skipped.pop()
            if tag in SKIPPED:
                skipped.append(tag)
                return True
            content = tag in BLOCKS and tag != "hr" and not set(skipped) - OPTIONS.keys()
            if not content and (tag not in ("article", "main") or not {"template", "noscript"}.isdisjoint(skipped)):
                if tag in BLOCKS and tag not in VOID:
                    inner.append(tag)
                return True
        skipped.clear()
        inner.clear()
        return False

    def flush() -> None:
        nonlocal linked, in_link
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                path = "/".join(key for _, key, _, _ in stack)
                out.append(Block(path, stack[-1][2] if stack else 0, text, min(linked, len(text))))
            parts.clear()
        linked, in_link = 0, False

    page = page or ""
    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at and not skipped:
            piece = page[at : m.start()]
            parts.append(piece)
            linked += len(piece) if in_link else 0
        at = m.end()
        tag = m[3]
        if not tag:
            continue
        tag = tag.lower()
        if tag in ("svg", "math") and m[4].endswith("/"):
            continue
        if skipped:
            if in_skipped(tag, bool(m[2])):
                continue
        elif tag in SKIPPED:
            if not m[2]:
                skipped.append(tag)
            continue
        if tag not in BLOCKS:
            if tag == "br":
                parts.append(" ")
            elif tag == "a":
                in_link = not m[2]
            continue
        flush()
        if m[2]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    del stack[depth:]
                    break
            continue
        if tag in VOID:
            continue
        if stack and stack[-1][0] == "p":
            stack.pop()
        for depth in range(len(stack) - 1, -1, -1):
            if tag in CLOSED_BY.get(stack[depth][0], ()):
                del stack[depth:]
                break
            if stack[depth][0] in SCOPE:
                break
        names = _names(m[4])
        beside = stack[-1][2] if stack else 0
        article = bool(stack) and stack[-1][3]
        key = tag + "".join(f".{re.sub('[0-9]+', '', name)}" for name in names[:1])
        beside = max(beside, _is_beside(tag, names, article))
        main = tag in ("article", "main") or any(n.lower() in MAIN_WORDS for n in names) or "main" in names and tag == "div"
        stack.append((tag, key.replace("/", "") + ("!" if main and not beside else ""), beside, article or main))
    if at < len(page) and not skipped:
        parts.append(page[at:])
        linked += len(page) - at if in_link else 0
    flush()
    return out


@dataclass
class Item:
    """A part of a wrapper: one slot, or a group of slots that may repeat, on ``pages`` pages."""

    paths: tuple[str, ...]
    repeated: bool = False
    optional: bool = False
    beside: int = 0
    pages: int = 1
    chars: int = 0
    linked: int = 0
    fixed: str | None = None  # the text where all pages agree on it; of a repeated group a digest of its texts


def _digest(inside: list[Block]) -> str:
    return "#" + hashlib.md5("\n".join(b.text for b in inside).encode("utf-8", "replace")).hexdigest()


def items_of(page: list[Block]) -> list[Item]:
    """The stream of a page with its repetitions made repeated groups."""
    return [item for item, _ in _items_with_blocks(page)]


def _items_with_blocks(page: list[Block]) -> list[tuple[Item, list[Block]]]:
    out: list[tuple[Item, list[Block]]] = []
    paths = [b.path for b in page]
    at = 0
    while at < len(page):
        best = (0, 1)  # slots covered beyond the first turn, width
        for width in range(1, GROUP + 1):
            turns = 1
            while paths[at + turns * width : at + (turns + 1) * width] == paths[at : at + width] and at + (turns + 1) * width <= len(page):
                turns += 1
            if turns > 1 and (turns - 1) * width > best[0]:
                best = ((turns - 1) * width, width)
        covered, width = best
        inside = page[at : at + covered + width]
        item = Item(
            tuple(paths[at : at + width]),
            repeated=covered > 0,
            beside=min(b.beside for b in inside),
            chars=sum(len(b.text) for b in inside),
            linked=sum(b.linked for b in inside),
            fixed=_digest(inside) if covered else inside[0].text,
        )
        out.append((item, inside))
        at += covered + width
    return out


def _met(a: Item, b: Item) -> Item:
    same = a.fixed is not None and a.fixed == b.fixed
    return Item(
        a.paths, a.repeated or b.repeated, a.optional or b.optional, min(a.beside, b.beside), a.pages + b.pages,
        a.chars + b.chars, a.linked + b.linked, a.fixed if same else None,
    )


def _alone(items: list[Item]) -> list[Item]:
    for item in items:
        item.optional = True
    return items


def aligned(a: list[Item], b: list[Item]) -> list[Item]:
    """The wrapper of what ``a`` and ``b`` are wrappers of, by a longest common subsequence of their groups."""
    if not a or not b:
        return _alone(a or b)
    left, right = [i.paths for i in a], [i.paths for i in b]
    if left == right:
        return [_met(x, y) for x, y in zip(a, b)]
    head = 0
    while head < min(len(a), len(b)) and left[head] == right[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and left[-1 - tail] == right[-1 - tail]:
        tail += 1
    x, y = left[head : len(a) - tail], right[head : len(b) - tail]
    longest = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        for j in range(len(y) - 1, -1, -1):
            longest[i][j] = longest[i + 1][j + 1] + 1 if x[i] == y[j] else max(longest[i + 1][j], longest[i][j + 1])
    out = [_met(p, q) for p, q in zip(a[:head], b[:head])]
    i = j = 0
    while i < len(x) and j < len(y):
        if x[i] == y[j]:
            out.append(_met(a[head + i], b[head + j]))
            i, j = i + 1, j + 1
        elif longest[i + 1][j] >= longest[i][j + 1]:
            out += _alone([a[head + i]])
            i += 1
        else:
            out += _alone([b[head + j]])
            j += 1
    out += _alone(a[head + i : len(a) - tail]) + _alone(b[head + j : len(b) - tail])
    return out + [_met(p, q) for p, q in zip(a[len(a) - tail :], b[len(b) - tail :])]


def expression(items: list[Item]) -> str:
    """The wrapper as a readable regular expression; ``#`` is a text slot."""
    shown = []
    for item in items:
        body = " ".join(f"<{p}>{'#' if item.fixed is None or item.repeated else json.dumps(item.fixed, ensure_ascii=False)}" for p in item.paths)
        shown.append(f"({body})" + "+" * item.repeated + "?" * item.optional if item.repeated or item.optional else body)
    return " ".join(shown)


@dataclass(frozen=True)
class Rule:
    """Which slots are main text: those under ``main``, or without it all but menus; fixed text is no main text.

    ``fixed`` has the paths and the text of template slots and groups, ``varied`` the paths of slots that a
    name would put beside the article and whose text differs from page to page.
    """

    main: str | None
    fixed: tuple[tuple[str, str], ...] = ()
    menus: tuple[str, ...] = ()
    varied: tuple[str, ...] = ()


def _under(path: str, main: str) -> bool:
    return (path + "/").startswith(main + "/")


def _heading(path: str) -> bool:
    key = path.rsplit("/", 1)[-1]
    return key[:1] == "h" and key[1:2].isdigit() and key[2:3] in ("", ".", "!")


def _menu(item: Item) -> bool:
    return item.linked >= LINKED * max(item.chars, 1)


def rule_of(items: list[Item]) -> Rule:
    """Of the article and main elements of a wrapper the one with the most text, and what the pages share and do not share."""
    chars: dict[str, int] = {}
    for item in items:
        if item.beside:
            continue
        path, keys = item.paths[0], []
        for key in path.split("/"):
            keys.append(key)
            if key.endswith("!"):
                prefix = "/".join(keys)
                chars[prefix] = chars.get(prefix, 0) + item.chars
    pages = max((i.pages for i in items), default=0)

    def template(share: float) -> tuple[tuple[str, str], ...]:
        """Fixed slots and groups that are on that share of the pages; a heading that pages share is still the article's."""
        enough = [i for i in items if i.fixed is not None and i.pages >= max(FIXED_PAGES, share * pages)]
        return tuple((" ".join(i.paths), i.fixed) for i in enough if not (chars and all(map(_heading, i.paths))))

    if chars:
        best = max(chars, key=lambda p: (chars[p], -len(p)))
        # an article within main, if it has most of it
        inner = [p for p in chars if p.startswith(best + "/") and 2 * chars[p] > chars[best]]
        if inner:
            best = max(inner, key=lambda p: (chars[p], -len(p)))
        within = [i for i in items if _under(i.paths[0], best) and i.pages >= FIXED_PAGES]
        # without a slot that varies these are copies of one page, which say nothing of a template
        if not any(i.fixed is None and i.beside < BESIDE for i in within):
            return Rule(best)
        varied = {p for i in within if i.beside == HINTED and i.fixed is None and not _menu(i) for p in i.paths}
        return Rule(best, template(FIXED_SHARE), (), tuple(sorted(varied)))
    return Rule(None, template(FIXED_SHARE_OUTSIDE), tuple({p for i in items if _menu(i) for p in i.paths}))


def main_text(page: str | None, rule: Rule | None) -> str:
    """The blocks of the article, joined by two line ends. A page unlike its host's wrapper is judged by itself."""
    found = blocks(page)
    items = _items_with_blocks(found)
    fixed = set(rule.fixed) if rule else set()
    free = [b for item, inside in items if (" ".join(item.paths), item.fixed) not in fixed for b in inside]
    if rule is not None and rule.main is not None:
        varied = set(rule.varied)
        inside = [b for b in found if _under(b.path, rule.main)]
        if any(not b.beside for b in inside):
            kept = [b for b in free if _under(b.path, rule.main) and (not b.beside or b.beside == HINTED and b.path in varied)]
            return "\n\n".join(b.text for b in kept)
    own = rule_of([item for item, _ in items])
    if own.main is not None:
        return "\n\n".join(b.text for b in found if not b.beside and _under(b.path, own.main))
    menus = set(rule.menus) & set(own.menus) if rule else set(own.menus)
    return "\n\n".join(b.text for b in free if not b.beside and b.path not in menus)


def host_of(url: Column) -> Column:
    """Lower-case host of a URL without user and port; empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url.cast("string"), r"^\s*(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _packed(items: list[Item]) -> str:
    return json.dumps([asdict(i) for i in items], ensure_ascii=False)


def _unpacked(text: str) -> list[Item]:
    return [Item(**{**i, "paths": tuple(i["paths"])}) for i in json.loads(text)]


def _aligned_runs(batches: Iterator[pd.DataFrame], copies: bool) -> Iterator[tuple[str, int, str]]:
    key, held, last = None, [], None
    for frame in batches:
        for host, part, wrapper in zip(frame["host"], frame["part"], frame["wrapper"]):
            if (host, part) == key:
                if not copies or wrapper != last:
                    held, last = aligned(held, _unpacked(wrapper)), wrapper
                continue
            if key is not None:
                yield *key, _packed(held)
            key, held, last = (host, part), _unpacked(wrapper), wrapper
    if key is not None:
        yield *key, _packed(held)


def _fold(copies: bool):
    """Rows (host, part, wrapper) sorted by host and part: one row for each, their wrappers aligned in turn.

    With ``copies`` the rows are also sorted by wrapper, and equal ones are copies that count as one page.
    """

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches_of(_aligned_runs(batches, copies), 500):
            yield pd.DataFrame(rows, columns=["host", "part", "wrapper"])

    return fold


def wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html", spread: int = SPREAD) -> DataFrame:
    """(host, wrapper): the aligned pages of each host, as JSON of Items.

    The pages of a host are dealt into ``spread`` parts, so that a host with a third of all pages is
    aligned in several tasks; a task holds one wrapper at a time. Then the parts are aligned. Copies of
    a page fall into one part and count as one page.
    """

    def streams_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            wrapper = [_packed(items_of(blocks(t))) for t in frame["text"]]
            yield pd.DataFrame({"host": frame["host"], "part": frame["part"], "wrapper": wrapper}).drop_duplicates()

    schema = "host string, part int, wrapper string"
    part = F.pmod(F.xxhash64(F.col(html_col)), F.lit(spread)).cast("int")
    texts = pages.filter(F.col(html_col).isNotNull()).select(
        host_of(F.col(url_col)).alias("host"), part.alias("part"), F.col(html_col).cast("string").alias("text")
    )
    streams = texts.mapInPandas(streams_of, schema)
    parts = streams.repartition("host", "part").sortWithinPartitions("host", "part", "wrapper").mapInPandas(_fold(True), schema)
    one = parts.select("host", F.lit(0).alias("part"), "wrapper", F.col("part").alias("turn"))
    whole = one.repartition("host").sortWithinPartitions("host", "turn").select("host", "part", "wrapper").mapInPandas(_fold(False), schema)
    return whole.select("host", "wrapper")


def extracted(pages: DataFrame, url_col: str = "url", html_col: str = "html", name: str = "main_text", spread: int = SPREAD) -> DataFrame:
    """``pages`` with the column ``name``, the main text; a column of that name is replaced.

    A null or empty page has empty text. Pages without a host (null URLs among them) share one wrapper.
    Repeated pages get equal texts. An empty table gives an empty result.
    """

    @pandas_udf("string")
    def rules(texts: pd.Series) -> pd.Series:
        return pd.Series([json.dumps(asdict(rule_of(_unpacked(t))), ensure_ascii=False) for t in texts], dtype=object)

    @pandas_udf("string")
    def extract(texts: pd.Series, found: pd.Series) -> pd.Series:
        known: dict[str, Rule] = {}
        out = []
        for text, packed in zip(texts, found):
            rule = None
            if packed is not None:
                if packed not in known:
                    read = json.loads(packed)
                    known[packed] = Rule(read["main"], tuple(map(tuple, read["fixed"])), tuple(read["menus"]), tuple(read["varied"]))
                rule = known[packed]
            out.append(main_text(text, rule))
        return pd.Series(out, dtype=object)

    host, rule = fresh_name(pages, "_host"), fresh_name(pages, "_rule")
    found = wrappers(pages, url_col, html_col, spread).select(F.col("host").alias(host), rules("wrapper").alias(rule))
    # written down, so that their size is known when the join is planned and the pages need no shuffle if it is small
    found = materialise(found, "rules")
    joined = pages.withColumn(host, host_of(F.col(url_col))).join(found, host, "left")
    columns = [F.col(f"`{c}`") for c in pages.columns if c.lower() != name.lower()]
    return joined.select(*columns, extract(F.col(html_col).cast("string"), F.col(rule)).alias(name))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = extracted(table(spark, sf_dir, "pages"), name="text")
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
