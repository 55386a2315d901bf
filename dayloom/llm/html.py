"""Main text of web pages by host consensus.

Every page's containers are scored by the text of their blocks, less that of links; each page votes for the
generalised path (tags with their classes, numbers left out) of its best container, weighted by its score. Votes are
added up per host in Spark, and every page is extracted again from the containers on the paths its host has chosen:
those with enough of its pages. Of several it is the path that holds most of the page's text times its votes, so a host may
have several templates. A page that has none of them, or no host, keeps its own best container. From there the
article is read whole: with the headline, lead and end that stand around the container in the same element.

Defined cases: null or empty html gives the empty text; pages without an url have no host; broken markup is read as far
as it goes; repeated rows each get their text; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayloom.llm.common import per_slice
from dayloom.operators.sizes import broadcast_if_small
from dayloom.session import written

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
CONTAINERS = {"body", "div", "article", "section", "main", "td", "center", "figure", "blockquote", "html"}
BLOCKS = CONTAINERS | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd", "pre", "table",
                       "thead", "tbody", "tfoot", "tr", "th", "caption", "figcaption", "address", "hgroup", "details",
                       "summary", "hr", "header", "footer", "nav", "aside", "form", "fieldset", "head", "noscript"}
#: Never part of the article; page furniture and controls.
SKIPPED = {"nav", "footer", "aside", "form", "script", "style", "noscript", "template", "button", "select", "option",
           "input", "textarea", "svg", "math", "canvas", "object", "iframe", "head", "title", "dialog", "menu", "label",
           "audio", "video", "fieldset", "noembed", "noframes", "xmp"}
#: Words in a class, an id or a role that mark furniture.
FURNITURE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookie\w*|consent|gdpr|notice|popup|modal|"
    r"overlay|newsletter|subscri\w*|signup|comment\w*|disqus|replies|respond|sidebar|side-bar|aside|rail|widget\w*|"
    r"nav\w*|menu\w*|breadcrumb\w*|pagination|pager|footer\w*|header|masthead|topbar|toolbar|share\w*|sharing|social\w*|"
    r"related\w*|recommend\w*|outbrain|taboola|login|search\w*|complementary|contentinfo|dialog|alert)(?:$|[\s_-])", re.I)
#: What readers write is never taken for the article while other text is there.
COMMENTS = re.compile(r"(?:^|[\s_-])(?:comment\w*|disqus|replies|respond)(?:$|[\s_-])", re.I)
#: The head of an article is part of it.
ARTICLE_HEADER = re.compile(r"(?:^|(?<=\s))(?:article|post|entry|story)[_-]+header(?=$|\s)", re.I)
#: An open element of the first kind ends where one of the second begins.
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"},
            "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"},
            "option": {"option"}, "head": {"body"}}
BOUNDARY = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
            "option": {"select"}, "head": set()}
#: Words in a class that name an article's own element.
ARTICLE_BOX = re.compile(r"(?:^|[\s_-])(?:h?article|post|h?entry|story)(?:$|[\s_-])", re.I)
#: Share of the best path's votes that another path of the host needs to be taken too.
RUNNER_UP = 0.05
#: Share of its host's pages, and pages, that a path needs at least; so a host has 1 / LEAST_SHARE paths at most.
LEAST_SHARE, LEAST_PAGES = 0.01, 2


class Block:
    """Text of one block: pieces, its nearest containers from the inside out, the elements around it that are furniture
    by their class, and characters inside links."""

    __slots__ = ("pieces", "inside", "marked", "linked", "heading", "text")

    def __init__(self, inside: tuple[int, ...], marked: frozenset[int], heading: bool):
        self.pieces, self.inside, self.marked, self.linked, self.heading, self.text = [], inside, marked, 0, heading, ""


def generalised(tag: str, kind: str) -> str:
    classes = sorted({re.sub(r"\d+", "#", c) for c in kind.lower().split()})
    return ".".join([tag, *classes])


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(text)}


def is_furniture(tag: str, attrs: dict[str, str], inside: tuple[str, ...]) -> bool:
    if tag in SKIPPED or "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true":
        return True
    if tag == "header" and "article" not in inside:
        return True
    return "display:none" in attrs.get("style", "").replace(" ", "").lower()


def is_marked(tag: str, attrs: dict[str, str]) -> bool:
    """Whether a class, an id or a role marks furniture."""
    if tag in ("html", "body", "article", "main"):
        return False
    return any(attrs.get(k) and FURNITURE.search(ARTICLE_HEADER.sub("", attrs[k])) for k in ("class", "id", "role"))


def visible(blocks: list[Block], comments: list[bool], mains: list[tuple[str, frozenset[int]]]) -> list[Block]:
    """The blocks that no marked element hides.

    A marked element hides nothing if it holds ``main``, or without one most of the page's text that is no link, or ``article`` where
    none stands outside marked elements and at least half as much text as those leave. If nothing is left, none hides.
    """
    hiding = set(range(len(comments)))
    own = [max(0, len(b.text) - b.linked) for b in blocks]
    held = [0] * len(comments)
    for block, n in zip(blocks, own, strict=True):
        for m in block.marked:
            held[m] += n
    total = sum(own)
    left = sum(n for b, n in zip(blocks, own, strict=True) if not b.marked)
    outside = any(not around for _, around in mains)
    inside = {tag: [0] * len(comments) for tag in ("article", "main")}
    for tag, around in mains:
        for m in around:
            inside[tag][m] += 1
    all_mains = sum(tag == "main" for tag, _ in mains)
    for m in range(len(comments)):
        most = 2 * held[m] > total and inside["main"][m] == all_mains
        article = inside["article"][m] and not outside and 2 * held[m] >= left
        if not comments[m] and (most or inside["main"][m] or article):
            hiding.discard(m)
    return [b for b in blocks if not hiding & b.marked] or blocks


def blocks_of(html: str) -> tuple[list[Block], list[str]]:
    """The page's blocks in order, without furniture, and the path of each container by its number."""
    blocks: list[Block] = []
    paths: list[str] = []
    stack: list[tuple[str, int, bool, int]] = []  # tag, container's number or -1, whether it is furniture, its mark or -1
    marked: frozenset[int] = frozenset()
    comments: list[bool] = []  # of each marked element
    mains: list[tuple[str, frozenset[int]]] = []  # article and main with the marked elements around them
    skipped = links = 0
    current: Block | None = None
    at = 0

    def close(down_to: int) -> None:
        nonlocal skipped, links, current, marked
        while len(stack) > down_to:
            tag, _, furniture, mark = stack.pop()
            skipped -= furniture
            links -= tag == "a"
            marked -= {mark}
            if tag in BLOCKS or mark >= 0:
                current = None

    def add(text: str) -> None:
        nonlocal current
        if skipped or not text:
            return
        if current is None:
            if text.isspace():
                return
            tags = [t for t, *_ in stack]
            heading = any(t[0] == "h" and t[1:].isdigit() for t in tags if len(t) == 2)
            current = Block(tuple(n for _, n, *_ in reversed(stack) if n >= 0), marked, heading)
            blocks.append(current)
        current.pieces.append(unescape(text) if "&" in text else text)
        if links:
            current.linked += len(text.strip())

    for m in TOKEN.finditer(html):
        if m.start() < at:
            continue
        add(html[at:m.start()])
        at = m.end()
        if m["cdata"] is not None:
            add(m["cdata"])
        if not m["tag"]:
            continue
        tag = m["tag"].lower()
        if m["end"]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    close(depth)
                    break
                if tag not in BLOCKS and stack[depth][0] in BLOCKS:
                    break  # an inline end tag does not close a block
            if tag in BLOCKS:
                current = None
            continue
        if tag in BLOCKS:
            for depth in range(len(stack) - 1, -1, -1):  # a block ends an open paragraph and what stands in it
                if stack[depth][0] == "p" or stack[depth][0][0] == "h" and stack[depth][0][1:].isdigit() and tag == "p":
                    close(depth)
                    break
                if stack[depth][0] in BLOCKS:
                    break
            for depth in range(len(stack) - 1, -1, -1):
                open_tag = stack[depth][0]
                if tag in ENDED_BY.get(open_tag, ()):
                    close(depth)
                    break
                if any(open_tag in BOUNDARY[k] for k, by in ENDED_BY.items() if tag in by):
                    break
            current = None
        if tag in VOID or m["attrs"].endswith("/") and tag not in BLOCKS | RAW:
            if tag in ("br", "wbr", "img", "hr"):
                add(" " if tag == "br" and current is not None else "")
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*[^>]*>", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        attrs = attributes(m["attrs"]) if m["attrs"] else {}
        furniture = is_furniture(tag, attrs, tuple(t for t, *_ in stack))
        number = mark = -1
        if not skipped and not furniture and is_marked(tag, attrs):
            if tag in BLOCKS or current is None:
                mark = len(comments)
                comments.append(any(COMMENTS.search(attrs.get(k, "")) for k in ("class", "id", "role")))
                marked |= {mark}
            else:
                furniture = True  # inside a line of text
        if tag in ("article", "main") and not skipped and not furniture:
            mains.append((tag, marked))
        if tag in CONTAINERS and not skipped and not furniture:
            above = next((paths[n] for _, n, *_ in reversed(stack) if n >= 0), "")
            paths.append((above + ">" if above else "") + generalised(tag, attrs.get("class", "")))
            number = len(paths) - 1
        stack.append((tag, number, furniture, mark))
        skipped += furniture
        links += tag == "a"
    add(html[at:])
    for block in blocks:
        block.text = " ".join("".join(block.pieces).split())
    return visible([b for b in blocks if b.text], comments, mains), paths


def container_scores(blocks: list[Block], paths: list[str]) -> list[float]:
    """Text of each container's blocks that is no link, in full for the nearest and in part for those around it.

    What ``article`` and ``main`` hold counts half as much again.
    """
    scores = [0.0] * len(paths)
    for block in blocks:
        text = block.text
        own = max(0, len(text) - 2 * block.linked) * (0.5 if block.heading else 1.0)
        if not block.heading and len(text) < 25 and not text.endswith((".", "!", "?", ":", "…")):
            own *= 0.3
        for distance, number in enumerate(block.inside):
            scores[number] += own * 0.6 ** distance
    return [s * (1.5 if p.rpartition(">")[2].split(".")[0] in ("article", "main") else 1) for s, p in zip(scores, paths, strict=True)]


def best_path(html: str) -> tuple[str, float]:
    blocks, paths = blocks_of(html)
    scores = container_scores(blocks, paths)
    if not scores or max(scores) <= 0:
        return "", 0.0
    best = max(range(len(scores)), key=lambda i: (scores[i], -i))
    return paths[best], scores[best]


def unlinked(blocks: list[Block]) -> int:
    return sum(max(0, len(b.text) - b.linked) for b in blocks)


def belongs(block: Block) -> bool:
    """Whether a block beside an article's box is read with it: a heading, or text that is not mostly links."""
    return block.heading or 2 * block.linked <= len(block.text)


def sentence(block: Block) -> bool:
    return block.heading or len(block.text) >= 25 and block.text.endswith((".", "!", "?", ":", "…", '"', "”", "»"))


def whole_article(blocks: list[Block], paths: list[str], boxes: set[int]) -> list[Block]:
    """The blocks of the boxes and of what stands around them in the same article, in page order.

    Climbs while the element around holds the article's own head, lead or end. ``article``, ``main`` and elements whose
    class names an article give all they hold, others only what stands in them directly or in sections, figures and quotes;
    the body gives headings and sentences of its own if it has no other box. Lists of links are left out.
    """
    above = {inner: outer for block in blocks for inner, outer in zip(block.inside, block.inside[1:], strict=False)}
    kept = {id(b) for b in blocks if any(n in boxes for n in b.inside)}
    while len(parents := {above.get(n) for n in boxes}) == 1 and (outer := parents.pop()) is not None:
        tag = paths[outer].rpartition(">")[2].split(".")[0]
        if tag == "html" or tag == "body" and any(paths[n].rpartition(">")[2].split(".")[0] in ("article", "main") for n in boxes):
            break
        beside: dict[int, list[Block]] = {}  # by the box beside ours that holds them, or the element itself
        for block in blocks:
            if outer in block.inside and not any(n in boxes for n in block.inside):
                place = block.inside.index(outer)
                beside.setdefault(block.inside[place - 1] if place else outer, []).append(block)
        direct = beside.pop(outer, [])
        others = {n: box for n, box in beside.items() if 2 * sum(b.linked for b in box) <= sum(len(b.text) for b in box)}
        kinds = {paths[n].rpartition(">")[2].split(".")[0] for n in others}
        if tag == "body":
            if others or not all(map(sentence, direct)):
                break
        elif tag not in ("article", "main") and not ARTICLE_BOX.search(paths[outer].rpartition(">")[2].replace(".", " ")) \
                and kinds - {"section", "figure", "blockquote"}:
            break
        kept |= {id(b) for b in direct if belongs(b)}
        kept |= {id(b) for box in others.values() for b in box}
        boxes = {outer}
    return [b for b in blocks if id(b) in kept]


def extract(html: str, chosen: list[str], votes: list[int] | None = None) -> str:
    """Blocks of the article around the boxes on the chosen path that holds most of the page, weighed by its votes, in page
    order; where the page has none of the paths, around its own best box."""
    blocks, paths = blocks_of(html)
    weight = dict(zip(chosen, votes or [1] * len(chosen), strict=True))
    of_path: dict[str, set[int]] = {}
    for block in blocks:
        for n in block.inside:
            if paths[n] in weight:
                of_path.setdefault(paths[n], set()).add(n)
    if of_path:
        held = {p: unlinked([b for b in blocks if any(n in boxes for n in b.inside)]) for p, boxes in of_path.items()}
        path = max(of_path, key=lambda p: ((held[p] + 1) * weight[p], weight[p], -chosen.index(p)))
        return "\n\n".join(b.text for b in whole_article(blocks, paths, of_path[path]))
    scores = container_scores(blocks, paths)
    if not scores or max(scores) <= 0:
        return "\n\n".join(b.text for b in blocks)
    best = max(range(len(scores)), key=lambda i: (scores[i], -i))
    return "\n\n".join(b.text for b in whole_article(blocks, paths, {best}))


def with_host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#:]*)", 1))
    return pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).alias("html"), host.alias("host"))


def consensus(pages: DataFrame) -> DataFrame:
    """host, its chosen paths, best first, and their pages. Votes are added up in each task first, so a path of a hot host is a row per task.

    Paths are weighed against totals per host, and only those that win are gathered: 1 / LEAST_SHARE of them at most.
    """

    def vote(part: pa.RecordBatch) -> pa.RecordBatch:
        votes = [best_path(h) for h in part.column("html").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [part.column("host"), pa.array([p for p, _ in votes], pa.string()),
             pa.array([s for _, s in votes], pa.float64())], ["host", "path", "score"])

    votes = with_host(pages).select("host", "html").where("host != ''").mapInArrow(
        per_slice(vote, "html"), "host string, path string, score double").where("path != ''")
    summed = written(votes.groupBy("host", "path").agg(F.count(F.lit(1)).alias("pages"), F.sum("score").alias("score")), "votes")
    totals = written(summed.groupBy(F.col("host").alias("of")).agg(F.sum("pages").alias("total"), F.max("pages").alias("most")), "totals")
    enough = F.greatest(F.lit(LEAST_PAGES), RUNNER_UP * F.col("most"), LEAST_SHARE * F.col("total"))
    taken = summed.where(F.col("pages") >= LEAST_PAGES).join(broadcast_if_small(totals), F.col("host") == F.col("of")).where(
        F.col("pages") >= enough)
    place = F.struct((-F.col("pages")).alias("pages"), (-F.col("score")).alias("score"), "path")
    ranked = taken.groupBy("host").agg(F.array_sort(F.collect_list(place)).alias("ranked"))
    return ranked.select("host", F.transform("ranked", lambda x: x["path"]).alias("paths"),
                         F.transform("ranked", lambda x: -x["pages"]).alias("votes"))


def main_text(pages: DataFrame) -> DataFrame:
    """Per row: page_id, url, text, n_chars (code points)."""
    chosen = written(consensus(pages), "paths").withColumnRenamed("host", "voted")
    joined = with_host(pages).join(broadcast_if_small(chosen), F.col("host") == F.col("voted"), "left").select(
        "page_id", "url", "html", "paths", "votes")

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = [extract(h, p or [], v or []) for h, p, v in zip(
            *(part.column(c).to_pylist() for c in ("html", "paths", "votes")), strict=True)]
        return pa.RecordBatch.from_arrays(
            [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in joined.schema}
    return joined.mapInArrow(per_slice(run, "html"), f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
