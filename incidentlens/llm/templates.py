"""Main text of web pages by deducing the template that pages of a host share.

A token of a page is an element, known by its path of tags and classes, or the text of
an element that occurs once.  A token's occurrence vector is how often it occurs in each
page of the host; vectors are never held, only an xor of hashes of (page, count), which
combines in any order, so that a host of any size is counted by partial aggregation.
Tokens with equal vectors are one equivalence class.  Classes on at least half of a
host's pages are valid if the tokens around theirs are; nested in one another they are
the template, and what lies inside their tokens are its slots.  From the page inwards
the slot is followed that holds most of the text that changes from page to page, links
not counted and text of article or main elements counted tenfold, until it is an article,
or no container inside it holds most of it.  Everything in that slot is extracted, whether
pages share it or not, but for elements that are named as something else (menus, forms,
adverts, comments and so on; the fixed values below).  If the slot is the whole page,
parts that nine of ten pages share are template and go too.

Hosts with fewer than four pages are judged together.  A page without the host's slot
is followed inwards by its own text alone.  Templates have one row per host, with the
rows a page's template can have; pages look them up by `lookup_join`.

Blocks are what stands between the borders of block elements, white space made one
blank each; `br` is white space.  Cases: a null or empty page, or one without main text,
has an empty text; a null or odd url counts as a small host; pages cut off in a tag, a
comment or a reference, unclosed and stray tags are read as a browser would; very long
pages are read whole, in time linear in their length; repeated rows give repeated rows;
an empty table gives no rows; other columns are not looked at."""

from __future__ import annotations

import re
from html import unescape

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.scale import lookup_join
from ..session import materialize

MIN_PAGES = 4  # of a host with a template of its own
SUPPORT = 0.5  # share of the pages that a template's token is on
MOST = 0.6  # share of a slot's text that makes one follow a slot inside it
FIXED = 0.9  # share of pages with equal text that makes a part fixed
STRONG = 10  # weight of text in article and main
TEMPLATES = 50_000  # hosts whose templates may be broadcast
FLUSH = 100_000  # counters held in a task

# Elements by what they do.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body button canvas caption center dd details dialog dir div dl dt"
    " fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend"
    " li main menu nav noscript object ol optgroup option p pre section select summary svg table tbody td"
    " template tfoot th thead tr ul video audio".split()
)
CONTAINER = set("html body div main article section center table tbody tr td".split())
SKIPPED = set(
    "head nav footer aside form button select dialog menu noscript template svg canvas object audio video"
    " optgroup option fieldset".split()
)
CLOSES = {  # an opening tag closes these, up to the nearest of those
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select", "optgroup"}),
}
# Words of class, id and role that name something other than main text.
OTHER = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner"
    " cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe paywall"
    " nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar topbar masthead"
    " footer sidebar aside widget widgets related recommended recommendations trending share sharing social"
    " comment comments disqus respond replies login signup search contentinfo complementary hidden".split()
)
OTHER_HEADER = {"header", "site-header", "page-top", "top"}
NEGATING = {"no", "has", "with", "without", "is"}

RAW = "script|style|textarea|title|xmp|iframe|noframes|noembed"
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({RAW})(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:_-]*)((?:[^<>"']|"[^"<]*"|'[^'<]*'|["'])*+)(?:>|(?=<)|\Z)"""
    r"|<[!?/][^<>]*(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(
    r"""(class|id|role|hidden|aria-hidden|style)(?![\w-])\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I
)
DIGITS = re.compile(r"[0-9]+")
WORD = re.compile(r"[a-z0-9]+")


def _named(attrs: str) -> tuple[list[str], str, bool]:
    """Class, id and role words, the path's part of them, whether it is hidden."""
    tokens, hidden = [], False
    for m in ATTRIBUTE.finditer(attrs):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name in ("class", "id", "role"):
            tokens += value.split()
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            hidden = True
        elif name == "style" and "display:none" in value.replace(" ", ""):
            hidden = True
    return tokens, DIGITS.sub("#", " ".join(sorted(tokens))), hidden


def _is_other(name: str, tokens: list[str], inside: bool) -> bool:
    """Whether an element is named as something other than main text."""
    if name in ("html", "body", "main"):
        return False
    if name in SKIPPED or (name == "header" and not inside):
        return True
    for token in tokens:
        words = WORD.findall(token)
        if not words or words[0] in NEGATING:
            continue
        if name == "article":
            if words[-1] == "comment":
                return True
        elif words[0] in OTHER or words[-1] in OTHER or (token in OTHER_HEADER and not inside):
            return True
    return False


class Page:
    """Elements (parent, path, tag) and blocks (element, text, weight) of a page."""

    def __init__(self, html: str):
        import xxhash

        self.parent, self.path, self.tag = [0], [0], [""]
        self.blocks: list[tuple[int, str, int]] = []
        stack = [(0, "", False, False)]  # element, tag, skipped, inside article or main
        pieces: list[str] = []
        linked = 0
        link = False

        def text(piece: str) -> None:
            nonlocal linked
            if piece and not stack[-1][2]:
                piece = unescape(piece)
                pieces.append(piece)
                if link:
                    linked += len(piece)

        def flush() -> None:
            nonlocal linked
            if pieces:
                block = " ".join("".join(pieces).split())
                if block:
                    at = next(s for s in reversed(stack) if s[0] is not None)
                    weight = max(len(block) - linked, 0) * (STRONG if at[3] else 1)
                    self.blocks.append((at[0], block, weight))
                pieces.clear()
            linked = 0

        def close(names: set, until: set) -> None:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][1] in names:
                    del stack[k:]
                    return
                if stack[k][1] in until:
                    return

        end = 0
        for m in MARKUP.finditer(html):
            text(html[end : m.start()])
            end = m.end()
            if m[3] is None:  # comment, raw text or declaration
                continue
            name = m[3].lower()
            block = name in BLOCK or "-" in name
            if m[2]:
                if name == "a":
                    link = False
                if name == "br":
                    text(" ")
                if not block and not (stack[-1][0] is None and stack[-1][1] == name):
                    continue
                if block:
                    flush()
                if name not in ("body", "html"):
                    for k in range(len(stack) - 1, 0, -1):
                        if stack[k][1] == name:
                            del stack[k:]
                            break
                continue
            if name == "br":
                text(" ")
            if name == "a":
                link = True
            if name in VOID:
                if block:  # a rule across the page
                    flush()
                continue
            if not block:
                if not m[4] or stack[-1][2]:
                    continue
                tokens, _, hidden = _named(m[4])
                if hidden or _is_other(name, tokens, stack[-1][3]):
                    stack.append((None, name, True, stack[-1][3]))
                continue
            flush()
            while stack[-1][0] is None:  # inline elements end with their block
                stack.pop()
            if stack[-1][1] == "p" or (stack[-1][1] == "head" and name != "noscript" and name != "template"):
                stack.pop()
            if name in CLOSES:
                close(*CLOSES[name])
            while stack[-1][0] is None:
                stack.pop()
            if name in ("html", "body") and any(s[1] == name for s in stack):
                continue
            element, _, skipped, inside = stack[-1]
            if skipped:
                stack.append((element, name, True, inside))
                continue
            tokens, classes, hidden = _named(m[4]) if m[4] else ([], "", False)
            other = hidden or _is_other(name, tokens, inside)
            label = f"{name}.{classes}" if classes else name
            self.parent.append(element)
            self.path.append(xxhash.xxh64_intdigest(label, self.path[element]) >> 1)
            self.tag.append(name)
            stack.append((len(self.parent) - 1, name, other, inside or name in ("article", "main")))
        text(html[end:])
        flush()

    def sums(self) -> tuple[list[int], list[int], list[bool]]:
        """Weight and text digest of everything inside each element, and whether it has an h1."""
        import xxhash

        weight, digest = [0] * len(self.parent), [0] * len(self.parent)
        title = [t == "h1" for t in self.tag]
        for element, block, w in self.blocks:
            weight[element] += w
            digest[element] = (digest[element] + xxhash.xxh64_intdigest(block)) & (1 << 63) - 1
        for k in range(len(self.parent) - 1, 0, -1):
            p = self.parent[k]
            weight[p] += weight[k]
            digest[p] = (digest[p] + digest[k]) & (1 << 63) - 1
            title[p] = title[p] or title[k]
        return weight, digest, title

    def text(self, chosen: set, dropped: set) -> str:
        """Blocks inside the chosen elements, without those inside the dropped ones."""
        kept = [0 in chosen]
        for k in range(1, len(self.parent)):
            kept.append((k in chosen or kept[self.parent[k]]) and k not in dropped)
        return "\n".join(block for element, block, _ in self.blocks if kept[element])


def follow(children: dict, tag, weight, value, title):
    """From the page (0) inwards to the slot that holds most of the text."""
    at = 0
    while tag[at] not in ("article", "main"):
        inside = children.get(at, [])
        rest = weight[at] - sum(weight[c] for c in inside)
        whole = sum(value[c] for c in inside) + rest * (value[at] / weight[at] if weight[at] else 0)
        able = [c for c in inside if tag[c] in CONTAINER or "-" in tag[c]]
        best = max(able, key=lambda c: value[c], default=None)
        if best is None or value[best] < MOST * whole or value[best] <= 0:
            break
        if title[at] and not title[best]:
            break
        at = best
    return at


def _of_page(page: Page) -> set:
    """The slot of a page judged by its own text."""
    weight, _, title = page.sums()
    children: dict = {}
    for k in range(1, len(page.parent)):
        children.setdefault(page.parent[k], []).append(k)
    return {follow(children, page.tag, weight, weight, title)}


# --- counting tokens

COUNTS = (
    "host string, path long, parent long, tag string, text long, pages long, vector long,"
    " weight long, title boolean"
)


def _count(batches):
    """Counters of tokens, added up within a task."""
    import pyarrow as pa
    import xxhash

    schema = pa.schema(
        [("host", pa.string()), ("path", pa.int64()), ("parent", pa.int64()), ("tag", pa.string()), ("text", pa.int64()),
         ("pages", pa.int64()), ("vector", pa.int64()), ("weight", pa.int64()), ("title", pa.bool_())]
    )
    held: dict = {}

    def out():
        rows = [(*k, *v) for k, v in held.items()]
        held.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], schema.field(i).type) for i in range(len(schema))], schema=schema
        )

    for batch in batches:
        for host, page_id, html in zip(*(batch.column(c).to_pylist() for c in ("host", "id", "html"))):
            page = Page(html or "")
            weight, digest, title = page.sums()
            name = xxhash.xxh64_intdigest(html or "", xxhash.xxh64_intdigest(page_id or ""))
            times: dict = {}
            for k, path in enumerate(page.path):
                times.setdefault(path, []).append(k)
            for path, ks in times.items():
                first = ks[0]
                once = digest[first] if len(ks) == 1 else None
                key = (host, path, page.path[page.parent[first]], page.tag[first], once)
                vector = xxhash.xxh64_intdigest(len(ks).to_bytes(8, "little"), name) - (1 << 63)
                old = held.get(key, (0, 0, 0, False))
                held[key] = (
                    old[0] + 1, old[1] ^ vector, old[2] + sum(weight[k] for k in ks), old[3] or any(title[k] for k in ks),
                )
            if len(held) >= FLUSH:
                yield out()
    if held:
        yield out()


def counted(pages: DataFrame) -> DataFrame:
    """Tokens of (host, id, html) by host, those of small hosts together (host null)."""
    sums = [
        F.sum("pages").alias("pages"),
        F.bit_xor("vector").alias("vector"),
        F.sum("weight").alias("weight"),
        F.max("title").alias("title"),
    ]
    texts = materialize(
        pages.select("host", "id", "html").mapInArrow(_count, COUNTS)
        .groupBy("host", "path", "parent", "tag", "text").agg(*sums)
    )
    once = F.when(F.col("text").isNotNull(), F.col("pages")).otherwise(0)
    tokens = texts.groupBy("host", "path", "parent", "tag").agg(
        *sums, F.sum(once).alias("once"), F.max(once).alias("same")
    )
    tokens = materialize(tokens)
    hosts = tokens.filter("path = 0").select(F.col("host").alias("h"), F.col("pages").alias("of"))
    known = tokens.join(hosts, F.col("host").eqNullSafe(F.col("h")))
    own = F.when(F.col("of") >= MIN_PAGES, F.col("host")).alias("host")
    return known.select(own, *[c for c in tokens.columns if c != "host"]).groupBy(
        "host", "path", "parent", "tag"
    ).agg(*sums, F.sum("once").alias("once"), F.max("same").alias("same"))


def classes(tokens: list[dict]) -> dict:
    """Paths of the valid equivalence classes, as a number per path: a class is the
    tokens with one occurrence vector, valid if the tokens around its own are valid."""
    number, out = {}, {}
    by_path = {t["path"]: t for t in tokens}

    def valid(path) -> bool:
        seen = []
        while path not in out and path in by_path and path != 0:
            seen.append(path)
            path = by_path[path]["parent"]
        sound = path == 0 or out.get(path) is not None
        for p in reversed(seen):
            t = by_path[p]
            out[p] = number.setdefault((t["pages"], t["vector"]), len(number)) if sound else None
        return sound

    if 0 in by_path:
        out[0] = number.setdefault((by_path[0]["pages"], by_path[0]["vector"]), 0)
    for path in by_path:
        valid(path)
    return {p: c for p, c in out.items() if c is not None}


def _template(key, table):
    """A host's template: the path of the main slot and the paths of fixed parts."""
    import pyarrow as pa

    tokens = table.to_pylist()
    of = classes(tokens)
    tokens = [t for t in tokens if t["path"] in of]
    tag = {t["path"]: t["tag"] for t in tokens}
    weight = {t["path"]: t["weight"] for t in tokens}
    title = {t["path"]: t["title"] for t in tokens}
    # classes whose tokens occur once in a page can be slots; what all pages share counts little
    shared = {t["path"]: t["same"] / t["pages"] for t in tokens}
    once = {t["path"] for t in tokens if t["once"] == t["pages"]}
    value = {p: w * (1.001 - shared[p]) if p in once else w for p, w in weight.items()}
    children: dict = {}
    for t in tokens:
        if t["path"] != 0:
            children.setdefault(t["parent"], []).append(t["path"])
    slots = {p: tag[p] if p in once else "" for p in tag}
    main = follow(children, slots, weight, value, title) if tokens else 0
    fixed = [p for p in once if p not in (0, main) and shared[p] >= FIXED] if tag.get(main, "") in ("", "html", "body") else []
    pages = max((t["pages"] for t in tokens if t["path"] == 0), default=0)
    return pa.table(
        {
            "host": pa.array([table.column("host")[0].as_py()], pa.string()),
            "main": pa.array([main], pa.int64()),
            "fixed": pa.array([fixed if pages >= MIN_PAGES else []], pa.list_(pa.int64())),
            "pages": pa.array([pages], pa.int64()),
        }
    )


def templates(pages: DataFrame) -> DataFrame:
    """host, main (path), fixed (paths), pages, from (host, id, html)."""
    tokens = materialize(counted(pages))
    hosts = tokens.filter("path = 0").select(F.col("host").alias("h"), F.col("pages").alias("of"))
    often = tokens.join(hosts, F.col("host").eqNullSafe(F.col("h"))).filter(F.col("pages") >= SUPPORT * F.col("of"))
    return often.drop("h", "of").groupBy("host").applyInArrow(
        _template, "host string, main long, fixed array<long>, pages long"
    )


# --- extraction


def _extract(batches):
    import pyarrow as pa

    for batch in batches:
        texts = []
        for html, main, fixed in zip(*(batch.column(c).to_pylist() for c in ("html", "main", "fixed"))):
            page = Page(html or "")
            chosen = {k for k, path in enumerate(page.path) if path == main} if main is not None else set()
            # the slot is the page itself where the template found none
            drop = {k for k, path in enumerate(page.path) if path in set(fixed or ())}
            if not chosen or main == 0:
                chosen = _of_page(page)
                drop -= chosen
            texts.append(page.text(chosen, drop))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("url"), pa.array(texts, pa.string())], ["id", "url", "text"]
        )


def host_of(url: Column) -> Column:
    """The host of a url, lower case, without user and port; null if there is none."""
    found = F.regexp_extract(F.lower(url), r"^\s*[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(found != "", found)


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url and the main text of every page."""
    id_type = pages.schema[page_id].dataType
    rows = pages.select(
        F.col(page_id).cast("string").alias("id"),
        F.col(url).alias("url"),
        host_of(F.col(url)).alias("host"),
        F.col(html).alias("html"),
    )
    found = materialize(templates(rows.select("host", "id", "html")))
    pool = found.filter("host is null").select("main", "fixed").first()
    own = found.filter("host is not null")
    joined = lookup_join(rows, own, ["host"], "pages", max_rows=TEMPLATES)
    if pool:
        few = F.col("main").isNull()
        joined = joined.withColumn("fixed", F.when(few, F.array(*map(F.lit, pool.fixed)).cast("array<long>")).otherwise(F.col("fixed")))
        joined = joined.withColumn("main", F.coalesce("main", F.lit(pool.main).cast("long")))
    texts = joined.select("id", "url", "html", "main", "fixed").mapInArrow(_extract, "id string, url string, text string")
    return texts.select(F.col("id").cast(id_type).alias("page_id"), "url", "text")


def query(spark, sf_dir: str) -> DataFrame:
    from .common import read

    found = main_text(read(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
