"""Main text of web pages by template deduction from equivalence classes of tags.

A tag occurs with its path, classes and id; that is a token. Tokens whose counts over the
pages of a host are the same vector, and that lie below one of them, form an equivalence
class, if it is large and frequent enough. It is valid if on all pages its tokens come in
one order, over and over, and belongs to the template if its occurrences nest with those of
the classes taken before it (more pages, then more tokens): none cross, and all lie in the
same gap of the other or all outside it. Text lies in the slots between template tags.

Outside articles the template decides: slots whose text is the same on all pages while other
text differs, or that are mostly links, are left out. If the host has no more text in
articles than in its other slots, both are main text; else the articles are. What is in
boilerplate elements or has boilerplate names is left out, whatever the template says.

A vector is kept as the sum of a hash of (page, count): it merges, and two tokens with
different vectors have the same sum only by chance. So a host with a third of all pages is a
few rows per task.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.store import map_arrow, written

MIN_PAGES, MIN_TOKENS = 3, 3  # support and size of a class that counts
# A quote opens a value only after an equals sign; elsewhere it is a character of the tag.
TAG = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][a-zA-Z0-9:-]*)"
    r"((?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|[=\"'])*+)(?:>|\Z))", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
# Elements by what HTML makes of them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe title svg object".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
# A start tag that ends an open one.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CLOSES_P = BLOCK - {"option", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "li", "dt", "dd", "html", "body"}
BOILERPLATE = frozenset("head nav footer aside button select menu dialog".split()) | RAW
MAIN = frozenset(("article", "main"))
BOILERPLATE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner banners sponsor sponsored promo promotion sidebar side "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription comment comments "
    "respond reply replies disqus share sharing social related recommended breadcrumb breadcrumbs pagination pager menu nav "
    "navbar navigation footer header masthead topbar copyright widget widgets login signup search form complementary "
    "contentinfo dialog toolbar skip".split())
MAIN_NAMES = frozenset("article main".split())
# Elements that hold prose themselves: a part of their name does not make them boilerplate.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre blockquote figcaption caption code cite em strong b i q sub sup abbr mark".split())
# Boxes of this kind hold articles of their own.
TEASERS = frozenset("ad ads advert advertisement promo sponsor sponsored related recommended comment comments respond reply replies disqus".split())


def names_in(attributes: str) -> list[str]:
    """Words of class, id and role, lower-cased, digits as #."""
    found = []
    for _, a, b, c in ATTRIBUTE.findall(attributes):
        found += re.sub(r"[0-9]+", "#", (a or b or c).lower()).replace("/", "|").split()
    return found


def walk(source: str) -> Iterator[tuple[str, list[str], list[list[str]], str]]:
    """Events of a page: ('open' or 'text' or 'break', path of tokens, names by element, text).
    The lists are the walker's own and change as it goes on."""
    path: list[str] = []
    names: list[list[str]] = []
    tags: list[str] = []
    at, end = 0, len(source)
    while at < end:
        m = TAG.search(source, at)
        if m is None:
            yield "text", path, names, source[at:]
            return
        if m.start() > at:
            yield "text", path, names, source[at : m.start()]
        at = m.end()
        tag = (m.group(2) or "").lower()
        if not tag:
            continue
        block = tag in BLOCK
        if m.group(1):
            if tag in tags:
                while tags:
                    last = tags.pop()
                    path.pop()
                    names.pop()
                    block = block or last in BLOCK
                    if last == tag:
                        break
            if block:
                yield "break", path, names, ""
            continue
        closed = CLOSES.get(tag, {"p"} if tag in CLOSES_P else ())
        if closed:
            # Up to the nearest such element, unless a container of its kind lies between.
            for i in range(len(tags) - 1, -1, -1):
                if tags[i] in closed:
                    del tags[i:], path[i:], names[i:]
                    break
                if tags[i] in ("ul", "ol", "dl", "table", "div", "article", "section", "body", "td", "li", "aside", "nav", "footer", "main", "form"):
                    break
        if block:
            yield "break", path, names, ""
        if tag == "br":
            yield "text", path, names, " "
        if tag in VOID:
            continue
        own = names_in(m.group(3) or "")
        tags.append(tag)
        path.append(f"{path[-1] if path else ''}/{tag}{''.join('.' + n for n in own)}")
        names.append([tag, *own])
        yield "open", path, names, ""
        if (m.group(3) or "").endswith("/") and tag in RAW:
            tags.pop(), path.pop(), names.pop()
        elif tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(source, at)
            at = close.end() if close else end
            tags.pop(), path.pop(), names.pop()


def scan(source: str) -> tuple[list[tuple[str, str, str]], dict[str, tuple[str, list[str]]], set[str]]:
    """Events of a page as (kind, token, text); parent and names by token, parents first; the
    tokens that hold an article or main element that is no teaser."""
    events: list[tuple[str, str, str]] = []
    elements: dict[str, tuple[str, list[str]]] = {}
    holds: set[str] = set()
    for kind, path, names, text in walk(source):
        token = path[-1] if path else ""
        if kind == "open":
            own = names[-1]
            if token not in elements:
                elements[token] = (path[-2] if len(path) > 1 else "", own)
            if (own[0] in MAIN or not MAIN_NAMES.isdisjoint(own[1:])) and not teaser(own):
                holds.update(path[:-1])
        events.append((kind, token, text))
    return events, elements, holds


def parts_of(own: list[str]) -> set[str]:
    return {w for n in own[1:] for w in re.split(r"[-_]+", n)}


def teaser(own: list[str]) -> bool:
    return any(re.split(r"[-_]+", n)[0] in TEASERS for n in own[1:])


def weighed(own: list[str]) -> bool:
    """Whether the label of an element depends on its share of the text."""
    return own[0] == "form" or not parts_of(own).union(own[1:]).isdisjoint(BOILERPLATE_NAMES | MAIN_NAMES) or teaser(own)


def masses(events: list[tuple[str, str, str]], elements: dict[str, tuple[str, list[str]]]) -> dict[str, int]:
    """Characters within each token, without links and boilerplate elements; of the page under ''."""
    found = dict.fromkeys(["", *elements], 0)
    for kind, token, text in events:
        if kind == "text":
            found[token] += len("".join(text.split()))
    for token, (parent, own) in reversed(elements.items()):
        if own[0] == "a" or own[0] in BOILERPLATE:
            found[token] = 0
        found[parent] += found[token]
    return found


def label(own: list[str], above: str, holds: bool, half: bool) -> str:
    """'main' within an article, 'boilerplate' within an element or class of that kind, else
    what is around it. ``holds``: an article is below; ``half``: at least half of the text is.

    A form, or a name of which only a part is of that kind, may be a wrapper: it is
    boilerplate unless it holds an article or half of the text. With a whole name, or the
    name of a teaser box, it takes both. Of prose elements only whole names and those of
    teasers count. A header or label within an article is part of it."""
    tag, whole, parts = own[0], set(own[1:]), parts_of(own)
    if tag in PROSE and not teaser(own):
        parts = whole
    if above == "boilerplate" or tag in BOILERPLATE or (tag == "label" and above != "main"):
        return "boilerplate"
    if tag in MAIN or whole & MAIN_NAMES or (half and parts & MAIN_NAMES):
        hidden = teaser(own) or (tag not in MAIN and whole & BOILERPLATE_NAMES)
        return "boilerplate" if hidden and not half else "main"
    if tag == "header" and above != "main":
        return "boilerplate"
    names = BOILERPLATE_NAMES - ({"header"} if above == "main" else set())
    if tag in ("html", "body") or not (tag == "form" or (whole | parts) & names):
        return above
    wrapper = holds and half if whole & names or teaser(own) else holds or half
    return above if wrapper else "boilerplate"


def labels_of(elements: dict[str, tuple[str, list[str]]], holds: set[str], wrappers: set[str]) -> dict[str, str]:
    found = {"": "other"}
    for token, (parent, own) in elements.items():
        found[token] = label(own, found[parent], token in holds, token in wrappers)
    return found


def halves(mass: dict[str, int]) -> set[str]:
    return {t for t, n in mass.items() if t and n and 2 * n >= mass[""]}


def host_of(url: str | None) -> str:
    m = re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m.group(1).lower() if m else ""


def _occurrences(pages: DataFrame) -> DataFrame:
    """Per host and token, merged over the pages of a batch: pages, sum of hashes of (page,
    count); if its label depends on that, the text within it and the text of those pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            found: dict[tuple[str, str], list[int]] = {}
            for page, url, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                counts: dict[str, int] = {}
                events, elements, _ = scan(source.as_py() or "")
                for kind, token, _ in events:
                    if kind == "open":
                        counts[token] = counts.get(token, 0) + 1
                mass = masses(events, elements)
                host = host_of(url)
                for token, n in counts.items():
                    vector = xxhash.xxh3_64_intdigest(f"{page} {n}") >> 24  # 40 bits, so sums stay exact
                    inside, whole = (mass[token], mass[""]) if weighed(elements[token][1]) else (0, 0)
                    own = found.get((host, token))
                    if own is None:
                        found[host, token] = [1, vector, inside, whole]
                    else:
                        own[0] += 1
                        own[1] += vector
                        own[2] += inside
                        own[3] += whole
            yield merged(found, OCCURRENCES)

    return map_arrow(pages, run, OCCURRENCES)


def merged(found: dict[tuple, list[int]], schema: str) -> pa.RecordBatch:
    """Keys and values as columns of a schema string."""
    types = {"string": pa.string(), "long": pa.int64()}
    names = [x.split() for x in schema.split(", ")]
    rows = list(zip(*((*k, *v) for k, v in found.items()))) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(rows, names)], names=[n for n, _ in names])


def classes_of(rows: list[dict]) -> tuple[dict[str, int], list[tuple[int, int]]]:
    """Class by token; (pages, tokens) by class. ``rows``: token, vector, pages. Of tokens with
    one vector, those below the same outermost one are a class."""
    groups: dict[tuple, list[str]] = {}
    roots: set[tuple] = set()
    for pages, vector, token in sorted((r["pages"], r["vector"], r["token"]) for r in rows):
        cuts = [i for i, c in enumerate(token) if c == "/" and i] + [len(token)]
        root = next((token[:i] for i in cuts if (pages, vector, token[:i]) in roots), token)
        roots.add((pages, vector, root))
        groups.setdefault((pages, vector, root), []).append(token)
    large = sorted((k for k, v in groups.items() if len(v) >= MIN_TOKENS), key=lambda k: (-k[0], -len(groups[k]), k[2], k[1]))
    return {t: i for i, k in enumerate(large) for t in groups[k]}, [(k[0], len(groups[k])) for k in large]


def nesting(opened: list[str], classes: dict[str, int], sizes: list[tuple[int, int]]) -> dict[tuple[int, int], list[int]]:
    """Of a page, by (class, class): its occurrences, least and greatest hash of its order; by
    (outer, inner): how often the inner starts within the outer, least and greatest gap. The
    greatest is above the least where tokens are out of order or occurrences cross."""
    import xxhash

    order: dict[int, list[str]] = {}
    count: dict[int, int] = {}
    broken: set[int] = set()
    stack: list[int] = []
    found: dict[tuple[int, int], list[int]] = {}
    for token in opened:
        own = classes.get(token)
        if own is None:
            continue
        size, i = sizes[own][1], count.get(own, 0)
        cycle = order.setdefault(own, [])
        if i < size:
            if token in cycle:
                broken.add(own)
            cycle.append(token)
        elif cycle[i % size] != token:
            broken.add(own)
        if i % size == 0 or own not in stack:
            for outer in stack:
                gap = count[outer] % sizes[outer][1]
                pair = found.setdefault((outer, own), [0, gap, gap])
                pair[0] += 1
                pair[1], pair[2] = min(pair[1], gap), max(pair[2], gap)
            stack.append(own)
        while stack[-1] != own:
            found[own, stack[-1]] = [1, -1, sizes[own][1]]
            stack.pop()
        count[own] = i + 1
        if i % size == size - 1:
            stack.pop()
    for own, cycle in order.items():
        size = sizes[own][1]
        value = xxhash.xxh3_64_intdigest("\n".join(cycle)) >> 1
        bad = own in broken or count[own] % size > 0
        found[own, own] = [count[own] // size, -1 if bad else value, value]
    return found


def template_of(rows: list[dict], pairs: list[dict]) -> list[str]:
    """Tokens of the valid classes that nest. ``pairs``: outer, inner, times, low, high."""
    classes, sizes = classes_of(rows)
    seen = {(r["outer"], r["inner"]): r for r in pairs}
    taken: list[int] = []
    for own in range(len(sizes)):
        r = seen.get((own, own))
        if r is None or r["low"] != r["high"]:
            continue
        both = [(seen.get(k), seen[k[1], k[1]]["times"]) for other in taken for k in ((own, other), (other, own))]
        if all(r is None or (r["low"] == r["high"] and r["times"] == times) for r, times in both):
            taken.append(own)
    kept = set(taken)
    return sorted(t for t, own in classes.items() if own in kept)


def slots_of(events: list[tuple[str, str, str]], elements: dict[str, tuple[str, list[str]]], template: set[str]) -> list[str]:
    """By event the slot of a text: its own tag, and the template tag that came last before it
    within the innermost template tag around it."""
    around: dict[str, str] = {"": ""}
    for token, (parent, _) in elements.items():
        around[token] = token if token in template else around[parent]
    last: dict[str, str] = {}
    found = []
    for kind, token, _ in events:
        if kind == "open" and token in template:
            last[around[elements[token][0]]] = token
            last.pop(token, None)
        found.append(f"{token} {last.get(around[token], '')}" if kind == "text" else "")
    return found


OCCURRENCES = "host string, token string, pages long, vector long, inside long, whole long"
NESTING = "host string, outer long, inner long, times long, low long, high long"
SLOTS = "host string, label string, slot string, pages long, low long, high long, chars long, links long"


def _with_known(pages: DataFrame, known: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return pages.withColumn("host", host).join(known, "host", "left")


def _nestings(pages: DataFrame, candidates: DataFrame) -> DataFrame:
    """Per host what ``nesting`` gives, merged over the pages of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, {}, [])
        for batch in batches:
            found: dict[tuple, list[int]] = {}
            for host, source, rows in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if host != last[0]:
                    last = (host, *classes_of(rows.as_py()))
                opened = [token for kind, token, _ in scan(source.as_py() or "")[0] if kind == "open"]
                for key, (times, low, high) in nesting(opened, last[1], last[2]).items():
                    own = found.setdefault((host, *key), [0, low, high])
                    own[0] += times
                    own[1], own[2] = min(own[1], low), max(own[2], high)
            yield merged(found, NESTING)

    return map_arrow(_with_known(pages, candidates).where("rows is not null").select("host", "html", "rows"), run, NESTING)


def _slots(pages: DataFrame, known: DataFrame) -> DataFrame:
    """Per host, label and slot that is no boilerplate, merged over the pages of a batch:
    pages with text there, least and greatest hash of it, its characters and those in links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        last: tuple = (None, set(), set())
        for batch in batches:
            found: dict[tuple, list[int]] = {}
            for host, source, *rest in zip(batch.column(0).to_pylist(), *batch.columns[1:4]):
                if host != last[0]:
                    last = (host, *(set(x.as_py() or ()) for x in rest))
                events, elements, holds = scan(source.as_py() or "")
                labels = labels_of(elements, holds, last[2])
                linked = {"": False}
                for token, (parent, own) in elements.items():
                    linked[token] = own[0] == "a" or linked[parent]
                texts: dict[tuple, list[str]] = {}
                links: dict[tuple, int] = {}
                for (kind, token, text), slot in zip(events, slots_of(events, elements, last[1])):
                    if kind == "text" and labels[token] != "boilerplate" and text.strip():
                        key = (host, labels[token], slot)
                        texts.setdefault(key, []).append(text)
                        links[key] = links.get(key, 0) + linked[token] * len("".join(text.split()))
                for key, parts in texts.items():
                    words = " ".join(parts).split()
                    value = xxhash.xxh3_64_intdigest(" ".join(words)) >> 1
                    own = found.setdefault(key, [0, value, value, 0, 0])
                    own[0] += 1
                    own[1], own[2] = min(own[1], value), max(own[2], value)
                    own[3] += sum(map(len, words))
                    own[4] += links[key]
            yield merged(found, SLOTS)

    return map_arrow(_with_known(pages, known).select("host", "html", "tokens", "wrappers"), run, SLOTS)


def templates(pages: DataFrame) -> DataFrame:
    """Per host: ``tokens`` of its template; ``dropped``, slots outside articles that are mostly
    links or whose text is the same on all pages while that of others differs; ``wrappers``,
    the tokens whose label depends on it and that hold at least half of the text of their
    pages; ``articles``, whether articles hold more text than the slots outside."""
    tokens = written(
        _occurrences(pages).groupBy("host", "token").agg(*[F.sum(c).alias(c) for c in ("pages", "vector", "inside", "whole")]),
        "html-tokens")
    classes = tokens.groupBy("host", "vector", "pages").agg(F.count(F.lit(1)).alias("size")).where(
        (F.col("pages") >= MIN_PAGES) & (F.col("size") >= MIN_TOKENS)).select("host", "vector", "pages")
    candidates = written(tokens.join(classes, ["host", "vector", "pages"]).groupBy("host").agg(
        F.collect_list(F.struct("token", "vector", "pages")).alias("rows")), "html-candidates")
    pairs = _nestings(pages, candidates).groupBy("host", "outer", "inner").agg(
        F.sum("times").alias("times"), F.min("low").alias("low"), F.max("high").alias("high"))
    nested = candidates.join(pairs.groupBy("host").agg(F.collect_list(F.struct("outer", "inner", "times", "low", "high")).alias("pairs")), "host")

    def deduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [template_of(rows.as_py(), found.as_py()) for rows, found in zip(batch.column(1), batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.string()))], names=["host", "tokens"])

    deduced = map_arrow(nested.select("host", "rows", "pairs"), deduce, "host string, tokens array<string>")
    wrappers = tokens.where("inside > 0 and 2 * inside >= whole").groupBy("host").agg(F.collect_set("token").alias("wrappers"))
    sizes = tokens.groupBy("host").agg(F.max("pages").alias("seen"))
    known = written(sizes.join(deduced, "host", "left").join(wrappers, "host", "left"), "html-deduced")
    slots = written(_slots(pages, known.drop("seen")).groupBy("host", "label", "slot").agg(
        *[F.sum(c).alias(c) for c in ("pages", "chars", "links")], F.min("low").alias("low"), F.max("high").alias("high")), "html-slots")
    differs = slots.groupBy("host").agg(F.max(F.col("low") != F.col("high")).alias("differs"))
    other, linky = F.col("label") == "other", 2 * F.col("links") > F.col("chars")
    same = F.col("differs") & (F.col("low") == F.col("high"))
    dropped = other & (F.col("pages") >= MIN_PAGES) & F.col("differs") & (linky | same)
    plain = F.col("chars") - F.col("links")
    decided = slots.join(differs, "host").groupBy("host").agg(
        F.collect_set(F.when(dropped, F.col("slot"))).alias("dropped"),
        (F.sum(F.when(F.col("label") == "main", plain).otherwise(0)) > F.sum(F.when(other & ~dropped, plain).otherwise(0))).alias("articles"))
    return known.drop("seen").join(decided, "host", "left")


def extract(source: str, template: set[str] | None, dropped: set[str], wrappers: set[str] | None = None, articles: bool | None = None) -> str:
    """Blocks of the main text, joined by line feeds: ``articles``, if there are any, or all
    text that is not boilerplate. Without ``wrappers`` or ``articles`` the page's own text
    tells them."""
    blocks: list[tuple[str, str]] = []
    parts: list[str] = []
    kind_of_parts = "other"
    events, elements, holds = scan(source)
    labels = labels_of(elements, holds, halves(masses(events, elements)) if wrappers is None else wrappers)

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            blocks.append((kind_of_parts, text))
        parts.clear()

    for (kind, token, text), slot in zip(events, slots_of(events, elements, template or set())):
        if kind == "break":
            flush()
        elif kind == "text":
            own = labels[token]
            if own == "boilerplate" or (own == "other" and slot in dropped):
                continue
            if own != kind_of_parts:
                flush()
                kind_of_parts = own
            parts.append(text)
    flush()
    if articles is None:
        articles = sum(len(t) if k == "main" else -len(t) for k, t in blocks) > 0
    chosen = [t for k, t in blocks if k == "main"] if articles else []
    return "\n".join(chosen or [t for _, t in blocks])


def main_text(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """One row per input row: ``page_id``, ``url``, ``text``, ``n_chars`` (code points).

    Pages of a host without a template (fewer than three pages, or no class) are read by
    their own tags. Null html gives an empty text; null urls share a host. Repeated rows are
    treated alike; broken and very long pages are read to the end. Empty input: no rows.
    """
    chosen = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"), F.col(html_column).alias("html"))
    known = written(templates(chosen), "html-templates")
    joined = _with_known(chosen, known).select("page_id", "url", "html", "tokens", "dropped", "wrappers", "articles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, set(), set(), set(), None)
        for batch in batches:
            texts = []
            for source, *known in zip(*batch.columns[2:7]):
                if known != last[0]:
                    last = (known, *(set(x.as_py() or ()) for x in known[:3]), known[3].as_py())
                texts.append(extract(source.as_py() or "", *last[1:]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    kind = chosen.schema["page_id"].dataType.simpleString()
    return map_arrow(joined, run, f"page_id {kind}, url string, text string, n_chars long")
