"""Main text of web pages by wrappers: union-free regular expressions inferred per host.

A page is a stream of tags and text slots. Within a stream, neighbouring equal runs become repeated
groups; two streams are aligned, and what only one has becomes an optional group; both are done
again until nothing changes, over all different streams of a host: some at a time, then the wrappers
of these, until the host has one. The wrapper's text
slots are then labelled by where they lie: under menus, headers, footers, sidebars, notices, adverts,
forms, scripts or comments they are not main text, nor are slots outside every repetition and every
article that have one and the same text on nearly all of all pages. A page is read by its host's labels.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from covisit.llm.common import bounded_join, staged

#: Streams or wrappers of a host that are aligned in one group; their wrappers are aligned in the next round.
ALIGNED = 16
#: Tokens of a stream; a page of more is several streams, each with the open tags at its ends.
STREAM_TOKENS = 3000
#: A slot is template text if so many different pages, and this share of them, have one text there.
SAME_PAGES, SAME_SHARE = 8, 0.9
#: Longest run that is folded into a repeated group.
_FOLD = 24

# fixed values: names of elements and of their classes
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "template", "noscript", "textarea", "title", "iframe", "svg")
DROPPED = frozenset([*RAW, *"head nav footer aside form button select option dialog menu object canvas".split()])
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
MAIN = frozenset(("article", "main"))
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
NOISE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|nav|navbar|navigation|menu\w*|breadcrumbs?|header|masthead|footer|sidebar\w*|"
    r"side|aside|widget\w*|cookies?|consent|gdpr|notices?|banner|alert|popup|modal|overlay|newsletter|subscribe\w*|signup|login|share|sharing|"
    r"social|related|recommend\w*|comments?|commentlist|replies|reply|disqus|respond|pagination|pager|toolbar|skip|tags|copyright|disclaimer)(?=$|[\s_-])")

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+|[^>]*)>|<(?=[a-zA-Z/])[^>]*\Z", re.DOTALL)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in RAW}


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """("text", decoded, ""), ("open", name, attributes) and ("close", name, ""), in page order.

    Comments, declarations and the insides of raw elements are passed over; an unfinished tag at the end too.
    """
    at = 0
    while True:
        m = _TAG.search(page, at)
        text = page[at : m.start()] if m else page[at:]
        if text:
            yield "text", html.unescape(text), ""
        if not m:
            return
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        yield ("close" if m[1] else "open"), name, m[3] or ""
        if not m[1] and name in _RAW_END and not (m[3] or "").endswith("/"):
            end = _RAW_END[name].search(page, at)
            if end:
                yield "close", name, ""
            elif name == "title" or name == "textarea":
                continue
            at = end.end() if end else len(page)


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(raw)}


def step_of(name: str, raw: str) -> str:
    """An element as a path names it: with its class, id, role and whether it is hidden."""
    if not raw.strip():
        return name
    a = _attributes(raw)
    hidden = re.search(r"\shidden(?=\s|$|=)", f" {raw.lower()}") or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", "")
    kind = " ".join(f"{a.get('class', '')} {a.get('id', '')}".split())
    return f"{name}.{kind}~{a.get('role', '')}" + "!" * bool(hidden) if kind or a.get("role") or hidden else name


def _is_noise(step: str, inside_main: bool) -> bool:
    name, _, rest = step.partition(".")
    if name in DROPPED or rest.endswith("!"):
        return True
    if name == "header" and not inside_main:
        return True
    kind, _, role = rest.rstrip("!").rpartition("~")
    if role in ROLES:
        return True
    return name not in MAIN and name not in ("body", "html") and bool(kind) and bool(NOISE.search(kind.replace("__", "-")))


def _is_main(step: str) -> bool:
    return step.partition(".")[0] in MAIN or step.rstrip("!").endswith("~main")


def label(path: tuple[str, ...]) -> str:
    """"noise", "main" (under an article) or "body" for a text slot at this path."""
    main = False
    for step in path:
        if _is_noise(step, main):
            return "noise"
        main = main or _is_main(step)
    return "main" if main else "body"


def slots(page: str) -> Iterator[tuple[tuple[str, ...], str | None]]:
    """Path and text of each text token; a None text where a block ends or starts."""
    path: list[tuple[str, str]] = []
    for kind, value, raw in tokens(page):
        if kind == "text":
            yield tuple(s for _, s in path), value
            continue
        if value not in INLINE:
            yield (), None
        if kind == "open" and value not in VOID and not raw.endswith("/"):
            if value == "p" or value == "li":  # a new one ends an open one, with what it holds
                for k in reversed(range(len(path))):
                    if path[k][0] == value:
                        del path[k:]
                        break
                    if path[k][0] not in INLINE:
                        break
            path.append((value, step_of(value, raw)))
        elif kind == "close":
            for k in reversed(range(len(path))):
                if path[k][0] == value:
                    del path[k:]
                    break


# --- inference ---------------------------------------------------------------------------

Item = str | tuple


def fold(stream: list[Item]) -> list[Item]:
    """Neighbouring equal runs as ("+", run), shortest runs first."""
    for width in range(1, _FOLD + 1):
        out, k = [], 0
        while k < len(stream):
            run, n = stream[k : k + width], 1
            while len(run) == width and stream[k + n * width : k + (n + 1) * width] == run:
                n += 1
            if n > 1 and not (width == 1 and run[0] == "#"):
                out.append(run[0] if width == 1 and isinstance(run[0], tuple) and run[0][0] == "+" else ("+", tuple(run)))
                k += n * width
            else:
                out.append(stream[k])
                k += 1
        stream = out
    # a run beside its own repetition is one more turn of it
    out = []
    for item in stream:
        if isinstance(item, tuple) and item[0] == "+" and tuple(out[-len(item[1]) :]) == item[1]:
            del out[-len(item[1]) :]
        if out and isinstance(out[-1], tuple) and out[-1] == item and item[0] == "+":
            continue
        out.append(item)
        for back in range(min(len(out) - 1, _FOLD), 0, -1):
            group = out[-back - 1]
            if isinstance(group, tuple) and group[0] == "+" and len(group[1]) == back and tuple(out[-back:]) == group[1]:
                del out[-back:]
                break
    return out


def align(wrapper: list[Item], stream: list[Item]) -> list[Item]:
    """One expression for both: what only one side has is optional."""
    out: list[Item] = []
    for kind, a, b, c, d in SequenceMatcher(None, wrapper, stream, autojunk=False).get_opcodes():
        if kind == "equal":
            out += wrapper[a:b]
        else:
            for part in (wrapper[a:b], stream[c:d]):
                loose = [x for x in part if not (isinstance(x, tuple) and x[0] == "?")]
                if len(loose) < len(part):
                    out += [x if isinstance(x, tuple) and x[0] == "?" else ("?", (x,)) for x in part]
                elif part:
                    out.append(("?", tuple(part)))
    return out


def token_streams(page: str) -> Iterator[list[Item]]:
    """Opening and closing tags by their steps, and "#" for a text slot, STREAM_TOKENS or a few more at once."""
    out: list[Item] = []
    path: list[tuple[str, str]] = []
    for kind, value, raw in tokens(page):
        item = ("#" if value.strip() else "") if kind == "text" else f"</{value}>" if kind == "close" else f"<{step_of(value, raw)}>"
        if item and not (item == "#" and out and out[-1] == "#"):
            out.append(item)
        if kind == "open" and value not in VOID:
            path.append((value, item))
        elif kind == "close":
            for k in reversed(range(len(path))):
                if path[k][0] == value:
                    del path[k:]
                    break
        if len(out) >= STREAM_TOKENS + len(path):
            yield out + [f"</{name}>" for name, _ in reversed(path)]
            out = [item for _, item in path]
    if out:
        yield out


def aligned(streams: Iterable[list[Item]]) -> list[Item]:
    """The wrapper of folded streams or wrappers: aligned, and folded again until it is stable."""
    wrapper: list[Item] | None = None
    for stream in streams:
        merged = stream if wrapper is None else align(wrapper, stream)
        while len(folded := fold(merged)) < len(merged):
            merged = folded
        wrapper = merged
    return wrapper or []


def infer(pages: list[str]) -> list[Item]:
    """The wrapper of pages of one host."""
    return aligned(fold(stream) for page in pages for stream in token_streams(page))


def repeated_paths(wrapper: list[Item]) -> set[tuple[str, ...]]:
    """Paths of text slots that lie in a repeated group."""
    found: set[tuple[str, ...]] = set()
    path: list[str] = []

    def walk(items, inside: bool) -> None:
        for item in items:
            if isinstance(item, tuple):
                walk(item[1], inside or item[0] == "+")
            elif item == "#":
                if inside:
                    found.add(tuple(path))
            elif item.startswith("</"):
                for k in reversed(range(len(path))):
                    if path[k].partition(".")[0] == item[2:-1]:
                        del path[k:]
                        break
            elif item[1:-1].partition(".")[0] not in VOID:
                path.append(item[1:-1])

    walk(wrapper, False)
    return found


def body_texts(page: str, labels: dict[tuple[str, ...], str]) -> set[tuple[tuple[str, ...], str]]:
    """Path and text of the slots outside articles and noise. ``labels`` is filled as paths are met."""
    found = set()
    for path, text in slots(page):
        if text and text.strip():
            if path not in labels:
                labels[path] = label(path)
            if labels[path] == "body":
                found.add((path, " ".join(text.split())))
    return found


def template_texts(pages: list[str], wrapper: list[Item]) -> dict[str, str]:
    """Slots (as JSON paths) outside every repetition and article whose text nearly all of many different pages share.

    ``wrappers`` is the same for tables.
    """
    pages = list(dict.fromkeys(pages))
    if len(pages) < SAME_PAGES:
        return {}
    repeated = repeated_paths(wrapper)
    texts: dict[tuple[str, ...], Counter] = defaultdict(Counter)
    for page in pages:
        for path, text in body_texts(page, {}):
            texts[path][text] += 1
    out = {}
    for path, counts in texts.items():
        text, n = counts.most_common(1)[0]
        if n >= SAME_SHARE * len(pages) and path not in repeated:
            out[json.dumps(path)] = text
    return out


def extract(page: str | None, template: dict[str, str], labels: dict[tuple[str, ...], str]) -> str:
    """The page's main text: blocks in page order, one line each. ``labels`` is filled as paths are met."""
    blocks: dict[str, list[list[str]]] = {"main": [[]], "body": [[]]}
    seen_main = False
    for path, text in slots(page or ""):
        if text is None:
            for of in blocks.values():
                if of[-1]:
                    of.append([])
            continue
        kind = labels.get(path)
        if kind is None:
            kind = labels[path] = label(path)
        if kind == "noise" or template and template.get(json.dumps(path)) == " ".join(text.split()):
            continue
        seen_main = seen_main or kind == "main"
        blocks[kind][-1].append(text)
    lines = (" ".join("".join(b).split()) for b in blocks["main" if seen_main else "body"])
    return "\n".join(x for x in lines if x)


def host_of(url: Column) -> Column:
    """The host in a URL, in lower case; null and odd URLs are one host."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def _hashes(path: tuple[str, ...], text: str) -> tuple[int, int]:
    return tuple(xxhash.xxh3_64_intdigest(x) - (1 << 63) for x in (json.dumps(path), text))


def common_texts(rows: DataFrame) -> DataFrame:
    """host, wanted (hashes of path and text): slots that have one text on nearly all different pages of ``rows`` (host, html)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels: dict[tuple[str, ...], str] = {}
        for batch in batches:
            digests, found = [], []
            for page in batch.column("html").to_pylist():
                if len(labels) > 100_000:
                    labels.clear()
                digests.append(xxhash.xxh3_128_digest(page))
                found.append([{"path": p, "text": t} for p, t in (_hashes(*x) for x in body_texts(page, labels))])
            yield pa.RecordBatch.from_pydict({
                "host": batch.column("host"), "page": pa.array(digests, pa.binary()),
                "slots": pa.array(found, pa.list_(pa.struct([("path", pa.int64()), ("text", pa.int64())])))})

    pages = staged(rows.mapInArrow(run, "host string, page binary, slots array<struct<path:long,text:long>>"), "page-slots")
    pages = pages.dropDuplicates(["host", "page"])
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= SAME_PAGES)
    counts = pages.select("host", F.inline("slots")).groupBy("host", "path", "text").agg(F.count(F.lit(1)).alias("n"))
    common = counts.where(F.col("n") >= SAME_SHARE * SAME_PAGES).join(totals, "host").where(F.col("n") >= SAME_SHARE * F.col("pages"))
    common = common.groupBy("host", "path").agg(F.max_by("text", F.struct("n", "text")).alias("text"))
    return common.groupBy("host").agg(F.collect_list(F.struct("path", "text")).alias("wanted"))


def _tupled(item):
    return item if isinstance(item, str) else tuple(map(_tupled, item))


def host_wrappers(streams: DataFrame) -> DataFrame:
    """host, wrapper (JSON) of all folded streams in ``streams`` (host, wrapper)."""

    def run(table: pa.Table) -> pa.Table:
        found = sorted(table.column("wrapper").to_pylist())
        wrapper = aligned(list(map(_tupled, json.loads(w))) for w in found)
        return pa.table({"host": [table.column("host")[0].as_py()], "wrapper": [json.dumps(wrapper)]})

    order = Window.partitionBy("host").orderBy(F.xxhash64("wrapper"), "wrapper")
    while True:
        groups = streams.distinct().withColumn("of", F.floor((F.row_number().over(order) - 1) / ALIGNED))
        streams = staged(groups.groupBy("host", "of").applyInArrow(run, "host string, wrapper string"), "wrappers")
        if streams.groupBy("host").count().where("count > 1").isEmpty():
            return streams


def wrappers(pages: DataFrame) -> DataFrame:
    """host, template (JSON): for each host what its wrapper, of all its pages, tells of its text slots.

    Texts are counted first; streams of hosts without a text that nearly all pages share are not aligned.
    """
    rows = pages.select(host_of(F.col("url")).alias("host"), "html").where("html IS NOT NULL")
    common = staged(common_texts(rows), "common")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels: dict[tuple[str, ...], str] = {}
        for batch in batches:
            found: dict[tuple, None] = {}
            seen: set[tuple] = set()
            for host, page, wanted in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "wanted"))):
                if len(labels) > 100_000:
                    labels.clear()
                wanted = {(w["path"], w["text"]) for w in wanted}
                found.update(((host, None, json.dumps(p), t), None) for p, t in body_texts(page, labels) if _hashes(p, t) in wanted)
                for stream in token_streams(page):
                    key = (host, xxhash.xxh3_128_digest("\n".join(stream)))
                    if key not in seen:
                        seen.add(key)
                        found[host, json.dumps(fold(stream)), None, None] = None
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*found)] if found else [pa.array([], pa.string())] * 4,
                                             names=["host", "wrapper", "path", "text"])

    parts = bounded_join(rows, common, ["host"], "inner", "common").mapInArrow(run, "host string, wrapper string, path string, text string")
    parts = staged(parts, "streams")
    texts = parts.where("path IS NOT NULL").groupBy("host").agg(F.collect_set(F.struct("path", "text")).alias("texts"))
    found = host_wrappers(parts.where("wrapper IS NOT NULL").select("host", "wrapper")).join(texts, "host")

    def template(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for wrapper, own in zip(batch.column("wrapper").to_pylist(), batch.column("texts").to_pylist()):
                repeated = repeated_paths(list(map(_tupled, json.loads(wrapper))))
                out.append(json.dumps({x["path"]: x["text"] for x in own if tuple(json.loads(x["path"])) not in repeated}, sort_keys=True))
            yield pa.RecordBatch.from_pydict({"host": batch.column("host"), "template": pa.array(out, pa.string())})

    return found.mapInArrow(template, "host string, template string")


_TEXT = "page_id long, url string, text string, n_chars long"


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html).

    Null html is empty, and a page without main text has an empty one. A null url belongs to a host of
    its own, pages with null page_ids count as others do; repeated rows are read row by row.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").withColumn("host", host_of(F.col("url")))
    joined = bounded_join(rows, wrappers(pages.select("url", "html")), ["host"], "left", "wrappers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates: dict[str | None, dict[str, str]] = {None: {}}
        labels: dict[tuple[str, ...], str] = {}
        for batch in batches:
            texts = []
            for page, template in zip(batch.column("html").to_pylist(), batch.column("template").to_pylist()):
                if template not in templates:
                    templates[template] = json.loads(template)
                if len(labels) > 100_000:
                    labels.clear()
                texts.append(extract(page, templates[template], labels))
            yield pa.RecordBatch.from_pydict({
                "page_id": batch.column("page_id"), "url": batch.column("url"),
                "text": pa.array(texts, pa.string()), "n_chars": pa.array(list(map(len, texts)), pa.int64())})

    return joined.select("page_id", "url", "html", "template").mapInArrow(run, _TEXT)
