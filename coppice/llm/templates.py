"""Main text of web pages by deducing the template that pages of one host share.

Tokens of a page are its tags, told apart by the path of elements around them, and its text nodes. The
occurrence vector of a token says how often each page of the host has it; tokens with equal vectors
form an equivalence class. The vector is kept as an order-free 64-bit hash, combined in every task, so
a host may hold any part of all pages. Pages with the same html are judged once, as copies would make
an article look like a template. Classes that nearly all pages of a host share are valid if they
nest: the largest one is the skeleton of the template, the others must lie in one gap between two of
its tokens. What is left between template tokens are the slots. Their text is summed over the
elements around them, and the smallest element that holds most of it is the host's main slot.

Extraction keeps the slots of the content part, in page order: of the article or main element if the
page has one; else of the main slot and, beside it below the same child of the body, of blocks that
are not mostly links, and headings. Elements that the standard or their names mark as menus, notices,
adverts, forms, comments and the like are left out afterwards. A block belongs to the template if all
its text does; in the plain paragraphs of an article it stays all the same. A page that has template
text only keeps it.

Defined cases: a null or empty page has an empty text; pages without a usable url share one host;
hosts with few different pages, and pages without their host's main slot, use the page's own main
element; very long pages are read whole; repeated rows and copies get the same text; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coppice.llm.html_tokens import BLOCKS, CONTENT, Token, squeezed, tokens
from coppice.llm.shipping import with_package
from coppice.llm.text import stored


HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")

#: Elements that hold text and no further structure.
LEAVES = (*HEADINGS, "p", "li", "td", "th", "dd", "dt", "pre", "blockquote", "figcaption")

#: Tokens that a task adds up before it hands them on; bounds its memory.
TOKENS_HELD = 50_000


@dataclass(frozen=True)
class TemplateSettings:
    """``min_share`` of at least ``min_pages`` pages must have a token of the template."""

    min_pages: int = 5
    min_share: float = 0.9
    main_share: float = 0.8


def _key(kind: str, path: str, text: str) -> int:
    """64-bit key of a token, as a signed number; ``text`` is squeezed."""
    name = f"{kind}\x00{path}\x00{text}"
    return int.from_bytes(xxhash.xxh64_digest(name.encode()), "big", signed=True)


def with_host(pages: DataFrame) -> DataFrame:
    """``(page_id, url, html, host)``."""
    url = F.col("url").cast("string")
    host = F.lower(F.coalesce(F.try_parse_url(url, F.lit("HOST")), F.lit("")))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        url.alias("url"),
        F.col("html").cast("string").alias("html"),
        host.alias("host"),
    )


def distinct_pages(hosted: DataFrame) -> DataFrame:
    """``(host, html)``: of the pages of one host with the same html, one."""
    keyed = hosted.select(
        "host", "html", F.xxhash64("html").alias("_same"), F.struct("url", "page_id").alias("_at")
    )
    copies = (
        keyed.groupBy("host", "_same")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
        .filter("_n > 1")
    )
    joined = keyed.join(stored(copies, "page-copies"), ["host", "_same"], "left")
    one = F.col("_first").isNull() | F.col("_at").eqNullSafe(F.col("_first"))
    return joined.filter(one).select("host", "html")


def _mixed(row: int, n: int) -> int:
    """Hash of a page and a number of occurrences, as a signed number."""
    return int.from_bytes(xxhash.xxh64_digest(b"%d,%d" % (row, n)), "big", signed=True)


def token_counts(pages: DataFrame) -> DataFrame:
    """``(host, token, pages, vector, at, path, is_text, chars)``, added up within batches.

    ``at`` sums up the positions of first occurrences, and ``chars`` the plain text.
    """
    names = ["host", "token", "pages", "vector", "at", "path", "is_text", "chars"]
    kinds = ["string", "int64", "int64", "int64", "int64", "string", "bool_", "int64"]

    def emptied(counts: dict) -> pa.RecordBatch:
        rows = [(*key, *entry) for key, entry in counts.items()]
        counts.clear()
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        arrays = [pa.array(c, getattr(pa, k)()) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, int], list] = {}
        tags: dict[tuple[str, str], int] = {}
        for batch in batches:
            for host, row, html in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                seen: dict[int, list] = {}
                at = 0
                for token in tokens(html or ""):
                    if token.kind == "text":
                        if not (text := squeezed(token.text)):
                            continue
                        key = _key("text", token.path, text)
                        chars = 0 if token.boilerplate or token.linked else len(text)
                    else:
                        chars = 0
                        tag = (token.kind, token.path)
                        if (key := tags.get(tag)) is None:
                            key = tags[tag] = _key(*tag, "")
                    if (entry := seen.get(key)) is None:
                        seen[key] = [1, at, token.path, token.kind == "text", chars]
                    else:
                        entry[0] += 1
                        entry[4] += chars
                    at += 1
                marks = {}
                for key, (n, first, path, is_text, chars) in seen.items():
                    if (mark := marks.get(n)) is None:
                        mark = marks[n] = _mixed(row, n)
                    if (total := counts.get((host, key))) is None:
                        counts[host, key] = [1, mark, first, path, is_text, chars]
                    else:
                        total[0] += 1
                        total[1] ^= mark
                        total[2] += first
                        total[5] += chars
                if len(counts) > TOKENS_HELD:
                    tags.clear()
                    yield emptied(counts)
        yield emptied(counts)

    slim = pages.select("host", F.monotonically_increasing_id().alias("row"), "html")
    schema = (
        "host string, token long, pages long, vector long, at long, path string, is_text boolean, "
        "chars long"
    )
    return with_package(slim).mapInArrow(run, schema)


def _nested(classes: list[tuple[int, list[tuple[float, int]]]]) -> set[int]:
    """Tokens of the valid classes: the skeleton, and classes that lie in one gap of it.

    A class is its number of pages and its tokens with their mean positions.
    """
    if not classes:
        return set()
    skeleton = max(classes, key=lambda c: (len(c[1]), c[0]))
    marks = sorted(at for at, _ in skeleton[1])
    kept = {token for _, token in skeleton[1]}
    for item in classes:
        gaps = {sum(m < at for m in marks) for at, _ in item[1]}
        if item is not skeleton and len(gaps) == 1:
            kept.update(token for _, token in item[1])
    return kept


def main_slot(large: Sequence[str]) -> str:
    """The innermost of the elements that hold most text, not below an article or a paragraph."""
    at = ""
    for path in sorted(large, key=lambda p: p.count("/")):
        name = path.rpartition("/")[2].split(".")[0]
        if path.rpartition("/")[0] != at or name not in BLOCKS or name in LEAVES:
            break
        at = path
        if name in CONTENT:
            break
    return at


def main_element(chars: dict[str, int], share: float) -> str:
    """The main slot of one page, from the characters by path."""
    total = sum(chars.values())
    inside: dict[str, int] = defaultdict(int)
    for path, n in chars.items():
        parts = path.split("/")[1:]
        for depth in range(1, len(parts) + 1):
            inside["/" + "/".join(parts[:depth])] += n
    return main_slot([p for p, n in inside.items() if total and n >= share * total])


def host_templates(hosted: DataFrame, settings: TemplateSettings) -> DataFrame:
    """``(host, large, template_texts)``: the elements around most slot text, and template text."""
    pages = distinct_pages(hosted)
    by_token = stored(
        token_counts(pages)
        .groupBy("host", "token")
        .agg(
            F.sum("pages").alias("pages"),
            F.bit_xor("vector").alias("vector"),
            (F.sum("at") / F.sum("pages")).alias("at"),
            F.first("path").alias("path"),
            F.first("is_text").alias("is_text"),
            F.sum("chars").alias("chars"),
        ),
        "page-tokens",
    )
    sizes = stored(pages.groupBy("host").agg(F.count(F.lit(1)).alias("of")), "host-sizes")
    # The first filter follows from the second; tokens of few pages need not meet their host.
    usual = stored(
        by_token.filter(F.col("pages") >= settings.min_share * settings.min_pages)
        .join(sizes, "host")
        .filter((F.col("of") >= settings.min_pages) & (F.col("pages") >= settings.min_share * F.col("of"))),
        "usual-tokens",
    )
    templates = stored(_template_texts(usual), "template-texts")
    template_tokens = templates.select("host", F.explode("template_texts").alias("token"))
    known = usual.join(template_tokens, ["host", "token"]).select("host", "path", (-F.col("chars")).alias("chars"))
    slots = (
        by_token.filter(F.col("is_text") & (F.col("chars") > 0))
        .select("host", "path", "chars")
        .unionByName(known)
        .groupBy("host", "path")
        .agg(F.sum("chars").alias("chars"))
        .filter("chars > 0")
    )
    parts = F.split("path", "/")
    around = F.transform(
        F.sequence(F.lit(2), F.size(parts)), lambda depth: F.array_join(F.slice(parts, F.lit(1), depth), "/")
    )
    elements = (
        slots.filter("path != ''")
        .select("host", "chars", F.explode(around).alias("path"))
        .groupBy("host", "path")
        .agg(F.sum("chars").alias("chars"))
    )
    totals = slots.groupBy("host").agg(F.sum("chars").alias("of"))
    # An element at each depth at most: the list of a host is no longer than its pages are deep.
    large = (
        elements.join(totals, "host")
        .filter(F.col("chars") >= settings.main_share * F.col("of"))
        .groupBy("host")
        .agg(F.collect_list("path").alias("large"))
    )
    return large.join(templates, "host", "full")


def _template_texts(usual: DataFrame) -> DataFrame:
    """``(host, template_texts)``: keys of the text tokens in valid classes."""
    classes = (
        usual.groupBy("host", "vector", "pages")
        .agg(F.collect_list(F.struct("at", "token", "is_text")).alias("tokens"))
        .groupBy("host")
        .agg(F.collect_list(F.struct("pages", "tokens")).alias("classes"))
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for found in batch.column(1).to_pylist():
                is_text = {t["token"] for c in found for t in c["tokens"] if t["is_text"]}
                kept = _nested(
                    [(c["pages"], [(t["at"], t["token"]) for t in c["tokens"]]) for c in found]
                )
                texts.append(sorted(kept & is_text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.list_(pa.int64()))], ["host", "template_texts"]
            )

    return with_package(classes).mapInArrow(run, "host string, template_texts array<long>")


def _inside(path: str, element: str) -> bool:
    return not element or path == element or path.startswith(f"{element}/")


def _body_child(path: str) -> str:
    """The child of the body that holds ``path``, or ``path`` itself if it is not below one."""
    parts = path.split("/")
    names = [part.split(".")[0] for part in parts]
    below = names.index("body") + 2 if "body" in names else len(parts)
    return "/".join(parts[:below])


def _is_heading(path: str) -> bool:
    return any(part.split(".")[0] in HEADINGS for part in path.split("/"))


def _content(page: list[Token], main: str, share: float) -> list[Token]:
    """The tokens of the content part of a page without an article."""
    chars: dict[str, int] = defaultdict(int)
    for t in page:
        chars[t.path] += 0 if t.linked else len(squeezed(t.text))
    if not main or not any(n for path, n in chars.items() if _inside(path, main)):
        main = main_element(chars, share)
    part = _body_child(main)
    plain: dict[int, int] = defaultdict(int)
    for t in page:
        plain[t.block] += (-1 if t.linked else 1) * len(squeezed(t.text))
    return [
        t
        for t in page
        if _inside(t.path, main)
        or (plain[t.block] > 0 and (_inside(t.path, part) or _is_heading(t.path)))
    ]


def _is_prose(path: str) -> bool:
    """Whether the text lies in an article without a class or id on the elements in between."""
    article = _content_path(path)
    return article is not None and "." not in path[len(article) :]


def slot_tokens(page: list[Token], template_texts: set[int]) -> list[Token]:
    """The tokens of blocks that the template does not make up as a whole.

    Repeated text in an article's plain paragraphs stays: pages quote each other. In an element with a
    class or an id it is a part of the template.
    """
    if not template_texts:
        return page
    own = {
        t.block
        for t in page
        if (text := squeezed(t.text))
        and (_is_prose(t.path) or _key("text", t.path, text) not in template_texts)
    }
    return [t for t in page if t.block in own]


def main_text(html: str, main: str, template_texts: set[int], share: float) -> str:
    """Blocks of the content part outside the template, joined by line breaks."""
    page = [t for t in tokens(html) if t.kind == "text" and not t.boilerplate]
    for texts in (slot_tokens(page, template_texts), page):
        article = next((p for t in texts if squeezed(t.text) and (p := _content_path(t.path))), None)
        chosen = [t for t in texts if _inside(t.path, article)] if article else _content(texts, main, share)
        blocks: dict[int, list[str]] = defaultdict(list)
        for t in chosen:
            blocks[t.block].append(t.text)
        lines = (squeezed("".join(parts)) for parts in blocks.values())
        if text := "\n".join(line for line in lines if line):
            return text
    return ""


def _content_path(path: str) -> str | None:
    parts = path.split("/")
    for i, part in enumerate(parts):
        if part.split(".")[0] in CONTENT:
            return "/".join(parts[: i + 1])
    return None


def extracted(pages: DataFrame, settings: TemplateSettings = TemplateSettings()) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every page.

    One narrow row per host is joined to the pages; Catalyst broadcasts it by its size on disk, or
    joins by host with adaptive splitting of large hosts.
    """
    hosted = with_host(pages)
    templates = stored(host_templates(hosted, settings), "templates")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                main_text(
                    html.as_py() or "", main_slot(large.as_py() or []), set(known.as_py() or []), settings.main_share
                )
                for html, large, known in zip(*batch.columns[2:], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    joined = hosted.join(templates, "host", "left").select(
        "page_id", "url", "html", "large", "template_texts"
    )
    return with_package(joined).mapInArrow(
        run, "page_id long, url string, text string, n_chars long"
    )
