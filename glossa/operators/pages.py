"""Talk pages: byline, paragraphs, footnotes and inline citations from a page's HTML and notes."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import escape
from html.parser import HTMLParser
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions.spread import bounded_batches, widened
from .fold import plain

BLOCKS = ("p", "h1", "h2", "h3", "li")
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Tags that end an open paragraph.
ENDS_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul li".split())
CHROME = ("author-name", "author-role", "title", "marker")
# Signals of a citation in parentheses, and the widths of context.
SIGNAL = re.compile(
    r'class="scripture-ref"|<cite>|“|&#8220;|\b(?:1[6-9]|20)\d\d\b|\bpp?\.\s?\d|\bno\.\s?\d|\bvol\.|\bHymns\b|\bJournal of Discourses\b|\bConference Report\b|\bEnsign\b|\bLiahona\b|\bIbid\b|'
    r"\b(?:act|scene|line|chapter|ch\.|sec\.)\s?\d",
    re.I,
)
WIDTH = 280
FIRST_INLINE = 10_000


@dataclass
class Block:
    tag: str
    attrs: dict
    in_footer: bool
    html: list[str] = field(default_factory=list)
    holds_p: bool = False

    @property
    def cls(self) -> str:
        return " ".join((self.attrs.get("class") or "").split())

    @property
    def source(self) -> str:
        return "".join(self.html)


class Body(HTMLParser):
    """Blocks of a page in reading order, each with its own HTML; notes footers are left out."""

    def __init__(self, source: str):
        super().__init__(convert_charrefs=False)
        self.blocks: list[Block] = []
        self.open: list[tuple[str, Block | None]] = []
        self.notes = 0  # depth of open elements inside a notes footer
        self.feed(source)
        self.close()

    def _write(self, text: str) -> None:
        for _, block in self.open:
            if block is not None:
                block.html.append(text)

    def _end(self, tag: str) -> None:
        """Closes the innermost open element of a tag, and what is open inside it."""
        if any(t == tag for t, _ in self.open):
            while self.open:
                name, _ = self.open[-1]
                self._write(f"</{name}>")
                self.open.pop()
                self.notes = min(self.notes, len(self.open)) if self.notes else 0
                if name == tag:
                    return

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        if self.notes:
            if tag not in VOID:
                self.open.append((tag, None))
            return
        if tag in ENDS_P and any(t == "p" for t, _ in self.open):
            self._end("p")
        if tag == "footer" and "notes" in (attrs.get("class") or "").split():
            self.open.append((tag, None))
            self.notes = len(self.open)
            return
        block = Block(tag, attrs, any(t == "footer" for t, _ in self.open)) if tag in BLOCKS else None
        if tag == "p":
            for _, outer in self.open:
                if outer is not None and outer.tag == "li":
                    outer.holds_p = True
        if block is not None:
            self.blocks.append(block)
        if tag not in VOID:
            self.open.append((tag, block))
        shown = "".join(f' {k}="{escape(v or "")}"' for k, v in attrs.items())
        self._write(f"<{tag}{shown}>")

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._end(tag)

    def handle_endtag(self, tag):
        if tag not in VOID:
            self._end(tag)

    def handle_data(self, data):
        if not self.notes:
            self._write(data)

    def handle_entityref(self, name):
        self.handle_data(f"&{name};")

    def handle_charref(self, name):
        self.handle_data(f"&#{name};")

    def first(self, cls: str) -> str | None:
        return next((plain(b.source) for b in self.blocks if b.tag == "p" and cls in b.cls.split()), None)

    def paragraphs(self) -> list[Block]:
        chrome = lambda b: "kicker" not in b.cls and any(k in b.cls for k in CHROME)
        return [b for b in self.blocks if not chrome(b) and not b.in_footer and not (b.tag == "li" and b.holds_p)]


NOTE_MARK = re.compile(r'(<a class="note-ref" href="#(?:note\d+)">.*?</a>|<[^>]+>)')


def note_offsets(p_html: str) -> list[tuple[str, int]]:
    """(note id, plain characters before its marker); a marker's own text does not count."""
    parts = NOTE_MARK.split(p_html)  # text and markup take turns
    lengths = [len(plain(t)) + t.endswith(" ") for t in parts[0::2]]
    marks = (re.match(r'<a class="note-ref" href="#(note\d+)">', m) for m in parts[1::2])
    return [(m.group(1), at) for m, at in zip(marks, accumulate(lengths), strict=False) if m]


def inline_groups(p_html: str) -> list[tuple[str, str]]:
    """(HTML, context before) of citation-like parentheses, then of scripture links outside them."""
    groups = {m.span(): m.group(1) for m in re.finditer(r"\(([^()]{3,}?)\)", p_html) if SIGNAL.search(m.group(1))}
    links = {m.span(): m.group() for m in re.finditer(r'<a class="scripture-ref"[^>]*>.*?</a>', p_html)}
    outside = {span: text for span, text in links.items() if not any(a <= span[0] < b for a, b in groups)}
    return [(text, plain(p_html[:start])[-WIDTH:]) for (start, _), text in (*groups.items(), *outside.items())]


def read_page(source: str, notes: list[tuple[str, dict]]) -> dict:
    """Byline, paragraphs (first of a pid wins) and footnotes of one page."""
    body = Body(source or "")
    rows, texts = [], {}
    for i, block in enumerate(body.paragraphs()):
        p_html = block.source
        text = plain(p_html)
        if not text:
            continue
        pid = block.attrs.get("data-aid") or block.attrs.get("id") or f"x{i}"
        rows.append((pid, i, text))
        texts[pid] = (text, p_html)
        if block.attrs.get("id"):
            texts.setdefault(block.attrs["id"], (text, p_html))
    told = {note: text[max(0, at - WIDTH) : at].strip() for text, p_html in texts.values() for note, at in note_offsets(p_html)}
    found = {}
    for i, (note, n) in enumerate(notes):
        found.setdefault(note, {"marker": note, "pid": n.get("pid"), "ord": i, "inline": False, "raw_html": n.get("text") or "", "context": told.get(note) or n.get("context") or ""})
    count, last = FIRST_INLINE, ""
    for pid, _, text in rows:
        for k, (fragment, context) in enumerate(inline_groups(texts[pid][1])):
            count += 1
            marker = f"i{pid}.{k}"
            found.setdefault(marker, {"marker": marker, "pid": pid, "ord": count, "inline": True, "raw_html": fragment, "context": context or last[-WIDTH:]})
        last = text
    first: dict = {}
    for pid, i, text in rows:
        first.setdefault(pid, {"pid": pid, "ord": i, "text": text})
    name = body.first("author-name")
    return {
        "speaker_role": body.first("author-role"), "speaker_name": re.sub(r"^(?:by|presented by)\s+", "", name, flags=re.I) if name else None,
        "paragraphs": list(first.values()), "footnotes": list(found.values()),
    }


def page_udf() -> Column:
    """Vectorised: (body, array of (key, note)) -> schema.BODY; one call a page gives all it holds, and batches are bounded by bytes."""
    bounded_batches(SparkSession.active())

    @F.pandas_udf(schema.BODY)
    def read(body: pd.Series, notes: pd.Series) -> pd.DataFrame:
        pages = [read_page(b, [(n["key"], n["value"] or {}) for n in (ns if ns is not None else [])]) for b, ns in zip(body, notes, strict=True)]
        return pd.DataFrame(pages, columns=["speaker_role", "speaker_name", "paragraphs", "footnotes"], dtype=object)

    return read


def published(structured: Column) -> Column:
    """The ISO date of a page's structured data; null where that is malformed."""
    return F.left(F.get_json_object(structured, "$.datePublished"), F.lit(10))


def parse_pages(refs: DataFrame, contents: DataFrame) -> DataFrame:
    """References joined with their contents (uri, meta, content): one row per talk, with its parts nested."""
    rows = widened(refs.join(contents, "uri"))
    notes = F.map_entries(F.coalesce("content.footnotes", F.expr("map()").cast("map<string,struct<text:string,pid:string,context:string>>")))
    rows = rows.withColumn("page", page_udf()(F.coalesce("content.body", F.lit("")), notes))
    name = F.coalesce(F.nullif("speaker", F.lit("")), F.nullif("page.speaker_name", F.lit("")), F.lit(""))
    return rows.select(
        *[c for c in refs.columns if c not in ("title", "speaker")], F.coalesce(F.nullif("meta.title", F.lit("")), "title").alias("title"), name.alias("speaker_name"),
        F.col("page.speaker_role").alias("speaker_role"), published(F.col("meta.structuredData")).alias("date"), F.col("page.paragraphs").alias("paragraphs"), F.col("page.footnotes").alias("footnotes"),
        F.current_timestamp().alias("parsed_at"),
    )


def paragraphs(parsed: DataFrame) -> DataFrame:
    return parsed.select(F.col("uri").alias("talk_id"), F.inline("paragraphs"))


def footnotes(parsed: DataFrame) -> DataFrame:
    return parsed.select(F.col("uri").alias("talk_id"), F.inline("footnotes"))
