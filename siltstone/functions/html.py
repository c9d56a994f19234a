"""Posting fields from HTML, in an Arrow UDF with the selectors as an argument."""

from __future__ import annotations

from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from siltstone.schemas import POSTING_SCHEMA

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_HIDDEN = frozenset(("script", "style", "template"))
_INLINE = frozenset("a abbr b big cite code em font i mark q s small span strike strong sub sup tt u".split())
#: Pages that are read together, and that go to Python together: whole pages and their texts fill a worker.
PAGE_ROWS, BATCH_ROWS = 50, 500
_SECTIONS = ("overview", "requirement", "benefit")
_ARROW_TYPE = pa.struct([
    (field.name, pa.list_(pa.string()) if field.name == "tags" else pa.string()) for field in POSTING_SCHEMA.fields
])


@dataclass(frozen=True)
class PostingSelectors:
    """Where the fields are: ``.name`` means a class token, anything else a tag name.

    ``tag_list`` names the element whose children are the tags. ``text_tags`` also takes the
    bare text between those children as tags.
    """

    # The class names of the posting pages.
    title: str = ".job-details__title"
    company: str = ".job-details__sub-title"
    tag_list: str = ".job-details__tag-list"
    paragraph: str = ".job-details__paragraph"
    text_tags: bool = False


class _PostingReader(HTMLParser):
    """Collects the text of the selected elements while the page streams through."""

    def __init__(self, selectors: PostingSelectors):
        super().__init__(convert_charrefs=True)
        self.selectors = selectors
        self.found: dict[str, list[list[str]]] = {"title": [], "company": [], "tag_list": [], "paragraph": []}
        self.tags: list[list[str]] = []
        # Open elements: name, texts that begin in them, tag list or not, and the place of the open
        # paragraph that a new one closes, or -1 beyond a block container or a selected element.
        self.stack: list[tuple[str, list[list[str]], bool, int]] = []
        self.open: dict[str, int] = {}
        self.texts: list[list[str]] = []
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        if tag == "p" and self.stack and self.stack[-1][3] >= 0:
            while len(self.stack) > self.stack[-1][3] + 1:
                self._pop()
            self._pop()
        classes = next((value or "" for name, value in attrs if name == "class"), "").split()
        texts, is_tag_list = [], False
        if self.stack and self.stack[-1][2]:
            self.tags.append([])
            texts.append(self.tags[-1])
        for field, hits in self.found.items():
            selector = getattr(self.selectors, field)
            hit = selector[1:] in classes if selector.startswith(".") else selector == tag
            if hit and (field == "paragraph" or not hits):
                hits.append([])
                texts.append(hits[-1])
                is_tag_list = is_tag_list or field == "tag_list"
        if tag not in _VOID:
            above = self.stack[-1][3] if self.stack else -1
            paragraph = len(self.stack) if tag == "p" else -1 if texts or tag not in _INLINE else above
            self.stack.append((tag, texts, is_tag_list, paragraph))
            self.open[tag] = self.open.get(tag, 0) + 1
            self.texts += texts
            self.hidden += tag in _HIDDEN

    def _pop(self):
        tag, texts, _, _ = self.stack.pop()
        self.open[tag] -= 1
        if texts:
            del self.texts[-len(texts):]
        self.hidden -= tag in _HIDDEN

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.open.get(tag):
            while self.stack[-1][0] != tag:
                self._pop()
            self._pop()

    def handle_data(self, data):
        if self.hidden:
            return
        if self.selectors.text_tags and self.stack and self.stack[-1][2]:
            self.tags.append([data])
        for text in self.texts:
            text.append(data)

    def fields(self) -> dict:
        def first(field):
            return "".join(self.found[field][0]) if self.found[field] else ""

        paragraphs = ["".join(text) for text in self.found["paragraph"]]
        sections = [*paragraphs[:2], *[""] * (2 - len(paragraphs)), "\n".join(paragraphs[2:])]
        return {
            "title": first("title"),
            "company": first("company"),
            "tags": ["".join(text) for text in self.tags],
            **dict(zip(_SECTIONS, sections)),
        }


def _read_posting(html: str | None, selectors: PostingSelectors) -> dict:
    if html is None:
        return {}
    reader = _PostingReader(selectors)
    try:
        reader.feed(html)
        reader.close()
    except AssertionError:
        # The standard parser gives up on some malformed declarations; keep what was read before.
        pass
    return reader.fields()


def _read_postings(pages: pa.Array, selectors: PostingSelectors) -> pa.Array:
    parts = [
        pa.array([_read_posting(page, selectors) for page in pages.slice(at, PAGE_ROWS).to_pylist()], type=_ARROW_TYPE)
        for at in range(0, len(pages), PAGE_ROWS)
    ]
    return pa.concat_arrays(parts) if parts else pa.array([], type=_ARROW_TYPE)


def extract_posting(html: Column, selectors: PostingSelectors = PostingSelectors()) -> Column:
    """Struct of title, tags, overview, requirement, benefit and company.

    Missing elements give empty values, a NULL page gives NULL fields. The third and all later
    paragraphs are the lines of the benefit. A new ``<p>`` closes an open one up to the nearest
    block container or selected element; one pass and one step per tag read a page. The session sends at most
    ``BATCH_ROWS`` rows to Python together from then on, so that a worker's memory does not grow with the table.
    """
    conf = SparkSession.active().conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) not in range(1, BATCH_ROWS + 1):
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    @F.arrow_udf(POSTING_SCHEMA)
    def read(pages: pa.Array) -> pa.Array:
        return _read_postings(pages, selectors)

    return read(html)
