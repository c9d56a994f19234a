import time

import pyarrow as pa
from pyspark.sql import functions as F

from siltstone.functions import html
from siltstone.functions.html import PostingSelectors, _read_posting, extract_posting

PAGE = """
<div class="big job-details__title x">Data &amp; AI <b>Engineer</b></div>
<div class="job-details__sub-title">Acme</div>
<div class="job-details__tag-list"> <a>SQL</a> <a>C<i>#</i></a></div>
<div class="job-details__paragraph">overview <p>one<p>two<br>three</div>
<div class="job-details__paragraph">require<script>var x="</div>";</script><!-- note -->ment</div>
<div class="job-details__paragraph">benefit</div>
<div class="job-details__paragraph">ignored</div>
<div class="job-details__title">second title</div>
"""


def parse(spark, pages, selectors=PostingSelectors()):
    df = spark.createDataFrame([(i, page) for i, page in enumerate(pages)], "i int, html string")
    rows = df.select("i", extract_posting(F.col("html"), selectors).alias("p")).select("i", "p.*").collect()
    return [row.asDict() for row in sorted(rows, key=lambda row: row["i"])]


def test_fields(spark):
    assert parse(spark, [PAGE])[0] == {
        "i": 0, "title": "Data & AI Engineer", "tags": ["SQL", "C#"], "overview": "overview onetwothree",
        "requirement": "requirement", "benefit": "benefit\nignored", "company": "Acme",
    }


def test_missing_parts(spark):
    nothing, null, one = parse(spark, ["", None, '<p class="job-details__paragraph">only'])
    assert nothing == {
        "i": 0, "title": "", "tags": [], "overview": "", "requirement": "", "benefit": "", "company": "",
    }
    assert {value for name, value in null.items() if name != "i"} == {None}
    assert one["overview"] == "only" and one["requirement"] == ""


def test_tag_selectors_and_open_paragraphs(spark):
    page = "<title>T</title><h1>H</h1><ul><li>a</li><li><b>b</b></li></ul><p><b>one<br><p>two</p><p>three"
    got = parse(spark, [page], PostingSelectors("title", "h1", "ul", "p"))[0]
    assert (got["title"], got["company"], got["tags"]) == ("T", "H", ["a", "b"])
    assert (got["overview"], got["requirement"], got["benefit"]) == ("one", "two", "three")


def test_bare_text_between_tags(spark):
    page = '<div class="job-details__tag-list">x<a>SQL</a> <a>C#</a></div>'
    assert parse(spark, [page])[0]["tags"] == ["SQL", "C#"]
    assert parse(spark, [page], PostingSelectors(text_tags=True))[0]["tags"] == ["x", "SQL", " ", "C#"]


def test_malformed_markup_keeps_what_was_read(spark):
    got = parse(spark, ['<p class="job-details__title">ok</p><![if x]><p class="job-details__sub-title">c</p>', "<![x["])
    assert got[0]["title"] == "ok"
    assert got[1]["title"] == ""


def test_stray_end_tags(spark):
    got = parse(spark, ['</div></p><div class="job-details__title">a</b></span>b</div>c'])
    assert got[0]["title"] == "ab"


def read(html):
    return _read_posting(html, PostingSelectors())


def test_no_paragraph_is_lost():
    got = read("".join(f'<p class="job-details__paragraph">{n}</p>' for n in ("one", "two", "three", "four", "five")))
    assert (got["overview"], got["requirement"], got["benefit"]) == ("one", "two", "three\nfour\nfive")


def test_a_new_paragraph_leaves_selected_and_block_elements_open():
    got = read('<p>intro<div class="job-details__paragraph">text <p>more</div> out')
    assert got["overview"] == "text more"
    got = read('<p class="job-details__paragraph">one <b>bold<p class="job-details__paragraph">two')
    assert (got["overview"], got["requirement"]) == ("one bold", "two")


def test_reading_is_linear_in_unclosed_tags():
    def seconds(n):
        start = time.perf_counter()
        read("<div>x" * n)
        return time.perf_counter() - start

    assert seconds(16_000) < 2


def test_pages_go_to_python_a_few_at_a_time(spark):
    pages, sizes = pa.array([f"<title>{i}</title>" for i in range(120)] + [None]), []

    class Counted:
        def __len__(self):
            return len(pages)

        def slice(self, at, n):
            sizes.append(n)
            return pages.slice(at, n)

    selectors = html.PostingSelectors(title="title")
    read = html._read_postings(Counted(), selectors)
    assert [x["title"] for x in read.to_pylist()] == [*map(str, range(120)), None] and max(sizes) <= html.PAGE_ROWS
    assert len(html._read_postings(pages.slice(0, 0), selectors)) == 0
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    extract_posting(F.col("x"))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= html.BATCH_ROWS
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
