import pytest

from loomwick.llm import html_extraction as op

LONG = "the cat and the dog were in the house with a bird that it was of no use to them " * 3
CASES = [
    (None, ""),
    ("", ""),
    ("plain text", "plain text"),
    ("<p>a &lt;b&gt; &amp;amp; &eacute;&#8364;</p>", "a <b> &amp; é€"),
    ("<article><p>one\n\t two&nbsp;three<br>four</p>five</article>", "one two three four five"),
    ("<nav>menu</nav><article><h1>T</h1><p>short<p>x</article><footer>f</footer>", "T short x"),
    ("<body><header><h1>Site</h1></header><main><header><h1>Title</h1></header><p>text</p></main>", "Title text"),
    ("<article><p>in</p><aside>side</aside><div class='reader-comments'><p>" + LONG + "</p></div><p>out</p></article>", "in out"),
    ("<article><p>a</p><div id=cookieNotice>we use</div><form><p>mail</p></form><p>b</p></article>", "a b"),
    ("<article>x<script>if (a < b) '</p>'</script>y<style>p{}</style>z<!-- <p>no</p> --></article>", "xyz"),
    ("<article>a<script>never closed <p>b</p>", "a"),
    ("<article><p>1 < 2 and <b>bold <i>text</p><p>next</b></p></article>tail", "1 < 2 and bold text next"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a b c d"),
    ("<article><p>text</p><ul><li><a href=x>some link list</a></li></ul></article>", "text"),
    ("<article><p>see <a href='a>b'>this</a> for more</p></article>", "see this for more"),
    ("<article><p>kept</p></article><div>Short line outside</div>", "kept"),
    ("<div class=ad>buy</div><p>" + LONG + "</p><p>short</p><div class='ad-slot'>now</div>", LONG.strip() + " short"),
    ("<p hidden>a</p><p style='display: none'>b</p><article>c</article>", "c"),
    ("<article><p>ok</p><a href=\"x>unclosed <p>more</p></article>", "ok unclosed more"),
    ("<article class='post with-sidebar'><p>kept</p></article>", "kept"),
    ("<article><p>loading</p><p class='shadow gradient header-text'>kept</p></article>", "loading kept"),
]


@pytest.mark.parametrize(("html", "text"), CASES)
def test_cases(html, text):
    assert op.extract(html) == text


def test_linear_on_hostile_pages():
    for part in ("<a ", "<p", "<!--", '<a "', "<div><p>", "</p>", "&", "<ul><li>"):
        op.extract(part * 20_000)


def test_query_columns(spark):
    df = spark.createDataFrame([(1, "u", "<article>né</article>", 5), (2, None, None, 5), (2, None, None, 5)], "page_id long, url string, html string, n_chars int")
    assert sorted(map(tuple, op.main_text(df).collect()), key=str) == sorted([(1, "u", "né", 2), (2, None, "", 0), (2, None, "", 0)], key=str)
    assert op.main_text(df.filter("false")).collect() == []
