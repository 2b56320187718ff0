import pytest

from loomwick.llm import html_extraction as op


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<article><p>a <svg class=icon/> b</p><p>c</p></article>", "a b c"),
        ("<article><p>a <math/> b</p><p>c <svg><path d=x /><title/></svg> d</p></article>", "a b c d"),
        ("<article><p>a</p><svg aria-hidden=true><path d=x><p>b</p></article>", "a b"),
        ("<article><p>area <math><mi>x</mi><mo>+</mo><mn>1</mn></math> end</p></article>", "area x+1 end"),
        ("<article><p>a</p><object data=x><p>fallback</p></object><p>b</p></article>", "a fallback b"),
        ("<article><p>a</p><object data=x><p>b</p></article>", "a b"),
        ("<article><p>a</p><noscript><p>shown without scripts</p></noscript><p>b</p></article>", "a shown without scripts b"),
        ("<article><p>a</p><xmp>x <b> y</xmp><p>b</p></article>", "a x <b> y b"),
        ("<article><p>a</p><select><option>one<option>two<p>b</p></article>", "a b"),
        ("<article><p>a</p><select><option>one<option>two</select><p>b</p></article>", "a b"),
    ],
)
def test_drawings_formulas_objects_and_choices(html, text):
    assert op.extract(html) == text
