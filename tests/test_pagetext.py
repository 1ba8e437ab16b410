"""Text by element structure: expected lines are built from the parts that pages are made of."""

import random

import pytest

from tallyloom.operators.pagetext import readable

CASES = [
    ("<body><nav>a<nav>b</nav>c</nav>text</body>", "text"),
    ("<body>before<script>var t = '</p>' < 3;", "before"),
    ("<body><p>a < b and c > d</p>", "a < b and c > d"),
    ('<body><p title="x>y">one</p><a href=\'q>"r\'>two</a>', "one\ntwo"),
    ("<p>&eacute;&ouml;&frac12; &amp &lt;tag&gt; &notit; &#65;&#x42;", "éö½ & <tag> ¬it; AB"),
    ("<title>t</title><p>no body tag", "no body tag"),
    ("<html><head><title>t</title><style>p{}</style></head><body><article>a</article><main>m<article>x</article></main><main>second</main>", "m\nx"),
    ("<body><article>first</article>between<article>second</article>", "first"),
    ("<body><nav><main>hidden</main></nav><article>shown</article>", "shown"),
    ("<body><nav><div>x</nav>after", "after"),
    ("<body><div><nav>x</div>after", "after"),
    ("<body><nav><span>x</div>y</nav>after", "after"),
    ("<body><b>one<nav>x</b>y</nav>two", "one\ntwo"),
    ("<body>a</span>b</i>c", "abc"),
    ("<body>a<!-- c -->b<b>c</b>d<br>e", "a\nb\nc\nd\ne"),
    ("<body><main></main><article>text</article>", ""),
    ("<body><!-- <main>x</main> -->y", "y"),
    ("<BODY><HEADER>x</HEADER><P>Upper<P>case<NoScript>n</NoScript>", "Upper\ncase"),
    ("<ul><li>one<li>two<ul><li>in</ul><li>three</ul>", "one\ntwo\nin\nthree"),
    ("<table><tr><td>a<nav>x<td>b<tr><td>c</table>d", "a\nb\nc\nd"),
    ("<template><p>x</p></template>y", "y"),
    ("<p>line one\n  line two \n\n", "line one\nline two"),
    ("", ""),
    ("plain text", "plain text"),
]


@pytest.mark.parametrize(("html", "want"), CASES)
def test_cases(html, want):
    assert readable(html) == want


def test_pages_built_from_parts():
    rng = random.Random(2)
    for _ in range(300):
        want, html = [], ["<html><head><title>no</title></head><body>"]

        def build(depth, dropped):
            for _ in range(rng.randrange(1, 4)):
                kind = rng.choice(["text", "p", "div", "nav", "header", "script", "b", "comment", "open"])
                word = f"w{rng.randrange(1000)} <  {rng.randrange(9)}"
                if kind == "text":
                    # A text of its own: an element stands before it.
                    html.append(f"<i>{word}</i>")
                elif kind == "script":
                    html.append(f"<script>if (a </b> '{word}')</script>")
                    continue
                elif kind == "comment":
                    html.append(f"<!-- <nav> {word} -->")
                    continue
                elif kind == "open":
                    html.append(f'<p title="</nav>{word}">{word}')
                else:
                    html.append(f'<{kind} data-x=">">{word}')
                    if not (dropped or kind in ("nav", "header")):
                        want.append(word)
                    if depth < 4:
                        build(depth + 1, dropped or kind in ("nav", "header"))
                    html.append(f"</{kind}>")
                    continue
                if not dropped:
                    want.append(word)

        build(0, False)
        assert readable("".join(html)).split("\n") == [" ".join(w.split(" ")) for w in want] or not want


def test_frames(spark):
    from tallyloom.operators.pagetext import structured_texts

    pages = spark.createDataFrame([(1, "<p>a", "x"), (2, None, "y"), (3, "", "z"), (4, "<nav>" * 5000 + "deep", "w")], "page_id long, html string, main_text string")
    got = structured_texts(pages)
    assert got.columns == ["page_id", "main_text"]
    assert {tuple(r) for r in got.collect()} == {(1, "a"), (2, None), (3, ""), (4, "")}
    assert structured_texts(pages.limit(0)).count() == 0
