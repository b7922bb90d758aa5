"""Main text of pages: given pages against their article, hand-made pages, awkward rows."""

import html
import re

import pytest

from quarry.llm import maintext

SF = "/root/testdata/sf0.01"


def article(page):
    """The blocks of the given pages' only article, read by its tags."""
    inner = re.search(r"<article>(.*)</article>", page, re.S).group(1)
    blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1|br)>", inner))
    return "\n\n".join(b for b in blocks if b)


def test_given_pages_whole(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    want = {r.page_id: article(r.html) for r in pages.collect()}
    got = maintext.extract(pages).collect()
    assert len(got) == len(want) and all(r.text == want[r.page_id] and r.n_chars == len(r.text) for r in got)


PARAGRAPHS = ["First paragraph of the story, long enough to tell it from a menu.", "Ok.",
              "The second one & its sign <b>, still part of the same story as before."]
STORY = "<h1>A title</h1>" + "".join(f"<p>{html.escape(p)}</p>" for p in PARAGRAPHS)
WANT = "\n\n".join(["A title", *PARAGRAPHS])
MENU = "<ul><li><a href='/a'>Home</a><li><a href='/b'>All the news of the day</a></ul>"


@pytest.mark.parametrize("page", [
    f"<header><h1>Site</h1></header><nav>{MENU}</nav><main>{STORY}</main><footer>© all rights</footer>",
    f"<div class='x1'>{MENU}</div><div class='x2'>{STORY}</div><div class='x3'><p>© 2020</p></div>",
    f"<body class='has-sidebar'><div id='cookie-notice'><p>We use cookies.</p></div><article>{STORY}</article>"
    "<section id='comments'><article class='comment'><p>Nice story, I liked it very much indeed.</p></article></section>",
    f"<form action='/'><input><main>{STORY}<form><p>Sign up</p></form></main></form><aside><p>Read this too</p></aside>",
    f"<article><header>{STORY}</header><div class='ad'>Buy <div>now</div></div><script>if (a<b) '</p>'</script></article>",
    f"<div role='navigation'>{MENU}</div><div><div>{STORY.replace('</p>', '')}</div></div><div hidden class=popup>x</div>",
    f"<article>{STORY}<style>p > a {{}}</style><!-- <p>no</p> --><textarea>no</textarea></article><p>outside",
])
def test_hand_made_pages(page):
    assert maintext.main_text(page) == WANT


def test_blocks_breaks_and_references():
    page = "<main><p>a&nbsp;b\n\t c<br>d&#233;&amp;amp;<br><br>e<td>f</td><p a='>'>g &lt;i&gt; &copy"
    assert maintext.main_text(page) == "a b c dé&amp;\n\ne\n\nf\n\ng <i> ©"


def test_awkward_rows(spark):
    long = "<p>" + "word " * 200_000 + "<p>end"
    rows = [(1, "u", None, "t"), (2, None, "", "t"), (None, "v", "<p>x", "t"), (3, "w", long, "t"), (3, "w", long, "t"),
            (4, "z", "<nav>" * 3000 + "never closed", "t"), (5, "q", "<p 'a=\"" * 2000, "t"), (6, "r", "no markup\n at all", "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((r.page_id or 0, r.url, r.text, r.n_chars) for r in maintext.extract(df).collect()), key=str)
    whole = ("word " * 200_000).strip() + "\n\nend"
    assert got == sorted([(1, "u", "", 0), (2, None, "", 0), (0, "v", "x", 1), (3, "w", whole, len(whole)),
                          (3, "w", whole, len(whole)), (4, "z", "", 0), (5, "q", "", 0),
                          (6, "r", "no markup at all", 16)], key=str)
    assert maintext.extract(df.limit(0)).collect() == []
