import pytest

from aspectra.llm.html import Page, best_path, host_paths, main_text


def own_text(page):
    p = Page(page)
    best = best_path(p.scores())
    return p.text(best) if best is not None else ""


PAGE = """<!DOCTYPE html><html><body class="has-sidebar"><header><h1>Site</h1><nav><a href=x>Home</a></nav></header>
<div class="wrap2"><div class="cookie-banner">We use cookies.</div><main><article class="post-{n}"><header><h1>Title &amp; {n}</h1>
<span class="byline">By X</span></header><p>One two<br>three <b>bold</b>, <a href="q>1">linked</a> text. {body}<p>Second&nbsp;para <span class="ad">BUY
<span>now</span></span> end.<div class="ad"><p>Advert</div><ul><li>a<li>b</ul><table><tr><td>c<td>d</table><form><input name=q>Search</form>
<!-- <p>gone</p> --><section class="comments"><p>Reader said hi</p></section><p style="display:none">x</p></article></main><aside><p>Side</p></aside></div>
<footer>&copy; x</footer><script>var a="<p>no</p>"</script></body></html>"""


def test_article_without_the_rest():
    assert own_text(PAGE.format(n=3, body="")) == "Title & 3\nOne two three bold, linked text.\nSecond para end.\na\nb\nc\nd"


@pytest.mark.parametrize("page", ["", "   ", "<html><head><title>t</title></head><body><nav>menu</nav></body></html>", "<script>only</script>", "<p"])
def test_no_text(page):
    assert own_text(page) == ""


def test_broken_markup():
    assert own_text("<p><b>One<br><p>Two &amp three &am<p>Fo") == "One\nTwo & three &am\nFo"
    assert own_text("<div><p>a < b and c > d</p><p class='x>y'>e</p></div><scr") == "a < b and c > d\ne"
    assert own_text("<article><p>kept</p></div></section><p>also</article>") == "kept\nalso"
    assert len(own_text("<div>" * 3000 + "deep")) == 4


def test_hosts_agree(spark):
    rows = [(i, f"https://One.example/{i}", f"<body><div class='c{i}'><p>{'text ' * 40}{i}</p></div><div class='box'><p>{'word ' * (90 if i == 5 else 9)}</p></div></body>") for i in range(12)]
    rows += [(20, "nohost", "<body><div class=box><p>alone</p></div></body>"), (21, None, None), (22, "https://two.example/", "")]
    pages = spark.createDataFrame([(*r, "h", "p") for r in rows], "page_id long, url string, html string, host string, path string")
    got = {r.page_id: r.text for r in main_text(pages).collect()}
    assert len(got) == 15 and got[20] == "alone" and got[21] == got[22] == ""
    for i in range(12):  # page 5 alone would have preferred its box
        assert got[i] == ("text " * 40 + str(i))
    joined = {r.page_id: r.text for r in main_text(pages, small=-1).collect()}  # winners joined, not sent
    assert joined == got
    assert [(r.host, r.label) for r in host_paths(pages).collect()] == [("one.example", "div.c")]
    assert main_text(pages.limit(0)).count() == 0
