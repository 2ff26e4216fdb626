from newsalpha.llm.wrappers import extract, infer, main_path, main_text, wrappers

SCHEMA = "page_id long, url string, html string"


def page(title, paragraphs, ad=True, comments=0):
    body = "".join(f"<p>{p}" for p in paragraphs)
    return (
        f"<!doctype html><html><head><title>{title}</title><script>var a = '<p>no</p>';</script></head><body>"
        "<nav><ul><li><a href=/>Home<li><a href=/x>Other</ul></nav>" + "<div class='ad box'>Buy <b>now</b></div>" * ad
        + f"<div id=content><h1>{title}</h1>{body}<table><tr><td>a<td>b &amp; c</table></div>"
        + "<div class=comments>" * bool(comments) + "<p>me too" * comments + "</div>" * bool(comments) + "<footer>&copy; all</footer></body></html>"
    )


def test_wrapper_has_slots_optional_and_repeated_groups():
    made = infer([page("one", ["a", "b"]), page("two", ["c"], ad=False), page("three", ["d", "e", "f"], comments=2)])
    body = next(i for i in next(i for i in made if i[0] == "html")[1] if i[0] == "body")[1]
    assert [(i[0], i[2]) for i in body] == [("nav!", "1"), ("div!", "?"), ("div", "1"), ("div!", "?"), ("footer!", "1")]
    assert [(i[0], i[2]) for i in body[2][1]] == [("h1", "1"), ("p", "+"), ("table", "1")]
    assert body[2][1][0][1] == [["#"]] and body[4][1] == [["=", "© all"]]
    assert main_path(made, 3) == ["html", "body", "div"]


def test_text_of_pages_without_marked_article(frame):
    pages = [(i, f"https://h.example/{i}", page(f"title {i}", [f"first  {i}\n", f"second {i}"], ad=i % 2, comments=i % 3)) for i in range(9)]
    rows = main_text(frame(pages, SCHEMA)).collect()
    assert {r.page_id: r.text for r in rows} == {i: f"title {i}\nfirst {i}\nsecond {i}\na\nb & c" for i in range(9)}


def test_marked_article_and_foreign_parts():
    html = """<main><article><header><h1>T &lt;1&gt;</h1></header><p class="lead">x<br>y <i>z</i>!</p><form><p>mail</form>
    <aside>side</aside><div class="cookie-notice">ok?</div><div id="comment-list"><p>hi</div><ul><li>one<li>two</ul><p>&nbsp;</p>end</article></main>"""
    assert extract(html, None) == "T <1>\nx y z!\none\ntwo\nend"


def test_containers_of_the_article_stay():
    html = "<body class='nav-open'><div class='with-sidebar'><div class=sidebar>x</div><article><p>text</article></div><div class=comments><article class=comment><p>me too</article></div>"
    assert extract(html, None) == "text"


def test_long_alternations_are_grouped_by_symbol():
    made = infer(["<div>" + "<h3>a</h3><p>b</p>" * n + "</div>" for n in (20_000, 30_000)])
    assert [(i[0], i[2]) for i in made[0][1]] == [("h3", "*"), ("p", "*")]


def test_deep_nesting():
    assert extract("<div>" * 5000 + "deep" + "</div>" * 5000 + "<span>" * 3000 + "text", None) == "deep\ntext"


def test_odd_pages(frame):
    pages = [
        (1, None, None), (2, "", ""), (None, "no address", "<p>text"), (3, "https://a.example", "plain words &amp; more"),
        (4, "https://a.example:80/x", "<"), (4, "https://a.example:80/x", "<"), (5, "HTTPS://A.example/y", "<p>" + "long " * 50_000),
        (6, "https://b.example", "</div></p>x<b>y"), (7, "https://b.example", "<!-- never closed <p>z"), (8, "https://b.example", "<script>no"),
    ]
    rows = main_text(frame(pages, SCHEMA)).collect()
    assert sorted(((r.page_id, r.text) for r in rows), key=str) == sorted([
        (1, ""), (2, ""), (None, "text"), (3, "plain words & more"), (4, "<"), (4, "<"), (5, ("long " * 50_000).strip()), (6, "xy"), (7, ""), (8, ""),
    ], key=str)
    assert main_text(frame([], SCHEMA)).collect() == []


def test_one_wrapper_a_host(frame):
    pages = frame([(i, f"https://h{i % 2}.example/{i}", page(str(i), ["p"])) for i in range(40)], SCHEMA)
    assert sorted(r.host for r in wrappers(pages).collect()) == ["h0.example", "h1.example"]


def test_every_template_of_a_host_has_a_wrapper(frame):
    def other(i):
        return f"<html><body><div><p>teaser {i}</p></div><section><p>article {i} <table><tr><td>cell</table></section></body></html>"

    pages = [(i, f"https://h.example/{i}", page(f"t {i}", [f"a {i}", f"b {i}"])) for i in range(40)]
    pages += [(40, "https://h.example/40", other(40)), (41, "https://g.example/41", other(41))]
    rows = {r.page_id: r.text for r in main_text(frame(pages, SCHEMA).repartition(7)).collect()}
    assert {i: rows[i] for i in range(40)} == {i: f"t {i}\na {i}\nb {i}\na\nb & c" for i in range(40)}
    assert rows[40] == "teaser 40\narticle 40\ncell" and rows[41] == "teaser 41\narticle 41\ncell"


def test_all_pages_of_a_template_take_part(frame):
    """Without marks or telling names, constant texts are left out; one page of 200 tells that a text varies."""
    def plain(i, lead):
        return f"<html><body><center>Home</center><div>{lead}</div><section><p>{i} first</p><p>{i} second</p></section></body></html>"

    pages = [(i, f"https://h.example/{i}", plain(i, "same lead")) for i in range(200)]
    rows = {r.page_id: r.text for r in main_text(frame(pages, SCHEMA).repartition(9)).collect()}
    assert rows == {i: f"{i} first\n{i} second" for i in range(200)}
    pages[77] = (77, "https://h.example/77", plain(77, "a lead of its own"))
    rows = {r.page_id: r.text for r in main_text(frame(pages, SCHEMA).repartition(9)).collect()}
    assert rows[77] == "Home\na lead of its own\n77 first\n77 second" and rows[5] == "Home\nsame lead\n5 first\n5 second"


def test_copies_and_shapes_in_any_order(frame):
    texts = [page(f"t {i % 7}", ["x"] * (1 + i % 3), ad=i % 2, comments=i % 4) for i in range(60)]
    made = [
        sorted(map(str, wrappers(frame([(i, "https://h.example", t) for i, t in enumerate(order)], SCHEMA).repartition(n)).collect()))
        for order, n in ((texts, 1), (texts[::-1], 5), (texts * 2, 11))
    ]
    assert made[0] == made[1] == made[2] and len(made[0]) == 1
    copies = [(i, "https://c.example", "<div><div>one</div><section><p>text</section></div>") for i in range(9)]
    assert {r.text for r in main_text(frame(copies, SCHEMA)).collect()} == {"one\ntext"}
