import pytest
from conftest import SF_CHECK

from rxcast.functions.markup import page_rows
from rxcast.operators import external as ex


@pytest.mark.parametrize("html, want", [
    (None, []),
    ("", []),
    ("<td>no row</td>", []),
    ("<table><tr><td>a<td>b<tr><td>c</table>", [["a", "b"], ["c"]]),  # nothing closed
    ("<table><tr><td>a</td><td>b", [["a", "b"]]),  # the page ends
    ("<table><tr><td>a<table><tr><td>in</td></tr></table>z</td><td>b</td></tr></table>", [["ainz", "in", "b"], ["in"]]),
    ("<table><tr><td>a<table><tr><td>in</table><td>b<tr><td>c</table>", [["ain", "in", "b"], ["in"], ["c"]]),
    ("<tr><td>1<!-- <td>no</td> -->2</td><td><script>x='<td>'</script>y</td><td><style>td{}</style></td></tr>", [["12", "y", ""]]),
    ("<TR CLASS='a>b'><TD\n>8-K &amp; A&#8211;&#x41;&eacute;&nbsp;</TD></TR>", [["8-K & A–Aé"]]),
    ("<tr><th>h</th></tr><tr></tr><tr><td> 1 <b> 2 </b></td></tr>", [[], [], ["12"]]),
    ("</td></tr><tr><td>a</tr></td><tr><td>b", [["a"], ["b"]]),  # ends without a beginning, in the wrong order
])
def test_odd_pages(html, want):
    assert page_rows(html) == want


def test_only_the_first_rows_and_whole_texts():
    assert page_rows("<tr><td>x" * 9) == [["x"]] * 5
    assert page_rows("<tr><td>x" * 9, max_rows=2) == [["x"]] * 2
    inner = "<tr><td>i" * 3000
    assert page_rows(f"<table><tr><td><table>{inner}</table><td>z</table>", max_rows=3) == [
        ["i" * 3000, *["i"] * 3000, "z"], ["i"], ["i"]]
    assert page_rows("<tr><td>" + "w " * 500_000)[0][0] == ("w " * 500_000).strip()


def test_lists_as_rows():
    html = "<ul><li>a<li>b<ul><li>c</ul>d</ul><ul><li>e</li></ul>"
    assert page_rows(html, "ul", "li") == [["a", "bcd", "c"], ["c"], ["e"]]


def test_pages_keep_their_keys(spark):
    pages = spark.createDataFrame([("k", "<tr>" + "<td>v" * 4), (None, "<tr>" + "<td>w" * 5), ("e", None), ("s", "<tr><td>1")],
                                  "page_id string, html string")
    assert sorted((r.page_id or "", r.row_idx, r.filing_type, r.filing_date) for r in ex.html_rows(pages).collect()) == [
        ("", 0, "w", "w"), ("k", 0, "v", "v")]
    assert ex.html_rows(pages.limit(0)).count() == 0
    whole = spark.read.parquet(f"{SF_CHECK}/pages.parquet")
    got = {(r.page_id, r.row_idx): (r.filing_type, r.filing_date) for r in ex.html_rows(whole, "ul", "li").collect()}
    want = {(r.page_id, i): (c[0], c[3]) for r in whole.collect() for i, c in enumerate(page_rows(r.html, "ul", "li")) if len(c) >= 4}
    assert got == want and got
