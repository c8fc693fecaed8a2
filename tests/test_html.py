from statuta.functions import html as H


def test_table_with_and_without_headers():
    md, tables = H.to_markdown("<p>앞</p><table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td><b>2</b> 3</td></tr><tr><td> </td></tr></table>")
    assert md == "앞\n\n| a | b |\n| --- | --- |\n| 1 | 2 3 |"
    assert tables == [{"headers": ["a", "b"], "rows": [["1", "2 3"]]}]
    md, tables = H.to_markdown("<table><tr><td>1</td><td>2</td></tr></table>")
    assert tables == [{"headers": ["열1", "열2"], "rows": [["1", "2"]]}]


def test_nested_blocks_repeat_and_scripts_are_left_out():
    assert H.to_markdown("<div>가<p>나</p></div><script>x</script><style>p{}</style>")[0] == "가 나\n나"


def test_links_are_ordered_distinct_and_few():
    page = "<embed src='/e.pdf'><a href='a.PDF'>x</a><a href='/flDownload.do?1'>y</a><a href='a.PDF'>z</a><a href='/b'>n</a><iframe src='/f.pdf'></iframe>"
    assert H.content_links(page, "http://h/p/") == ["http://h/p/a.PDF", "http://h/flDownload.do?1", "http://h/e.pdf"]


def test_broken_and_empty_pages():
    for page in (None, "", "<", "<table><tr><td>x", "</p></div>", "<p>a<p>b"):
        H.to_markdown(page)
    assert H.to_markdown("<table><tr><td>x")[1] == [{"headers": ["열1"], "rows": [["x"]]}]
