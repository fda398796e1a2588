import random

import pytest

from shelfcount.llm import page_diff as p

from ..conftest import SMALL


def lcs(a, b):
    size = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            size[i + 1][j + 1] = size[i][j] + 1 if x == y else max(size[i][j + 1], size[i + 1][j])
    return size[-1][-1]


def test_common_lines_against_a_table():
    rng = random.Random(1)
    for _ in range(2000):
        a = [rng.randrange(5) for _ in range(rng.randrange(14))]
        b = [rng.randrange(5) for _ in range(rng.randrange(14))]
        used = sorted(p.common_lines(a, b))
        rest = iter(b)
        assert len(used) == lcs(a, b) and all(a[k] in rest for k in used)
    long = list(range(3000))
    assert len(p.common_lines(long, long[::-1])) == 1 and len(p.common_lines([0, *long], [*long, 5])) == 3000


@pytest.mark.parametrize(
    "page, want",
    [
        ("", []),
        ("plain &lt;b&gt; &amp; &#233;&nbsp; x", ["plain <b> & é x"]),
        ("<p>a<br>b\n c<p>d</p>e", ["a b c", "d", "e"]),
        ("<nav><p>menu</p></nav><header>top</header>text<footer>end</footer>", ["text"]),
        ("<script>var x = '</p><p>no';</script><style>p{}</style><!-- <p>no</p> -->yes", ["yes"]),
        ("<div class='sidebar-left'><div>no</div>no</div><div class='lead'>yes</div>", ["yes"]),
        ("<div class=ad>no</div><div id=\"cookieNotice\">no</div><div role='navigation'>no</div><div hidden>no</div>yes", ["yes"]),
        ("<nav>menu <article><header><h1>T</h1></header><p>yes</p></article> after", ["T", "yes", "after"]),
        ("<article><p>yes</p><section class='comments'><article>no</article></section></article>", ["yes"]),
        ("<article><p>x &gt; y</p><aside>no</aside><form><p>no</p></form></article>", ["x > y"]),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", ["a", "b", "c", "d"]),
        ("a < b and <c", ["a < b and <c"]),
        ("<p title='a > b'>x</p><p title=\"broken>y</p>", ["x", "y"]),
        ("<script>never closed <p>no</p>", []),
        ("<p class='ad'>no<p>yes", ["yes"]),
        ("</p></div>x</body>", ["x"]),
    ],
)
def test_lines(page, want):
    assert [x for x, _ in p.page_lines(page)] == want


def test_long_and_broken_pages_end():
    for page in ("<a " * 50_000 + ">", "<" * 100_000, "<!--" * 50_000, "<div>" * 50_000 + "</x>" * 50_000, "<a \"" * 30_000 + ">", "<p>" * 50_000 + "x"):
        p.page_lines(page)


def read(html):
    """(line, inside the article) of the plain pages used here, by cutting at block tags."""
    import html as entities
    import re

    page = re.sub(r"(?s)<!--.*?-->|<(script|style|title|nav|footer)\b.*?</\1>|<div class=\"ad\">.*?</div>", "", html or "")
    out = []
    for k, part in enumerate(re.split(r"</?article>", page)):
        for line in re.split(r"</?(?:p|h1|div|ul|li|html|head|body|!DOCTYPE)(?:\s[^>]*)?>", part):
            line = " ".join(entities.unescape(re.sub(r"<[^>]*>", "", line.replace("<br>", " "))).split())
            if line:
                out.append((line, k % 2 == 1))
    return out


def shared(own, other):
    """Places of the lines of a longest common subsequence, by the full table."""
    size = [[0] * (len(other) + 1) for _ in range(len(own) + 1)]
    for i, x in enumerate(own):
        for j, y in enumerate(other):
            size[i + 1][j + 1] = size[i][j] + 1 if x == y else max(size[i][j + 1], size[i + 1][j])
    i, j, used = len(own), len(other), set()
    while i and j:
        if own[i - 1] == other[j - 1]:
            i, j = i - 1, j - 1
            used.add(i)
        elif size[i][j - 1] >= size[i - 1][j]:
            j -= 1
        else:
            i -= 1
    return used


def brute(rows):
    """Sort each host's distinct pages, compare neighbours, delete; nothing of the library is used."""
    import re

    hosts: dict = {}
    parsed = []
    for page, url, html in rows:
        m = re.match(r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", url or "")
        host = m[1].lower() if m else ""
        path = re.match("([^?#]*)", (url or "")[m.end() if m else 0 :])[1]
        found = tuple(read(html))
        pages = hosts.setdefault(host, {})
        pages[found] = min(path, pages.get(found, path))
        parsed.append((page, host, found))
    on: dict = {}
    for host, pages in hosts.items():
        for found in pages:
            for line in {x for x, _ in found}:
                on.setdefault(line, {}).setdefault(host, []).append(found)
    lost: dict = {}
    for host, pages in hosts.items():
        row = sorted(pages, key=lambda f: pages[f].encode())
        assert len({pages[f] for f in row}) == len(row)  # else the order of pages of one path is not known here
        for k, found in enumerate(row):
            own = [x for x, _ in found]
            marked = any(i for _, i in found)
            for j in (k - 1, k + 1):
                if not 0 <= j < len(row):
                    continue
                both = shared(own, [x for x, _ in row[j]])
                copy = len(both) > 0.8 * len(own)
                for at in both:
                    n = len(on[own[at]][host])
                    if marked:
                        gone = found[at][1] and n >= 5 and 2 * n >= len(row) and len(on[own[at]]) == 1
                    else:
                        gone = not copy or (n >= 5 and 10 * n >= len(row))
                    if gone:
                        lost.setdefault((host, found), set()).add(at)
    out = []
    for page, host, found in parsed:
        marked = any(i for _, i in found)
        text = [x for k, (x, i) in enumerate(found) if (i or not marked) and k not in lost.get((host, found), ())]
        out.append((page, "\n\n".join(text)))
    return out


def made(seed):
    rng = random.Random(seed)
    rows = []
    for k in range(160):
        host = "http://Hot.example/" if k % 3 else f"https://h{k % 5}.example/"
        body = "".join(f"<p>own {rng.randrange(10**9)}</p>" for _ in range(rng.randrange(1, 7)))
        body = "<div>Home</div><div>About us</div>" + body + "<div>All rights reserved</div>"
        if k % 10 == 0:
            body = f"<div>Home</div><article>{body}</article>"
        rows.append((k, f"{host}{rng.randrange(4)}/{rng.randrange(40)}/{k}?q={k}#x", f"<html><body>{body}</body></html>"))
    copy = "<p>one copied page</p><p>of two lines</p>"
    rows += [(200 + k, f"http://hot.example/1/{k:03d}", copy) for k in range(60)]
    rows += [(300, None, "<p>no url</p>"), (301, "odd", None), (302, "http://hot.example/", ""), (None, "http://hot.example/z", "<div>Home</div><p>only here</p>")]
    return rows + rows[:3]


def test_against_brute_force(spark):
    rows = made(5)
    df = spark.createDataFrame([(*r, "old") for r in rows], "page_id long, url string, html string, text string")
    out = p.main_text(df)
    assert out.columns == ["page_id", "url", "html", "text"]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = sorted(((r.page_id, r.text) for r in out.collect()), key=key)
    want = sorted(brute(rows), key=key)
    assert got == want
    text = dict(got)
    assert text[200] == "one copied page\n\nof two lines" and text[301] == "" and text[300] == "no url"
    plain = [t for i, t in got if i is not None and i < 160 and i % 10]
    assert sum("Home" not in t and "rights" not in t for t in plain) > 0.9 * len(plain)
    assert all("own" in t for t in plain)


def test_pages_table(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    got = {r.page_id: r for r in p.text_digest(pages).collect()}
    want = dict(brute([(r.page_id, r.url, r.html) for r in pages.collect()]))
    assert {k: r.text for k, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values()) and any(r.n_chars for r in got.values())
    assert p.text_digest(pages.limit(0)).count() == 0


def test_long_templates_and_copies(spark):
    template = [f"<div>template {k}</div>" for k in range(18)]
    rows = [(k, f"http://long.example/{k:03d}", "".join([*template[:9], f"<p>own {k}</p><p>text {k}</p>", *template[9:]])) for k in range(40)]
    body = "".join(f"<p>told {k}</p>" for k in range(60))
    page = "".join(template) + body
    rows += [(100 + k, f"http://long.example/020/{k}", page + f"<p>variant {k}</p>") for k in range(3)]
    rows += [(200 + k, f"http://two.example/{k}", body + f"<p>variant {k}</p>") for k in range(2)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    text = {r.page_id: r.text for r in p.main_text(df).collect()}
    assert all(text[k] == f"own {k}\n\ntext {k}" for k in range(40))
    told = "\n\n".join(f"told {k}" for k in range(60))
    assert all(text[100 + k] == f"{told}\n\nvariant {k}" for k in range(3))
    assert all(text[200 + k] == f"{told}\n\nvariant {k}" for k in range(2))


def test_templates_inside_marked_articles(spark):
    rows = []
    for k in range(30):
        host, common = ("one", "two")[k % 2], "<p>A saying that stands everywhere.</p>" if k % 3 else ""
        body = f"<h1>Title {k}</h1><p>Read our magazine {host}</p>{common}<p>own {k}</p><p>rare on {host}</p>" if k < 8 else f"<h1>Title {k}</h1><p>Read our magazine {host}</p>{common}<p>own {k}</p>"
        rows.append((k, f"http://{host}.example/{k:03d}", f"<html><body><div>Home</div><article>{body}</article></body></html>"))
    rows += [(100 + k, f"http://few.example/{k}", f"<article><p>own {k}</p><p>Read the few</p></article>") for k in range(4)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    text = {r.page_id: r.text for r in p.main_text(df).collect()}
    assert text == dict(brute(rows))
    for k in range(30):
        lines = text[k].split("\n\n")
        assert lines[0] == f"Title {k}" and f"own {k}" in lines and not any("magazine" in x for x in lines)
        assert ("A saying that stands everywhere." in lines) == bool(k % 3) and (k >= 8 or lines[-1].startswith("rare"))
    assert all(text[100 + k].endswith("Read the few") for k in range(4))
